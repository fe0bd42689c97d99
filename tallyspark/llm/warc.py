"""WARC archives: writing pages, and reading archives back by boundary-chain verification.

Writing: a record a page, uncompressed, by Spark's text writer with the records' closing blank lines as separator, so
archives come to any file system by Spark's commit protocol. Of pages with equal payloads, that with the
largest id is a response and the others are revisits of it. Equal payloads are found by the two-pass Bloom filter of
exact dedup over their digests: pages that are unique for sure are written where they were read, only the others move.

Reading: archives are split anywhere. Spark's text reader cuts them at the version line ("magic"), which may also
stand inside a payload. Each chunk gives a candidate: its offset and, by the length its header declares, the
offset of its successor. A record is real only if it is reached from its file's start. Chains are first
followed inside blocks of ``BLOCK`` bytes (candidate -> first offset past the block), then pointer jumping over the
blocks of each file, ceil(log2(blocks)) rounds, finds where the chain enters every block, and a walk from
there marks the real records. Candidates off the chain are parts of payloads, which are put together from their chunks.

Only offsets, lengths and header fields move; payloads are hashed where they are read. The chunks of payloads that hold
the magic are read again, by their hash, and only those are moved.

Defined results. Null html: an empty payload. Null url: no target. Null id: the record has no number, and never is chosen over
one that has. Rows that repeat id and payload: all are responses. Empty table: no records. Other columns are ignored.
A chain that breaks (a declared length that leads to no record) ends its file's records there; ``complete`` tells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import all_salts, materialise, salted
from .exact_dedup import filter_bits, flag_repeated, repeated_cells

MAGIC = "WARC/1.1\r\n"
BLOCK = 64 << 20
MIN_BYTES = 0
_URN = "urn:tallyspark:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BIN = 64 << 10  # width of the bins in which chunks meet the records they are parts of


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 in base 32: each 10 hex digits are 8 base-32 digits, then from the digits 0-9A-V to the alphabet A-Z2-7."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields])


def write_warc(spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` as archives into the new folder ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.regexp_replace(F.col(url_col), r"[\r\n]", "").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", base32_sha1("payload"))
    found = materialise(spark, rows.select("id", "digest", F.octet_length("payload").alias("size")), "warc-digests")
    large = found.where(F.col("size") >= min_bytes)
    bits = filter_bits(found.count())
    bitmaps = materialise(spark, repeated_cells(large, "digest", bits), "warc-filter")
    groups = (flag_repeated(large, "digest", bitmaps, bits, "repeated").where("repeated")
              .groupBy("digest").agg(F.max("id").alias("first")))
    flagged = flag_repeated(rows, "digest", bitmaps, bits, "repeated")
    flagged = flagged.withColumn("repeated", F.col("repeated") & (F.octet_length("payload") >= min_bytes))
    once = flagged.where(~F.col("repeated")).withColumn("first", F.lit(None).cast("long"))
    again = (salted(flagged.where("repeated"), "salt", F.col("id")).join(all_salts(groups, "salt"), ["digest", "salt"])
             .withColumn("first", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))))
    columns = ["id", "url", "payload", "digest", "first"]
    every = once.select(*columns).unionByName(again.select(*columns))
    revisit = F.col("first").isNotNull()
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size,
                    F.lit("\r\n\r\n")).cast("binary")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(F.lit(MAGIC), _lines(
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.concat(F.lit(f"<{_URN}"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Refers-To", F.concat(F.lit(f"<{_URN}"), F.col("first").cast("string"), F.lit(">"))),
        ("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string"))), F.lit("\r\n")).cast("binary")
    every.select(F.concat(head, block).cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def _field(header: str, name: str) -> Column:
    return F.regexp_extract(F.col(header), rf"(?mi)^{name}:[ \t]*([^\r\n]*)", 1)


def _payload(block: Column, http: Column) -> Column:
    """What follows the HTTP header, if the block has one."""
    head = F.octet_length(F.substring_index(block.cast("string"), "\r\n\r\n", 1))
    return F.when(http, F.substring(block, head + 5, F.greatest(F.octet_length(block) - head - 4, F.lit(0)))).otherwise(block)


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """The archives' bytes, cut at each magic."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per chunk: file, offset, next (the declared successor; null if the header is none), len, chunk (its SHA-1),
    whole (the chunk ends where its record does) and the header's fields."""
    body = F.col("value").cast("binary")
    parsed = (_raw(spark, path).withColumn("at", F.monotonically_increasing_id())
              .withColumn("header", F.concat(F.substring_index("value", "\r\n\r\n", 1), F.lit("\r\n")))
              .withColumn("head", F.octet_length("header").cast("long") + 2)
              .withColumn("len", F.octet_length("value").cast("long"))
              .withColumn("content", F.expr("try_cast(regexp_extract(header, '(?mi)^Content-Length:[ \\\\t]*([0-9]+)[ \\\\t]*\\r?$', 1) AS long)"))
              .withColumn("whole", F.coalesce(F.col("len") == F.col("head") + F.col("content") + 4, F.lit(False)))
              .withColumn("http", _field("header", "Content-Type").startswith("application/http")))
    block = F.substring(body, F.col("head").cast("int") + 1, F.col("content").cast("int"))
    payload = _payload(block, F.col("http"))
    fields = parsed.select(
        "file", "split", "at", "len", "head", "content", "whole", "http", F.sha1(body).alias("chunk"),
        F.lower(_field("header", "WARC-Type")).alias("record_type"), _field("header", "WARC-Record-ID").alias("record_id"),
        _field("header", "WARC-Target-URI").alias("uri"), _field("header", "WARC-Refers-To").alias("refers"),
        F.regexp_extract(_field("header", "WARC-Payload-Digest"), "(?i)^sha1:(.*)", 1).alias("declared"),
        F.when(F.col("whole"), F.octet_length(payload).cast("long")).alias("payload_bytes"),
        F.when(F.col("whole"), base32_sha1(payload)).alias("payload_digest"))
    chunks = materialise(spark, fields, "warc-chunks")
    step = F.col("len") + F.lit(len(MAGIC))
    splits = chunks.groupBy("file", "split").agg(F.sum(step).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    base = splits.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.col("offset") + F.lit(len(MAGIC)) + F.col("head") + F.col("content") + 4
    placed = (chunks.withColumn("run", F.coalesce(F.sum(step).over(inside), F.lit(0))).join(base, ["file", "split"])
              .withColumn("offset", F.col("base") + F.col("run") - F.lit(len(MAGIC)))
              .withColumn("next", F.when(F.col("head") <= F.col("len"), ends)).drop("split", "at", "run", "base"))
    return materialise(spark, placed.where("offset >= 0"), "warc-candidates")


def _follow(group, block: int):
    """Inside one block: where each candidate's chain first leaves it (-1: it breaks off)."""
    offsets, nexts = group["offset"].tolist(), group["next"].tolist()
    known, end = {}, (offsets[0] // block + 1) * block
    for o, n in sorted(zip(offsets, nexts, strict=True), reverse=True):
        known[o] = -1 if n is None or n != n or n <= o else int(n) if n >= end else known.get(int(n), -1)
    return group[["file", "offset"]].assign(exit=[known[o] for o in offsets])


def reachable(spark: SparkSession, links: DataFrame, block: int = BLOCK) -> DataFrame:
    """(file, offset) of the records on the chain from each file's start. ``links``: file, offset, next."""
    links = links.select("file", "offset", "next", F.floor(F.col("offset") / block).cast("long").alias("block"))
    blocks = (links.agg(F.max("block")).first()[0] or 0) + 1
    exits = links.groupBy("file", "block").applyInPandas(lambda g: _follow(g, block), "file string, offset long, exit long")
    reached = links.select("file").distinct().select("file", F.lit(0).cast("long").alias("offset"))
    if blocks > 1:
        exits = materialise(spark, exits, "warc-exits")
        entries = exits.select("file", F.col("exit").alias("offset")).unionByName(reached).distinct()
        jump = materialise(spark, exits.join(entries, ["file", "offset"], "left_semi").where("exit >= 0"), "warc-jump")
        for _ in range((blocks - 1).bit_length()):
            step = reached.join(jump, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
            reached = materialise(spark, reached.unionByName(step).distinct(), "warc-reached")
            on = jump.select("file", F.col("offset").alias("exit"), F.col("exit").alias("further"))
            jump = materialise(spark, jump.join(on, ["file", "exit"]).select("file", "offset", F.col("further").alias("exit")),
                               "warc-jump")
    starts = reached.select("file", F.floor(F.col("offset") / block).cast("long").alias("block"), F.col("offset").alias("entry"))

    def walk(group):
        following = dict(zip(group["offset"].tolist(), group["next"].tolist(), strict=True))
        at, found = int(group["entry"].iloc[0]), []
        while at in following:
            found.append(at)
            after = following[at]
            if after is None or after != after or after <= at:
                break
            at = int(after)
        return group[["file", "offset"]][group["offset"].isin(found)]

    return links.join(starts, ["file", "block"]).groupBy("file", "block").applyInPandas(walk, "file string, offset long")


def _assembled(spark: SparkSession, path: str, broken: DataFrame, chunks: DataFrame) -> DataFrame:
    """(file, offset, value) of records whose payload holds the magic, from the chunks that lie in them."""
    bins = F.explode(F.sequence(F.floor(F.col("start") / _BIN), F.floor((F.col("end") - 1) / _BIN)))
    spans = broken.select("file", F.col("offset").alias("start"), F.col("next").alias("end")).withColumn("bin", bins)
    parts = (chunks.select("file", "offset", "chunk").withColumn("bin", F.floor(F.col("offset") / _BIN))
             .join(spans, ["file", "bin"]).where("offset >= start AND offset < end")
             .select("file", "start", "offset", "chunk"))
    parts = materialise(spark, parts, "warc-parts")
    values = (_raw(spark, path).select("file", F.sha1(F.col("value").cast("binary")).alias("chunk"), "value")
              .join(parts.select("file", "chunk").distinct(), ["file", "chunk"], "left_semi").dropDuplicates(["file", "chunk"]))
    return (parts.join(values, ["file", "chunk"]).groupBy("file", F.col("start").alias("offset"))
            .agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("parts"))
            .select("file", "offset", F.array_join("parts.value", MAGIC).alias("value")))


def read_warc(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """One row per record: file, offset, record_type, record_id, uri, refers, payload_bytes, payload_digest (of the bytes
    read) and complete (the record has the length it declares, and the digest if it declares one)."""
    chunks = candidates(spark, path)
    real = chunks.join(materialise(spark, reachable(spark, chunks, block), "warc-real"), ["file", "offset"])
    columns = ["file", "offset", "record_type", "record_id", "uri", "refers", "declared", "payload_bytes", "payload_digest"]
    found = real.where("whole").select(*columns)
    broken = materialise(spark, real.where("NOT whole"), "warc-broken")
    if broken.count():
        content = F.substring(F.col("value").cast("binary"), F.col("head").cast("int") + 1, F.col("content").cast("int"))
        joined = _assembled(spark, path, broken, chunks).join(broken, ["file", "offset"]).withColumn("block", content)
        payload = _payload(F.col("block"), F.col("http"))
        ends = F.octet_length("block") == F.col("content")
        mended = joined.withColumn("payload_bytes", F.when(ends, F.octet_length(payload).cast("long"))).withColumn(
            "payload_digest", F.when(ends, base32_sha1(payload)))
        found = found.unionByName(mended.select(*columns))
    own = F.col("record_type").isin("revisit") | (F.col("declared") == "") | (F.col("declared") == F.col("payload_digest"))
    return found.withColumn("complete", F.coalesce(own & F.col("payload_bytes").isNotNull(), F.lit(False)))


def _number(record: Column) -> Column:
    return F.regexp_extract(record, f"<{_URN}(-?[0-9]+)>", 1).try_cast("long")


def resolved(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit has the payload of the response
    it refers to, found by joining on the record's number (a response referred to by very many is a hot key on one side
    of a plain join, which AQE splits)."""
    rows = materialise(spark, records.withColumn("page_id", _number(F.col("record_id")))
                       .withColumn("refers_to", _number(F.col("refers"))), "warc-records")
    own = rows.where("record_type = 'response'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"]
    targets = own.where("page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared"), F.col("payload_bytes").alias("bytes"))
    again = rows.where("record_type = 'revisit'").join(targets.dropDuplicates(["refers_to", "declared"]),
                                                       ["refers_to", "declared"], "left")
    again = again.select("page_id", F.col("bytes").alias("payload_bytes"),
                         F.when(F.col("bytes").isNotNull(), F.col("declared")).alias("payload_digest"), "record_type",
                         "refers_to", F.col("bytes").isNotNull().alias("complete"))
    return own.select(*columns).unionByName(again.select(*columns))
