"""Surrogates for personal data: detected entities get keyed replacements of the same type, format, script and gender.

* Detection: e-mail and IP addresses, long (card) numbers, phone numbers, social security numbers, IBANs, access keys, values
  of passwords and tokens; persons after a title, or by a known given name before a capitalised surname.
* An entity is (type, canonical value): digits without separators, addresses in lower case, given name and surname each on
  their own. Its surrogate follows from a keyed hash (HMAC) of both and an attempt number, so the same
  entity gets the same surrogate in every document, in the format of each mention: "Mr Smith" and "John Smith" share a surname.
* Formats: digits for digits, letters for letters of the same case, separators and prefixes kept; card numbers keep length,
  first digit and validity of the check digit; IBANs keep the country and get right check digits; private and
  loopback IP ranges stay such; given names keep gender and script, surnames script and gendered ending.
* Entities are replaced whole, however long: no mention is cut to a matched prefix.
* Collisions: of all distinct entities of the corpus, those whose surrogate another entity also got (all but one), or
  whose surrogate is an entity of the corpus itself, draw again, until none is left. The draws beyond the first are the
  exceptions; documents that mention one carry its attempt number, all other documents are rewritten where they are read.
  Given names come from fixed lists and move on along their list; they are kept distinct among themselves only.
* Full spaces: after each ``TRIES`` attempts an entity's surrogate gets one more character (192.168 addresses go on to 10.*,
  addresses at last to IPv6 of the private or documentation range), so every entity comes to a space with room for it.
* Masks: a value of a password without letter or digit and of at most two different characters (``********``, ``------>``) is
  none, and stays; other values of symbols alone get symbols.

Texts are read twice, and moved only if a great many documents mention exceptions. Distinct entities are combined before the
shuffle, so an entity in a third of all documents costs one row a task.

Defined results. Null text: stays null, nothing replaced. Empty text, or without entities: unchanged. Null id: carried along.
Repeated rows: one row each, equal results. Empty table: empty result. Other columns are ignored. Texts of any length
are handled whole.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_small, materialise, small_batches

KEY = b"tallyspark surrogate key"  # a deployment passes its own
#: Attempts in a space of surrogates before it is widened.
TRIES = 4
_SYMBOLS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"

# FIXED VALUES: common given names by script and gender, titles by gender
GIVEN = {
    ("latin", "f"): "Anna Maria Laura Julia Sophie Emma Clara Elena Alice Marie Lucia Carmen Sabine Monika Mary Susan Linda "
                    "Patricia Jennifer Elizabeth Barbara Margaret Sarah Karen Nancy Helen Sandra Claire Camille Isabel".split(),
    ("latin", "m"): "John Peter Thomas Martin Paul David Michael Robert James William Richard Charles Joseph Daniel Mark "
                    "George Steven Edward Brian Kevin Hans Klaus Jean Pierre Jacques Carlos Juan Miguel Pablo Luis".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Александр Сергей Дмитрий Андрей Алексей Михаил Николай Владимир Павел".split(),
}
TITLES = {"f": "Mrs Ms Miss Frau Mme Madame Señora Sra Госпожа Г-жа".split(),
          "m": "Mr Herr Monsieur Señor Sr Господин Г-н".split(), "": "Dr Prof".split()}

_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_TITLE = {t: g for g, names in TITLES.items() for t in names}


def _capitals() -> str:
    """The upper and title case letters of all scripts, as ranges of a character class."""
    ranges: list[list[int]] = []
    for c in range(0x20000):
        if unicodedata.category(chr(c)) in ("Lu", "Lt"):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


# A surname of any letters, whole: McDonald, Smith-Jones, O'Brien, SMITH, van der Berg; without the 's of a possessive, and
# no Roman numeral after a given name.
_LETTERS = r"(?:[^\W\d_]|[\u0300-\u036f])++"
_JOINED = rf"(?:[-\u2010\u2011]{_LETTERS}|['\u2019\u02bc](?!(?i:s|d|m|t|ll|ve|re)(?![^\W\d_])){_LETTERS})"
_PARTICLES = r"(?:(?:[Vv][ao]n|[Dd](?:e[nr]?|ella?|[aiou]s?)|[Ll][ae]|[Tt]e[nr]|[Zz]u[mr]?|[Ss]t\.?|El) )*+"
_CAP = rf"{_PARTICLES}[{_capitals()}](?:{_LETTERS}{_JOINED}*+|{_JOINED}++)"
_LAST = rf"(?![IVX]+\b){_CAP}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What a text must hold to be looked at closely.
_TRIGGER = re.compile(r"[0-9@]|(?i:password|passwd|pwd|token|secret|api[_-]?key)\s*[:=]|"
                      rf"\b(?:{'|'.join([*_TITLE, *_GENDER])})\b")
#: The same for Arrow, which passes over whole batches: at least the texts with a trigger. Its word bounds are those of ASCII, and it folds no Turkish i.
_ROUGH = (r"[0-9@]|(?i:password|passwd|pwd|token|secret|ap[i\x{130}\x{131}][_-]?key)[\x09-\x0d\x1c-\x20\x{85}\pZ]*[:=]|"
          + "|".join((r"\b" if w[0].isascii() else "") + w + (r"\b" if w[-1].isascii() else "") for w in [*_TITLE, *_GENDER]))
# inside a word, entities begin at digits only
_ENTITY = re.compile(r"(?!(?<=\w)\D)(?:" + "|".join([
    r"(?P<email>(?<![\w.%+-])[\w.%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}\b)",
    r"(?P<key>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:gh[pousr]_[A-Za-z0-9]{30}|sk-[A-Za-z0-9]{20})[A-Za-z0-9_-]*+)",
    r"(?:(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key))\s{0,3}[:=]\s{0,3}[\"']?(?P<secret>[^\s\"']{6,}+))",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)",
    rf"(?=[\d+(])(?:(?P<ip>(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d))",
    r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
    r"(?P<card>(?<![\d+.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\d))",
    r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?![.-]?\d)"
    r"|(?<![\w+])\(\d{2,4}\) ?\d{3,4}[ .-]?\d{3,4}(?![.-]?\d)|(?<![\w+.-])(?:\d{2,4}(?P<sep>[.-])\d{3,4}(?P=sep)\d{3,4}|\d{3} \d{3} \d{4})(?![\d.-]\d|\d)))",
    rf"(?:\b(?P<title>{'|'.join(_TITLE)})\b\.? (?P<one>{_CAP})(?: (?P<two>{_LAST}))?)",
    rf"(?:\b(?P<given>{'|'.join(_GENDER)}) (?P<surname>{_LAST}))",
]) + ")")
_KINDS = ("email", "key", "secret", "iban", "ip", "ssn", "card", "phone", "title", "given")
_WORD = {"latin": "an ber cor dal el fin gar hol ir kel lan mor nel or pel ren sal tor ul ven wal".split(),
         "cyrillic": "ан бер вол гор дан ел зим кор лав мор нев ор пол рад сев тар ул чер".split()}


def script_of(word: str) -> str:
    return "cyrillic" if "\u0400" <= word[:1] <= "\u04ff" else "latin"


def _surname(mention: str) -> str:
    """A surname in capitals is the same one."""
    return mention.title() if mention.isupper() else mention


def entities(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, type, canonical value, mention) of a text, in order, without overlaps."""
    if not _TRIGGER.search(text):
        return []
    found = []

    def add(match, group, kind, value=None):
        mention = match[group]
        found.append((match.start(group), match.end(group), kind, value or mention, mention))

    for m in _ENTITY.finditer(text):
        kind = next(k for k in _KINDS if m[k])
        if m["title"] or m["given"]:
            first, last = (m["one"], m["two"]) if m["title"] else (m["given"], m["surname"])
            names = ("one", "two") if m["title"] else ("given", "surname")
            if first in _GENDER:
                add(m, names[0], f"given-{'-'.join(_GENDER[first])}")
            elif m["title"]:  # a surname stands right after the title; what follows isn't part of the name
                add(m, names[0], f"surname-{script_of(first)}", _surname(first))
                last = None
            if last:
                add(m, names[1], f"surname-{script_of(last)}", _surname(last))
        elif kind in ("card", "phone", "ssn"):
            digits = re.sub(r"\D", "", m[0])
            if kind != "phone" or len(digits) >= 8:
                add(m, kind, kind, digits)
        elif kind == "iban":
            plain = m[0].replace(" ", "")
            if 15 <= len(plain) <= 34:
                add(m, kind, kind, plain)
        elif kind != "secret" or not _mask(m[kind]):
            add(m, kind, kind, m[kind].lower() if kind == "email" else None)
    return found


def _mask(value: str) -> bool:
    """A masked value, a rule or an arrow: nothing that could be kept secret."""
    return len(set(value)) <= 2 and not any(c.isalnum() for c in value)


class _Draw:
    """An endless keyed stream of numbers."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.seed, self.block, self.bytes = key, f"{kind}\0{value}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.bytes) < 4:
            self.bytes += hmac.new(self.key, self.seed + b"\0%d" % self.block, hashlib.sha256).digest()
            self.block += 1
        number, self.bytes = int.from_bytes(self.bytes[:4], "big"), self.bytes[4:]
        return number % n

    def like(self, c: str) -> str:
        """A character of the same class."""
        if "0" <= c <= "9":
            return str(self.below(10))
        for first, last in ("az", "AZ", "ая", "АЯ"):
            if first <= c <= last:
                return chr(ord(first) + self.below(ord(last) - ord(first) + 1))
        if c.isdecimal():
            return chr(ord(c) - unicodedata.decimal(c) + self.below(10))
        return chr(ord("a") + self.below(26)) if c.isalnum() else c

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))

    def letters(self, n: int) -> str:
        return "".join(chr(ord("a") + self.below(26)) for _ in range(n))


def _check_digit(digits: str) -> int:
    """The last digit that makes ``digits`` + it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _iban(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{country}{98 - number % 97:02d}{rest}"


def surrogate(kind: str, value: str, attempt: int = 0, key: bytes = KEY) -> str:
    """The canonical surrogate of an entity."""
    draw, wider = _Draw(key, kind, value, attempt), attempt // TRIES
    if kind.startswith("given-"):
        names = GIVEN[tuple(kind.split("-")[1:])]
        start = 1 + _Draw(key, "given", kind, 0).below(len(names) - 1)  # the list moved on by a keyed step: one to one
        return names[(names.index(value) + start + attempt) % len(names)]
    if kind.startswith("surname-"):
        parts = _WORD[kind.split("-")[1]]
        stem = "".join(parts[draw.below(len(parts))] for _ in range(2 + attempt // 4 + draw.below(2)))
        ends = re.search(r"(?:ova|eva|ов|ова|ев|ева|ский|ская|ин|ина)$", value)
        return (stem + (ends[0] if ends else "")).capitalize()
    if kind == "email":
        user, domain = value.split("@")
        keyed = _Draw(key, "domain", domain, 0)
        *labels, top = domain.split(".")
        return "".join(map(draw.like, user)) + draw.letters(wider) + "@" + ".".join("".join(map(keyed.like, x)) for x in labels) + "." + top
    if kind == "ip":
        first, second, *_ = value.split(".")
        private = {"10": 1, "127": 1}.get(first) or (2 if (first, second) == ("192", "168") else 0)
        if wider > 1:
            groups = [f"{draw.below(1 << 16):x}" for _ in range(7 if private else 6)]
            return ":".join([f"fd{draw.below(256):02x}"] if private else ["2001", "db8"]) + ":" + ":".join(groups)
        kept = ["10"] if wider and private == 2 else value.split(".")[:private]
        own = [str(1 + draw.below(223))] if not private else []
        if own in (["10"], ["127"], ["192"], ["172"]):
            own = [str(int(own[0]) + 1)]
        return ".".join([*kept, *own, *[str(draw.below(256)) for _ in range(4 - len(kept) - len(own))]])
    if kind == "card":
        body = value[0] + draw.digits(len(value) - 2 + wider)
        right = _check_digit(body)
        valid = _check_digit(value[:-1]) == int(value[-1])
        return body + str(right if valid else (right + 1 + draw.below(9)) % 10)
    if kind in ("phone", "ssn"):
        digits = [str(draw.below(10)) for _ in value]
        return "".join(c if c != "0" or v == "0" else "7" for c, v in zip(digits, value, strict=True)) + draw.digits(wider)
    if kind == "iban":
        return _iban(value[:2], "".join(map(draw.like, value[4:])) + draw.digits(wider))
    if kind == "key":
        kept = re.match(r"AKIA|ASIA|gh[pousr]_|sk-", value)[0]
        return kept + "".join(map(draw.like, value[len(kept):])) + draw.letters(wider)
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value)
    if hexadecimal:
        digits = "0123456789ABCDEF" if value.upper() == value and value.lower() != value else "0123456789abcdef"
        return "".join(digits[draw.below(16)] for _ in range(len(value) + wider))
    if not any(c.isalnum() for c in value):
        return "".join(_SYMBOLS[draw.below(len(_SYMBOLS))] for _ in range(len(value) + wider))
    return "".join(map(draw.like, value)) + draw.letters(wider)


def rendered(canonical: str, kind: str, mention: str) -> str:
    """The surrogate in the format of the mention."""
    if kind == "iban":
        left = iter(canonical)
        return "".join(c if c == " " else next(left) for c in mention) + "".join(left)
    if kind in ("card", "phone", "ssn"):
        left = iter(canonical)
        return "".join(next(left) if "0" <= c <= "9" else c for c in mention) + "".join(left)
    if kind.startswith("surname-") and mention.isupper():
        return canonical.upper()
    if kind == "email":
        user, domain = mention.split("@")
        new_user, new_domain = canonical.split("@")
        return "@".join("".join(n.upper() if o.isupper() else n for o, n in zip_longest(old, new, fillvalue=""))
                        for old, new in ((user, new_user), (domain, new_domain)))
    return canonical


def rewrite(text: str, attempts: dict, key: bytes = KEY) -> tuple[str, int, str]:
    """The text with surrogates, the number of mentions, their types. ``attempts``: by (type, value), where not 0."""
    found = entities(text)
    if not found:
        return text, 0, ""
    out, at = [], 0
    for start, end, kind, value, mention in found:
        out += [text[at:start], rendered(surrogate(kind, value, attempts.get((kind, value), 0), key), kind, mention)]
        at = end
    out.append(text[at:])
    return "".join(out), len(found), ",".join(sorted({f[2] for f in found}))


def _close(texts: pa.Array) -> np.ndarray:
    """The numbers of the texts to be looked at closely: all with a trigger are among them."""
    return np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, _ROUGH), False).to_numpy(zero_copy_only=False))


def _mentions(docs: DataFrame, text: Column, marks: list[Column]) -> DataFrame:
    """Distinct (m1, m2, kind, value) of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            rows = [(i, *e) for i in _close(texts).tolist() for e in sorted({(k, v) for _, _, k, v, _ in entities(texts[i].as_py())})]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("m1").take(at), batch.column("m2").take(at),
                                              pa.array([r[1] for r in rows], pa.string()),
                                              pa.array([r[2] for r in rows], pa.string())], names=["m1", "m2", "kind", "value"])

    rows = docs.where(text.isNotNull()).select(marks[0].alias("m1"), marks[1].alias("m2"), text.alias("text"))
    return rows.mapInArrow(run, "m1 long, m2 long, kind string, value string")


def assign(spark: SparkSession, found: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, value, attempt, surrogate) of the distinct entities ``found`` (kind, value), without collisions."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(c).to_pylist() for c in ("kind", "value", "attempt")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([surrogate(*x, key) for x in zip(*given, strict=True)],
                                                                       pa.string())], names=["kind", "value", "attempt", "surrogate"])

    schema = "kind string, value string, attempt int, surrogate string"
    drawn = materialise(spark, found.withColumn("attempt", F.lit(0)).mapInArrow(draw, schema), "surrogates")
    while True:
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("first"))
        real = (found.where("kind NOT LIKE 'given-%'")
                .select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real")))
        told = (drawn.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
                .withColumn("again", (F.col("value") != F.col("first")) | F.coalesce("real", F.lit(False))))
        told = materialise(spark, told.select("kind", "value", "attempt", "surrogate", "again"), "surrogates")
        if told.where("again").isEmpty():
            return drawn
        redrawn = told.where("again").select("kind", "value", (F.col("attempt") + 1).alias("attempt")).mapInArrow(draw, schema)
        drawn = materialise(spark, told.where("NOT again").drop("again").unionByName(redrawn), "surrogates")


def replace_personal_data(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          key: bytes = KEY) -> DataFrame:
    """One row per document: ``id_col``, ``text_col`` with surrogates, n_replaced, kinds (types found, comma-separated)."""
    small_batches(spark)
    text = F.col(text_col)
    whole = F.coalesce(text, F.lit(""))
    marks = [F.xxhash64(F.lit(i), F.coalesce(F.col(id_col).cast("string"), F.lit("")), whole) for i in (1, 2)]
    mentions = materialise(spark, _mentions(docs, text, marks), "pii-mentions")
    given = assign(spark, materialise(spark, mentions.select("kind", "value").distinct(), "pii-entities"), key)
    exceptions = given.where("attempt > 0").select("kind", "value", "attempt")
    by_row = (mentions.join(exceptions, ["kind", "value"]).groupBy("m1", "m2")
              .agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("exceptions")))  # of one document's mentions
    by_row = materialise(spark, by_row, "pii-exceptions")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), marks[0].alias("m1"), marks[1].alias("m2"))
    rows = join_small(rows, by_row, ["m1", "m2"], entries=F.size("exceptions")).select("id", "text", "exceptions")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, exceptions = batch.column("text"), batch.column("exceptions")
            at, n, kinds = _close(texts), np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, "", object)
            out = []
            for i in at.tolist():
                attempts = {(e["kind"], e["value"]): e["attempt"] for e in exceptions[i].as_py() or ()}
                new, n[i], kinds[i] = rewrite(texts[i].as_py(), attempts, key)
                out.append(new)
            close = np.zeros(batch.num_rows, bool)
            close[at] = True
            yield pa.RecordBatch.from_arrays([batch.column("id"), pc.replace_with_mask(texts, close, pa.array(out, texts.type)),
                                              pa.array(n), pa.array(kinds, pa.string())], names=["id", "text", "n_replaced", "kinds"])

    done = rows.mapInArrow(run, f"id {kind}, text string, n_replaced long, kinds string")
    return done.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_replaced", "kinds")
