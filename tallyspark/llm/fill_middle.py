"""Fill-in-middle examples by a counted-quantifier pattern.

A text is a run of units (by default a word of letters or one other character). ``regexp_count`` gives their number n,
seeded hashes of the id two cuts a <= b in 0..n, and a pattern made for the row, ``(unit{a})(unit{b-a})(rest)`` with
possessive quantifiers, captures prefix, middle and suffix in one match, whose replacement is the finished example. Possessive
counted groups run in a loop without backtracking or recursion, so texts of any length pass in linear time. All of it is
DataFrame functions in one projection: nothing is shuffled, and no row depends on another.

Forms: ``psm`` is P prefix S suffix M middle, ``spm`` is S suffix P prefix M middle, ``plain`` the text as it is. Sentinels
occur once each in an example, since texts that hold one stay plain and no sentinel overlaps another; so the parts, and the
text, can be read back from it (:func:`restored`, :func:`part_lengths`).

Defined results. Null text: empty. Empty texts, and texts with a sentinel: plain. Null id: hashed as an empty string. Repeated
rows and ids: the same cuts. Empty table: empty result. Other columns are passed on; those added take names that are free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

UNIT = "[A-Za-z]+|[^A-Za-z]"
SENTINELS = ("<P>", "<S>", "<M>")  # before prefix, suffix, middle
SEED = 1
#: Of 100 texts, about so many are cut; of 100 cut ones, about so many have the suffix first.
CUT_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20


def _check(sentinels: tuple[str, str, str]) -> None:
    for a in sentinels:
        for b in sentinels:
            borders = any(a.endswith(b[:i]) for i in range(1, min(len(a), len(b)) + (a != b)))
            if not a or borders or (a != b and b in a):
                raise ValueError("sentinels must not be empty, overlap or hold one another")
    if len({*sentinels}) < 3:
        raise ValueError("sentinels must differ")


def _quoted(sentinel: str) -> str:
    """As literal text of a replacement."""
    return sentinel.replace("\\", "\\\\").replace("$", "\\$")


def hash_parts(seed: int, key: Column) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def split_pattern(first: Column, second: Column, unit: str = UNIT) -> Column:
    """The row's pattern: ``first`` units, ``second`` units, the rest."""
    times = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"(?s)\A"), times(first), times(second), F.lit(r"(.*)\z"))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, unit: str = UNIT,
                   sentinels: tuple[str, str, str] = SENTINELS, cut_percent: int = CUT_PERCENT,
                   suffix_first_percent: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """The columns of ``docs`` and, under free names, n (units), form and output."""
    _check(sentinels)
    text, marks, n, form, cuts, output = (free_name(docs, x) for x in ("fim_text", "fim_hash", "n", "form", "cuts", "output"))
    rows = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.withColumn(marks, F.array(*hash_parts(seed, F.col(id_col)))).withColumn(n, F.regexp_count(text, F.lit(unit)).cast("long"))
    h = [F.col(marks)[i] for i in range(4)]
    held = [F.contains(F.col(text), F.lit(s)) for s in sentinels]
    plain = (F.col(text) == "") | held[0] | held[1] | held[2] | (h[2] % 100 >= cut_percent)
    rows = rows.withColumn(form, F.when(plain, "plain").when(h[3] % 100 < suffix_first_percent, "spm").otherwise("psm"))
    one, two = h[0] % (F.col(n) + 1), h[1] % (F.col(n) + 1)
    rows = rows.withColumn(cuts, F.array(F.least(one, two), F.abs(one - two)))
    p, s, m = map(_quoted, sentinels)
    made = F.regexp_replace(F.col(text), split_pattern(F.col(cuts)[0], F.col(cuts)[1], unit),
                            F.when(F.col(form) == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2"))
    return rows.withColumn(output, F.when(F.col(form) == "plain", F.col(text)).otherwise(made)).drop(text, marks, cuts)


def part_lengths(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> tuple[Column, Column]:
    """Code points of prefix and middle, read from an example; null for a plain one."""
    p, s, m = sentinels
    at = {x: F.instr(output, F.lit(x)) for x in sentinels}
    prefix = F.when(form == "psm", at[s] - 1 - len(p)).when(form == "spm", at[m] - at[p] - len(p))
    middle = F.when(form != "plain", F.length(output) - (at[m] - 1 + len(m)))
    return prefix.cast("long"), middle.cast("long")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an example was made of."""
    p, s, m = (rf"\Q{x}\E" for x in sentinels)
    return (F.when(form == "psm", F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z", "$1$3$2"))
            .when(form == "spm", F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z", "$2$3$1")).otherwise(output))
