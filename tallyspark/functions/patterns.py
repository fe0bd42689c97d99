"""Regular expressions and character classes.

Spark evaluates patterns with ``java.util.regex``; the oracle queries run them in
DuckDB (RE2). The rules being matched were written for Python's Unicode-aware
``re``, so every class below is spelled out explicitly instead of relying on
engine-specific meanings of ``\\s``, ``\\d``, ``\\w`` or ``\\b``.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the rules being reproduced).
# Python's str whitespace (``\s`` / ``str.strip``): ASCII controls 9-13, 28-31,
# space, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F,
# U+205F, U+3000.
WS = "\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
# Cyrillic letters used by the Mongolian alphabet: А-я, Ё ё, Ө ө, Ү ү.
MN_LETTERS = "А-яЁёӨөҮү"
LATIN_LETTERS = "A-Za-z"
# Character class of the "looks Mongolian" share: Cyrillic, digits, whitespace,
# and . , ! ? ; : ' " ( ) % - /
MN_SHARE_CLASS = "А-Яа-яӨөҮүЁё0-9" + WS + ".,!?;:'\"()%\\-/"
# Register-number letters: А-Я, Ё, Ө, Ү matched case-insensitively.
REGISTER_LETTERS = "А-Яа-яЁёӨөҮү"
# PII token texts.
TOKEN_PHONE = "[REDACTED_PHONE]"
TOKEN_EMAIL = "[REDACTED_EMAIL]"
TOKEN_REGISTER = "[REDACTED_REGISTER]"
TOKEN_NUMBER = "[REDACTED_NUMBER]"
# Money / loan / term / income words.
UNIT_WORDS = "саяар|сая|million"
CURRENCY_WORDS = "төгрөг|төг|mnt|mнт|₮"
LOAN_WORDS = "зээл|loan"
TERM_UNITS = "сараар|сарын|сар|жилийн|жил|months?|years?"
YEAR_UNITS = ("year", "years", "жил", "жилийн")
INCOME_WORDS = "орлого|цалин|income|salary"
# ---------------------------------------------------------------------------

# Java (Spark) forms. (?U): Unicode \d, \w, \b and case folding, as in Python.
# Written so that each start position is first tested against one character class
# (a match must begin with that character), and only then against the look-behind:
#   phone     (?<!\d)X            -> (?=[+\d])(?<!\d)X
#   number    (?<!\d)\d{10,16}     -> \d(?<!\d\d)\d{9,15}
# Each is the same language as the plain form; the plain forms are kept below. (The
# register pattern is left plain: the reordered form measured slower.)
PHONE_JAVA_PLAIN = f"(?U)(?<!\\d)(?:\\+?976[-{WS}]?)?(?:\\d[-{WS}]?){{8}}(?!\\d)"
REGISTER_JAVA_PLAIN = f"(?U)\\b[{REGISTER_LETTERS}]{{2}}\\d{{8}}\\b"
LONG_NUMBER_JAVA_PLAIN = "(?U)(?<!\\d)\\d{10,16}(?!\\d)"
PHONE_JAVA = f"(?U)(?=[+\\d])(?<!\\d)(?:\\+?976[-{WS}]?)?(?:\\d[-{WS}]?){{8}}(?!\\d)"
EMAIL_JAVA = "(?U)\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b"
REGISTER_JAVA = REGISTER_JAVA_PLAIN
LONG_NUMBER_JAVA = "(?U)\\d(?<!\\d\\d)\\d{9,15}(?!\\d)"

# Reasoning blocks: case-insensitive, dot matches newline, non-greedy.
THINK_BLOCK_JAVA = "(?isU)<think\\b[^>]*>.*?</think>"
THINK_TAG_JAVA = "(?iU)</?think\\b"

# RE2 (DuckDB oracle) forms. No lookaround in RE2: the boundary conditions are
# written as consumed context, which is exact for existence tests.
RE2_WORD = "\\p{L}\\p{N}_"
PHONE_RE2_EXISTS = f"(^|\\P{{Nd}})(\\+?976[-{WS}]?)?(\\p{{Nd}}[-{WS}]?){{8}}($|\\P{{Nd}})"
PHONE_RE2_FIRST = f"(^|\\P{{Nd}})((\\+?976[-{WS}]?)?(\\p{{Nd}}[-{WS}]?){{8}})($|\\P{{Nd}})"
EMAIL_RE2_EXISTS = (
    f"((^|[^{RE2_WORD}])[A-Za-z0-9]|[{RE2_WORD}][._%+-])[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}($|[^{RE2_WORD}])"
)
REGISTER_RE2_EXISTS = f"(^|[^{RE2_WORD}])[{REGISTER_LETTERS}]{{2}}\\p{{Nd}}{{8}}($|[^{RE2_WORD}])"
LONG_NUMBER_RE2_EXISTS = "(^|\\P{Nd})\\p{Nd}{10,16}($|\\P{Nd})"


def money_java() -> str:
    """number [unit] [currency]; group 1 = number, group 2 = unit."""
    return (f"(?iU)(\\d[\\d,.{WS}]*)(?:[{WS}]*({UNIT_WORDS}))?"
            f"(?:[{WS}]*(?:{CURRENCY_WORDS}))?")


def loan_context_java() -> str:
    # (?d): '.' excludes only '\n', like Python. Where a number fails, so does every later part of it, and where a part of its run of digits and
    # separators would do, the whole run does: no start after a digit, and the run is never given back.
    return (f"(?idU)(?<!\\d)(\\d[\\d,.{WS}]*+)(?:[{WS}]*({UNIT_WORDS}))?"
            f"(?:[{WS}]*(?:{CURRENCY_WORDS}))?.{{0,30}}(?:{LOAN_WORDS})")


def term_java() -> str:
    return f"(?iU)(?<!\\d)(\\d++)[{WS}]*({TERM_UNITS})"


def income_java() -> str:
    return f"(?iU)(?:{INCOME_WORDS})[^\\d]{{0,24}}(\\d[\\d,.{WS}]*)(?:[{WS}]*({UNIT_WORDS}))?"


def money_re2() -> str:
    return (f"(?i)([0-9][0-9,.{WS}]*)(?:[{WS}]*({UNIT_WORDS}))?"
            f"(?:[{WS}]*(?:{CURRENCY_WORDS}))?")


def loan_context_re2() -> str:
    return (f"(?i)([0-9][0-9,.{WS}]*)(?:[{WS}]*({UNIT_WORDS}))?"
            f"(?:[{WS}]*(?:{CURRENCY_WORDS}))?.{{0,30}}(?:{LOAN_WORDS})")


def term_re2() -> str:
    return f"(?i)([0-9]+)[{WS}]*({TERM_UNITS})"


def income_re2() -> str:
    return f"(?i)(?:{INCOME_WORDS})[^0-9]{{0,24}}([0-9][0-9,.{WS}]*)(?:[{WS}]*({UNIT_WORDS}))?"


def _expand(ranges) -> str:
    """Characters of a list of (first, last) code point ranges, as one string."""
    return "".join(chr(c) for a, b in ranges for c in range(a, b + 1))


# The same classes as explicit character sets (for ``translate``-based counting,
# which avoids running a regex over every character).
WS_CHARS = _expand([(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)])
MN_LETTER_CHARS = _expand([(0x410, 0x44F), (0x401, 0x401), (0x451, 0x451), (0x4E8, 0x4E9), (0x4AE, 0x4AF)])
LATIN_CHARS = _expand([(0x41, 0x5A), (0x61, 0x7A)])
MN_SHARE_CHARS = _expand([(0x410, 0x44F), (0x4E8, 0x4E9), (0x4AE, 0x4AF), (0x401, 0x401), (0x451, 0x451),
                          (0x30, 0x39)]) + WS_CHARS + ".,!?;:'\"()%-/"
