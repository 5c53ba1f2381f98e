"""Text scores as column expressions; all run inside the JVM."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.buffers import pieces

# White space as Python's str.split and strip see it: Java's Unicode class and four separators it lacks.
WS = r"(?U)[\s\x1C-\x1F]"
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Advertising, copyright and navigation patterns that count as boilerplate.
BOILERPLATE = (
    r"扫码关注.{0,6}公众号",
    r"点击(链接|原文).{0,10}(抢购|下载|查看)",
    r"转载请注明出处",
    r"免责声明",
    r"(?U)www\.[\w-]+\.c[no]",
    r"下载 APP",
)
# Patterns of personal data (mobile number, e-mail, identity number).
PII = (
    r"1[3-9]\d{9}",
    r"(?U)[\w.+-]+@[\w-]+\.[\w.]+",
    r"\d{17}[\dXx]",
)


def _text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


def strip(c: Column | str) -> Column:
    """Without leading and trailing white space."""
    return F.btrim(_text(c), F.lit(WS_CHARS))


def visible(c: Column | str) -> Column:
    """Without any white space."""
    return F.translate(_text(c), WS_CHARS, "")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def text_length(c: Column | str) -> Column:
    return F.length(strip(c)).cast("double")


def doc_length(c: Column | str) -> Column:
    """Characters that are not white space."""
    return F.length(visible(c)).cast("double")


def script_ratio(c: Column | str, script: str = r"[\x{4E00}-\x{9FFF}]") -> Column:
    """Share of visible characters in a script (CJK ideographs by default); 0 for an empty text."""
    return bound(F.length(visible(c)), lambda seen: F.when(seen == 0, F.lit(0.0)).otherwise(F.regexp_count(_text(c), F.lit(script)) / seen))


def char_repetition(c: Column | str) -> Column:
    """1 minus the share of the longest run of one character; 1 for fewer than 4 characters."""

    def longest(s: Column) -> Column:
        """Only runs of four and more are brought into an array; shorter ones are told by whether they occur."""
        long = F.array_max(F.transform(F.regexp_extract_all(s, F.lit(r"(?s)(.)\1{3,}"), F.lit(0)), F.length))
        return F.coalesce(long, F.when(s.rlike(r"(?s)(.)\1\1"), F.lit(3)).when(s.rlike(r"(?s)(.)\1"), F.lit(2)).otherwise(F.lit(1)))

    return bound(strip(c), lambda s: F.when(F.length(s) < 4, F.lit(1.0)).otherwise(1 - longest(s) / F.length(s)))


def lines(c: Column | str) -> Column:
    """Stripped lines that are not empty."""
    return F.filter(F.transform(F.split(_text(c), "\n"), strip), lambda x: x != "")


def line_repetition(c: Column | str) -> Column:
    """Share of distinct lines; 1 for fewer than 2 lines."""
    return bound(lines(c), lambda x: F.when(F.size(x) < 2, F.lit(1.0)).otherwise(F.size(F.array_distinct(x)) / F.size(x)))


def pattern_hits(c: Column | str, patterns=BOILERPLATE) -> Column:
    return sum((F.regexp_count(_text(c), F.lit(p)) for p in patterns[1:]), F.regexp_count(_text(c), F.lit(patterns[0])))


def boilerplate(c: Column | str) -> Column:
    return F.greatest(F.lit(0.0), 1 - 0.2 * pattern_hits(c))


def pii_classes(c: Column | str) -> Column:
    number, mail, identity = (_text(c).rlike(p) for p in PII)
    return number.cast("int") + (_text(c).contains("@") & mail).cast("int") + identity.cast("int")


def pii_detect(c: Column | str) -> Column:
    return F.greatest(F.lit(0.0), 1 - 0.34 * pii_classes(c))


def whitespace_ratio(c: Column | str) -> Column:
    n = F.length(_text(c))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.regexp_count(_text(c), F.lit(WS)) / n)


# ---------------------------------------------------------------- normalisation rules, in their order


# Characters of which no text changes when composed: each is composed already and joins no other (a selection, fixed by Unicode's stability rules).
COMPOSED = r"\x00-\x{2FF}\x{388}-\x{482}\x{48A}-\x{52F}\x{2002}-\x{20CF}\x{2190}-\x{2328}\x{2330}-\x{2ADB}\x{3001}-\x{3029}\x{3030}-\x{3098}\x{309B}-\x{9FFF}\x{AC00}-\x{D7A3}\x{FF01}-\x{FFEF}\x{1F300}-\x{1FAFF}"


def _nfc(c: Column) -> Column:
    """Only texts with a character outside ``COMPOSED`` reach Python, where they are composed piece by piece."""

    @F.arrow_udf("string")
    def compose(column: pa.Array) -> pa.Array:
        done = [pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in column.slice(at, end - at).to_pylist()], pa.string()) for at, end, *_ in pieces(column)]
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return F.coalesce(compose(F.when(c.rlike(f"[^{COMPOSED}]"), c)), c)


# White space but for line ends.
_BLANK = "\\t\\x0B\\f\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def _where(found: Column, after: Column, c: Column) -> Column:
    """``after`` only where there is something to change."""
    return F.when(found, after).otherwise(c)


def _collapse(c: Column) -> Column:
    """Blanks to one space, none at the ends of a line; a single space within a line is no match."""
    once = F.regexp_replace(c, f"[{_BLANK}&&[^ ]][{_BLANK}]*| [{_BLANK}]+", " ")
    return bound(F.regexp_replace(once, "(?m) $|^ ", ""), lambda x: _where(x.contains("\n\n\n"), F.regexp_replace(x, r"\n{3,}", "\n\n"), x))


RULES = {
    "line_separators": lambda c: _where(c.contains("\u2028") | c.contains("\u2029"), F.translate(c, "\u2028\u2029", "\n\n"), c),
    "newline": lambda c: _where(c.contains("\r"), F.regexp_replace(c, r"\r\n?", "\n"), c),
    "zero_width": lambda c: F.regexp_replace(c, "[​‌‍⁠﻿]", ""),
    "control_chars": lambda c: F.regexp_replace(c, r"[\p{Cc}\p{Cf}&&[^\n\t\r]]", ""),
    "whitespace_collapse": _collapse,
    "strip": strip,
}


def _changes(changed: list[Column]) -> Column:
    return F.filter(F.array(*changed), lambda x: x.isNotNull()).alias("rules") if changed else F.array().cast("array<string>").alias("rules")


def normalized(c: Column | str, rules=("nfc", *RULES)) -> Column:
    """A struct of the text, each rule applied to what the one before left, and the names of the rules that changed it.

    What a rule leaves is worked out once (see :func:`bound`), though the next rule and the names refer
    to it; where nfc is not the first rule that can't be, since Python does not run within ``bound``.
    Select the struct before its fields, so that it is worked out once for both.
    """
    c, rules = _text(c), list(rules)
    if "nfc" in rules[1:]:
        changed = []
        for name in rules:
            after = _nfc(c) if name == "nfc" else RULES[name](c)
            changed.append(F.when(after != c, F.lit(name)))
            c = after
        return F.struct(c.alias("text"), _changes(changed))

    def step(before: Column, left: list[str], changed: list[Column]) -> Column:
        if not left:
            return F.struct(before.alias("text"), _changes(changed))
        name, *rest = left
        return bound(RULES[name](before), lambda after: step(after, rest, [*changed, F.when(after != before, F.lit(name))]))

    if rules[:1] != ["nfc"]:
        return step(c, rules, [])
    both = F.struct(c.alias("raw"), _nfc(c).alias("composed"))
    return bound(both, lambda x: step(x["composed"], rules[1:], [F.when(x["composed"] != x["raw"], F.lit("nfc"))]))


def normalize(c: Column | str, rules=("nfc", *RULES)) -> tuple[Column, Column]:
    """(text, names of the rules that changed it) of :func:`normalized`."""
    done = normalized(c, rules)
    return done["text"], done["rules"]


# ---------------------------------------------------------------- synthesis and contamination of texts


def truncate_repair(c: Column | str) -> Column:
    """A full stop where the text ends without punctuation."""
    return F.when(strip(c).rlike(r"(?U)[\p{P}]$") | (strip(c) == ""), _text(c)).otherwise(F.concat(strip(c), F.lit("。")))


def cap_runs(c: Column | str, most: int = 4) -> Column:
    """No character more than ``most`` times in a row."""
    return F.regexp_replace(_text(c), rf"(?s)(.)\1{{{most},}}", "$1" * most)


def uniform(key: Column, seed: int | str) -> Column:
    """A number in 0..1 fixed by key and seed."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256), 1, 8), 16, 10).cast("double") / 4294967296.0
