"""Several values packed in one field: one row per value, with its place.

Quoted spans that open a value become placeholders, the rest is split at the
separators, and the placeholders are looked up in the array of spans again. A
placeholder is a mark and the span's number; a mark that the text holds itself
is escaped first, so no text can collide with one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import let, spread

# Separators; the plain comma is apart because it may belong to a title.
STRONG = r"[;|•；｜，、﹔﹐﹑､]|\r\n|[\n\r\x{0B}\x{0C}\x{85}\x{2028}\x{2029}]|(?<=\s)[/／\-‐‑‒–—―－](?=\s)"
WEAK = ","
# Opening and closing quotes of a whole value.
QUOTES = (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("「", "」"), ("『", "』"))
DASHES = "-‐‑‒–—―－"
MARK, OPEN, LITERAL, CLOSE = "", "", "", ""
SPACE = r"[\s\x{1c}-\x{1f}]"


def _span(separators: str) -> str:
    """A quoted span between a separator (or the start) and a separator (or the end); group 3 is the span with its quotes."""
    # Unrolled and possessive, so that long spans neither backtrack nor recurse.
    bodies = "|".join(f"{a}[^{b}]*+(?:{b}{b}[^{b}]*+)*+{b}" for a, b in QUOTES)
    return rf"(?U)(\A|{separators})({SPACE}*)({bodies})(?={SPACE}*(?:{separators}|\z))"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|(?<!{SPACE}){SPACE}+\z", "")


def _masked(text: Column, separators: str) -> Column:
    """`text` with the n-th span replaced by MARK OPEN n CLOSE."""
    parts = F.split(F.regexp_replace(text, _span(separators), f"$1$2{MARK}{OPEN}"), f"{MARK}{OPEN}", -1)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(MARK + OPEN), (i - 1).cast("string"), F.lit(CLOSE), p))), "")


def _unquote(span: Column) -> Column:
    bare = span
    for a, b in QUOTES:
        bare = F.when(span.startswith(a) & span.endswith(b), F.replace(F.substring(span, F.lit(2), F.char_length(span) - 2), F.lit(b + b), F.lit(b))).otherwise(bare)
    return bare


def _split(text: Column, separators: str) -> Column:
    spans = F.regexp_extract_all(text, F.lit(_span(separators)), F.lit(3))
    index = lambda part: F.regexp_extract(part, f"{MARK}{OPEN}([0-9]+){CLOSE}", 1).try_cast("int")
    parts = F.split(_masked(text, separators), rf"(?U){separators}", -1)
    restored = let(spans, lambda s: F.transform(parts, lambda part: F.when(part.contains(MARK + OPEN), _unquote(F.get(s, index(part)))).otherwise(part)))
    plain = F.transform(restored, lambda value: _strip(F.replace(value, F.lit(MARK + LITERAL), F.lit(MARK))))
    return F.filter(plain, lambda value: F.char_length(value) > 0)


def values(text: Column) -> Column:
    """The values of a packed field, in order, as an array.

    Null, blank and a lone dash give an empty array. A quote that opens a value
    but closes before its end belongs to the value.
    """
    safe = F.replace(text, F.lit(MARK), F.lit(MARK + LITERAL))
    both = f"(?:{STRONG}|{WEAK})"
    unquoted = F.regexp_replace(safe, _span(both), "$1$2")
    lone = _strip(text).rlike(f"^[{DASHES}]?$")
    split = F.when(unquoted.rlike(f"(?U){STRONG}"), _split(safe, f"(?:{STRONG})")).otherwise(_split(safe, both))
    return F.when(text.isNull() | lone, F.array().cast("array<string>")).otherwise(split)


def unpack(df: DataFrame, key: str, field: str) -> DataFrame:
    """(key, pos, val): one row per value of `field`. Repeated rows give their values again."""
    return spread(df.select(key, field)).select(F.col(key), F.posexplode(values(F.col(field))).alias("pos", "val"))
