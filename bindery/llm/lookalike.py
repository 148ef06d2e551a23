"""One form for text that looks the same but has different characters.

Look-alike classes hold strings and single code points. They are the transitive
closure, by union-find, of: letter width, canonical decomposition, blanks,
characters that show nothing, and look-alike letters of other scripts. The most
frequent member of a class in the corpus stands for it, and texts are rewritten
by an Aho-Corasick automaton, longest match first from the left.

Only code points that occur are collected (Unicode bounds their number).
"""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import cut, kept, spread

# Letters of other scripts (and Latin variants) that look like a Latin letter as a whole, in the usual fonts:
# Cyrillic, Greek, Armenian, Latin extensions; then Coptic, Cherokee, Lisu. Letters that only resemble one (a dot or a tail more) are not here.
LETTERS = {
    "A": "АΑ" "ⲀᎪꓮ", "B": "ВΒ" "ⲂᏴꓐ", "C": "СϹ" "ⲤᏟꓚ", "D": "Ꭰꓓ", "E": "ЕΕ" "Ꭼꓰ", "F": "Ϝ" "ꓝ", "G": "Ԍ" "Ᏻꓖ", "H": "НΗ" "ⲎᎻꓧ", "I": "ІΙӀ" "Ⲓꓲ", "J": "ЈͿ" "Ꭻꓙ", "K": "КΚ" "ⲔᏦꓗ", "L": "Ꮮꓡ",
    "M": "МΜ" "ⲘᎷꓟ", "N": "Ν" "Ⲛꓠ", "O": "ОΟՕ" "Ⲟꓳ", "P": "РΡ" "ⲢᏢꓑ", "Q": "Ԛ", "R": "ᎡᏒꓣ", "S": "ЅՏ" "ᏕᏚꓢ", "T": "ТΤ" "ⲦᎢꓔ", "U": "Ս" "ꓴ", "V": "Ѵ" "Ꮩꓦ", "W": "Ԝ" "ᎳᏔꓪ", "X": "ХΧ" "Ⲭꓫ", "Y": "УҮΥ" "ⲨᎩꓬ", "Z": "Ζ" "Ꮓꓜ",
    "a": "аɑα", "b": "Ꮟ", "c": "сϲ" "ᴄⲥ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ" "Ꮒ", "i": "іι" "Ꭵ", "j": "јϳ", "k": "ĸ", "l": "ӏ", "n": "ո", "o": "оοօ" "ᴏⲟ", "p": "рρ" "ⲣ", "q": "ԛզ",
    "s": "ѕ" "ꜱ", "u": "սυ" "ᴜ", "v": "ѵν" "ᴠ", "w": "ԝ" "ᴡ", "x": "х", "y": "уүγ", "z": "ᴢ",
}
# Characters outside the format category (Cf) that show nothing.
UNSEEN = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"


def _unseen(c: str) -> bool:
    return unicodedata.category(c) == "Cf" or c in UNSEEN or 0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF


def _width(c: str) -> str | None:
    tag, _, rest = unicodedata.decomposition(c).partition(" ")
    return "".join(chr(int(x, 16)) for x in rest.split()) if tag in ("<wide>", "<narrow>") else None


class _Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def root(self, x: str) -> str:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, x: str, y: str) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)


@functools.cache
def _composed() -> dict[str, tuple[str, str]]:
    """Every composed letter: its base and its marks, fully decomposed."""
    out = {}
    for n in range(0xC0, 0x1F000):
        c = chr(n)
        if unicodedata.decomposition(c) and not 0xAC00 <= n <= 0xD7A3:
            whole = unicodedata.normalize("NFD", c)
            if len(whole) > 1 and unicodedata.normalize("NFC", whole) == c:
                out[c] = (whole[0], whole[1:])
    return out


def rewriting(counts: dict[str, int]) -> dict[str, str]:
    """From each member of a class to its representative, for a corpus with these code points.

    Ties in frequency go to the smallest code point. Members that are their own representative are left out.
    """
    classes = _Classes()
    seen = set(counts)
    for letter, others in LETTERS.items():
        for other in others:
            classes.union(letter, other)
    for c in seen:
        if _unseen(c):
            classes.union("", c)
        elif c.isspace():
            classes.union(" ", c)
        elif (narrow := _width(c)) is not None:
            classes.union(narrow, c)
    singles = {}
    for x in classes.up:
        singles.setdefault(classes.root(x), set()).add(x)
    like = lambda c: singles.get(classes.root(c), {c}) if c in classes.up else {c}
    # A composed letter, its decomposed string, and the strings with a base that looks alike, are one class.
    for c, (base, marks) in _composed().items():
        bases = like(base)
        if c in seen or bases & seen:
            key = min(bases) + marks
            classes.union(key, c)
            for b in bases:
                classes.union(key, b + marks)
                if len(one := unicodedata.normalize("NFC", b + marks)) == 1:
                    classes.union(key, one)
    members: dict[str, list[str]] = {}
    for x in classes.up:
        members.setdefault(classes.root(x), []).append(x)
    table = {}
    for group in members.values():
        best = "" if "" in group else " " if " " in group else min(group, key=lambda x: (-(counts.get(x, 0) if len(x) == 1 else 0), len(x), x))
        table |= {x: best for x in group if x not in (best, "")}
    return table


def _automaton(table: dict[str, str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for pattern, to in table.items():
        automaton.add_word(pattern, (len(pattern), to))
    automaton.make_automaton()
    return automaton


def rewrite(text: str, automaton) -> str:
    """The one form of a text: rewritten until nothing changes, blanks in one, none at the edges."""
    before = None
    while text != before:
        before, text = text, unicodedata.normalize("NFC", text)
        out, at = [], 0
        for end, (size, to) in automaton.iter_long(text):
            out += (text[at : end + 1 - size], to)
            at = end + 1
        text = "".join(out) + text[at:]
    return " ".join(text.split())


def code_points(texts: DataFrame, text: str = "text") -> dict[str, int]:
    """How often each code point occurs; counted on the map side first."""
    counted = texts.select(F.explode(F.split(F.col(text), "")).alias("c")).filter("c <> ''").groupBy("c").count()
    return {r["c"]: r["count"] for r in counted.collect()}


def one_form(table: dict[str, str]):
    """A vectorised column function from text to its one form; null stays null."""
    key = ("look-alike", hash(frozenset(table.items())))

    @F.pandas_udf("string")
    def form(batch: pd.Series) -> pd.Series:
        automaton = kept(key, lambda: _automaton(table))
        return batch.map(lambda t: None if t is None else rewrite(t, automaton))

    return form


def fields_of(df: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """(fld, id, text): the fields as rows; null and blank texts show nothing and are left out."""
    cells = F.array(*(F.struct(F.lit(f).alias("fld"), F.col(f).alias("text")) for f in fields))
    return df.select(F.col(key).alias("id"), F.inline(cells)).filter(F.col("text").rlike("(?U)\\S"))


def looks(rows: DataFrame) -> DataFrame:
    """(fld, text, look): the one form of each distinct text."""
    texts = spread(cut(rows.select("fld", "text").distinct()))
    form = one_form(rewriting(code_points(rows)))
    return texts.select("fld", "text", form(F.col("text")).alias("look")).filter("look <> ''")


def variants(rows: DataFrame) -> DataFrame:
    """(fld, look, text): texts that share their look with another text."""
    known = cut(looks(rows))
    several = known.groupBy("fld", "look").count().filter("count > 1").select("fld", "look")
    return known.join(several, ["fld", "look"]).select("fld", "look", "text")


def members(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("judul", "alternative_title")) -> DataFrame:
    """(fld, look, id, text): the records of each class of texts that look the same, one row per record and field; no pairs are made."""
    rows = fields_of(df, key, fields).filter("id is not null").distinct()
    known = variants(rows)
    return rows.join(known, ["fld", "text"]).select("fld", "look", "id", "text")


def pairs(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("judul", "alternative_title")) -> DataFrame:
    """(fld, id_a, id_b), id_a < id_b: records whose field looks the same but differs in some character.

    Equal texts make no pair. A field without visible text looks like nothing.
    Distinct rows, so repeated records add none. Records with null keys are left out.
    """
    rows = fields_of(df, key, fields).filter("id is not null").distinct()
    known = cut(variants(rows))
    # Pairs of distinct texts first, so copies of one text never meet each other.
    a, b = known.toDF("fld", "look", "text_a"), known.toDF("fld", "look", "text_b")
    texts = a.join(b, ["fld", "look"]).filter("text_a <> text_b").select("fld", "text_a", "text_b")
    named = cut(rows.join(known.select("fld", "text"), ["fld", "text"], "left_semi").select("fld", "id", "text"))
    left, right = named.toDF("fld", "id_a", "text_a"), named.toDF("fld", "id_b", "text_b")
    return texts.join(left, ["fld", "text_a"]).join(right, ["fld", "text_b"]).filter("id_a < id_b").select("fld", "id_a", "id_b").distinct()
