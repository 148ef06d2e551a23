"""Queries of the text operators."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm import encoding, leakage, lookalike, names, repetition, residue
from bindery.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.pairs(table(spark, folder, "komik"))


def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that share their look with others: how many there are, and the least and greatest."""
    rows = lookalike.fields_of(table(spark, folder, "komik"), "id", ("judul", "alternative_title"))
    return lookalike.variants(rows).groupBy("fld", "look").agg(F.count(F.lit(1)).alias("n_texts"), F.min("text").alias("least"), F.max("text").alias("greatest")).drop("look")


def p1_members(spark: SparkSession, folder: str) -> DataFrame:
    """The class of every record whose field looks like another's: the class is named by its least record."""
    found = lookalike.members(table(spark, folder, "komik"))
    named = found.groupBy("fld", "look").agg(F.min("id").alias("class_id"))
    return found.join(named, ["fld", "look"]).select("fld", "class_id", "id")


def _variants(spark: SparkSession, folder: str) -> DataFrame:
    return names.variants(table(spark, folder, "komik"), table(spark, folder, "nicknames"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.pairs(_variants(spark, folder))


def p2_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every spelling with others, its group and the group's number of spellings."""
    labelled = _variants(spark, folder)
    return labelled.join(labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n_spellings")), "label")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.found(table(spark, folder, "detail_lines"))


def p6_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Title and synopsis of every valid record, residue left out."""
    return residue.clean(table(spark, folder, "detail_lines"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode(table(spark, folder, "documents"), "byte_bpe_50k")


def p8_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as decoded from their ids."""
    return encoding.decode(p8_ids(spark, folder), "byte_bpe_50k")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_items(spark: SparkSession, folder: str) -> DataFrame:
    """The report by test item: how many documents leak it."""
    return p9_found(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """TESTDATA.md fixes the share at 0.4: thresholds of the groups' sketches up to it give the candidates, an exact check follows."""
    return repetition.repetitive(table(spark, folder, "documents"), quantile=0.9, least=0.1, exact=repetition.SHARE).select("doc_id")


def p10_adaptive(spark: SparkSession, folder: str) -> DataFrame:
    """Documents above the 95 % quantile of their language and source, between 0.1 and 0.9."""
    found = repetition.repetitive(table(spark, folder, "documents"), quantile=0.95, least=0.1, most=0.9)
    return found.select("doc_id", F.round("share", 6).alias("share"))


def p10_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the 95 % quantile of each group's sketch keeps to its stated rank error."""
    return repetition.rank_check(table(spark, folder, "documents"), 0.95)


def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    measured = repetition.measured(table(spark, folder, "documents").select("doc_id", "text"))
    return measured.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.round("share", 6).alias("share"))


QUERIES = {f.__name__: f for f in (p1_found, p1_classes, p1_members, p2_found, p2_groups, p6_found, p6_clean, p8_ids, p8_roundtrip, p9_found, p9_items, p10_found, p10_adaptive, p10_limits, p10_shares)}

# Full-width forms stand 0xFEE0 behind their narrow ones; half-width kana by their own compatibility form.
_NARROW = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFF61, 0xFFA0)}
# The look-alike letters that the tables hold, told apart from the operator's table: by their code points.
_SEEN = {
    "A": "0410 0391", "B": "0412 0392", "C": "0421 03F9", "E": "0415 0395", "H": "041D 0397", "I": "0406 0399", "J": "0408", "K": "041A 039A", "M": "041C 039C", "N": "039D", "O": "041E 039F", "P": "0420 03A1", "S": "0405",
    "T": "0422 03A4", "X": "0425 03A7", "Y": "0423 03A5", "Z": "0396", "a": "0430 0251", "c": "0441 03F2", "d": "0501", "e": "0435", "h": "04BB", "i": "0456", "j": "0458", "o": "043E 03BF 0585", "p": "0440 03C1", "s": "0455", "x": "0445", "y": "0443",
}
_FROM = "".join(chr(int(n, 16)) for ns in _SEEN.values() for n in ns.split()) + "".join(_NARROW)
_TO = "".join(a * len(ns.split()) for a, ns in _SEEN.items()) + "".join(_NARROW.values())
_LOOKS = rf"""
WITH f AS (SELECT id, 'judul' AS fld, judul AS t FROM komik UNION SELECT id, 'alternative_title', alternative_title FROM komik),
s AS (SELECT id, fld, t, nfc_normalize(translate(regexp_replace(t, '[\p{{Cf}}\x{{034F}}]', '', 'g'), '{_FROM.replace("'", "''")}', '{_TO.replace("'", "''")}')) AS n FROM f),
l AS (SELECT id, fld, t, trim(regexp_replace(n, '[\s\p{{Z}}]+', ' ', 'g')) AS look FROM s),
v AS (SELECT * FROM l WHERE look <> '')
"""
_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_LEAKS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, {_WORDS} AS w FROM eval_items WHERE text IS NOT NULL),
dg AS (SELECT doc_id, unnest([array_to_string(w[n:n+11], ' ') FOR n IN range(1, len(w) - 10)]) AS g FROM d),
ig AS (SELECT item_id, unnest([array_to_string(w[n:n+11], ' ') FOR n IN range(1, len(w) - 10)]) AS g FROM i),
f AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))
"""
_SHARES = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS n, unnest([array_to_string(w[n:n+4], ' ') FOR n IN range(1, len(w) - 3)]) AS g FROM d),
a AS (SELECT doc_id, n FROM g QUALIFY row_number() OVER (PARTITION BY doc_id, g ORDER BY n) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS covered FROM (SELECT doc_id, unnest(range(n, n + 5)) AS p FROM a) GROUP BY 1),
s AS (SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CASE WHEN coalesce(len(w), 0) > 0 THEN coalesce(covered, 0) / len(w) END AS share FROM d LEFT JOIN c USING (doc_id))
"""
ORACLE = {
    "p1_found": _LOOKS + "SELECT DISTINCT a.fld, a.id AS id_a, b.id AS id_b FROM v a JOIN v b ON a.fld = b.fld AND a.look = b.look AND a.id < b.id AND a.t <> b.t",
    "p1_classes": _LOOKS + "SELECT fld, count(DISTINCT t) AS n_texts, min(t) AS least, max(t) AS greatest FROM v GROUP BY fld, look HAVING count(DISTINCT t) > 1",
    "p1_members": _LOOKS
    + """, c AS (SELECT fld, look, min(id) AS class_id FROM v GROUP BY fld, look HAVING count(DISTINCT t) > 1) SELECT v.fld, class_id, v.id FROM v JOIN c ON c.fld = v.fld AND c.look = v.look""",
    "p8_roundtrip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p9_found": _LEAKS + "SELECT doc_id, item_id FROM f",
    "p9_items": _LEAKS + "SELECT item_id, count(*) AS n_docs FROM f GROUP BY 1",
    "p10_found": _SHARES + "SELECT doc_id FROM s WHERE n_words >= 20 AND share >= 0.4",
    "p10_limits": _SHARES
    + f"""SELECT g_lang, g_source, count(*) AS n_docs, CAST(1 AS INT) AS within FROM s JOIN (SELECT doc_id, coalesce(lower(trim(source, ' ')), '') AS g_source,
CASE lower(trim(lang, ' ')) {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in repetition.LANGUAGES.items())} ELSE coalesce(lower(trim(lang, ' ')), '') END AS g_lang FROM documents) USING (doc_id) WHERE n_words >= 20 GROUP BY ALL""",
    "p10_shares": _SHARES + "SELECT doc_id, n_words, round(share, 6) AS share FROM s",
}
