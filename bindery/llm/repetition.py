"""Repetition inside a document, and thresholds on it that follow each language and source.

The share is exact. Thresholds come from mergeable quantile sketches, one per
language and source, within given bounds; documents are filtered by a join with
them. Where a fixed share is asked for, the sketches' thresholds, kept at or
below it, give the candidates, and an exact check follows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.llm.words import words
from bindery.runtime import bounded_broadcast, cut, spread

#: Size of a sketch. Its rank error is 2.296 / K ** 0.9723 (0.3 %) at 99 % confidence; groups of fewer values are exact.
K = 1000
RANK_ERROR = 2.296 / K**0.9723
RUN, LEAST_WORDS, SHARE = 5, 20, 0.4
# Codes that name one language.
LANGUAGES = {"in": "id", "ind": "id", "eng": "en", "jp": "ja", "jpn": "ja", "spa": "es"}


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, each spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeated(lists: pa.Array, run: int) -> tuple[np.ndarray, np.ndarray]:
    """By row of words: how many there are, and how many of them lie in a run that also starts earlier in the row."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    n = len(row)
    if n < run:
        return sizes, np.zeros(len(sizes), dtype=np.int64)
    # Equal words have equal numbers within the batch.
    word = _mixed(np.asarray(pc.dictionary_encode(lists.flatten()).indices).astype(np.uint64) + np.uint64(1))
    starts = np.flatnonzero(np.arange(n) + run <= ends[row + 1])
    gram = np.zeros(len(starts), dtype=np.uint64)
    for i in range(run):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + word[starts + i]
    gram = _mixed(gram ^ _mixed(row[starts].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(gram, kind="stable")
    again = starts[order[1:][gram[order[1:]] == gram[order[:-1]]]]
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, again, 1)
    np.add.at(steps, again + run, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(steps[:-1]) > 0)))
    return sizes, covered[ends[1:]] - covered[ends[:-1]]


def measured(docs: DataFrame, text: str = "text", run: int = RUN) -> DataFrame:
    """`docs` with n_words (words of the text) and share (of them repeated; null without words).

    A word is repeated if it lies in a run of `run` words that also starts
    earlier in the same document. Runs are compared by a 64-bit hash, and found
    by sorting, so long texts cost n log n. `docs` must not have columns named n_words or share.
    """

    @F.arrow_udf("struct<n_words: int, share: double>")
    def share(batch: pa.Array) -> pa.Array:
        n, again = _repeated(batch, run)
        return pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(again / np.maximum(n, 1), pa.float64(), mask=n == 0)], ["n_words", "share"])

    # Told to Spark as not deterministic, so that no filter measures a text a second time.
    found = docs.withColumn("_m", share.asNondeterministic()(words(F.col(text))))
    return found.withColumns({"n_words": F.col("_m.n_words"), "share": F.col("_m.share")}).drop("_m")


def group_of(lang: Column, source: Column) -> tuple[Column, Column]:
    """Language and source in one spelling; null and blank are the group ''."""
    code = F.coalesce(F.lower(F.trim(lang)), F.lit(""))
    table = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    return F.coalesce(table[code], code), F.coalesce(F.lower(F.trim(source)), F.lit(""))


def thresholds(shares: DataFrame, quantile: float, least: float, most: float, least_words: int = LEAST_WORDS, k: int = K) -> DataFrame:
    """(g_lang, g_source, n_docs, at, threshold): the quantile of each group's sketch, as it is and kept within [least, most]."""
    counted = shares.filter(F.col("n_words") >= least_words)
    sketched = counted.groupBy("g_lang", "g_source").agg(F.count(F.lit(1)).alias("n_docs"), F.kll_sketch_agg_double(F.col("share").cast("double"), F.lit(k)).alias("sketch"))
    told = sketched.select("g_lang", "g_source", "n_docs", F.kll_sketch_get_quantile_double("sketch", F.lit(quantile)).alias("at"))
    return told.withColumn("threshold", F.greatest(F.least("at", F.lit(most)), F.lit(least)))


def _grouped(docs: DataFrame, key: str, lang: str, source: str, text: str, least_words: int) -> DataFrame:
    """(key, g_lang, g_source, n_words, share) of texts of at least `least_words` words, written once."""
    g_lang, g_source = group_of(F.col(lang), F.col(source))
    rows = spread(docs.select(F.col(key), g_lang.alias("g_lang"), g_source.alias("g_source"), F.col(text).alias("text")))
    return cut(measured(rows).drop("text").filter(F.col("n_words") >= least_words))


def repetitive(docs: DataFrame, quantile: float = 0.9, least: float = 0.0, most: float = 1.0, exact: float | None = None, least_words: int = LEAST_WORDS, key: str = "doc_id", lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(key, share, threshold): documents of at least `least_words` words whose share reaches their group's threshold.

    With `exact` the thresholds are kept at or below it, and a share must reach it
    too. Null, empty and short texts are never returned; repeated rows are returned each.
    """
    shares = _grouped(docs, key, lang, source, text, least_words)
    limits = cut(thresholds(shares, quantile, least, most if exact is None else min(most, exact), least_words).select("g_lang", "g_source", "threshold"))
    found = shares.join(bounded_broadcast(limits), ["g_lang", "g_source"]).filter(F.col("share") >= F.col("threshold"))
    return (found if exact is None else found.filter(F.col("share") >= exact)).select(key, "share", "threshold")


def rank_check(docs: DataFrame, quantile: float, key: str = "doc_id", lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(g_lang, g_source, n_docs, within): 1 if the sketch's quantile lies within twice its stated rank error of the exact rank."""
    shares = _grouped(docs, key, lang, source, text, LEAST_WORDS)
    limits = cut(thresholds(shares, quantile, 0.0, 1.0).select("g_lang", "g_source", "n_docs", "at"))
    ranks = shares.join(bounded_broadcast(limits), ["g_lang", "g_source"]).groupBy("g_lang", "g_source", "n_docs").agg(
        F.avg((F.col("share") < F.col("at")).cast("int")).alias("below"), F.avg((F.col("share") <= F.col("at")).cast("int")).alias("upto")
    )
    near = F.lit(2 * RANK_ERROR) + 1 / F.col("n_docs")
    return ranks.select("g_lang", "g_source", "n_docs", ((F.col("below") - near <= quantile) & (F.col("upto") + near >= quantile)).cast("int").alias("within"))
