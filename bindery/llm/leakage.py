"""Evaluation texts that leaked into a corpus, by winnowing.

Of every window of w consecutive k-word hashes the least is kept as fingerprint,
so two texts that share k + w - 1 consecutive words share a fingerprint. Corpus
and test fingerprints are joined, and every hit is extended word by word, words
being compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.llm.words import words
from bindery.runtime import cut, small, spread

#: Words in a leaked span; words in a fingerprint. The window follows from both.
SPAN, GRAM = 12, 6
#: Test fingerprints up to this many go to the corpus by broadcast.
BROADCAST_PRINTS = 500_000
SALT = 16


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, each spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all rows, one after another, and where each row's begin and end. A word is hashed once in a batch."""
    import xxhash

    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    ends = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64))))
    coded = pc.dictionary_encode(lists.flatten())
    of = np.array([xxhash.xxh64_intdigest(w.encode()) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return of[np.asarray(coded.indices)] if len(of) else np.zeros(0, dtype=np.uint64), ends


def fingerprints(hashes: np.ndarray, ends: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of the first least k-word hash of every window of each row, each place once."""
    n, span = len(hashes), gram + window - 1
    if n < span:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),)
    grams = np.zeros(n - gram + 1, dtype=np.uint64)
    for i in range(gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - gram + 1 + i]
    grams = _mixed(grams)
    row = np.repeat(np.arange(len(ends) - 1, dtype=np.int64), np.diff(ends))
    begins = np.flatnonzero(np.arange(n - span + 1) + span <= ends[row[: n - span + 1] + 1])
    least = np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1)[begins]
    places = np.unique(begins + least)
    return row[places], places, grams[places]


def _printed(gram: int, reach: int, known: np.ndarray | None, bare: bool):
    """A batch function from (name, words) to fingerprints with the words around them (or bare hashes); only hashes in `known`, sorted, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ends = _word_hashes(batch.column(1))
            row, at, h = fingerprints(hashes, ends, gram, reach + 1)
            h = h.view(np.int64)
            if bare:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(h))], names=["h"])
                continue
            if known is not None:
                hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h if len(known) else np.zeros(len(h), dtype=bool)
                row, at, h = row[hit], at[hit], h[hit]
            first = np.maximum(at - reach, ends[row])
            size = np.minimum(at + gram + reach, ends[row + 1]) - first
            offsets = np.concatenate(([0], np.cumsum(size)))
            around = hashes.view(np.int64)[np.repeat(first - offsets[:-1], size) + np.arange(offsets[-1])]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(around, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(h, pa.int64()), pa.array(at - first, pa.int32()), lists], names=["name", "h", "before", "around"])

    return run


def _prints(df: DataFrame, key: str, text: str, span: int, gram: int, name: str, known: np.ndarray | None = None, bare: bool = False) -> DataFrame:
    """(name, h, before, around): each fingerprint with the hashes of the words around it, and how many of them precede it; or (h) alone."""
    read = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("name"), words(F.col(text)).alias("w"))
    shape = "h long" if bare else f"name {read.schema['name'].dataType.simpleString()}, h long, before int, around array<long>"
    made = read.mapInArrow(_printed(gram, span - gram, known, bare), shape)
    return made if bare else made.select(F.col("name").alias(name), "h", F.col("before").alias(f"{name}_before"), F.col("around").alias(f"{name}_around"))


def _extends(span: int, gram: int) -> Column:
    """Whether the words around two equal fingerprints agree over `span` words that hold it."""
    d, i, db, ib = F.col("doc_around"), F.col("item_around"), F.col("doc_before"), F.col("item_before")
    left = F.least(db, ib)
    return F.exists(
        F.sequence(F.lit(0), F.lit(span - gram)),
        lambda o: (o <= left) & (F.size(F.slice(d, db - o + 1, span)) == span) & (F.slice(d, db - o + 1, span) == F.slice(i, ib - o + 1, span)),
    )


def leaks(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", broadcast_prints: int = BROADCAST_PRINTS) -> DataFrame:
    """(doc_key, item_key): documents that hold at least `span` consecutive words of an item.

    Every such pair is found (the window guarantees a common fingerprint) and
    every pair is verified on its words. Texts that are null or shorter than
    `span` words leak nothing. Rows are distinct. Up to `broadcast_prints` test
    fingerprints go to the corpus by broadcast. If there are more, those that no
    document has are left out first; if there still are, both sides are shuffled
    by hash, the corpus side salted.
    """
    tests = cut(_prints(items, item_key, text, span, gram, "item").distinct())
    corpus = lambda known=None, bare=False: _prints(spread(docs), doc_key, text, span, gram, "doc", known, bare)
    if not small(tests, broadcast_prints):
        # Bare hashes first: most test fingerprints are in no document.
        met = cut(corpus(bare=True).distinct().join(tests.select("h").distinct(), "h"))
        tests = cut(tests.join(met, "h", "left_semi"))
    if small(tests, broadcast_prints):
        hashes = tests.select("h").distinct().toPandas()["h"].to_numpy(dtype=np.int64)
        hits = corpus(np.sort(hashes)).join(F.broadcast(tests), "h")
    else:
        salted = tests.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        # Spread by document: copies of a hot passage in many documents go to all salts.
        hits = corpus().withColumn("salt", F.pmod(F.hash("doc"), F.lit(SALT))).join(salted, ["h", "salt"])
    return hits.filter(_extends(span, gram)).select(F.col("doc").alias(doc_key), F.col("item").alias(item_key)).distinct()
