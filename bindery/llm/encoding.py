"""Encoding of a corpus with a public tokenizer through a table of its distinct words.

Byte-level pair encodings merge only within the words their pattern splits off.
So the words are split in Spark, each distinct word is encoded once, and the ids
are joined back by position. The most frequent words, of a set number, are joined
in place by broadcast, so a text's places are never shuffled; only its other
words, each once, go through a join of their own and come back to the text.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.runtime import cut, kept, spread

VOCABULARIES = "/opt/tokenizers"
#: At most this many words are joined by broadcast: all if there are no more, else those with at least 1 / HOT_WORDS of all words, which are no more by arithmetic.
HOT_WORDS = 200_000
# Fixed value: how the vocabulary splits a text; written with explicit Unicode classes for the JVM.
_WS = r"[\p{IsWhite_Space}]"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{IsWhite_Space}}\p{{L}}\p{{N}}]+|{_WS}+(?!\P{{IsWhite_Space}})|{_WS}+"


def vocabulary(name: str, folder: str = VOCABULARIES) -> str:
    """The vocabulary file `name`, as the driver reads it; it travels to the executors with the job."""
    return Path(f"{folder}/{name}.json").read_text(encoding="utf-8")


def tokenizer(text: str):
    """The tokenizer of a vocabulary's text, made once in a process. Strings of special tokens are ordinary text to it."""

    def load():
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_str(text)
        loaded.encode_special_tokens = True
        return loaded

    return kept(("tokenizer", hash(text)), load)


def encode_distinct(words: DataFrame, name: str, folder: str = VOCABULARIES) -> DataFrame:
    """`words`, a table of distinct words (word), with their ids."""
    shared = words.sparkSession.sparkContext.broadcast(vocabulary(name, folder))

    @F.pandas_udf("array<int>")
    def encode(batch: pd.Series) -> pd.Series:
        return pd.Series([x.ids for x in tokenizer(shared.value).encode_batch(batch.tolist(), add_special_tokens=False)])

    return words.withColumn("ids", encode("word"))


def split(text: Column) -> Column:
    """The words of a text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column, without those of nulls, and the place where each row's begin and end."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    return lists.flatten(), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def _coded(words: pa.Array, table: pa.Table) -> tuple[pa.Array, pa.Array]:
    """By row of words: the ids of those in `table` (word, ids), -1 - n for the row's n-th other word; and its other words, each once."""
    flat, ends = _flat(words)
    known_ids, known_ends = _flat(table["ids"])
    known_ids = np.asarray(known_ids, dtype=np.int32)
    found = pc.index_in(flat, value_set=table["word"])
    other = np.asarray(found.is_null())
    at = np.asarray(found.fill_null(0), dtype=np.int64)
    at[other] = 0
    size = np.ones(len(at), dtype=np.int64)
    if table.num_rows:
        size = np.where(other, 1, known_ends[at + 1] - known_ends[at])
    starts = np.concatenate(([0], np.cumsum(size)))
    ids = np.zeros(starts[-1], dtype=np.int32)
    if len(known_ids):
        # The n-th id of a word stands n places behind its first.
        first = np.where(other, 0, known_ends[at])
        source = np.repeat(first - starts[:-1], size) + np.arange(starts[-1])
        ids = known_ids[np.minimum(source, len(known_ids) - 1)]
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[other]
    codes = pc.dictionary_encode(flat.filter(pa.array(other)))
    keys = row * max(1, len(codes.dictionary)) + np.asarray(codes.indices, dtype=np.int64)
    once, place = np.unique(keys, return_inverse=True)
    owner = once // max(1, len(codes.dictionary))
    begins = np.searchsorted(owner, np.arange(len(ends)))
    ids[starts[:-1][other]] = -1 - (place - begins[row])
    rest = codes.dictionary.take(pa.array(once % max(1, len(codes.dictionary))))
    return pa.ListArray.from_arrays(pa.array(starts[ends], pa.int32()), pa.array(ids, pa.int32())), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), rest)


def _hot(table: DataFrame, hot_words: int) -> pa.Table:
    """(word, ids) of the words that are joined in place, at most `hot_words`."""
    n, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
    return table.filter(F.col("count") * hot_words >= (0 if n <= hot_words else total)).select("word", "ids").toArrow()


def encode(docs: DataFrame, name: str, key: str = "doc_id", text: str = "text", folder: str = VOCABULARIES, hot_words: int = HOT_WORDS) -> DataFrame:
    """(key, ids): the token ids of every row, without special tokens.

    Empty and null texts give an empty list, blank texts are encoded as they are.
    Repeated rows and null keys give a row each. Other columns of `docs` are not read.
    """
    rows = spread(docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))).select("k", split(F.col("t")).alias("words"))
    table = cut(encode_distinct(rows.select(F.explode("words").alias("word")).groupBy("word").count(), name, folder))
    sink = pa.BufferOutputStream()
    hot = _hot(table, hot_words)
    with pa.ipc.new_stream(sink, hot.schema) as writer:
        writer.write_table(hot)
    stored = sink.getvalue().to_pybytes()
    shared, stamp = docs.sparkSession.sparkContext.broadcast(stored), hashlib.sha1(stored).hexdigest()

    def code(batches):
        known = kept(("hot words", stamp), lambda: pa.ipc.open_stream(shared.value).read_all().combine_chunks())
        for batch in batches:
            ids, rest = _coded(batch.column("words"), known)
            yield pa.RecordBatch.from_arrays([batch.column("k"), ids, rest], names=["k", "ids", "rest"])

    kind = rows.schema["k"].dataType.simpleString()
    coded = rows.mapInArrow(code, f"k {kind}, ids array<int>, rest array<string>")
    if hot.num_rows == table.count():
        return coded.select(F.col("k").alias(key), "ids")
    # Rows are told apart by a number that the checkpoint fixes.
    coded = cut(coded.withColumn("row", F.monotonically_increasing_id()))
    asked = coded.select("row", F.posexplode("rest").alias("n", "word"))
    told = asked.join(table.select("word", F.col("ids").alias("own")), "word").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "own"))).alias("told"))
    filled = F.flatten(F.transform("ids", lambda x: F.when(x >= 0, F.array(x)).otherwise(F.get("told", -1 - x)["own"])))
    whole = coded.filter(F.size("rest") == 0).select(F.col("k").alias(key), "ids")
    return whole.unionByName(coded.filter(F.size("rest") > 0).join(told, "row").select(F.col("k").alias(key), filled.alias("ids")))


def pieces(spark: SparkSession, name: str, folder: str = VOCABULARIES) -> DataFrame:
    """(id, piece): the bytes of every id of a byte-level vocabulary; its size is fixed by the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unshown = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(unshown)}
    vocab = tokenizer(vocabulary(name, folder)).get_vocab()
    return spark.createDataFrame(pd.DataFrame([(i, bytes(byte[c] for c in piece)) for piece, i in vocab.items() if all(c in byte for c in piece)], columns=["id", "piece"]), "id int, piece binary")


def decode(encoded: DataFrame, name: str, key: str = "doc_id", folder: str = VOCABULARIES) -> DataFrame:
    """(key, text) of (key, ids) with distinct keys, by a join of ids with pieces (a vocabulary: broadcast)."""
    exploded = encoded.select(key, F.posexplode_outer("ids").alias("pos", "id"))
    joined = exploded.join(F.broadcast(pieces(encoded.sparkSession, name, folder)), "id", "left")
    ordered = joined.groupBy(key).agg(F.sort_array(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("pos", F.hex("piece").alias("piece"))))).alias("p"))
    return ordered.select(key, F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["piece"]), "")), "UTF-8").alias("text"))
