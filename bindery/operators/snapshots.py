"""What changed between full snapshots, by invertible Bloom lookup tables.

A record of a snapshot is an element (rec_id, digest of its compared values).
Every hash bucket of a snapshot pair has a table of cells; an element is added
to three of them (count, and the exclusive or of id, digest and check). The
earlier snapshot's cells are subtracted within the same aggregation, so equal
elements cancel and only differing ones stay.

Rows are shuffled once, by relation and bucket. The latest delivery of a record,
its two signs, the tables and their peeling follow within that partition. Records
that hold a large share of a snapshot's deliveries are aggregated before it.

A bucket whose cells do not peel down to nothing, or whose recovered elements
do not give the bucket's own digest, is done again with a larger table; a bucket
that still fails after the last enlargement is compared by a join.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import bounded_broadcast, cut

#: Deliveries of one snapshot per hash bucket, cells of its first table, growth of a failed one.
BUCKET_RECORDS, CELLS, GROWTH, ROUNDS = 2_000, 1_200, 4, 5
#: A record with this share of a snapshot's deliveries is aggregated before the shuffle; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.01
_PAIR = ["rel", "snapshot_no", "bucket"]


# White space of any kind.
SPACES = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def number_text(written: Column) -> Column:
    """One spelling for every way of writing a number; other text trimmed; blank is null."""
    bare = F.replace(F.btrim(written, F.lit(SPACES)), F.lit(","), F.lit("."))

    def one(text: Column) -> Column:
        number = text.try_cast("decimal(38,12)").cast("string")
        plain = F.rtrim(F.rtrim(number, F.lit("0")), F.lit("."))
        return F.when(text == "", None).otherwise(F.coalesce(F.when(plain.isin("-0", "-", ""), "0").otherwise(plain), F.concat(F.lit("t:"), text)))

    return one(bare)


def _hash(*columns: Column) -> Column:
    return F.xxhash64(*columns)


def _check(rec_id: int, digest: int) -> int:
    """xxhash64(rec_id, digest) as Spark computes it."""
    import xxhash

    seed = xxhash.xxh64_intdigest(struct.pack("<q", rec_id), 42)
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<q", digest), seed)))[0]


def _places(rec_id: int, digest: int, cells: int) -> list[int]:
    import xxhash

    seed = xxhash.xxh64_intdigest(struct.pack("<q", digest), xxhash.xxh64_intdigest(struct.pack("<q", rec_id), 42))
    third = cells // 3
    return [j * third + struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<q", j), seed)))[0] % third for j in range(3)]


def _sides(steps: DataFrame) -> DataFrame:
    """(rel, snapshot_no, at, sign): the pair that a snapshot ends (+1) and the pair that it begins (-1), named by the later one."""
    beside = steps.groupBy("rel").agg(F.sort_array(F.collect_list("snapshot_no")).alias("all"))
    own = F.transform("all", lambda s, i: F.struct(s.alias("snapshot_no"), F.when(i > 0, s).alias("at"), F.lit(1).alias("sign")))
    next_ = F.transform("all", lambda s, i: F.struct(s.alias("snapshot_no"), F.get("all", i + 1).alias("at"), F.lit(-1).alias("sign")))
    return beside.select("rel", F.inline(F.concat(own, next_))).filter("at is not null")


def _elements(rows: DataFrame, steps: DataFrame, buckets: int, failed: DataFrame | None = None) -> DataFrame:
    """(rel, snapshot_no, bucket, rec_id, digest, sign): of each record in each snapshot the row delivered last, once for each pair it is in.

    Partitioned by rel and bucket; no later aggregation by these moves a row. Only
    of the buckets in `failed`, if given; other rows go before they are read whole.
    """
    placed = rows.withColumn("bucket", F.pmod(_hash(F.col("rec_id")), F.lit(buckets).cast("long")).cast("int"))
    if failed is not None:
        placed = placed.join(bounded_broadcast(failed.select("rel", "bucket").distinct()), ["rel", "bucket"], "left_semi")
    last = F.max(F.struct("at", "digest")).alias("m")
    keys = ["rel", "bucket", "snapshot_no", "rec_id"]
    hot = [r["rec_id"] for r in steps.select(F.explode("hot").alias("rec_id")).distinct().collect()]
    if hot:
        early = placed.filter(F.col("rec_id").isin(hot)).groupBy(*keys).agg(last).select(*keys, "m.*")
        placed = placed.filter(~F.col("rec_id").isin(hot)).select(*keys, "at", "digest").unionByName(early)
    state = placed.repartition("rel", "bucket").groupBy(*keys).agg(last)
    sides = bounded_broadcast(cut(_sides(steps)))
    return state.join(sides, ["rel", "snapshot_no"]).select("rel", F.col("at").alias("snapshot_no"), "bucket", "rec_id", F.col("m.digest").alias("digest"), "sign")


def _cells(elements: DataFrame, cells: int) -> DataFrame:
    """(pair, bucket, list of cells); cell -1 holds the bucket's own digest."""
    third = cells // 3
    place = F.array(F.lit(-1), *((F.lit(j * third) + F.pmod(_hash(F.col("rec_id"), F.col("digest"), F.lit(j).cast("long")), F.lit(third).cast("long"))).cast("int") for j in range(3)))
    summed = (
        elements.select(*_PAIR, "sign", "rec_id", "digest", _hash(F.col("rec_id"), F.col("digest")).alias("chk"), F.explode(place).alias("cell"))
        .groupBy(*_PAIR, "cell")
        .agg(F.sum("sign").alias("n"), F.bit_xor("rec_id").alias("k"), F.bit_xor("digest").alias("d"), F.bit_xor("chk").alias("c"))
    )
    full = summed.filter((F.col("n") != 0) | (F.col("k") != 0) | (F.col("d") != 0) | (F.col("c") != 0))
    return full.groupBy(*_PAIR).agg(F.collect_list(F.struct("cell", "n", "k", "d", "c")).alias("cells"))


def _peel(table: list, cells: int) -> list[tuple[int, int]] | None:
    """(sign, rec_id) of the differing elements; None if the table can't be read."""
    own = {"n": 0, "c": 0}
    at: dict[int, list[int]] = {}
    for x in table:
        if x["cell"] < 0:
            own = x
        else:
            at[x["cell"]] = [x["n"], x["k"], x["d"], x["c"]]
    found, todo = [], list(at)
    n, c = 0, 0
    while todo:
        x = at.get(todo.pop())
        if x is None or abs(x[0]) != 1 or _check(x[1], x[2]) != x[3]:
            continue
        sign, key, digest, chk = x
        found.append((sign, key))
        n, c = n + sign, c ^ chk
        for p in _places(key, digest, cells):
            y = at.setdefault(p, [0, 0, 0, 0])
            y[0] -= sign
            y[1] ^= key
            y[2] ^= digest
            y[3] ^= chk
            if any(y):
                todo.append(p)
            else:
                del at[p]
        if len(found) > 4 * cells:
            return None
    return found if not at and n == own["n"] and c == own["c"] else None


def _classify(found: list[tuple[int, int]]) -> dict[int, str] | None:
    signs: dict[int, list[int]] = {}
    for sign, key in found:
        signs.setdefault(key, []).append(sign)
    names = {(1,): "added", (-1,): "removed", (-1, 1): "changed"}
    kinds = {key: names.get(tuple(sorted(s))) for key, s in signs.items()}
    return None if None in kinds.values() else kinds


def _read(cells: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for rel, step, bucket, table in zip(pdf["rel"], pdf["snapshot_no"], pdf["bucket"], pdf["cells"]):
                found = _peel([{k: (v if k == "cell" else int(v)) for k, v in x.items()} for x in table], cells)
                kinds = None if found is None else _classify(found)
                rows += [(rel, step, bucket, 0, "failed")] if kinds is None else [(rel, step, bucket, k, d) for k, d in kinds.items()]
            yield pd.DataFrame(rows, columns=["rel", "snapshot_no", "bucket", "rec_id", "delta"])

    return run


def _joined(elements: DataFrame) -> DataFrame:
    """The exact way for buckets that no table could hold."""
    signs = elements.groupBy(*_PAIR, "rec_id", "digest").agg(F.sum("sign").alias("n")).filter("n <> 0").groupBy(*_PAIR, "rec_id").agg(F.sort_array(F.collect_list("n")).alias("s"))
    one = F.element_at("s", 1)
    return signs.select(*_PAIR, "rec_id", F.when(F.size("s") == 2, "changed").when(one > 0, "added").otherwise("removed").alias("delta"))


def deliveries(df: DataFrame, rel: str, key: str, compared: list[Column], at: str = "delivered_at") -> DataFrame:
    """(rel, snapshot_no, rec_id, at, digest) of each delivered row. Rows without key or snapshot number are left out."""
    present = [c.isNotNull().cast("long") for c in compared]
    digest = _hash(*(x for pair in zip(present, compared) for x in pair))
    rows = df.filter(F.col(key).isNotNull() & F.col("snapshot_no").isNotNull())
    return rows.select(F.lit(rel).alias("rel"), F.col("snapshot_no").cast("int").alias("snapshot_no"), F.col(key).cast("long").alias("rec_id"), F.col(at).alias("at"), digest.alias("digest"))


def deltas(rows: DataFrame, bucket_records: int = BUCKET_RECORDS, cells: int = CELLS, hot_share: float = HOT_SHARE) -> DataFrame:
    """(rel, snapshot_no, rec_id, delta) between consecutive snapshots of each relation of `rows` (see deliveries).

    Of several rows of a record in a snapshot the one delivered last counts; of
    rows delivered at the same time the one with the greatest digest, so the
    result is stable; a null time is the earliest. No rows, or one snapshot, give
    no rows. snapshot_no is the later one.
    """
    # The sketch keeps every record with such a share (and few others); it sees rec_id only.
    tops = F.expr(f"approx_top_k(rec_id, {int(1 / hot_share)}, {int(20 / hot_share)})")
    steps = rows.groupBy("rel", "snapshot_no").agg(F.count(F.lit(1)).alias("n"), tops.alias("tops"))
    steps = cut(steps.select("rel", "snapshot_no", "n", F.transform(F.filter("tops", lambda t: t["count"] > F.greatest(F.col("n") * hot_share, F.lit(2))), lambda t: t["item"]).alias("hot")))
    buckets = max(1, (steps.agg(F.max("n")).first()[0] or 0) // bucket_records)
    elements, done, failed = _elements(rows, steps, buckets), None, None
    schema = "rel string, snapshot_no int, bucket int, rec_id long, delta string"
    for attempt in range(ROUNDS):
        if attempt:
            # Only if some bucket failed are its elements made again, and kept.
            again = _elements(rows, steps, buckets, failed) if attempt == 1 else elements
            elements = cut(again.join(bounded_broadcast(failed), _PAIR, "left_semi"))
        read = cut(_cells(elements, cells).mapInPandas(_read(cells), schema))
        good = read.filter("delta <> 'failed'").select("rel", "snapshot_no", "rec_id", "delta")
        done = good if done is None else done.unionByName(good)
        failed = read.filter("delta = 'failed'").select(*_PAIR)
        if failed.isEmpty():
            return done
        cells *= GROWTH
    left = elements.join(bounded_broadcast(failed), _PAIR, "left_semi")
    return done.unionByName(_joined(left).select("rel", "snapshot_no", "rec_id", "delta"))
