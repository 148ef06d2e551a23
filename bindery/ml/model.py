"""Splitting, scaling, oversampling, training and scoring of the multi-label field detector."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.runtime import cut

#: At most this many rows train the network; a documented bound, drawn by hash.
TRAIN_ROWS = 200_000


def positives(rows: DataFrame, fields: list[str], column: str = "labels") -> DataFrame:
    """(field, n_positive, n_rows, ratio) of every label; the ratio is 0 without rows."""
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(column)[i].alias("y")) for i, f in enumerate(fields)))
    counts = rows.select(F.inline(cells)).groupBy("field").agg(F.count_if(F.col("y") == 1).alias("n_positive"), F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("ratio", F.coalesce(F.try_divide(F.col("n_positive") * 1.0, "n_rows"), F.lit(0.0)))


def exact_split(rows: DataFrame, key: list[str], stratum: Column, share: float = 0.8, seed: int = 42) -> DataFrame:
    """`rows` with is_train: the rows of the first `share` of each stratum (rounded up) in the order of a hash of the key.

    Whole strata are never sorted in one task: a place is the number of rows in the
    hash ranges before and the rank within its own. Keys must be distinct and not null.
    """
    bins = 4096
    hashed = cut(rows.withColumns({"_s": stratum.cast("int"), "_h": F.xxhash64(F.lit(seed), *key)}).withColumn("_b", F.pmod("_h", F.lit(bins).cast("long"))))
    sizes = hashed.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n"))
    # At most `bins` rows for a stratum.
    run = Window.partitionBy("_s").orderBy("_b")
    before = sizes.select("_s", "_b", (F.sum("_n").over(run) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy("_s")).alias("_all"))
    ranked = hashed.withColumn("_r", F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", *key))).join(F.broadcast(before), ["_s", "_b"])
    return ranked.withColumn("is_train", F.col("_before") + F.col("_r") <= F.ceil(F.col("_all") * share)).select(*rows.columns, "is_train")


def split(rows: DataFrame, key: list[str], stratum: Column, share: float = 0.8, seed: int = 42) -> DataFrame:
    """`rows` with is_train: by a hash of the key, so each stratum keeps its proportion and a row its side.

    The proportion is kept up to chance, and nothing is shuffled; exact_split keeps it to the row.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), stratum.cast("int"), *key), F.lit(1_000_000))
    return rows.withColumn("is_train", place < int(share * 1_000_000))


def scaler(rows: DataFrame, width: int, column: str = "features") -> tuple[list[float], list[float]]:
    """Mean and population deviation of every feature (deviation 0 becomes 1), in one aggregation."""
    stats = rows.agg(*(f(F.col(column)[i]).alias(f"{n}{i}") for i in range(width) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    return [float(stats[f"m{i}"] or 0.0) for i in range(width)], [float(stats[f"s{i}"] or 0.0) or 1.0 for i in range(width)]


def scaled(vector: Column, mean: list[float], scale: list[float]) -> Column:
    return F.zip_with(F.zip_with(vector, F.array(*map(F.lit, mean)), lambda v, m: v - m), F.array(*map(F.lit, scale)), lambda v, s: v / s)


def oversampling(rows: DataFrame, width: int, target: float = 0.05, most: int = 50, column: str = "labels") -> DataFrame:
    """Rows repeated so that every label reaches `target` of all rows: the factor of a row is the greatest of its labels."""
    counts = rows.agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col(column)[i]).alias(f"p{i}") for i in range(width))).first()
    n = counts["n"]
    extra = [min(most, max(0, int((target * n - p) / ((1 - target) * p)))) if (p := counts[f"p{i}"] or 0) else 0 for i in range(width)]
    factor = F.greatest(F.lit(1), *(F.when(F.col(column)[i] == 1, k + 1).otherwise(1) for i, k in enumerate(extra)))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), factor))).drop("copy")


@dataclass
class Network:
    """A multi-label perceptron with its scaler and thresholds."""

    mean: list[float]
    scale: list[float]
    weights: list[list[list[float]]]
    biases: list[list[float]]
    fields: list[str]
    thresholds: list[float]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Network:
        read = json.loads(text)
        return cls(**(read | {"thresholds": read.get("thresholds") or [0.5] * len(read["fields"])}))

    def forward(self, x: np.ndarray) -> np.ndarray:
        a = (x - np.array(self.mean)) / np.array(self.scale)
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            a = a @ np.array(w) + np.array(b)
            a = np.maximum(a, 0) if i < len(self.weights) - 1 else 1 / (1 + np.exp(-a))
        return a


def train(rows: DataFrame, fields: list[str], mean: list[float], scale: list[float], hidden: tuple[int, ...] = (256, 128), epochs: int = 30, batch: int = 512, rate: float = 1e-3, seed: int = 42, most_rows: int = TRAIN_ROWS, patience: int = 5) -> Network:
    """Fit by Adam with early stopping on a tenth of the rows; at most `most_rows` rows (smallest hashes) come to the driver."""
    picked = rows.select("features", "labels").orderBy(F.xxhash64("features", "labels")).limit(most_rows).toPandas()
    x, y = np.array(picked["features"].tolist(), dtype=np.float64), np.array(picked["labels"].tolist(), dtype=np.float64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held = max(1, len(x) // 10)
    z = (x - np.array(mean)) / np.array(scale)
    zv, yv, z, y = z[order[:held]], y[order[:held]], z[order[held:]], y[order[held:]]
    sizes = [x.shape[1], *hidden, y.shape[1]]
    params = [p for a, b in zip(sizes, sizes[1:]) for p in (rng.normal(0, np.sqrt(2 / a), (a, b)), np.zeros(b))]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0

    def run(data: np.ndarray) -> list[np.ndarray]:
        out = [data]
        for i in range(0, len(params), 2):
            a = out[-1] @ params[i] + params[i + 1]
            out.append(np.maximum(a, 0) if i < len(params) - 2 else 1 / (1 + np.exp(-a)))
        return out

    best, kept, bad = np.inf, [p.copy() for p in params], 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(z)), max(1, len(z) // batch)):
            outs = run(z[part])
            delta, grads = (outs[-1] - y[part]) / max(1, len(part)), []
            for i in range(len(params) - 2, -1, -2):
                grads[:0] = [outs[i // 2].T @ delta, delta.sum(0)]
                delta = (delta @ params[i].T) * (outs[i // 2] > 0)
            step += 1
            for k, g in enumerate(grads):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                params[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        p = np.clip(run(zv)[-1], 1e-9, 1 - 1e-9)
        loss = -(yv * np.log(p) + (1 - yv) * np.log(1 - p)).mean()
        if loss < best - 1e-5:
            best, kept, bad = loss, [q.copy() for q in params], 0
        elif (bad := bad + 1) >= patience:
            break
    return Network(mean, scale, [w.tolist() for w in kept[::2]], [b.tolist() for b in kept[1::2]], list(fields), [0.5] * len(fields))


def train_single(rows: DataFrame, field: str, fields: list[str], width: int, **options) -> Network:
    """A network for one field of labelled rows: its own scaler, oversampling and one output."""
    own = rows.withColumn("labels", F.array(F.col("labels")[fields.index(field)]))
    mean, scale = scaler(own, width)
    return train(oversampling(own, 1), [field], mean, scale, **({"hidden": (64, 32)} | options))


def scores(rows: DataFrame, network: Network, column: str = "features") -> DataFrame:
    """`rows` with probs: one matrix product per Arrow batch."""
    net = network

    @F.pandas_udf("array<double>")
    def infer(batch: pd.Series) -> pd.Series:
        return pd.Series(list(net.forward(np.array(batch.tolist(), dtype=np.float64)))) if len(batch) else pd.Series([], dtype=object)

    return rows.withColumn("probs", infer(F.col(column)))


def forward_columns(vector: Column, network: Network) -> Column:
    """The same as column expressions, without Python; for small networks and parity checks."""
    a = scaled(vector, network.mean, network.scale)
    for i, (w, b) in enumerate(zip(network.weights, network.biases)):
        units = []
        for j, bias in enumerate(b):
            column = F.array(*(F.lit(float(r[j])) for r in w))
            units.append(F.aggregate(F.zip_with(a, column, lambda x, y: x * y), F.lit(float(bias)), lambda s, x: s + x))
        a = F.array(*units)
        a = F.transform(a, lambda x: F.greatest(x, F.lit(0.0))) if i < len(network.weights) - 1 else F.transform(a, lambda x: 1 / (1 + F.exp(-x)))
    return a


def feature_weights(network: Network, names: list[str], n: int = 20) -> list[tuple[str, float]]:
    """The n features with the greatest mean absolute weight of the first layer."""
    means = np.abs(np.array(network.weights[0])).mean(1)
    return sorted(zip(names, means.tolist()), key=lambda x: (-x[1], x[0]))[:n]
