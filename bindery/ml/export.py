"""Feature matrices as tables, metadata of a network, and its exchange as an ONNX graph.

The graph is written as protocol-buffer bytes here: subtract the means, divide by
the deviations, then products, sums and rectifiers, and a sigmoid at the end.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.ml.features import padded
from bindery.ml.model import Network


def write_matrix(rows: DataFrame, path: str) -> None:
    """Feature and label vectors (features, labels, and whatever tells the rows apart) to a Parquet folder."""
    rows.write.mode("overwrite").parquet(path)


def read_matrix(spark: SparkSession, path: str, width: int, labels: int) -> DataFrame:
    """The matrix of a folder; vectors of older sets of features or labels are filled with zeros."""
    rows = spark.read.parquet(path)
    more = lambda c, n: F.concat(c, F.array_repeat(F.lit(0), F.greatest(F.lit(n) - F.size(c), F.lit(0))))
    return rows.withColumns({"features": padded(F.col("features"), width), "labels": more(F.col("labels"), labels)})


def metadata(network: Network, names: list[str]) -> str:
    """Names, scaler and thresholds of a network, as JSON."""
    return json.dumps({"feature_names": names, "scaler_mean": network.mean, "scaler_scale": network.scale, "field_names": network.fields, "field_thresholds": dict(zip(network.fields, network.thresholds))})


def thresholds_of(text: str | None, fields: list[str], default: float = 0.5) -> list[float]:
    """The threshold of each field from metadata; `default` for a field that has none, or a wrong one, and for missing or broken metadata."""
    try:
        known = json.loads(text or "{}")["field_thresholds"]
    except (ValueError, KeyError, TypeError):
        known = {}
    told = [known.get(f) if isinstance(known, dict) else None for f in fields]
    return [float(t) if isinstance(t, (int, float)) and not isinstance(t, bool) else default for t in told]


# --- ONNX ----------------------------------------------------------------------


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: int | bytes | str) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _tensor(name: str, values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, dtype="<f4")
    return b"".join(_field(1, d) for d in values.shape) + _field(2, 1) + _field(8, name) + _field(9, values.tobytes())


def _value(name: str, width: int) -> bytes:
    shape = _field(1, _field(2, "n")) + _field(1, _field(1, width))
    return _field(1, name) + _field(2, _field(1, _field(1, 1) + _field(2, shape)))


def to_onnx(network: Network) -> bytes:
    """The network as an ONNX model: input `features` (n, width), output `probabilities` (n, fields), single precision."""
    nodes, tensors, at = [], [], "features"

    def step(kind: str, to: str, *more: tuple[str, np.ndarray]) -> None:
        nonlocal at
        tensors.extend(_tensor(n, v) for n, v in more)
        nodes.append(b"".join(_field(1, n) for n in (at, *(n for n, _ in more))) + _field(2, to) + _field(3, to) + _field(4, kind))
        at = to

    step("Sub", "centred", ("mean", np.array(network.mean)))
    step("Div", "scaled", ("scale", np.array(network.scale)))
    for i, (w, b) in enumerate(zip(network.weights, network.biases)):
        step("MatMul", f"product_{i}", (f"weights_{i}", np.array(w)))
        step("Add", f"sum_{i}", (f"bias_{i}", np.array(b)))
        if i < len(network.weights) - 1:
            step("Relu", f"hidden_{i}")
    step("Sigmoid", "probabilities")
    graph = b"".join(_field(1, n) for n in nodes) + _field(2, "detector") + b"".join(_field(5, t) for t in tensors)
    graph += _field(11, _value("features", len(network.mean))) + _field(12, _value("probabilities", len(network.fields)))
    return _field(1, 8) + _field(7, graph) + _field(8, _field(1, "") + _field(2, 13))


def largest_difference(network: Network, model: bytes, rows: np.ndarray) -> float:
    """Greatest difference between the network's probabilities and those of its ONNX model on some rows."""
    import onnxruntime

    session = onnxruntime.InferenceSession(model, providers=["CPUExecutionProvider"])
    told = session.run(None, {"features": rows.astype(np.float32)})[0]
    return float(np.abs(told - network.forward(rows)).max()) if len(rows) else 0.0
