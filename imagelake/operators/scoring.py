"""Batch scoring and feature extraction.

The network runs in ``mapInPandas`` on Arrow record batches, never per row;
a batch is bounded both in rows (``spark.sql.execution.arrow.maxRecordsPerBatch``)
and in bytes (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB by default),
so full-size pictures arrive a few dozen at a time. Weights travel
once as a broadcast variable - their size is fixed by the model, not by the
data - and each Python worker builds the model once (module-level cache). A
dense head runs in NumPy; a full network can be given as an ONNX file on shared
storage (``onnxruntime``, loaded once per worker).
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ACTIVATIONS = ("linear", "relu", "sigmoid", "softmax")


@dataclass(frozen=True)
class ModelSpec:
    """A model to score with. ``layers`` is a tuple of ``(W[in, out], b[out], activation)``;
    ``scaling`` records how training inputs were scaled (``unit`` = x/255,
    ``signed`` = x/127.5-1, ``raw``) so mismatched inputs are refused.
    ``exact_sums`` adds each unit's inputs in input order with plain products
    instead of a BLAS product: scores are then bit-identical on every machine,
    thread count and retried task (and equal to the same sum written in SQL), at
    the cost of memory per batch proportional to inputs x units - meant for heads,
    not full networks."""
    name: str
    layers: tuple = ()
    scaling: str = "raw"
    exact_sums: bool = False
    onnx_path: str | None = None
    onnx_output: str | None = None
    meta: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def key(self) -> str:
        h = hashlib.sha1(self.name.encode())
        for w, b, act in self.layers:
            h.update(np.ascontiguousarray(w).tobytes())
            h.update(np.ascontiguousarray(b).tobytes())
            h.update(act.encode())
        h.update(str(self.onnx_path).encode())
        h.update(b"exact" if self.exact_sums else b"blas")
        return h.hexdigest()


def dense_spec(name: str, weights: list[tuple[np.ndarray, np.ndarray, str]], scaling: str = "raw",
               exact_sums: bool = False) -> ModelSpec:
    for w, b, act in weights:
        if act not in ACTIVATIONS:
            raise ValueError(f"unknown activation {act}")
        if w.shape[1] != b.shape[0]:
            raise ValueError("weight and bias shapes differ")
    return ModelSpec(name=name, layers=tuple((np.asarray(w, np.float64), np.asarray(b, np.float64), a)
                                             for w, b, a in weights), scaling=scaling, exact_sums=exact_sums)


# per-Python-worker cache: spec key -> callable(batch ndarray) -> ndarray
_MODELS: dict[str, object] = {}


def _activate(x: np.ndarray, act: str) -> np.ndarray:
    if act == "relu":
        return np.maximum(x, 0.0)
    if act == "sigmoid":
        return 1.0 / (1.0 + np.exp(-x))
    if act == "softmax":
        z = x - x.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)
    return x


def _build(spec: ModelSpec, upto: int | None):
    if spec.onnx_path:
        import onnxruntime as ort  # optional dependency, imported on the worker
        sess = ort.InferenceSession(spec.onnx_path, providers=["CPUExecutionProvider"])
        inp = sess.get_inputs()[0].name
        out = [spec.onnx_output] if spec.onnx_output else None
        return lambda x: np.asarray(sess.run(out, {inp: x.astype(np.float32)})[0], np.float64)
    layers = spec.layers if upto is None else spec.layers[:upto]

    def affine_map(h, w, b):
        if spec.exact_sums:  # running sum over inputs in index order
            return np.cumsum(h[:, :, None] * w[None, :, :], axis=1)[:, -1, :] + b
        return h @ w + b

    def forward(x):
        h = x.astype(np.float64, copy=False)
        for w, b, act in layers:
            h = _activate(affine_map(h, w, b), act)
        return h
    return forward


def _model(bc, upto):
    spec: ModelSpec = pickle.loads(bc.value)
    k = f"{spec.key}:{upto}"
    m = _MODELS.get(k)
    if m is None:
        m = _MODELS[k] = _build(spec, upto)
    return m


def _check_scaling(spec: ModelSpec, input_scaling: str | None) -> None:
    if input_scaling is not None and input_scaling != spec.scaling:
        raise ValueError(f"model {spec.name} expects '{spec.scaling}' inputs, got '{input_scaling}'")


def _stack(col) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in col]) if len(col) else np.zeros((0, 0))


def score_batch(df: DataFrame, spec: ModelSpec, features_col: str = "features",
                keep: list[str] | None = None, input_scaling: str | None = None) -> DataFrame:
    """Forward pass per Arrow batch (E1): ``keep`` columns + ``probs ARRAY<DOUBLE>``,
    ``class_id`` (first maximum) and ``confidence``."""
    _check_scaling(spec, input_scaling)
    keep = [c for c in df.columns if c != features_col] if keep is None else keep
    bc = df.sparkSession.sparkContext.broadcast(pickle.dumps(spec))
    schema = T.StructType([df.schema[c] for c in keep] + [
        T.StructField("probs", T.ArrayType(T.DoubleType())),
        T.StructField("class_id", T.IntegerType()),
        T.StructField("confidence", T.DoubleType())])

    def run(batches):
        model = _model(bc, None)
        for pdf in batches:
            out = pdf[keep].copy()
            if len(pdf):
                p = model(_stack(pdf[features_col]))
                idx = p.argmax(axis=1)  # first maximum, as the reference
                out["probs"] = list(p)
                out["class_id"] = idx.astype(np.int32)
                out["confidence"] = p[np.arange(len(p)), idx]
            else:
                out["probs"], out["class_id"], out["confidence"] = [], [], []
            yield out

    return df.select(*keep, features_col).mapInPandas(run, schema)


def extract_features(df: DataFrame, spec: ModelSpec, upto: int, features_col: str = "pixels",
                     out_col: str = "features", keep: list[str] | None = None,
                     input_scaling: str | None = None) -> DataFrame:
    """Output of the first ``upto`` layers as ``ARRAY<FLOAT>`` (E2): the frozen base,
    run once and written as a reusable table by the caller."""
    _check_scaling(spec, input_scaling)
    keep = [c for c in df.columns if c != features_col] if keep is None else keep
    bc = df.sparkSession.sparkContext.broadcast(pickle.dumps(spec))
    schema = T.StructType([df.schema[c] for c in keep] + [
        T.StructField(out_col, T.ArrayType(T.FloatType()))])

    def run(batches):
        model = _model(bc, upto)
        for pdf in batches:
            out = pdf[keep].copy()
            out[out_col] = list(model(_stack(pdf[features_col])).astype(np.float32)) if len(pdf) else []
            yield out

    return df.select(*keep, features_col).mapInPandas(run, schema)


def rule_head(n_in: int, n_out: int) -> ModelSpec:
    """A linear softmax head whose weights follow a fixed rule:
    ``W[j, k] = ((7 j + 13 k) mod 17 - 8) / 8``, zero bias (used by the checks)."""
    j = np.arange(n_in)[:, None]
    k = np.arange(n_out)[None, :]
    w = ((7 * j + 13 * k) % 17 - 8) / 8.0
    return dense_spec("rule_head", [(w, np.zeros(n_out), "softmax")])


def rule_mlp(n_in: int, n_hidden: int, n_out: int, exact_sums: bool = False) -> ModelSpec:
    """Two-layer rule-based network (ReLU hidden layer) for feature extraction checks."""
    j = np.arange(n_in)[:, None]
    h = np.arange(n_hidden)[None, :]
    w1 = ((5 * j + 3 * h) % 11 - 5) / 10.0
    w2 = ((np.arange(n_hidden)[:, None] + 2 * np.arange(n_out)[None, :]) % 7 - 3) / 3.0
    return dense_spec("rule_mlp", [(w1, np.zeros(n_hidden), "relu"), (w2, np.zeros(n_out), "softmax")],
                      exact_sums=exact_sums)
