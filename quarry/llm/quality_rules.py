"""Quality rules from hashed n-grams.

A logistic regression over hashed words and character n-grams is trained on
labelled quality rows, calibrated to probabilities on rows it was not fitted
to, and scores documents in Arrow batches against fixed thresholds.

Features are relative frequencies: every document has a mass of one for its
words, its pairs of neighbouring words and its character n-grams of each order, spread over hash buckets.  A
score is therefore the mean weight of what the text holds, and is computed
for a slice of documents by gathers and segment sums over whole texts.

Edge cases: a null text counts as empty; an empty text has no features, and
its probability is that of the intercept; repeated rows score alike; an
empty table gives no rows; other columns are passed through by ``judge``.
Without labels of both classes the model keeps what the rules keep.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.labelled import labelled_sample
from quarry.llm.textbuf import TextSlice, base_counts, slices

#: Buckets: words and word pairs, then one range for each character order.
WORD_BITS, CHAR_BITS, CHAR_ORDERS = 13, 13, (2, 4)
N_FEATURES = (2 << WORD_BITS) + len(CHAR_ORDERS) * (1 << CHAR_BITS)
#: Fit on at most this many labelled rows.
MAX_TRAIN_ROWS = 2500
#: Fixed thresholds.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
KEEP_PROBABILITY = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _families(s: TextSlice):
    """For each feature family: bucket of every item, document of every item."""
    yield (s.word_hash >> np.uint64(64 - WORD_BITS)).astype(np.int64), s.word_doc
    pair, doc, echo = s.bigrams()
    bucket = (pair >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    bucket[echo] = 0  # a word that follows itself is one feature, whatever the word
    yield bucket + (1 << WORD_BITS), doc
    for k, n in enumerate(CHAR_ORDERS):
        first = (2 << WORD_BITS) + k * (1 << CHAR_BITS)
        if len(s.cp) < n:
            yield np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            continue
        hashes = s.rolling.every(n)
        doc = np.repeat(np.arange(s.n_docs), np.diff(s.offsets))
        whole = doc[: len(hashes)] == doc[n - 1 :]
        bucket = (hashes >> np.uint64(64 - CHAR_BITS)).astype(np.int64) + first
        yield bucket[whole], doc[: len(hashes)][whole]


@dataclass
class Model:
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def probability(self, s: TextSlice) -> np.ndarray:
        z = np.full(s.n_docs, self.intercept)
        for bucket, doc in _families(s):
            n = np.maximum(np.bincount(doc, minlength=s.n_docs), 1)
            z += np.bincount(doc, weights=self.weights[bucket], minlength=s.n_docs) / n
        return _sigmoid(self.slope * z + self.shift)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _featurize(batches):
    """Sparse relative frequencies of each document."""
    for b in batches:
        texts, label = b.column("text"), b.column("label").to_pylist()
        for lo, hi in slices(texts):
            s = TextSlice(texts.slice(lo, hi - lo))
            idx, val, doc = [], [], []
            for bucket, d in _families(s):
                pair, count = np.unique(d * N_FEATURES + bucket, return_counts=True)
                own = pair // N_FEATURES
                idx.append(pair % N_FEATURES)
                val.append(count / np.maximum(np.bincount(d, minlength=s.n_docs), 1)[own])
                doc.append(own)
            idx, val, doc = map(np.concatenate, (idx, val, doc))
            order = np.argsort(doc, kind="stable")
            cut = np.cumsum(np.bincount(doc, minlength=s.n_docs))[:-1]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").slice(lo, hi - lo), pa.array(label[lo:hi], pa.int32()),
                pa.array([x.astype(np.uint16).tobytes() for x in np.split(idx[order], cut)], pa.binary()),
                pa.array([x.astype(np.float32).tobytes() for x in np.split(val[order], cut)], pa.binary())],
                ["doc_id", "label", "idx", "val"])


#: idx: bucket numbers as 16-bit words; val: their shares as 32-bit floats.
_FEATURES = "doc_id string, label int, idx binary, val binary"


def fit(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS,
        steps: int = 150, penalty: float = 1e-5) -> Model:
    """Fit and calibrate on a bounded sample of labelled documents.

    Feature vectors are made in Spark; at most `max_train_rows` of them, each
    of at most N_FEATURES entries whatever the length of its text, reach the
    driver.  Every fifth row by hash of doc_id is left out of the fit and
    calibrates the probabilities (a line on the log-odds).
    """
    sample = labelled_sample(docs, labels, "quality", max_train_rows)
    sample = sample.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "label")
    rows = sample.mapInArrow(_featurize, _FEATURES).toArrow()
    order = np.argsort(np.array(rows["doc_id"].to_pylist(), dtype=str), kind="stable")
    y = rows["label"].to_numpy()[order].astype(float)
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(N_FEATURES), 20.0, 1.0, 0.0)
    parts = [_sparse(rows, order[lo : lo + 250]) for lo in range(0, len(y), 250)]  # worked through in parts
    del rows
    held = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        held[:] = False
    fitted = (~held).astype(float)
    w, b = np.zeros(N_FEATURES), 0.0
    m, v = np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1)
    for t in range(1, steps + 1):  # full-batch Adam: the sample is small
        err = (_sigmoid(_margins(parts, w) + b) - y) * fitted / fitted.sum()
        g, lo = np.append(penalty * w, err.sum()), 0
        for idx, val, row, n in parts:
            g[:-1] += np.bincount(idx, weights=err[lo : lo + n][row] * val, minlength=N_FEATURES)
            lo += n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.5 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        w, b = w - step[:-1], b - step[-1]
    z = _margins(parts, w) + b
    on = held if held.any() else ~held
    slope, shift = _calibrate(z[on], y[on])
    return Model(w, float(b), slope, shift)


def _sparse(rows: pa.Table, own: np.ndarray):
    """Bucket, value and row of every entry of some rows, and the number of rows."""
    idx = [np.frombuffer(rows["idx"][int(k)].as_py(), dtype=np.uint16) for k in own]
    val = [np.frombuffer(rows["val"][int(k)].as_py(), dtype=np.float32) for k in own]
    row = np.repeat(np.arange(len(own), dtype=np.int16), [len(x) for x in idx])
    return np.concatenate(idx), np.concatenate(val), row, len(own)


def _margins(parts, w: np.ndarray) -> np.ndarray:
    return np.concatenate([np.bincount(row, weights=w[idx] * val, minlength=n) for idx, val, row, n in parts])


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log-odds by Newton steps, with smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([z, np.ones_like(z)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ theta)
        g = x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        theta = theta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def _scorer(model: Model, names: list[str], text: str):
    def score(batches):
        for b in batches:
            texts = b.column(text)
            parts = {c: [] for c in [*COUNTS, "quality_probability"]}
            for lo, hi in slices(texts):
                s = TextSlice(texts.slice(lo, hi - lo))
                for c, x in base_counts(s).items():
                    parts[c].append(x)
                parts["quality_probability"].append(model.probability(s))
            made = {c: np.concatenate(x) if x else np.zeros(0) for c, x in parts.items()}
            failed = ((made["n_words"] < MIN_WORDS)
                      | (100 * made["n_repeat_words"] > MAX_REPEATED_PERCENT * made["n_words"]))
            kept = ~failed & (made["quality_probability"] >= KEEP_PROBABILITY)
            cols = [b.column(c) for c in names]
            cols += [pa.array(made[c].astype(np.int64)) for c in COUNTS]
            cols += [pa.array(failed.astype(bool)), pa.array(made["quality_probability"].astype(float)),
                     pa.array(kept.astype(bool))]
            yield pa.RecordBatch.from_arrays(cols, [*names, *COUNTS, "base_failed", "quality_probability", "kept"])
    return score


def judge(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Counts, rule verdict, probability and final verdict of every document.

    `carry` names the columns to pass through (default: all).  A carried
    column named like a result gets the prefix ``in_``.
    """
    carry = docs.columns if carry is None else carry
    result = {*COUNTS, "base_failed", "quality_probability", "kept", "_judged"}
    renamed = [c if c not in result else f"in_{c}" for c in carry]
    need = [F.col(f"`{c}`").alias(r) for c, r in zip(carry, renamed, strict=True)]
    src = docs.select(*need, F.col(f"`{text}`").alias("_judged"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "_judged"])
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("base_failed", "boolean").add("quality_probability", "double").add("kept", "boolean")
    return src.mapInArrow(_scorer(model, renamed, "_judged"), schema)
