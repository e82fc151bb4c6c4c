"""Quality classifier: additive model with pairwise interactions.

Each document is described by a few numbers (shares of character classes,
repetition, lengths).  The log-odds of good quality are a sum of one lookup
table per number and one per chosen pair of numbers.  The tables are learned
by cyclic boosting: round after round, each feature in turn gets a shallow
tree over its bins, fitted to the current gradients, and the tree's leaf
values are added to its table.  Then the pairs with the largest remaining
gain are boosted the same way.  Scoring is a bin search and an addition of
table entries, vectorised over a batch.

Edge cases: null text counts as empty; empty texts score like any other;
repeated rows score alike; without labels of both classes every score is
the share of label 1 (0.5 without labels); empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.labelled import labelled_sample
from quarry.llm.textbuf import TextSlice, base_counts, slices, table_flags

FEATURES = ["log_words", "log_chars", "word_length", "symbols", "capitals", "digits", "punctuation",
            "exclamations", "bars", "dup_lines", "repeats", "distinct_words", "log_lines", "white",
            "non_ascii", "stops", "top_word", "long_words", "echoes"]
MAX_TRAIN_ROWS = 20_000
MAX_BINS = 32
N_PAIRS = 6


def _flags(test) -> np.ndarray:
    return np.array([bool(test(chr(i))) for i in range(0x250)])


_UPPER, _DIGIT = _flags(str.isupper), _flags(str.isdigit)
_PUNCT = _flags(lambda c: c in "!\"'(),-./:;?[]_`{}~@^+=\\")


def features(s: TextSlice) -> np.ndarray:
    """One row of FEATURES for each document of the slice."""
    base = base_counts(s)
    chars = np.maximum(np.diff(s.offsets), 1)
    words = np.maximum(base["n_words"], 1)
    lines = s.per_doc(s.cp == 10) + 1
    key = s.word_hash + s.word_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    owner = s.word_doc[first]
    top = np.zeros(s.n_docs)
    np.maximum.at(top, owner, count)
    long_words = np.bincount(s.word_doc[(s.ends - s.starts) > 12], minlength=s.n_docs)
    _, pair_doc, echo = s.bigrams()
    echoes = np.bincount(pair_doc[echo], minlength=s.n_docs)
    share = lambda table: s.per_doc(table_flags(s.cp, table)) / chars
    return np.stack([
        np.log1p(base["n_words"]), np.log1p(np.diff(s.offsets)), base["word_chars"] / words,
        base["n_symbols"] / words, share(_UPPER), share(_DIGIT), share(_PUNCT),
        s.per_doc(s.cp == 33) / words, s.per_doc(s.cp == 124) / words, base["n_dup_lines"] / lines,
        base["n_repeat_words"] / words, np.bincount(owner, minlength=s.n_docs) / words, np.log1p(lines),
        s.per_doc(s.space) / chars, s.per_doc(s.cp > 127) / chars, s.per_doc(s.cp == 46) / words,
        top / words, long_words / words, echoes / words], axis=1)


@dataclass
class Additive:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, j], side="right")]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[np.searchsorted(self.coarse[a], x[:, a], side="right"),
                   np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    q = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
    return q[q > column.min()] if len(q) else q


def _split(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(hl < least) | (hr < least)] = 0
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, ridge: float = 1.0, least: float = 0.5) -> np.ndarray:
    """Leaf value of every bin of a shallow tree over one feature."""
    _, at = _split(g, h, ridge, least)
    if depth == 0 or at == 0:
        return np.full(len(g), -g.sum() / (h.sum() + ridge))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1, ridge, least), _tree(g[at:], h[at:], depth - 1, ridge, least)])


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float = 1.0, least: float = 0.5) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts one feature, then the other."""
    best = (0.0, np.zeros_like(g))
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        for cut in range(1, len(a)):
            gain, out = -a.sum() ** 2 / (b.sum() + ridge), np.zeros_like(a)
            for part in (slice(0, cut), slice(cut, len(a))):
                pg, ph = a[part].sum(axis=0), b[part].sum(axis=0)
                _, at = _split(pg, ph, ridge, least)
                for side in ((slice(0, at), slice(at, len(pg))) if at else (slice(0, len(pg)),)):
                    sg, sh = pg[side].sum(), ph[side].sum()
                    gain += sg ** 2 / (sh + ridge)
                    out[part, side] = -sg / (sh + ridge)
            if gain > best[0]:
                best = (gain, out.T if turn else out)
    return best


def train(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1,
          n_pairs: int = N_PAIRS, pair_rounds: int = 60) -> Additive:
    """Cyclic boosting of the single tables, then of the chosen pairs."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    d = x.shape[1]
    model.edges = [_cuts(x[:, j], MAX_BINS) for j in range(d)]
    model.coarse = [_cuts(x[:, j], 8) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    z = np.full(len(y), model.intercept)

    def gradients():
        p = 1.0 / (1.0 + np.exp(-z))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(d):
            g, h = gradients()
            n = len(model.tables[j])
            leaf = rate * _tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            model.tables[j] += leaf
            z += leaf[bins[j]]

    def grid(a, b):
        na, nb = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        g, h = gradients()
        cell = rough[a] * nb + rough[b]
        return (np.bincount(cell, g, na * nb).reshape(na, nb), np.bincount(cell, h, na * nb).reshape(na, nb))

    gains = [(_pair_tree(*grid(a, b))[0], (a, b)) for a, b in combinations(range(d), 2)]
    model.pairs = [p for gain, p in sorted(gains, key=lambda t: (-t[0], t[1]))[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            leaf = rate * _pair_tree(*grid(a, b))[1]
            model.pair_tables[k] += leaf
            z += leaf[rough[a], rough[b]]
    return model


def _describe(batches):
    for b in batches:
        texts = b.column("text")
        for lo, hi in slices(texts):
            x = features(TextSlice(texts.slice(lo, hi - lo)))
            cut = b.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([cut.column("doc_id"), cut.column("label"),
                                              pa.array(list(x), type=pa.list_(pa.float64()))], ["doc_id", "label", "x"])


def fit(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS, learn_from=None) -> Additive:
    """Train on at most `max_train_rows` labelled rows that `learn_from` admits.

    Only the feature numbers of that bounded sample reach the driver.
    """
    sample = labelled_sample(docs, labels, "quality", max_train_rows, learn_from)
    sample = sample.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "label")
    rows = sample.mapInArrow(_describe, "doc_id string, label int, x array<double>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.stack(rows["x"].tolist()) if len(rows) else np.zeros((0, len(FEATURES)))
    return train(x, rows["label"].to_numpy(dtype=float))


def _scorer(model: Additive, names: list[str]):
    def run(batches):
        for b in batches:
            texts = b.column("_judged")
            parts = [model.score(features(TextSlice(texts.slice(lo, hi - lo)))) for lo, hi in slices(texts)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(score),
                                              pa.array((score >= 0.5).astype(np.int32))], [*names, "score", "predicted"])
    return run


def score(docs: DataFrame, model: Additive, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Score and predicted class of every document, beside the carried columns.

    A carried column named like a result gets the prefix ``in_``.
    """
    carry = docs.columns if carry is None else carry
    renamed = [c if c not in ("score", "predicted", "_judged") else f"in_{c}" for c in carry]
    src = docs.select(*(F.col(f"`{c}`").alias(r) for c, r in zip(carry, renamed, strict=True)),
                      F.col(f"`{text}`").alias("_judged"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "_judged"]).add("score", "double").add("predicted", "integer")
    return src.mapInArrow(_scorer(model, renamed), schema)


def held_out(doc_id="doc_id"):
    """Rows that never teach the model: crc32 of the id as text leaves 1 when divided by 3."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))
