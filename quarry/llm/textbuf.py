"""Vectorised views of a batch of texts.

A slice of an Arrow text column becomes one array of code points with
document offsets; words, lines and rolling hashes are then computed for
all documents of the slice at once with numpy.  Texts are whole: a slice
ends between documents, never inside one.

Null texts count as empty.  Words are runs of anything but the six ASCII
white-space characters (space and U+0009 to U+000D).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document makes a slice alone.
SLICE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            up = np.full(size, _ODD, dtype=np.uint64)
            down = np.full(size, _ODD_INVERSE, dtype=np.uint64)
            up[0] = down[0] = 1
            up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size > 8 * SLICE_BYTES:  # a rare giant is not kept
            return up[:n], down[:n]
        _POWERS["up"], _POWERS["down"] = up, down
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Rolling:
    """Hash of any window of a sequence from one prefix sum."""

    def __init__(self, values: np.ndarray):
        up, self._down = _powers(len(values) + 1)
        self._sum = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self._sum[1:])

    def windows(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(np.uint64))

    def every(self, n: int) -> np.ndarray:
        """Hashes of all windows of n items, by start."""
        return mix((self._sum[n:] - self._sum[:-n]) * self._down[: len(self._sum) - n])


def slices(texts: pa.Array):
    """Yield (first row, row after the last) of slices of about SLICE_BYTES."""
    n = len(texts)
    if not n:
        return
    sizes = np.asarray(pc.binary_length(texts).fill_null(0), dtype=np.int64)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield lo, hi
        lo = hi


class TextSlice:
    """Code points, words and lines of some documents, all as flat arrays."""

    def __init__(self, texts: pa.Array):
        raw = [t or "" for t in texts.to_pylist()]
        self.n_docs = len(raw)
        self.cp = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.offsets = np.zeros(self.n_docs + 1, dtype=np.int64)
        np.cumsum([len(t) for t in raw], out=self.offsets[1:])
        cp, n = self.cp, len(self.cp)
        self.space = (cp == 32) | ((cp >= 9) & (cp <= 13))
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.ones(n + 1, dtype=bool)  # white space or an edge lies before position i
        before[1:] = self.space
        before |= edge
        after = np.ones(n + 1, dtype=bool)
        after[:n] = self.space
        after |= edge
        word = ~self.space
        self.starts = np.flatnonzero(word & before[:n])
        self.ends = np.flatnonzero(word & after[1:]) + 1
        self.word_doc = self.doc_of(self.starts)
        self.n_words = np.bincount(self.word_doc, minlength=self.n_docs)
        self.rolling = Rolling(cp)
        self.word_hash = self.rolling.windows(self.starts, self.ends)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-character array over each document."""
        total = np.zeros(len(self.cp) + 1, dtype=np.int64 if flags.dtype != np.float64 else np.float64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and document of every pair of neighbouring words, and whether
        both are the same word."""
        inside = np.flatnonzero(self.word_doc[1:] == self.word_doc[:-1])
        one, two = self.word_hash[inside], self.word_hash[inside + 1]
        return mix(one * np.uint64(_ODD) + two), self.word_doc[inside], one == two

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every line (split at \\n)."""
        cuts = np.flatnonzero(self.cp == 10)
        starts = np.concatenate([self.offsets[:-1], cuts + 1])
        doc = np.concatenate([np.arange(self.n_docs), self.doc_of(cuts)])
        order = np.lexsort((starts, doc))
        starts, doc = starts[order], doc[order]
        last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, dtype=bool)
        ends = np.append(starts[1:] - 1, 0)
        ends[last] = self.offsets[1:][doc[last]]
        return starts, ends, doc

    def duplicate_lines(self) -> np.ndarray:
        """Per document: lines with a word that equal an earlier line."""
        starts, ends, doc = self.lines()
        worded = np.searchsorted(self.starts, starts, side="left") < np.searchsorted(self.starts, ends, side="left")
        starts, ends, doc = starts[worded], ends[worded], doc[worded]
        key = mix(self.rolling.windows(starts, ends) + doc.astype(np.uint64) * np.uint64(_ODD))
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), dtype=bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        return np.bincount(doc[again], minlength=self.n_docs)

    def repeated_words(self, width: int = 8) -> np.ndarray:
        """Per document: words inside windows of `width` words that occur
        twice or more in that document, the first occurrence included."""
        m = len(self.word_hash)
        if m < width:
            return np.zeros(self.n_docs, dtype=np.int64)
        inside = self.word_doc[: m - width + 1] == self.word_doc[width - 1 :]
        at = np.flatnonzero(inside)
        key = Rolling(self.word_hash).every(width)[at]
        key = mix(key + self.word_doc[at].astype(np.uint64) * np.uint64(_ODD))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(m + 1, dtype=np.int64)
        np.add.at(edge, at[twice], 1)
        np.add.at(edge, at[twice] + width, -1)
        return np.bincount(self.word_doc[np.cumsum(edge[:m]) > 0], minlength=self.n_docs)


SYMBOLS = np.array([ord(c) for c in "#*$%&|<>"], dtype=np.uint32)
_IS_SYMBOL = np.zeros(128, dtype=bool)
_IS_SYMBOL[SYMBOLS] = True


def table_flags(cp: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Look code points up in a table of the first code points; others are False."""
    return table[np.minimum(cp, len(table) - 1)] & (cp < len(table))


def base_counts(s: TextSlice) -> dict[str, np.ndarray]:
    """The five base counts of every document in the slice."""
    return {
        "n_words": s.n_words.astype(np.int64),
        "word_chars": np.bincount(s.word_doc, weights=(s.ends - s.starts), minlength=s.n_docs).astype(np.int64),
        "n_symbols": s.per_doc(table_flags(s.cp, _IS_SYMBOL)),
        "n_dup_lines": s.duplicate_lines().astype(np.int64),
        "n_repeat_words": s.repeated_words().astype(np.int64),
    }
