"""Pairs of close fingerprints among rows sorted by a bucket key.

Partitions arrive sorted by key, in Arrow batches of any size.  Rows of a
key are compared with one another by shifting the whole batch against itself
1, 2, 3, ... rows while keys still agree, so small buckets cost no Python
step of their own.  At most `limit` rows of a bucket are held; a larger
bucket is passed on whole, for the caller's exact way of treating it.
"""

from __future__ import annotations

import numpy as np


def key_runs(batches, columns: list[str], limit: int):
    """Yield (arrays, overflow): whole buckets of at most `limit` rows, many at
    a time, or, with overflow set, consecutive pieces of a larger bucket."""
    held: list[np.ndarray] | None = None
    spilling = None
    for b in batches:
        now = [np.asarray(b.column(c)) for c in columns]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            held = None
        key = now[0]
        if not len(key):
            continue
        if spilling is not None:
            more = int(np.searchsorted(key, spilling, side="right"))
            if more:
                yield [x[:more] for x in now], True
            if more == len(key):
                continue
            spilling, now = None, [x[more:] for x in now]
            key = now[0]
        last = int(np.searchsorted(key, key[-1], side="left"))
        cuts = np.flatnonzero(np.append(True, key[1:last] != key[: last - 1])) if last else np.zeros(0, dtype=np.int64)
        sizes = np.diff(np.append(cuts, last)) if last else cuts
        big = sizes > limit
        if big.any():
            for lo, n in zip(cuts[big], sizes[big], strict=True):
                yield [x[lo : lo + n] for x in now], True
            few = np.repeat(~big, sizes)
            yield [x[:last][few] for x in now], False
        elif last:
            yield [x[:last] for x in now], False
        rest = [x[last:] for x in now]
        if len(rest[0]) > limit:
            spilling = key[-1]
            yield rest, True
        else:
            held = rest
    if held is not None:
        yield held, False


def close_pairs(key: np.ndarray, fingerprint: np.ndarray, bits: int, also=None):
    """Distinct pairs (low, high) of fingerprints of one key that differ in at
    most `bits` bits.  `also(i, j)` may add a condition on row positions."""
    at, shift, found = np.arange(len(key)), 0, []
    while True:
        shift += 1
        at = at[at + shift < len(key)]
        at = at[key[at] == key[at + shift]]
        if not len(at):
            break
        near = np.bitwise_count(fingerprint[at] ^ fingerprint[at + shift]) <= bits
        i = at[near]
        if also is not None and len(i):
            i = i[also(i, i + shift)]
        found.append(np.stack([fingerprint[i], fingerprint[i + shift]], axis=1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=fingerprint.dtype)
    pairs.sort(axis=1)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return np.unique(pairs, axis=0)
