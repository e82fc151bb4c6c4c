"""Removal of repeated passages with a run-length index.

Every byte covered by a string of LENGTH bytes that also starts anywhere else
in the table (same text included, overlaps count) is marked and removed.
Texts are taken as UTF-8 bytes; matches never cross texts.

How equal windows meet.  Each window of LENGTH bytes is filed under the
smallest hash of its ANCHOR-byte strings (the leftmost of equals).  Equal
windows have equal keys, and neighbouring windows under the same place form
one segment, so a text is cut into segments of at most 2 * LENGTH - ANCHOR
bytes with every window in exactly one of them; two equal windows of one text
never share a segment.  Keys that occur once in the table cannot hold a
repeat.  A key with several equal segments and no other is all repeats, whatever
their text.  The segments of the other keys are gathered, equal segments as one
with its number of copies, and dealt by key.

The index.  A task sorts the windows' suffixes of its segments in blocks of
whole keys and keeps of their Burrows-Wheeler transform only the runs: for
each run its byte, its start, and the text positions sampled at its first
suffix and at the last of the run before.  Inside a run the match of a suffix
with its predecessor is one byte shorter than that of the position before it
(the irreducible ones lie at run starts), so matching statistics stream from
the samples alone: a sample at x with partner y and match m covers x to x + m
and y to y + m.  This holds for matches of LENGTH or more although only
suffixes of at least LENGTH bytes are sorted: a suffix between two that share
more than LENGTH bytes shares them too.  Copies of a segment only widen runs;
their own boundary is sampled at the segment's start with its whole length (so keys
with nothing but copies need no text).

A key with more than CROWD different segments (the edge of a passage that very
many texts share) is not given to one task.  Its windows are told apart by their
place relative to the anchor, in blocks of LEVELS places: windows of a block have
its common bytes around the anchor, so a segment is filed once per block under their hash.
What the segments of a block have alike is one part with its number of copies: near
copies differ in few blocks, so a crowd of them is few parts.  Groups of one copy go,
small groups of parts are indexed, and the parts of those still crowded are
divided into the blocks of the next level; at the last one a part is one window.
The ranges of a part are handed back to its members, level by level.

Repeated keys are looked up in bit maps of SIEVE_BITS bits when there are at
most SIEVE_KEYS of them; beyond that by a join, with the same result.  Texts are
shuffled once, compressed, to meet their marks.

Edge cases: null and empty texts have no bytes and nothing removed; texts
shorter than LENGTH stay whole; rows with equal texts (repeated rows, ties)
are all treated alike, so none of two copies stays; very long texts are cut
in slabs of SLAB windows and never held as more than their own bytes and a few
arrays per slab; an empty table gives no rows; other columns are carried by
place, so their names may clash with nothing.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.naming import by_place
from quarry.llm.textbuf import Rolling
from quarry.session import cut_lineage, scratch_path

LENGTH = 200
ANCHOR = 64
#: Windows handled at once of a long text.
SLAB = 1 << 20
#: Bits of the map of repeated keys (16 MiB), and the most keys put into it.
SIEVE_BITS = 1 << 27
SIEVE_KEYS = 1 << 26
#: Different segments of a key that one task indexes.
CROWD = 2000
#: Places per block of a crowded key's windows, level by level.
LEVELS = (28, 6, 1)
#: Bytes of segments in one index block.
BLOCK_BYTES = 1 << 20
#: Bytes of segments per output batch, and segments a task remembers having sent.
_FLUSH, _SEEN = 8 << 20, 200_000

_PLACE = np.uint64((1 << 21) - 1)


# ------------------------------------------------------------------ segments
def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours (block prefix and suffix minima)."""
    n = len(a) - width + 1
    padded = np.concatenate([a, np.full(-len(a) % width, np.iinfo(a.dtype).max, dtype=a.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: bytes, length: int = LENGTH, anchor: int = ANCHOR):
    """Yield arrays (start, end, key) of the segments of one text.

    Segment k is data[start:end]; its windows start at start .. end - length.
    """
    width = length - anchor + 1
    for base in range(0, len(data) - length + 1, SLAB):
        size = min(SLAB + length - 1, len(data) - base)
        h = Rolling(np.frombuffer(data, dtype=np.uint8, count=size, offset=base)).every(anchor)
        ranked = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min(ranked, width) & _PLACE).astype(np.int64)
        cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        yield base + cut, base + np.append(cut[1:], len(at)) + length - 1, h[at[cut]].view(np.int64)


class Sieve:
    """Bit map of keys; may let other keys through, never loses one."""

    def __init__(self, bits: bytes | None):
        self._bits = None if bits is None else np.frombuffer(bits, dtype=np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if self._bits is None:
            return np.ones(len(keys), dtype=bool)
        at = keys & (len(self._bits) * 8 - 1)
        return (self._bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _texts(batches):
    """(bytes of a text, starts to keep or None) of every row."""
    for b in batches:
        given = b.column("starts").to_pylist() if "starts" in b.schema.names else None
        for lo in range(0, len(b), 256):  # a few texts at a time
            for k, t in enumerate(b.column("text").slice(lo, 256).cast(pa.binary()).to_pylist()):
                yield t, None if given is None else given[lo + k]


def _hash(piece: bytes) -> int:
    return xxhash.xxh3_64_intdigest(piece) - (1 << 63)


def _keys(length: int, anchor: int):
    """key and hash of every segment."""
    def run(batches):
        for b in batches:
            for lo in range(0, len(b), 256):
                keys, hashes = [], []
                for t in b.column("text").slice(lo, 256).cast(pa.binary()).to_pylist():
                    for start, end, key in segments(t, length, anchor):
                        keys.append(key)
                        hashes += [_hash(t[x:y]) for x, y in zip(start.tolist(), end.tolist(), strict=True)]
                if hashes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(hashes, pa.int64())], ["key", "seg"])
    return run


def _repeated(data: bytes, starts, sieve: Sieve, length: int, anchor: int):
    """(start, end, key) of the segments under repeated keys."""
    for start, end, key in segments(data, length, anchor):
        on = sieve(key) if starts is None else np.isin(start, starts)
        yield from zip(start[on].tolist(), end[on].tolist(), key[on].tolist(), strict=True)


def _gather(sieve, length: int, anchor: int):
    """Segments under repeated keys: key, hash, copies, and the bytes where the task has not sent them before."""
    def out(held):
        cols = zip(*((k, s, n, seg) for (k, s), (n, seg) in held.items()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                          ["key", "seg", "n", "bytes"])

    def run(batches):
        look, held, size, seen = Sieve(sieve.value if sieve else None), {}, 0, set()
        for data, starts in _texts(batches):
            for a, b, key in _repeated(data, starts, look, length, anchor):
                piece = data[a:b]
                same = (key, _hash(piece))
                if same in held:
                    held[same][0] += 1
                    continue
                held[same] = [1, None if same in seen else piece]
                size += 64 + (0 if same in seen else len(piece))
            if size > _FLUSH:
                yield out(held)
                if len(seen) > _SEEN:
                    seen.clear()
                seen.update(held)
                held, size = {}, 0
        if held:
            yield out(held)
    return run


def _occurrences(sieve, length: int, anchor: int):
    """key, hash, digest of the text, start and size of every segment under a repeated key; equal texts of a task once."""
    def run(batches):
        look, rows, seen = Sieve(sieve.value if sieve else None), [], set()
        for data, starts in _texts(batches):
            digest = hashlib.sha256(data).digest()
            if digest in seen:
                continue
            if len(seen) > _SEEN:
                seen.clear()
            seen.add(digest)
            rows += [(key, _hash(data[a:b]), digest, a, b - a)
                     for a, b, key in _repeated(data, starts, look, length, anchor)]
            if len(rows) > 50_000:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    def _rows(rows):
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          ["key", "seg", "digest", "start", "size"])
    return run


def _places(length: int, anchor: int):
    """key, digest and start of every segment, for the join on keys."""
    def run(batches):
        for b in batches:
            for t in b.column("text").cast(pa.binary()).to_pylist():
                digest = hashlib.sha256(t).digest()
                for start, _, key in segments(t, length, anchor):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array([digest] * len(key), pa.binary()), pa.array(start.astype(np.int64))],
                                                     ["key", "digest", "start"])
    return run


# --------------------------------------------------------------------- index
class RunIndex(NamedTuple):
    """Runs of the Burrows-Wheeler transform of a block of segments.

    Run k has the byte `byte[k]` (-1: a segment's start, always a run of its
    own) from rank `start[k]`; `first[k]` is the suffix at its first rank,
    `before[k]` the one at the last rank of the run before (-1 for none), and
    `match[k]` the length they share if that is at least the window, else 0.
    A suffix is (segment, offset), numbered through `segment` and `offset`.
    """

    byte: np.ndarray
    start: np.ndarray
    first: np.ndarray
    before: np.ndarray
    match: np.ndarray
    segment: np.ndarray
    offset: np.ndarray


def shared(a: bytes, b: bytes, least: int) -> int:
    """Length of the common prefix of a and b if it is at least `least`, else 0."""
    if a[:least] != b[:least]:
        return 0
    low, high = least, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low + 1 < high:  # a[:low] agrees, a[:high] does not
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def build_index(pieces: list[bytes], length: int = LENGTH) -> RunIndex:
    """Run-compressed transform of the suffixes of at least `length` bytes."""
    suffixes = [p[o:] for p in pieces for o in range(len(p) - length + 1)]
    counts = np.array([max(0, len(p) - length + 1) for p in pieces], dtype=np.int64)
    segment = np.repeat(np.arange(len(pieces)), counts)
    offset = np.arange(len(suffixes)) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__), dtype=np.int64)  # equal suffixes by place
    whole = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    begin = np.cumsum([0, *map(len, pieces)])[:-1]
    head = np.where(offset == 0, -1, whole[np.maximum(begin[segment] + offset - 1, 0)].astype(np.int16))[order] if len(order) else np.zeros(0, np.int16)
    start = np.flatnonzero(np.append(True, (head[1:] != head[:-1]) | (head[1:] < 0))) if len(head) else np.zeros(0, np.int64)
    first = order[start]
    before = np.where(start > 0, order[np.maximum(start - 1, 0)], -1)
    match = np.array([shared(suffixes[x], suffixes[y], length) if y >= 0 else 0 for x, y in zip(first.tolist(), before.tolist(), strict=True)], dtype=np.int64)
    return RunIndex(head[start], start, first, before, match, segment, offset)


def union_of(ranges) -> list[tuple[int, int]]:
    """Maximal runs of the union of ranges (touching ones are one)."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def long_matches(pieces: list[bytes], copies: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Ranges of each segment that are covered by a repeated window of the block."""
    index = build_index(pieces, length)
    found: list[list[tuple[int, int]]] = [[(0, len(p))] if n > 1 and len(p) >= length else [] for p, n in zip(pieces, copies, strict=True)]
    on = np.flatnonzero(index.match)
    for side in (index.first, index.before):
        x, m = side[on], index.match[on]
        for s, a, b in zip(index.segment[x].tolist(), index.offset[x].tolist(), (index.offset[x] + m).tolist(), strict=True):
            found[s].append((a, b))
    return [union_of(r) for r in found]


def _indexed(length: int):
    def run(batches):
        def solve(rows):
            marks = long_matches([r[3] for r in rows], [r[2] for r in rows], length)
            rows = [(r[0], r[1], [x for a in m for x in a]) for r, m in zip(rows, marks, strict=True) if m]
            if rows:
                yield _marks(rows)

        held, size = [], 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("key", "seg", "n", "bytes")), strict=True):
                if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                    yield from solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from solve(held)
    return run


_MARKS = "key long, seg long, ranges array<int>"


def _marks(rows):
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "seg", "ranges"])


def divide(piece: bytes, size: int, length: int = LENGTH, anchor: int = ANCHOR):
    """Yield (hash, first, after the last) of the blocks of a segment's windows.

    A window's place is the number of its bytes before the anchor; a block has
    the places k * size .. (k + 1) * size - 1.  The hash is of the block and of the bytes around the
    anchor that all its windows have, so equal windows of two segments share it.
    """
    h = Rolling(np.frombuffer(piece, dtype=np.uint8)).every(anchor)
    windows = len(piece) - length + 1
    # the anchor of all windows is that of the first
    at = int(((h[: length - anchor + 1] & ~_PLACE) | np.arange(min(len(h), length - anchor + 1), dtype=np.uint64)).min() & _PLACE)
    for k in range((at - windows + 1) // size, at // size + 1):
        low, high = k * size, (k + 1) * size - 1  # places of the block
        first, last = max(0, at - high), min(windows - 1, at - low)
        if first <= last:
            common = piece[at - low : at - high + length]
            yield xxhash.xxh3_128_digest(k.to_bytes(4, "big") + common), first, last + 1


def _divided(size: int, length: int, anchor: int):
    """The blocks of crowded segments: hash of the block, of the bytes of its windows (a part),
    the segment, the part's place in it, and the bytes where the task has not sent them before."""
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())

    def run(batches):
        seen = set()
        for b in batches:
            for lo in range(0, len(b), 512):
                rows = []
                for k, s, n, p in zip(*(b.column(c).slice(lo, 512).to_pylist() for c in ("key", "seg", "n", "bytes")), strict=True):
                    for sub, first, end in divide(p, size, length, anchor):
                        part = p[first : end - 1 + length]
                        same = (sub, _hash(part))
                        rows.append((*same, k, s, n, first, None if same in seen else part))
                        seen.add(same)
                if len(seen) > _SEEN:
                    seen.clear()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                     ["sub", "part", "key", "seg", "n", "at", "bytes"])
    return run


def crowd_parts(segs: DataFrame, size: int, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """(members, parts) of crowded segments (key, seg, n, bytes) in blocks of `size` places.

    parts: key (of the block), seg (of the part), n (copies), bytes and m, the
    parts of its block; blocks of one copy are left out.  members: up_key and
    up_seg of a part, and a segment that holds it from byte `at` on."""
    blocks = cut_lineage(segs.mapInArrow(_divided(size, length, anchor), "sub binary, part long, key long, seg long, n long, at int, bytes binary"))
    parts = cut_lineage(blocks.groupBy("sub", "part").agg(F.sum("n").alias("n"), F.max("bytes").alias("bytes")))
    groups = parts.groupBy("sub").agg(F.sum("n").alias("copies"), F.count("*").alias("m")).where("copies > 1").select("sub", "m")
    parts = cut_lineage(parts.join(groups, "sub").select(F.xxhash64("sub").alias("key"), F.col("part").alias("seg"), "n", "bytes", "m"))
    return blocks.select(F.xxhash64("sub").alias("up_key"), F.col("part").alias("up_seg"), "key", "seg", "at"), parts


def _merged(batches):
    """Ranges of every segment, as their union."""
    for b in batches:
        rows = [(k, s, [x for r in union_of(zip(f[::2], f[1::2], strict=True)) for x in r])
                for k, s, f in zip(*(b.column(c).to_pylist() for c in ("key", "seg", "ranges")), strict=True)]
        if rows:
            yield _marks(rows)


def _sieve_of(keys: DataFrame):
    """The repeated keys as a broadcast bit map of fixed size."""
    place = F.col("key").bitwiseAND(F.lit(SIEVE_BITS - 1))
    rows = (keys.groupBy(F.shiftright(place, 15).alias("page"))
            .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("bits")).collect())  # at most SIEVE_BITS / 8 bytes
    bits = bytearray(SIEVE_BITS // 8)
    for r in rows:
        bits[r["page"] * 4096 : r["page"] * 4096 + 4096] = r["bits"]
    return keys.sparkSession.sparkContext.broadcast(bytes(bits))


# ------------------------------------------------------------------ operator
def repeated_ranges(texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, crowd: int = CROWD,
                    sieve_keys: int = SIEVE_KEYS) -> DataFrame:
    """digest, marks of every different text that has a repeated window.

    `texts` has one column text without nulls.  digest is the text's SHA-256;
    marks holds (start, ranges) with ranges (a, b, a, b, ...) relative to start.
    """
    keys = cut_lineage(texts.mapInArrow(_keys(length, anchor), "key long, seg long").groupBy("key")
                       .agg(F.count("*").alias("n"), F.min("seg").alias("seg"), F.max("seg").alias("other")).where("n > 1").select("key", "seg", "other"))
    sieve = mixed = None
    if keys.count() <= sieve_keys:
        sieve, mixed, source = _sieve_of(keys), _sieve_of(keys.where("seg != other")), texts
    else:
        places = texts.mapInArrow(_places(length, anchor), "key long, digest binary, start long").join(keys, "key", "left_semi")
        starts = places.groupBy("digest").agg(F.collect_set("start").alias("starts"))
        source = texts.withColumn("digest", F.unhex(F.sha2("text", 256))).join(cut_lineage(starts), "digest").select("text", "starts")
    path = scratch_path(texts.sparkSession, "segments")
    (source.mapInArrow(_gather(mixed, length, anchor), "key long, seg long, n long, bytes binary")
     .groupBy("key", "seg").agg(F.sum("n").alias("n"), F.max("bytes").alias("bytes")).write.option("compression", "zstd").parquet(path))
    pieces = texts.sparkSession.read.parquet(path)
    crowded = cut_lineage(pieces.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > crowd).select("key"))
    cols = ["key", "seg", "n", "bytes"]
    few = pieces.join(crowded, "key", "left_anti").select(*cols)
    segs, levels, equal = pieces.join(crowded, "key", "left_semi").select(*cols), [], None
    for size in LEVELS if not crowded.isEmpty() else ():
        members, parts = crowd_parts(segs, size, length, anchor)
        levels.append(members)
        if size == 1:
            equal = parts.select("key", "seg", F.array(F.lit(0), F.lit(length)).alias("ranges"))
        else:
            few, segs = few.union(parts.where(F.col("m") <= crowd).select(*cols)), parts.where(F.col("m") > crowd).select(*cols)
    # dealt by a hash of the key, not the key: a repartition like a join's own would be dropped from the plan
    few = few.repartition(F.xxhash64("key")).sortWithinPartitions("key")
    marks = few.mapInArrow(_indexed(length), _MARKS)
    if equal is not None:
        marks = cut_lineage(marks.union(equal))
    for members in reversed(levels):
        up = marks.select(F.col("key").alias("up_key"), F.col("seg").alias("up_seg"), "ranges")
        own = members.join(up, ["up_key", "up_seg"]).select("key", "seg", F.transform("ranges", lambda x: x + F.col("at")).alias("ranges"))
        own = own.groupBy("key", "seg").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
        marks = cut_lineage(marks.union(own.mapInArrow(_merged, _MARKS)))
    whole = keys.where("seg = other").select("key", "seg", F.array().cast("array<int>").alias("ranges"))
    marks = cut_lineage(marks.union(whole))
    seen = source.mapInArrow(_occurrences(sieve, length, anchor), "key long, seg long, digest binary, start long, size int").join(marks, ["key", "seg"])
    ranges = F.when(F.size("ranges") == 0, F.array(F.lit(0), F.col("size"))).otherwise(F.col("ranges"))
    return seen.select("digest", F.struct("start", ranges.alias("ranges")).alias("mark")).groupBy("digest").agg(F.collect_set("mark").alias("marks"))


def _pack(names: list[str]):
    """Texts with their digest, compressed."""
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                                                       pa.array([squeeze.compress(t) for t in texts], pa.binary())], [*names, "digest", "packed"])
    return run


_ADDED = "kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>"


def _cut(names: list[str]):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        expand = zstandard.ZstdDecompressor()
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                kept, size, gone, spans = [], [], [], []
                for data, marks in zip(map(expand.decompress, part.column("packed").to_pylist()), part.column("marks").to_pylist(), strict=True):
                    cut = union_of((m["start"] + r[0], m["start"] + r[1]) for m in marks or ()
                                   for r in zip(m["ranges"][::2], m["ranges"][1::2], strict=True))
                    edges = [0, *(x for c in cut for x in c), len(data)]
                    kept.append(data if not cut else b"".join(data[a:e] for a, e in zip(edges[::2], edges[1::2], strict=True)))
                    size.append(len(data))
                    gone.append(sum(e - a for a, e in cut))
                    spans.append([{"start": a, "end": e} for a, e in cut])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span)],
                    [*names, "kept", "n_bytes", "n_removed", "spans"])
    return run


def strip_repeats(docs: DataFrame, text: str = "text", carry: list[str] | None = None, length: int = LENGTH, anchor: int = ANCHOR,
                  crowd: int = CROWD, sieve_keys: int = SIEVE_KEYS) -> DataFrame:
    """The columns `carry` (default: all) of `docs`, then kept (the bytes that
    remain), n_bytes, n_removed and spans (maximal removed runs)."""
    carry = list(docs.columns if carry is None else carry)
    placed, (body, *own) = by_place(docs, text, *carry)
    full = placed.withColumn("text", F.coalesce(F.col(body).cast("string"), F.lit("")))
    ranges = repeated_ranges(full.select("text"), length, anchor, crowd, sieve_keys)
    fields = [f"{c} {docs.schema[n].dataType.simpleString()}" for c, n in zip(own, carry, strict=True)]
    packed = full.select(*own, "text").mapInArrow(_pack(own), ", ".join([*fields, "digest binary, packed binary"]))
    joined = packed.join(cut_lineage(ranges), "digest", "left").select(*own, "packed", "marks")
    out = joined.mapInArrow(_cut(own), ", ".join([*fields, _ADDED]))
    return out.toDF(*carry, "kept", "n_bytes", "n_removed", "spans")
