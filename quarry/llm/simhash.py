"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has a bit set if over half of its shingle hashes
have it set.  Documents link when their fingerprints differ in few bits.

Links are found with a covering code.  Two fingerprints that differ in at
most t bits differ in at most t // 2 bits in one of their halves (the
halves are 32 bits).  In that half the anchors are the code words of the
perfect single-error-correcting code of length 31: its covering radius is 1,
so the word nearest to one fingerprint is within 1 + t // 2 bits of the other.
Each distinct fingerprint is therefore replicated to every anchor within that
distance (16 of 2^26 per half for t = 2 or 3) and compared, over all 64 bits,
with those that met it there.

Anchors that gather more than ANCHOR_LIMIT fingerprints take another exact
way: two fingerprints at most two bits apart have a common neighbour one bit
from both (or are it), so each such fingerprint is keyed by all 65 words
within one bit of it, and fingerprints that share a key link (for one bit: with the key, if it is one of them).  At most
65 can share a key, so no group grows with the data.

Equal fingerprints are one row throughout; documents rejoin at the end.
Null and empty texts have fingerprint zero and link like any other.  Rows
with a null doc_id take part but never give their id to a component unless
all ids in it are null.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import connected_components
from quarry.llm.naming import by_place
from quarry.llm.runs import close_pairs, key_runs
from quarry.session import cut_lineage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
ANCHOR_LIMIT = 64

_BYTES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    cuts = np.arange(0, n, 255)
    out = 0
    for k in range(8):  # eight byte-wide counters in each 64-bit lane, emptied every 255 rows
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _BYTES, cuts)
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > n):
            out |= 1 << (8 * int(byte) + k)
    return out


def fingerprint_text(text: str, width: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    begin = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(begin, begin[width:], strict=False)),
                                dtype=np.uint64, count=len(words) - width + 1))


def _fingerprinter(names: list[str], width: int):
    def run(batches):
        for b in batches:
            texts = b.column("_text")  # one text at a time is a Python string
            made = np.array([fingerprint_text(t.as_py() or "", width) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(made.view(np.int64))],
                                             [*names, "fingerprint"])
    return run


def fingerprints(docs: DataFrame, text: str = "text", carry: list[str] | None = None,
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """The carried columns and the fingerprint (its 64 bits as a long)."""
    carry = docs.columns if carry is None else carry
    renamed = [c if c not in ("fingerprint", "_text") else f"in_{c}" for c in carry]
    src = docs.select(*(F.col(f"`{c}`").alias(r) for c, r in zip(carry, renamed, strict=True)), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "_text"]).add("fingerprint", "long")
    return src.mapInArrow(_fingerprinter(renamed, width), schema)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All code words within two bits of the low 31 bits of each half:
    positions in `half`, and the words.

    Bit p - 1 has the number p (1 to 31); a word's syndrome is the exclusive
    or of the numbers of its set bits, and code words have syndrome zero.
    """
    half = half & np.uint64(0x7FFFFFFF)
    syndrome = np.zeros(len(half), dtype=np.int64)
    for k in range(5):
        mask = np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1))
        syndrome |= (np.bitwise_count(half & mask).astype(np.int64) & 1) << k
    rows = np.arange(len(half))
    bit = np.array([0] + [1 << (p - 1) for p in range(1, 32)], dtype=np.uint64)
    at, words = [rows], [half ^ bit[syndrome]]  # the nearest: no or one bit away
    for i in range(1, 32):
        j = i ^ syndrome
        two = (syndrome > 0) & (j > i)  # j is another bit; both together have the syndrome
        at.append(rows[two])
        words.append(half[two] ^ bit[i] ^ bit[j[two]])
    return np.concatenate(at), np.concatenate(words)


def _to_anchors(batches):
    for b in batches:
        f = np.asarray(b.column("fingerprint")).view(np.uint64)
        for part in range(2):
            at, word = anchors(f >> np.uint64(32 * part) & np.uint64(0xFFFFFFFF))
            key = (word | np.uint64(part << 31)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(f[at].view(np.int64))], ["anchor", "fingerprint"])


def _comparer(bits: int):
    def run(batches):
        for (key, f), overflow in key_runs(batches, ["anchor", "fingerprint"], ANCHOR_LIMIT):
            if overflow:
                a, b, busy = f, f, np.ones(len(f), dtype=bool)
            else:
                a, b = close_pairs(key, f, bits).T
                busy = np.zeros(len(a), dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)), pa.array(np.ascontiguousarray(b)),
                                              pa.array(busy)], ["a", "b", "busy"])
    return run


def _to_neighbours(batches):
    flips = np.array([0] + [1 << k for k in range(64)], dtype=np.uint64)
    for b in batches:
        f = np.asarray(b.column("fingerprint")).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((f[:, None] ^ flips).ravel().view(np.int64)),
                                          pa.array(np.repeat(f, 65).view(np.int64))], ["middle", "fingerprint"])


def links(distinct: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of fingerprints whose components are those of all pairs at
    most `bits` bits apart.  `bits` is 2 or less.

    Pairs from ordinary anchors are all listed; those from crowded anchors
    are listed as stars around a common neighbour.
    """
    if not 0 <= bits <= 2:
        raise ValueError("the covering is laid out for at most two bits")
    dealt = distinct.mapInArrow(_to_anchors, "anchor long, fingerprint long").repartition("anchor")
    met = cut_lineage(dealt.sortWithinPartitions("anchor").mapInArrow(_comparer(bits), "a long, b long, busy boolean"))
    plain = met.where("not busy").select("a", "b")
    busy = met.where("busy").select(F.col("a").alias("fingerprint")).distinct()
    return plain.union(_star_links(busy.mapInArrow(_to_neighbours, "middle long, fingerprint long"), bits)).distinct()


def _star_links(keyed: DataFrame, bits: int) -> DataFrame:
    if bits == 0:
        keyed = keyed.where("middle = fingerprint")  # distinct fingerprints: no link
    group = keyed.groupBy("middle").agg(F.collect_set("fingerprint").alias("f")).where("size(f) > 1")
    if bits == 1:  # two members may be two bits apart; the middle, if a member, is one bit from each
        return group.where(F.array_contains("f", F.col("middle"))).select(F.col("middle").alias("a"), F.explode("f").alias("b")).where("a != b")
    return group.select(F.array_min("f").alias("a"), F.explode("f").alias("b")).where("a != b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    width: int = SHINGLE_WORDS, bits: int = MAX_BITS, carry: list[str] | None = None) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row, and the `carry` columns.

    component_id is the smallest doc_id of the documents reachable over
    links.  Every row of the input gives one row, repeated rows included.
    """
    carry = carry or []
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), *carry)
    prints = cut_lineage(fingerprints(src, "text", ["doc_id", *carry], width))
    classes = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(classes.select("fingerprint"), bits))
    rooted = classes.join(roots, classes.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    rooted = cut_lineage(rooted)
    owner = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = cut_lineage(rooted.join(owner, "root").select("fingerprint", "root", "component_id"))
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id", "root", *carry)


def hex_fingerprint(column="fingerprint"):
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             width: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: that with the smallest doc_id (null last),
    the first in the table among rows that share it.

    The columns are those of `docs`, which must be a table or checkpoint, so
    that reading it twice gives rows in the same places.
    """
    place, (doc_id, text) = by_place(docs, doc_id, text)
    place = place.withColumn("_place", F.monotonically_increasing_id())
    near = near_duplicates(place, doc_id, text, width, bits, ["_place"])
    best = near.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_place")).alias("best"))
    kept = cut_lineage(best.select(F.col("best._place").alias("_place")))
    return place.join(kept, "_place", "left_semi").drop("_place").toDF(*docs.columns)
