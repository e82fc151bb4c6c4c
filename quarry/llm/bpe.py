"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space, which no token crosses: the tokenizer
normalises, splits and merges each word by itself.  A run of documents makes
a block, and each block lists its distinct words once.  The lists are dealt
out by a hash of the word, so that all blocks' copies of a word meet in one
task, which encodes it once; the ids go back to the blocks by position in their
lists, where the documents put them in order of their words.  Only word lists, id lists and positions are
shuffled, never one row per word.

Decoding collects the table of pieces, which has the fixed size of the
vocabulary, broadcasts it and looks ids up by position; pieces are joined with one space, as a tokenizer
without a decoder does.

Edge cases: null and empty texts have no ids and decode to the empty string;
repeated rows encode alike; a null key column stays null; an empty table gives
no rows.  Blocks are made twice, for words and for documents, so the input
must be a table or checkpoint that gives rows in the same places when read
again; a checksum of every block's word list is compared and a difference
raises an error.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: UTF-8 bytes of text in a block (a longer document is a block alone).
BLOCK_BYTES = 8 << 20
#: A block's word list is cut into this many parts per shuffle partition of the
#: session; a part meets its like of all other blocks in one task, whose table
#: of words holds the distinct words of that part.
PARTS_PER_PARTITION = 4

_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, loaded once per worker, without truncation or padding.

    Spark's tasks are the parallelism: threads of the library's own would
    crowd the executor's cores, and each keeps memory of its own."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def _block(rows: list[bytes], parts: int):
    """Word lists by part, the checksum, and for each row the numbers of its words.

    A word's number counts through the parts in order.
    """
    found: dict[bytes, int] = {}
    number = found.setdefault
    each = []
    for r in rows:
        words = r.split()
        each.append(np.fromiter((number(w, len(found)) for w in words), dtype=np.uint32, count=len(words)))
    words = list(found)
    found.clear()
    part = np.fromiter((xxhash.xxh32_intdigest(w) % parts for w in words), dtype=np.int64, count=len(words))
    order = np.argsort(part, kind="stable")
    place = np.empty(len(words), dtype=np.uint32)
    place[order] = np.arange(len(words), dtype=np.uint32)
    sizes = np.bincount(part, minlength=parts)
    lists = [b" ".join([words[i] for i in own]) for own in np.split(order, np.cumsum(sizes)[:-1])]
    check = xxhash.xxh64_intdigest(b"\n".join(lists)) >> 1
    return lists, sizes, check, each, place


def _blocks(batches):
    """(number in the partition, rows, batch slices) of blocks of about BLOCK_BYTES."""
    rows, cuts, held, n = [], [], 0, 0
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        lo = 0
        for k in range(len(texts)):
            rows.append(texts[k].as_py() or b"")
            held += len(rows[-1]) + 16
            if held >= BLOCK_BYTES:
                yield n, rows, [*cuts, b.slice(lo, k + 1 - lo).drop_columns(["text"])]
                rows, cuts, held, n, lo = [], [], 0, n + 1, k + 1
        if lo < len(texts):
            cuts.append(b.slice(lo).drop_columns(["text"]))
    if rows:
        yield n, rows, cuts


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _word_lists(parts: int):
    def run(batches):
        for n, rows, _ in _blocks(batches):
            lists, sizes, check, _, _ = _block(rows, parts)
            full = np.flatnonzero(sizes)
            block = (_partition() << 24) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(full), block)), pa.array(full.astype(np.int32)), pa.array(np.full(len(full), check)),
                 pa.array([zstandard.ZstdCompressor(level=1).compress(lists[i]) for i in full], pa.binary())],
                ["block", "part", "check", "words"])
    return run


def _documents(parts: int):
    def run(batches):
        for n, rows, cuts in _blocks(batches):
            _, _, check, each, place = _block(rows, parts)
            block, size = (_partition() << 24) + n, len(each)
            packed = [_pack(place[numbers]) for numbers in each]
            own = pa.Table.from_batches(cuts).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.full(size, block)), pa.array(np.full(size, check)),
                                              pa.array(packed, pa.binary())], [*own.schema.names, "block", "check", "numbers"])
    return run


def _encoder(path: str):
    """Ids of the words of every list. Lists come sorted by part; the table of
    distinct words holds each word of the part once, for all blocks."""
    def run(batches):
        encode = tokenizer(path).encode_batch
        table: dict[bytes, bytes] = {}
        at = None
        for b in batches:
            out = []
            for part, data in zip(b.column("part").to_pylist(), b.column("words").to_pylist(), strict=True):
                if part != at:
                    table.clear()
                    at = part
                words = zstandard.ZstdDecompressor().decompress(data).split(b" ")
                new = [w for w in words if w not in table]
                for lo in range(0, len(new), 2000):
                    some = new[lo : lo + 2000]
                    made = encode([w.decode("utf-8") for w in some], add_special_tokens=False)
                    table.update((w, np.array(e.ids, dtype=np.uint32).tobytes()) for w, e in zip(some, made, strict=True))
                ids = [table[w] for w in words]
                sizes = np.array([len(x) // 4 for x in ids], dtype=np.uint32)
                out.append(_pack(np.concatenate([np.array([len(ids)], np.uint32), sizes,
                                                 np.frombuffer(b"".join(ids), dtype=np.uint32)])))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("part"), b.column("check"), pa.array(out, pa.binary())],
                                             ["block", "part", "check", "ids"])
    return run


def _assembler(names: list[str]):
    """Put the ids of a block's words at the words' positions in its documents."""
    def run(docs: pa.Table, lists: pa.Table) -> pa.Table:
        lists = lists.sort_by("part")
        if docs.num_rows and lists.num_rows and len({*docs.column("check").to_pylist(), *lists.column("check").to_pylist()}) > 1:
            raise RuntimeError("the input gave rows in other places when read again; pass a table or checkpoint")
        sizes, ids = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for data in lists.column("ids").to_pylist():
            x = _unpack(data, np.uint32)
            sizes.append(x[1 : 1 + x[0]])
            ids.append(x[1 + x[0] :])
        sizes, ids = np.concatenate(sizes).astype(np.int64), np.concatenate(ids)
        first = np.cumsum(sizes) - sizes
        values, lengths = [], []
        for data in docs.column("numbers").to_pylist():
            at = _unpack(data, np.uint32).astype(np.int64)
            n = sizes[at]
            total = int(n.sum())
            values.append(ids[np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(total)])
            lengths.append(total)
        offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
        np.cumsum(lengths, out=offsets[1:])
        flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
        made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        return pa.Table.from_arrays([*(docs.column(c) for c in names), made], [*names, "ids"])
    return run


def encode(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (default: all others) and `ids`, an array of token ids.

    `path` names the tokenizer's file, which every worker can read.  A carried
    column named like a working column gets the prefix ``in_``.
    """
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    names = [f"in_{c}" if c in ("text", "block", "check", "numbers", "ids") else c for c in carry]
    src = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(carry, names, strict=True)), F.col(f"`{text}`").alias("text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name != "text"]
    parts = PARTS_PER_PARTITION * max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lists = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_word_lists(parts), "block long, part int, check long, words binary")
    ids = lists.repartition("part").sortWithinPartitions("part").mapInArrow(_encoder(path), "block long, part int, check long, ids binary")
    placed = src.mapInArrow(_documents(parts), ", ".join([*kinds, "block long, check long, numbers binary"]))
    return placed.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(
        _assembler(names), ", ".join([*kinds, "ids array<int>"]))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(id, piece) of the whole vocabulary, special tokens included."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame(pd.DataFrame({"id": list(vocabulary.values()), "piece": list(vocabulary)}), "id int, piece string")


def decode(encoded: DataFrame, vocabulary: DataFrame, ids: str = "ids") -> DataFrame:
    """`encoded` and `decoded`, the pieces of its ids joined with a space.

    The vocabulary has a fixed size, so it is collected and broadcast, and ids
    are looked up by position; an id without a piece is left out.
    """
    rows = vocabulary.toPandas()
    known = np.full(int(rows["id"].max()) + 2, None, dtype=object)  # the last entry, null, is for unknown ids
    known[rows["id"].to_numpy()] = rows["piece"].to_numpy()
    shared = encoded.sparkSession.sparkContext.broadcast(known)
    out = "in_decoded" if "decoded" in encoded.columns else "decoded"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields), f"{out} string"])

    def run(batches):
        table = pa.array(shared.value, pa.string())
        for b in batches:
            for lo in range(0, len(b), 256):
                cut = b.slice(lo, 256)
                lists = cut.column(ids)
                flat = np.asarray(lists.flatten()).astype(np.int64)
                flat[(flat < 0) | (flat >= len(table))] = len(table) - 1
                joined = table.take(pa.array(flat))
                sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
                offsets = np.zeros(len(cut) + 1, dtype=np.int32)
                if joined.null_count:
                    known_one = np.asarray(joined.is_valid())
                    owner = np.repeat(np.arange(len(cut)), sizes)[known_one]
                    sizes, joined = np.bincount(owner, minlength=len(cut)), joined.drop_null()
                np.cumsum(sizes, out=offsets[1:])
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), joined), " ")
                yield pa.RecordBatch.from_arrays([*cut.columns, text], [*cut.schema.names, out])

    return encoded.mapInArrow(run, schema)


def ids_text(ids: str = "ids"):
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids), " ")
