"""Prefix trie of conversations by parallel tree contraction.

Conversations that begin with the same turns (role and text) share a path from
the root.  A node is named by the hash of its path, which is a fold modulo a
prime of 127 bits: the fold of a sequence follows from the folds of its pieces,
so the table is sorted by range, a conversation may cross any number of
partitions (the driver puts together at most two pieces per partition), and
texts are reduced to 128-bit digests before the first shuffle.

Subtree totals.  The tree is contracted in rounds until only the root is left.
Compress: unary chains are spliced out; of a run of nodes that lie next to one
another under the order of conversation and depth only the lowest stays, and
in a round that left over three quarters of the nodes, other chains lose the
unary nodes that a coin marks and whose parent it does not.  What a spliced node holds goes onto the edge of the node below, and its
total is noted as that node's total plus a difference.  Rake: leaves are removed
with their totals, which go to their parents, summed before the shuffle.  Both
are joins on unique keys.  The contracted nodes are then expanded in reverse order.

The number of rounds is logarithmic whatever the shape: leaves and neighbouring
chains go at once, and other chains lose a constant share in every such round.

Edge cases: rows with a null conv_id belong to no conversation and are left out;
null roles and texts are empty; turns sort null first, rows of one turn by role,
then text (its first 64 signs, then its digest); repeated rows are further turns;
very long texts count whole; an empty table gives no rows; a table where no
conversation has a turn gives the root alone; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.structure import digests
from quarry.session import cut_lineage

#: Modulus and base of the path fold.
PRIME = (1 << 127) - 1
BASE = 0x4F1BBCDCBFA53E0AB0CEB9FE1A85EC53 % PRIME
ROOT = 1
#: A conversation takes its first turns from the one that begins its hundred.
FAMILY, HEAD = 100, 6
#: Bytes of ids per block of a node's list.
BLOCK = 1 << 18


# --------------------------------------------------------------------- paths
def split(h: int) -> tuple[int, int]:
    """A fold as two signed 64-bit words."""
    return h >> 64, (h & (1 << 64) - 1) - (1 << 63)


def join(high: int, low: int) -> int:
    return (high << 64) + low + (1 << 63)


def fold(h: int, digest: bytes) -> int:
    return (h * BASE + int.from_bytes(digest, "big") + 1) % PRIME


def after(h: int, n: int, piece: int) -> int:
    """Fold of a sequence followed by n items whose fold from zero is `piece`."""
    return (h * pow(BASE, n, PRIME) + piece) % PRIME


def _runs(batches):
    """(conversation, first of the partition, rows in batches) row by row: conv, part, digest, chars, first, starts."""
    own, first = None, True
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "digest", "chars", "head")), strict=True):
            new = own is None or row[0] != own
            if new and own is not None:
                first = False
            own = row[0]
            yield row, new, first


_PIECE = "conv_id long, part int, n long, total binary, folds array<binary>"


def _pieces(batches):
    """Number of turns and folds of the first and the last conversation of a partition."""
    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([h.to_bytes(16, "big")], pa.binary()),
             pa.array([[x.to_bytes(16, "big") for x in folds]], pa.list_(pa.binary()))], ["conv_id", "part", "n", "total", "folds"])

    conv = None
    for (c, p, digest, _, _), new, first in _runs(batches):
        if new:
            if conv is not None and at_first:
                yield out()
            conv, part, n, h, folds, at_first = c, p, 0, 0, [], first
        h = fold(h, digest)
        n += 1
        if n < HEAD:
            folds.append(h)
    if conv is not None:
        yield out()


def _starts(pieces) -> dict:
    """For each piece: turns before it, their fold from the root, the fold of those after
    the head, and whether the conversation ends in it."""
    by_conv: dict = {}
    for r in pieces:
        by_conv.setdefault(r["conv_id"], []).append(r)
    out = {}
    for conv, found in by_conv.items():
        found.sort(key=lambda r: r["part"])
        before, whole, prefixes = 0, ROOT, [ROOT]  # prefixes: folds of the first turns
        for k, r in enumerate(found):
            out[conv, r["part"]] = (before, whole, list(prefixes), k + 1 == len(found))
            folds = [after(whole, i + 1, int.from_bytes(x, "big")) for i, x in enumerate(r["folds"])]
            prefixes = (prefixes + folds)[:HEAD]
            before, whole = before + r["n"], after(whole, r["n"], int.from_bytes(r["total"], "big"))
    return out


_WALK = "conv_id long, place long, high long, low long, up_high long, up_low long, chars long, ends boolean"


def _walk(starts: dict):
    """Every turn of a conversation that can be in a path, with folds.

    Turns up to place head (of the conversation that lends its first turns: up to
    HEAD - 1) as folds from the root; later ones, place counted on from the head,
    as folds from zero after the head.  up_*: the same fold before the turn.
    The two kinds are told apart by the sign of place: lent turns are negative.
    """
    def run(batches):
        rows = []

        def put(conv, place, h, up, chars, ends):
            rows.append((conv, place, *split(h), *split(up), chars, ends))

        def frame():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.bool_() if k == 7 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))],
                [f.split()[0] for f in _WALK.split(", ")])

        held = None  # the turn not yet known to be the last
        ends_here = True
        for (conv, part, digest, chars, head), new, _ in _runs(batches):
            if new:
                if held:
                    put(*held, True)
                    held = None
                place, whole, prefixes, ends_here = starts.get((conv, part), (0, ROOT, [ROOT], True))
                tail = 0
                if place > head:  # the fold after the head, from the whole and the head's
                    tail = (whole - prefixes[head] * pow(BASE, place - head, PRIME)) % PRIME
            elif held:
                put(*held, False)
                held = None
            place += 1
            if place < HEAD:
                up, whole = whole, fold(whole, digest)
                if conv % FAMILY == 0:
                    put(conv, -place, whole, up, chars, False)
            if place > head:
                up, tail = tail, fold(tail, digest)
                held = (conv, place - head, tail, up, chars)
            if len(rows) >= 20_000:
                yield frame()
                rows.clear()
        if held:
            put(*held, ends_here)
        if rows:
            yield frame()
    return run


_MEMBER = "conv_id long, depth long, high long, low long, up_high long, up_low long, chars long, ends boolean"


def _canonical(batches):
    """Own turns with the fold of the whole path."""
    names = [f.split()[0] for f in _MEMBER.split(", ")]
    for b in batches:
        rows = []
        for conv, place, high, low, up_high, up_low, chars, ends, m, head_high, head_low in zip(
                *(b.column(c).to_pylist() for c in ("conv_id", "place", "high", "low", "up_high", "up_low", "chars", "ends", "m", "head_high", "head_low")), strict=True):
            head = join(head_high, head_low)
            rows.append((conv, m + place, *split(after(head, place, join(high, low))), *split(after(head, place - 1, join(up_high, up_low))), chars, ends))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if k == 7 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))], names)


def members(conversations: DataFrame) -> DataFrame:
    """(conversation, depth) of every node of every rebuilt conversation, the root included.

    conv_id, depth, high, low (the node), up_high, up_low (its parent; null for
    the root), chars (code points of the last text), ends (the conversation has no further turn).
    """
    head = (F.crc32(F.col("conv_id").cast("string")) % HEAD).cast("int")
    src = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                               F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    src = src.where("conv_id is not null")
    named = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    src = src.select("conv_id", "turn", "role", F.substring("text", 1, 64).alias("start"), F.substring(F.unhex(F.sha2(named, 256)), 1, 16).alias("digest"),
                     F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("place"))
    keys = ["conv_id", "turn", "role", "start", "digest", "place"]
    dealt = src.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = cut_lineage(dealt.select("conv_id", "digest", "chars", head.alias("head"), F.spark_partition_id().alias("part")))
    starts = _starts(dealt.mapInArrow(_pieces, _PIECE).collect())  # at most two pieces per partition
    walk = cut_lineage(dealt.mapInArrow(_walk(starts), _WALK))
    lent = walk.where("place < 0").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("place")).alias("depth"), "high", "low", "up_high", "up_low", "chars"))).alias("lent"))  # at most HEAD - 1
    convs = dealt.select("conv_id", "head").distinct()
    convs = convs.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    convs = convs.join(lent.select(F.col("conv_id").alias("family"), "lent"), "family", "left")
    taken = F.coalesce(F.slice("lent", 1, F.col("head")), F.array().cast("array<struct<depth:bigint,high:bigint,low:bigint,up_high:bigint,up_low:bigint,chars:bigint>>"))
    root_high, root_low = split(ROOT)
    convs = convs.select("conv_id", taken.alias("lent")).withColumn("m", F.size("lent").cast("long"))
    convs = convs.withColumns({"head_high": F.when(F.col("m") > 0, F.try_element_at("lent", F.lit(-1))["high"]).otherwise(root_high),
                               "head_low": F.when(F.col("m") > 0, F.try_element_at("lent", F.lit(-1))["low"]).otherwise(root_low)})
    convs = cut_lineage(convs)
    own = cut_lineage(walk.where("place > 0"))
    canonical = own.join(convs.select("conv_id", "m", "head_high", "head_low"), "conv_id").mapInArrow(_canonical, _MEMBER)
    goes_on = own.where("place = 1").select("conv_id", F.lit(True).alias("goes_on"))
    convs = convs.join(goes_on, "conv_id", "left").withColumn("stops", F.col("goes_on").isNull())
    heads = convs.select("conv_id", "m", "stops", F.explode("lent").alias("x")).select(
        "conv_id", "x.depth", "x.high", "x.low", "x.up_high", "x.up_low", "x.chars", (F.col("stops") & (F.col("x.depth") == F.col("m"))).alias("ends"))
    none = F.lit(None).cast("long")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(root_high).cast("long").alias("high"), F.lit(root_low).cast("long").alias("low"),
                        none.alias("up_high"), none.alias("up_low"), F.lit(0).cast("long").alias("chars"), (F.col("stops") & (F.col("m") == 0)).alias("ends"))
    return cut_lineage(canonical.union(heads).union(root))


# --------------------------------------------------------------- contraction
_NODE = ["high", "low"]
_ACTIVE = "high long, low long, up_high long, up_low long, conv_id long, depth long, kids long, leaves long, saved long, edge_leaves long, edge_saved long"
_COLS = [f.split()[0] for f in _ACTIVE.split(", ")]


def _splice(batches):
    """Runs of unary nodes, each the parent of the next row, go into the lowest of them.

    Rows that stay have below_* null; for a spliced row below_* is the node that stays
    for it, and leaves and saved the difference of the totals.
    """
    names = [*_COLS, "below_high", "below_low"]
    kinds = [pa.int64()] * len(names)
    run: list[list] = []

    def close():
        low = run[-1]
        low_leaves, low_saved = low[9], low[10]
        gone, sum_leaves, sum_saved = [], low_leaves, low_saved
        for row in reversed(run[:-1]):  # what is held from this node down to the one that stays
            sum_leaves, sum_saved = sum_leaves + row[7], sum_saved + row[8]
            gone.append([*row[:7], sum_leaves, sum_saved, row[9], row[10], low[0], low[1]])
            sum_leaves, sum_saved = sum_leaves + row[9], sum_saved + row[10]
        top = run[0]
        stays = [low[0], low[1], top[2], top[3], *low[4:9], sum_leaves, sum_saved, None, None]
        run.clear()
        return [*gone, stays]

    for b in batches:
        out = []
        for row in zip(*(b.column(c).to_pylist() for c in _COLS), strict=True):
            row = list(row)
            if run:
                above = run[-1]
                if not (above[6] == 1 and above[2] is not None and row[2] == above[0] and row[3] == above[1]):
                    out += close()
            run.append(row)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
    if run:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*close(), strict=True), kinds, strict=True)], names)


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """high, low, leaves, saved: the sums over each node's subtree.

    `nodes` has high, low, up_high, up_low (null for the one root), conv_id and
    depth (an order that keeps chains together), kids, and the node's own leaves and saved.
    """
    active = cut_lineage(nodes.select(*_COLS[:9], F.lit(0).cast("long").alias("edge_leaves"), F.lit(0).cast("long").alias("edge_saved")))
    noted: list[DataFrame] = []  # high, low, below_high, below_low, leaves, saved of every splice, in the order of the rounds
    done: list[DataFrame] = []  # high, low, leaves, saved
    turn, before = 0, None
    while True:
        turn += 1
        both = cut_lineage(active.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
                           .mapInArrow(_splice, f"{_ACTIVE}, below_high long, below_low long"))
        noted.append(both.where("below_high is not null").select(*_NODE, "below_high", "below_low", "leaves", "saved"))
        active = both.where("below_high is null").select(*_COLS)
        # rake: only the root has no parent; it is the last leaf
        fallen = active.where("kids = 0")
        done.append(fallen.select(*_NODE, "leaves", "saved"))
        gifts = fallen.where("up_high is not null").groupBy("up_high", "up_low").agg(
            F.count("*").alias("fewer"), F.sum(F.col("leaves") + F.col("edge_leaves")).alias("more_leaves"), F.sum(F.col("saved") + F.col("edge_saved")).alias("more_saved"))
        gifts = gifts.select(F.col("up_high").alias("high"), F.col("up_low").alias("low"), "fewer", "more_leaves", "more_saved")
        zero = lambda c: F.coalesce(c, F.lit(0))
        rest = active.where("kids > 0").join(gifts, _NODE, "left")
        active = cut_lineage(rest.withColumns({"kids": F.col("kids") - zero("fewer"), "leaves": F.col("leaves") + zero("more_leaves"),
                                               "saved": F.col("saved") + zero("more_saved")}).select(*_COLS))
        left = active.agg(F.count("*").alias("n"), F.count(F.when((F.col("kids") == 1) & F.col("up_high").isNotNull(), 1)).alias("unary")).first()
        if not left["n"]:
            break
        if left["unary"] and before is not None and 4 * left["n"] > 3 * before:  # chains that change conversation at every node
            active, spliced = _mate(active, turn)
            noted.append(spliced)
        before = left["n"]
    totals = cut_lineage(_union(done))
    for notes in reversed(noted):
        below = totals.select(F.col("high").alias("below_high"), F.col("low").alias("below_low"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        found = notes.join(below, ["below_high", "below_low"]).select(
            *_NODE, (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))
        totals = cut_lineage(totals.union(found))
    return totals


def _mate(active: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Splice the unary nodes that this round's coin marks, where it does not mark their parent."""
    active = active.withColumn("marked", (F.col("kids") == 1) & F.col("up_high").isNotNull() & (F.xxhash64(*_NODE, F.lit(turn)) % 2 == 0))
    parent = active.where("marked").select(F.col("high").alias("up_high"), F.col("low").alias("up_low"), F.lit(True).alias("above"))
    chosen = cut_lineage(active.where("marked").join(parent, ["up_high", "up_low"], "left_anti").select(
        *_NODE, "up_high", "up_low", "leaves", "saved", "edge_leaves", "edge_saved"))
    stays = active.join(chosen.select(*_NODE), _NODE, "left_anti")
    over = chosen.toDF("up_high", "up_low", "top_high", "top_low", "l", "s", "el", "es")
    child = cut_lineage(stays.join(over, ["up_high", "up_low"], "left"))
    hit = F.col("top_high").isNotNull()
    notes = child.where(hit).select(F.col("up_high").alias("high"), F.col("up_low").alias("low"), F.col("high").alias("below_high"), F.col("low").alias("below_low"),
                                    (F.col("l") + F.col("edge_leaves")).alias("leaves"), (F.col("s") + F.col("edge_saved")).alias("saved"))
    now = child.select(*_NODE, F.when(hit, F.col("top_high")).otherwise(F.col("up_high")).alias("up_high"),
                       F.when(hit, F.col("top_low")).otherwise(F.col("up_low")).alias("up_low"), "conv_id", "depth", "kids", "leaves", "saved",
                       (F.col("edge_leaves") + F.coalesce(F.col("l") + F.col("el"), F.lit(0))).alias("edge_leaves"),
                       (F.col("edge_saved") + F.coalesce(F.col("s") + F.col("es"), F.lit(0))).alias("edge_saved"))
    return cut_lineage(now.select(*_COLS)), notes


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


# ------------------------------------------------------------------ operator
_IDS = "high long, low long, part int, block int, ids string"


def _id_blocks(batches):
    """Ids of a node in the partition as blocks of text, each id with a comma before it."""
    own, part, block, held, size = None, 0, 0, [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(
            (*own, part, block, "".join(held)), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()), strict=True)],
            [f.split()[0] for f in _IDS.split(", ")])

    for b in batches:
        for high, low, conv, p in zip(*(b.column(c).to_pylist() for c in ("high", "low", "conv_id", "part")), strict=True):
            if own != (high, low) or size >= BLOCK:
                if held:
                    yield out()
                block, held, size = (block + 1 if own == (high, low) else 0), [], 0
                own, part = (high, low), p
            held.append(f",{conv}")
            size += len(held[-1])
    if held:
        yield out()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 (of the ids that end here, in order)."""
    rows = members(conversations)
    up = F.col("up_high")
    nodes = rows.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min(up).alias("up_high"), F.min("up_low").alias("up_low"), F.max("chars").alias("chars"),
        F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("one_end"))
    nodes = cut_lineage(nodes)
    kids = nodes.where("up_high is not null").groupBy(F.col("up_high").alias("high"), F.col("up_low").alias("low")).agg(F.count("*").alias("kids"))
    nodes = cut_lineage(nodes.join(kids, _NODE, "left").withColumn("kids", F.coalesce("kids", F.lit(0))))
    totals = subtree_totals(nodes.withColumns({"leaves": (F.col("kids") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}))
    shared = rows.where("ends").join(nodes.where("n_ends > 1").select(*_NODE), _NODE)
    shared = shared.select(*_NODE, "conv_id").repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    blocks = shared.withColumn("part", F.spark_partition_id()).mapInArrow(_id_blocks, _IDS)
    blocks = cut_lineage(blocks.withColumn("node", F.concat_ws(":", "high", "low")))
    first = blocks.groupBy("node").agg(F.min(F.struct("part", "block")).alias("first"))
    blocks = blocks.join(first, "node").withColumn("ids", F.when(F.struct("part", "block") == F.col("first"), F.expr("substring(ids, 2)")).otherwise(F.col("ids")))
    lists = digests(blocks, "node", ["part", "block"], "ids")
    parent = nodes.select(F.col("high").alias("up_high"), F.col("low").alias("up_low"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, _NODE).join(parent, ["up_high", "up_low"], "left").withColumn("node", F.concat_ws(":", "high", "low")).join(lists, "node", "left")
    none_or_one = F.sha2(F.coalesce(F.col("one_end").cast("string"), F.lit("")), 256)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), F.coalesce("sha256", none_or_one).alias("ends_sha256"))
