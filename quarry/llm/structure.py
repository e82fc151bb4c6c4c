r"""Repair of conversation structure by depth-first branch-and-bound.

The rows of a conversation, by turn, get a first fault each: blank (no sign but
the six ASCII white-space characters), duplicate (role and text of an earlier
row) or truncated (the last sign is none of ``.!?``).  Edits make the initials
of the roles match ``(s?(ua)+)?``: K keeps a row (0), R gives it the role user
or assistant (2), D deletes it (3; blank and duplicate rows must go), I inserts
an empty user or assistant row anywhere (2); a truncated row that is not deleted
adds 1.  Wanted is the cheapest sequence of edits, of equally cheap ones the
least in ASCII order.

Search.  ``cheapest`` walks prefixes of the edit sequence depth first from an
explicit stack.  A prefix is cut off if its cost and the lower bound of the
rows left (``Bounds``) exceed the incumbent's, or only equal it while its audit is
already past the incumbent's, or if the table of its node (row, last role) holds
a prefix at least as good.  When the stack is empty, the incumbent is proved.

Size.  A long conversation is searched in chunks of CHUNK rows for every pair
of states at the chunk's ends (inserts stand before a row, or at the very end, so
audits of a chunk never extend one another and their order decides), and the chunks
are put together by cost, then audit.  The table is sorted by range; a
conversation at the edge of a partition is treated in pieces: its fresh rows are
checked against the pieces before, each piece reports its 16 costs and the order of
its audits, the driver picks the states at the cuts (at most two pieces per
partition), and every piece is then solved between its states.  No conversation
has to fit a task.

Edge cases: null roles and texts are one space (so such texts are blank); turns
sort null first, rows of one turn by role, then text (its first 64 signs, then a
hash); a null conv_id is a conversation of its own; a conversation without rows
gives no row here; repeated rows are duplicates; roles other than those that begin with
s, u or a must be given another role or go, and s may stay only in front; an
empty table gives no rows; very long texts are rendered in blocks of about
BLOCK signs; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarry.session import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: the initial of the last message; 0 before any.
START, SYSTEM, USER, ASSISTANT = range(4)
END = -1
#: The role that a rerole or insert gives after each state.
WANT = (USER, USER, ASSISTANT, USER)
NAMES = ("", "system", "user", "assistant")
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Inserts that end a conversation legally from each state.
CLOSING = (0, 2, 1, 0)
CHUNK = 16
BLOCK = 1 << 20

_WHITE = " \t\n\v\f\r"
_FAR = 1 << 60


# -------------------------------------------------------------------- search
def code(initial: int, must_go: bool, truncated: bool) -> str:
    """One row as a letter."""
    return chr(65 + 4 * initial + 2 * must_go + truncated)


def _read(letter: str) -> tuple[int, bool, bool]:
    n = ord(letter) - 65
    return n >> 2, bool(n & 2), bool(n & 1)


def keeps(state: int, initial: int) -> bool:
    """Whether a row with this initial may follow the state as it is."""
    return initial == SYSTEM and state == START or initial > SYSTEM and initial == WANT[state]


class Bounds:
    """Lower bound of the cost of the rows from i on after a state.

    Every row costs at least its cheapest edit.  Beyond that, neighbours among
    the rows that may stay which do not fit each other (or the state before, or
    the end after) need an insert between them (2) or an edit of one of them (2
    more than its cheapest, shared by at most two such pairs): at least 1 each.
    """

    def __init__(self, rows, last: int):
        n = len(rows)
        self.least, self._next, self._misfits, self._free = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        self._rows, self._last = rows, last
        for i in range(n - 1, -1, -1):
            initial, must_go, cut = rows[i]
            self.least[i] = self.least[i + 1] + (DELETE if must_go else cut if initial else REROLE + cut)
            self._free[i] = self._free[i + 1] + (not must_go)
            if must_go:  # looks through to the next row that may stay
                self._next[i], self._misfits[i] = self._next[i + 1], self._misfits[i + 1]
            elif initial:
                self._next[i] = initial
                after = self._next[i + 1]
                misfit = not keeps(initial, after) if after else self._free[i + 1] == 0 and self._ends(initial)
                self._misfits[i] = self._misfits[i + 1] + misfit
            else:  # a row that must be given a role takes any place: what is before it fits
                self._misfits[i] = self._misfits[i + 1]

    def _ends(self, initial: int) -> bool:
        return initial != ASSISTANT if self._last == END else self._last > START and initial != self._last

    def __call__(self, i: int, state: int) -> int:
        out = self.least[i] + self._misfits[i]
        if self._next[i]:
            return out + (not keeps(state, self._next[i]))
        if not self._free[i]:
            if self._last == END:
                out += INSERT * CLOSING[state]
            elif state != self._last:
                return _FAR
        return out


@lru_cache(maxsize=100_000)
def cheapest(letters: str, first: int = START, last: int = END) -> tuple[int, str] | None:
    """(cost, audit) of the best edits of these rows from a state to another (or
    to a legal end); None if there are none."""
    rows = [_read(x) for x in letters]
    n, bound = len(rows), Bounds(rows, last)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {(0, first): (0, "")}
    stack = [(0, first, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if table[i, state] != (cost, audit):
            continue  # a better prefix has reached the node since
        if best is not None:
            f = cost + bound(i, state)
            if f > best[0] or f == best[0] and audit > best[1][: len(audit)]:
                continue
        if i == n:
            if last == END:
                cost, audit = cost + INSERT * CLOSING[state], audit + "I" * CLOSING[state]
            elif state != last:
                continue
            if best is None or (cost, audit) < best:
                best = cost, audit
            continue
        initial, must_go, cut = rows[i]
        ways = [(state, cost + DELETE, audit + "D")]
        if not must_go:
            for at, price, sofar in ((state, cost + cut, audit), (WANT[state], cost + cut + INSERT, audit + "I")):
                if keeps(at, initial):
                    ways.append((initial, price + KEEP, sofar + "K"))
                ways.append((WANT[at], price + REROLE, sofar + "R"))
        kids = []
        for after, price, sofar in ways:
            f = price + bound(i + 1, after)
            if f >= _FAR or best is not None and (f > best[0] or f == best[0] and sofar > best[1][: len(sofar)]):
                continue
            node = i + 1, after
            if node in table and table[node] <= (price, sofar):
                continue
            table[node] = price, sofar
            kids.append((f, sofar, after, price))
        kids.sort(reverse=True)  # the most promising is popped first
        stack += [(i + 1, after, price, sofar) for _, sofar, after, price in kids]
    return best


def chunks(letters: str) -> list[str]:
    return [letters[k : k + CHUNK] for k in range(0, len(letters), CHUNK)] or [""]


def best_edits(letters: str, first: int = START, last: int = END) -> tuple[int, str] | None:
    """As ``cheapest``, for any number of rows."""
    parts = chunks(letters)
    if len(parts) == 1:
        return cheapest(letters, first, last)
    ahead = [None] * len(parts)  # cost from each state before a chunk to the end
    ahead[-1] = [c[0] if (c := cheapest(parts[-1], s, last)) else _FAR for s in range(4)]
    for k in range(len(parts) - 2, -1, -1):
        ahead[k] = [min((c[0] + ahead[k + 1][t] for t in range(4) if (c := cheapest(parts[k], s, t))), default=_FAR) for s in range(4)]
    if ahead[0][first] >= _FAR:
        return None
    state, audits = first, []
    for k, part in enumerate(parts[:-1]):
        audit, state = min((c[1], t) for t in range(4) if (c := cheapest(part, state, t)) and c[0] + ahead[k + 1][t] == ahead[k][state])
        audits.append(audit)
    audits.append(cheapest(parts[-1], state, last)[1])
    return ahead[0][first], "".join(audits)


def piece_matrix(letters: str) -> list[list[tuple[int, int, int]]]:
    """For each state before a piece: (state after, cost, place of its audit among
    that row's audits); the cost to a legal end as state END."""
    out = []
    for s in range(4):
        found = [(t, *c) for t in range(4) if (c := best_edits(letters, s, t))]
        order = {a: k for k, a in enumerate(sorted(a for _, _, a in found))}
        end = best_edits(letters, s, END)
        out.append([(t, c, order[a]) for t, c, a in found] + [(END, end[0], 0)])
    return out


def cut_states(matrices) -> list[tuple[int, int]]:
    """(state before, state after) of the consecutive pieces of a conversation."""
    ahead = [[] for _ in matrices]
    for k in range(len(matrices) - 1, -1, -1):
        if k == len(matrices) - 1:
            ahead[k] = [next(c for t, c, _ in row if t == END) for row in matrices[k]]
        else:
            ahead[k] = [min((c + ahead[k + 1][t] for t, c, _ in row if t != END), default=_FAR) for row in matrices[k]]
    state, out = START, []
    for k, m in enumerate(matrices):
        after = END
        if k + 1 < len(matrices):
            _, after = min((place, t) for t, c, place in m[state] if t != END and c + ahead[k + 1][t] == ahead[k][state])
        out.append((state, after))
        state = after
    return out


def repaired(rows, audit: str, state: int):
    """role:text of the messages that the edits leave, with what stands before each."""
    at = 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = NAMES[WANT[state]], ""
        if edit != "I":
            _, own, text = rows[at]
            role = own if edit == "K" else role
            at += 1
        yield ("\n" if state else "") + f"{role}:{text}"
        state = INITIAL[role[0]]


# -------------------------------------------------------------------- tables
def is_blank(text: str) -> bool:
    return not text.strip(_WHITE)


def is_cut(text: str) -> bool:
    return not text.rstrip(_WHITE).endswith((".", "!", "?"))


def _conversations(batches):
    """(key, first of the partition, last of the partition, rows) of every conversation."""
    own, held, first = None, [], True
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "conv_id", "part")), strict=True):
            if held and row[0] != own:
                yield own, first, False, held
                held, first = [], False
            own = row[0]
            held.append(row)
    if held:
        yield own, first, True, held


_RESULT = ("part int, block int, whole boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, text string")
_NAMES = ["conv", "conv_id", *(f.split()[0] for f in _RESULT.split(", "))]


def _spread(turns) -> int:
    """Gaps of turn numbers (without nulls)."""
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


def _letters(rows, duplicate) -> tuple[str, list[int]]:
    """Rows as letters, and the numbers of blank, duplicate and truncated ones."""
    out, n = [], [0, 0, 0]
    for (_, role, text), again in zip(rows, duplicate, strict=True):
        blank = is_blank(text)
        again = again and not blank
        cut = not blank and not again and is_cut(text)
        for k, x in enumerate((blank, again, cut)):
            n[k] += x
        out.append(code(INITIAL.get(role[:1], 0), blank or again, cut))
    return "".join(out), n


def _illegal(initials) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _result(conv, conv_id, part, rows, duplicate, gaps, first=START, last=END, before=None, whole=True):
    """Result rows of a conversation or a piece of one: sums, audit and rendered text in blocks."""
    letters, (blank, again, cut) = _letters(rows, duplicate)
    cost, audit = best_edits(letters, first, last)
    initials = [r[1][:1] for r in rows]
    if before is not None:
        initials.insert(0, before)
    blocks, held, size = [], [], 0
    for text in repaired(rows, audit, first):
        held.append(text)
        size += len(text)
        if size >= BLOCK:
            blocks.append("".join(held))
            held, size = [], 0
    if held or not blocks:
        blocks.append("".join(held))
    sums = gaps, blank, again, cut, _illegal(initials), cost, audit
    for k, text in enumerate(blocks):
        yield (conv, conv_id, part, k, whole and len(blocks) == 1, *(sums if k == 0 else (0, 0, 0, 0, 0, 0, "")), text)


def _frame(rows, id_kind):
    kinds = [pa.string(), id_kind, pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def _seen(rows) -> list[bool]:
    had, out = set(), []
    for _, role, text in rows:
        out.append((role, text) in had)
        had.add((role, text))
    return out


def _inner(id_kind):
    """Whole conversations inside a partition."""
    def run(batches):
        out, size = [], 0
        for conv, first, last, held in _conversations(batches):
            if first or last:
                continue
            rows = [r[1:4] for r in held]
            new = list(_result(conv, held[0][4], held[0][5], rows, _seen(rows), _spread([r[0] for r in rows if r[0] is not None])))
            out += new
            size += sum(len(r[-1]) for r in new)
            if len(out) >= 2000 or size >= 4 * BLOCK:
                yield _frame(out, id_kind)
                out, size = [], 0
        if out:
            yield _frame(out, id_kind)
    return run


def _edges(id_kind):
    """Rows of the first and last conversation of a partition; fresh ones may repeat a row of an earlier part."""
    names = ["conv", "conv_id", "part", "at", "turn", "role", "text", "again", "fresh"]
    kinds = [pa.string(), id_kind, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.binary()]

    def run(batches):
        for conv, first, last, held in _conversations(batches):
            if not (first or last):
                continue
            again = _seen([r[1:4] for r in held])
            for lo in range(0, len(held), 1000):
                rows = []
                for k, (_, turn, role, text, conv_id, part) in enumerate(held[lo : lo + 1000], lo):
                    digest = None if again[k] else hashlib.sha256(f"{len(role)}:{role}:{text}".encode("utf-8", "surrogatepass")).digest()
                    rows.append((conv, conv_id, part, k if first else k + (1 << 40), turn, role, text, again[k], digest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return run


def _pieces(batches):
    """(key, part, rows, duplicate flags) of pieces in the order of part and at."""
    own, held = None, []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("part", "conv", "turn", "role", "text", "again", "conv_id")), strict=True):
            if held and row[:2] != own:
                yield *own, held
                held = []
            own = row[:2]
            held.append(row)
    if held:
        yield *own, held


_REPORT = "conv string, part int, matrix array<array<array<long>>>, turns array<long>, different long, first string, last string"


def _reports(batches):
    for part, conv, held in _pieces(batches):
        rows = [r[2:5] for r in held]
        letters, _ = _letters(rows, [r[5] for r in held])
        turns = [r[0] for r in rows if r[0] is not None]
        ends = [turns[0], turns[-1]] if turns else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], k) for x, k in (
                (conv, pa.string()), (part, pa.int32()), ([[list(x) for x in row] for row in piece_matrix(letters)], pa.list_(pa.list_(pa.list_(pa.int64())))),
                (ends, pa.list_(pa.int64())), (len(set(turns)), pa.int64()), (rows[0][1][:1], pa.string()), (rows[-1][1][:1], pa.string()))],
            ["conv", "part", "matrix", "turns", "different", "first", "last"])


def _solve(states: dict, id_kind):
    def run(batches):
        for part, conv, held in _pieces(batches):
            gaps, first, last, before, whole = states[conv, part]
            yield from (_frame([r], id_kind) for r in _result(
                conv, held[0][6], part, [r[2:5] for r in held], [r[5] for r in held], gaps, first, last, before, whole))
    return run


def _joined_up(reports) -> dict:
    """For each piece: gaps (on the first), states before and after, the initial before it, and whether it is all there is."""
    by_conv: dict = {}
    for r in reports:
        by_conv.setdefault(r["conv"], []).append(r)
    states = {}
    for conv, found in by_conv.items():
        found.sort(key=lambda r: r["part"])
        different, top, low = 0, None, None
        for r in found:  # turns rise from piece to piece
            if r["turns"]:
                different += r["different"] - (top is not None and top == r["turns"][0])
                low, top = r["turns"][0] if low is None else low, r["turns"][1]
        gaps = top - low + 1 - different if top is not None else 0
        for k, (r, (a, b)) in enumerate(zip(found, cut_states([r["matrix"] for r in found]), strict=True)):
            states[conv, r["part"]] = (gaps if k == 0 else 0, a, b, found[k - 1]["last"] if k else None, len(found) == 1)
    return states


def repair_pieces(conversations: DataFrame, order=()) -> DataFrame:
    """The repair of every conversation with a row.

    One row per conversation, or several in the order of part and block for long ones:
    conv_id, part, block, whole (the only one), then gaps, blank, duplicate,
    truncated, illegal, cost (to be summed), audit and text (the repaired
    messages as role:text, one per line; to be put together).  `order` is a list of
    further sorting columns for rows of equal turn, before role and text.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    src = conversations.select(
        F.col("conv_id"), F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null")).alias("conv"),
        F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"),
        *[F.col(c).alias(f"order{k}") for k, c in enumerate(order)])
    src = src.withColumns({"start": F.substring("text", 1, 64), "hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    keys = ["conv_id", "turn", *(f"order{k}" for k in range(len(order))), "role", "start", "hash", "place"]
    dealt = src.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = cut_lineage(dealt.select("conv_id", "conv", "turn", "role", "text", F.spark_partition_id().alias("part")))
    kind = src.schema["conv_id"].dataType
    id_kind, id_text = to_arrow_type(kind), kind.simpleString()
    inner = dealt.mapInArrow(_inner(id_kind), f"conv string, conv_id {id_text}, {_RESULT}")
    edges = cut_lineage(dealt.mapInArrow(_edges(id_kind), f"conv string, conv_id {id_text}, part int, at long, turn long, role string, text string, again boolean, fresh binary"))
    earliest = cut_lineage(edges.where("fresh is not null").groupBy("conv", "fresh").agg(F.min("part").alias("earliest")))
    known = edges.where("fresh is not null").join(earliest, ["conv", "fresh"]).withColumn("again", F.col("part") > F.col("earliest"))
    cols = ["conv", "conv_id", "part", "at", "turn", "role", "text", "again"]
    pieces = known.select(*cols).union(edges.where("fresh is null").select(*cols)).repartition(F.xxhash64("part")).sortWithinPartitions("part", "at")
    pieces = cut_lineage(pieces)
    states = _joined_up(pieces.mapInArrow(_reports, _REPORT).collect())  # at most two pieces per partition
    return inner.union(pieces.mapInArrow(_solve(states, id_kind), f"conv string, conv_id {id_text}, {_RESULT}"))


def digests(pieces: DataFrame, key: str, order: list[str], data: str) -> DataFrame:
    """key and the SHA-256 (lower-case hex) of its `data` in the given order.

    Only the blocks pass; a task streams those of a key one by one."""
    def run(batches):
        own, sha = None, None
        for b in batches:
            for k, x in zip(b.column("k").to_pylist(), b.column("x").to_pylist(), strict=True):
                if sha is None or k != own:
                    if sha is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([sha.hexdigest()])], ["k", "sha"])
                    own, sha = k, hashlib.sha256()
                sha.update(x)
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([sha.hexdigest()])], ["k", "sha"])

    blocks = pieces.select(F.col(key).alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(data).cast("binary").alias("x"))
    # dealt by a hash of the key: a repartition like that of a join below would be dropped from the plan
    blocks = blocks.repartition(F.xxhash64("k")).sortWithinPartitions("k", *(f"o{i}" for i in range(len(order)))).select("k", "x")
    return blocks.mapInArrow(run, f"k {pieces.schema[key].dataType.simpleString()}, sha string").toDF(key, "sha256")


def repair(conversations: DataFrame, order=()) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of every conversation with a row."""
    pieces = repair_pieces(conversations, order)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = pieces.where("whole").select("conv_id", *counts, "audit", F.sha2("text", 256).alias("repaired_sha256"))
    parts = cut_lineage(pieces.where("not whole"))
    together = parts.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in counts],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    together = together.join(digests(parts, "conv", ["part", "block"], "text"), "conv")
    return whole.union(together.select("conv_id", *counts, "audit", F.col("sha256").alias("repaired_sha256")))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of conversations with faults by the remainder of crc32(`conv_id:turn`)
    by 20: 0 drops the row, 1 empties its text, 2 removes the ends of its
    sentences, 3 repeats it, 4 makes its role user.  Nulls are one space.
    role0 and text0 are as before, to sort rows of equal turns."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    src = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role0"), space("text").alias("text0"),
                               (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("fault"))
    src = src.where("fault != 0").withColumns({
        "role": F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role0")),
        "text": F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text0", "[.!?]", "")).otherwise(F.col("text0"))})
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return src.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text", "role0", F.substring("text0", 1, 64).alias("text0"),
                                                            F.xxhash64("text0").alias("hash0"))
