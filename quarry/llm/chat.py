r"""Chat formatting with minimum-cost repair of turn order.

A legal conversation is a word of a small automaton: an optional system turn,
then user and assistant in turn, ending with the assistant.  Each turn of the
input is kept, given another role, or merged into the message before it, and
empty messages may be inserted; every repair has a cost, and dynamic programming
over the automaton's states finds a cheapest legal reading.  The repaired
sequence is rendered message by message.

A turn acts on the costs of the states as a min-plus matrix, and such matrices
multiply in any grouping.  The table is therefore sorted by range, and a
conversation that crosses partitions is solved in three steps: the matrix of
each piece, the best states at the cuts (at most two pieces per partition), and
the path within each piece.  No conversation has to fit one task.

The result has one row per turn: what was done with it and the text that it
adds to the rendered conversation.  Joined in order, the rendered pieces of a
conversation are its whole rendering.

Edge cases: roles are compared in lower case without white space around them,
and usual other names count as the three roles; other or null roles must be
relabelled; null texts are empty; a null conv_id is a conversation of its own;
turns are ordered by turn (null first), equal turns by role, hash of the text
and place in the table; repeated rows are further turns (and merge); marks of
the template inside a text are broken up; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

ROLES = ("system", "user", "assistant")
#: States: nothing yet, then after a message of each role.
START, FINAL = 0, 3
#: From each state, the states of the messages that may follow.
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
MERGE, RELABEL, NAME, INSERT = 1, 2, 1, 3
#: Other names of the roles.
NAMES = {"system": 1, "developer": 1, "user": 2, "human": 2, "prompter": 2, "customer": 2,
         "assistant": 3, "gpt": 3, "bot": 3, "model": 3, "ai": 3, "agent": 3}

_INF = math.inf
_STATES = range(4)


def role_of(name: str | None) -> int:
    """State of a role name; 0 if it names none."""
    return NAMES.get((name or "").strip().lower(), 0)


def _insertions() -> list[list[tuple[int, ...] | None]]:
    """The shortest run of empty messages from each state to each other."""
    found: list[list[tuple[int, ...] | None]] = [[None] * 4 for _ in _STATES]
    for s in _STATES:
        found[s][s], edge = (), [s]
        while edge:
            here = edge.pop(0)
            for n in NEXT[here]:
                if found[s][n] is None:
                    found[s][n] = (*found[s][here], n)
                    edge.append(n)
    return found


INSERTIONS = _insertions()


def _relabel(role: int, state: int) -> int:
    return 0 if role == state else RELABEL if role else NAME


def _moves(role: int) -> list[tuple[int, int, int, tuple[int, ...], bool]]:
    """Ways to take a turn: from, to, cost, states inserted before, merged."""
    out = []
    for s in _STATES:
        for mid in _STATES:
            way = INSERTIONS[s][mid]
            if way is None:
                continue
            out += [(s, n, INSERT * len(way) + _relabel(role, n), way, False) for n in NEXT[mid]]
        if s:
            out.append((s, s, MERGE + _relabel(role, s), (), True))
    return sorted(out, key=lambda m: (m[0], m[1], m[2], m[4], m[3]))


def _cheapest(moves):
    """The first cheapest move between each pair of states."""
    best: dict[tuple[int, int], tuple] = {}
    for m in moves:
        if (m[0], m[1]) not in best or m[2] < best[m[0], m[1]][2]:
            best[m[0], m[1]] = m
    return list(best.values())


MOVES = [_cheapest(_moves(r)) for r in range(4)]


def advance(cost: list[float], role: int) -> list[float]:
    """Costs of the states after one more turn."""
    out = [_INF] * 4
    for s, n, c, _, _ in MOVES[role]:
        if cost[s] + c < out[n]:
            out[n] = cost[s] + c
    return out


def piece_matrix(roles) -> list[list[float]]:
    """Cost from each state before to each state after a piece of a conversation."""
    rows = [[0.0 if a == b else _INF for b in _STATES] for a in _STATES]
    for r in roles:
        rows = [advance(x, r) for x in rows]
    return rows


def end_cost(state: int) -> float:
    return _INF if INSERTIONS[state][FINAL] is None else INSERT * len(INSERTIONS[state][FINAL])


def best_path(roles: list[int], first: int = START, last: int | None = None):
    """A cheapest move for each turn from `first` to `last` (or to any end)."""
    cost = [0.0 if s == first else _INF for s in _STATES]
    back = []
    for r in roles:
        now, via = [_INF] * 4, [None] * 4
        for m in MOVES[r]:
            if cost[m[0]] + m[2] < now[m[1]]:
                now[m[1]], via[m[1]] = cost[m[0]] + m[2], m
        cost = now
        back.append(via)
    state = min(_STATES, key=lambda s: (cost[s] + end_cost(s), s)) if last is None else last
    out = []
    for via in reversed(back):
        out.append(via[state])
        state = via[state][0]
    return out[::-1]


def cut_states(matrices: list[list[list[float]]]) -> list[tuple[int, int]]:
    """The best (state before, state after) of consecutive pieces."""
    cost, back = [0.0 if s == START else _INF for s in _STATES], []
    for m in matrices:
        now = [min((cost[s] + m[s][n], s) for s in _STATES) for n in _STATES]
        cost = [c for c, _ in now]
        back.append([s for _, s in now])
    state = min(_STATES, key=lambda s: (cost[s] + end_cost(s), s))
    out = []
    for via in reversed(back):
        out.append((via[state], state))
        state = via[state]
    return out[::-1]


def _open(state: int) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n"


_CLOSE = "<|im_end|>\n"


def render(move, text: str | None, last: bool) -> str:
    """What a turn adds to the rendering."""
    before, after, _, inserted, merged = move
    text = (text or "").replace("<|im_", "<| im_")
    if merged:
        out = f"\n\n{text}" if text else ""
    else:
        out = _CLOSE if before else ""
        out += "".join(_open(s) + _CLOSE for s in inserted) + _open(after) + text
    if last:
        out += _CLOSE + "".join(_open(s) + _CLOSE for s in INSERTIONS[after][FINAL])
    return out


def _runs(batches):
    """(conversation, first of the partition, last of the partition, batch slices)."""
    held, own, first = [], None, True
    for b in batches:
        ids, lo = b.column("conv").to_pylist(), 0
        for k, c in enumerate(ids):
            if held and lo == k and c != own:
                yield own, first, False, held
                held, first = [], False
            own = c
            if k + 1 == len(ids) or ids[k + 1] != c:
                held.append(b.slice(lo, k + 1 - lo))
                lo = k + 1
    if held:
        yield own, first, True, held


def _cut_matrices(batches):
    """The matrices of the pieces that may go on in another partition."""
    for conv, first, last, held in _runs(batches):
        if first or last:
            roles = [role_of(r) for b in held for r in b.column("role").to_pylist()]
            flat = [x for row in piece_matrix(roles) for x in row]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.string()), pa.array([held[0].column("part")[0].as_py()], pa.int32()),
                 pa.array([flat], pa.list_(pa.float64()))], ["conv", "part", "costs"])


_RESULT = ("turn long, action string, role string, cost int, inserted string, rendered string")


def _solver(states: dict, id_kind: pa.DataType):
    """One result row per turn; `states` has the cut states of the pieces of
    conversations that cross partitions, and whether a piece is the last."""
    def run(batches):
        for conv, _, _, held in _runs(batches):
            part = held[0].column("part")[0].as_py()
            before, after, ends = states.get((conv, part), (START, None, True))
            roles = [role_of(r) for b in held for r in b.column("role").to_pylist()]
            path = best_path(roles, before, after)
            at = 0
            for b in held:
                moves = path[at : at + len(b)]
                own = roles[at : at + len(b)]
                at += len(b)
                cost = [m[2] for m in moves]
                if at == len(path) and ends:
                    cost[-1] += INSERT * len(INSERTIONS[moves[-1][1]][FINAL])
                action = [("merge" if m[4] else "new") + ("" if r == m[1] else ", relabel") for m, r in zip(moves, own, strict=True)]
                inserted = [",".join(ROLES[s - 1] for s in m[3]) for m in moves]
                if at == len(path) and ends:
                    tail = [ROLES[s - 1] for s in INSERTIONS[moves[-1][1]][FINAL]]
                    inserted[-1] = ";".join([inserted[-1], ",".join(tail)]) if tail else inserted[-1]
                text = [render(m, t, ends and at == len(path) and k + 1 == len(moves))
                        for k, (m, t) in enumerate(zip(moves, b.column("text").to_pylist(), strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv_id").cast(id_kind), b.column("turn"), pa.array(action), pa.array([ROLES[m[1] - 1] for m in moves]),
                     pa.array(cost, pa.int32()), pa.array(inserted), pa.array(text)],
                    ["conv_id", "turn", "action", "role", "cost", "inserted", "rendered"])
    return run


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, action, role, cost, inserted and rendered of every turn.

    action: new or merge, with ", relabel" if the role changed; inserted:
    roles of empty messages before the turn, and after a semicolon those
    that close the conversation.
    """
    src = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                               F.col("text").cast("string").alias("text"),
                               F.col("conv_id").cast("string").alias("conv"), F.monotonically_increasing_id().alias("place"))
    keys = ["conv_id", "turn", "role", F.xxhash64("text"), "place"]
    dealt = src.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = cut_lineage(dealt.select("conv_id", "conv", "turn", "role", "text", F.spark_partition_id().alias("part")))
    pieces: dict = {}
    # at most two pieces per partition
    for r in dealt.mapInArrow(_cut_matrices, "conv string, part int, costs array<double>").collect():
        pieces.setdefault(r["conv"], []).append((r["part"], [r["costs"][4 * s : 4 * s + 4] for s in _STATES]))
    states = {}
    for conv, found in pieces.items():
        found.sort(key=lambda x: x[0])
        for k, ((part, _), (a, b)) in enumerate(zip(found, cut_states([m for _, m in found]), strict=True)):
            states[conv, part] = (a, b, k + 1 == len(found))
    kind = src.schema["conv_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    return dealt.mapInArrow(_solver(states, to_arrow_type(src.schema["conv_id"].dataType)), f"conv_id {kind}, {_RESULT}")


def conversation_costs(repaired: DataFrame) -> DataFrame:
    """conv_id, turns and total repair cost of every conversation."""
    return repaired.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.sum("cost").cast("long").alias("cost"))
