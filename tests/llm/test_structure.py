"""Prefix trie, repeated passages and structure repair against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from quarry.llm import queries, repeats, structure, trie

TURNS = "conv_id long, turn long, role string, text string"


# ------------------------------------------------------------------ repeats
def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        spans = repeats.union_of((i, i + length) for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1)
        kept = bytes(x for i, x in enumerate(t) if not any(a <= i < b for a, b in spans))
        out.append((kept, len(t), sum(b - a for a, b in spans), [tuple(s) for s in spans]))
    return out


def passages(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdeé€", k=rnd.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(3)]
    docs = [prose(rnd.randint(0, 150)) for _ in range(12)]
    docs += [prose(rnd.randint(0, 40)) + shared[k % 3] + prose(rnd.randint(0, 40)) for k in range(12)]
    docs += [docs[0], docs[0], shared[0], "a" * 500, "ab" * 300, "", None, " ", docs[1][:150], docs[1] + "!", "x" * 199, "x" * 200]
    return docs


@pytest.mark.parametrize("crowd,sieve_keys,anchor", [(2000, 1 << 26, 64), (1, 1 << 26, 64), (2000, 0, 64), (0, 0, 8)])
def test_repeats_equal_brute_force(spark, crowd, sieve_keys, anchor):
    docs = passages(3)
    # names that the operator uses itself
    df = spark.createDataFrame([(i, t, i, "d", [1], "k") for i, t in enumerate(docs)],
                               "doc_id long, text string, key long, digest string, marks array<int>, packed string").repartition(5)
    got = {r["doc_id"]: r for r in repeats.strip_repeats(df, crowd=crowd, sieve_keys=sieve_keys, anchor=anchor).collect()}
    want = brute_repeats([(t or "").encode() for t in docs], 200)
    assert len(got) == len(docs)
    for i, (kept, n, gone, spans) in enumerate(want):
        r = got[i]
        assert (bytes(r["kept"]), r["n_bytes"], r["n_removed"], [(s["start"], s["end"]) for s in r["spans"]]) == (kept, n, gone, spans), i
        assert (r["key"], r["digest"], r["marks"], r["packed"]) == (i, "d", [1], "k")


def test_a_crowd_of_near_copies_is_few_parts(spark):
    """What near copies have alike is indexed and divided once, not once per copy."""
    rnd = random.Random(5)
    base = "".join(rnd.choices("abcdefghij ", k=900))
    docs = [base[:at] + "Z" + base[at + 1 :] for at in rnd.sample(range(len(base)), 120)]
    found = defaultdict(dict)
    for t in docs:
        for starts, ends, keys in repeats.segments(t.encode()):
            for a, b, key in zip(starts.tolist(), ends.tolist(), keys.tolist(), strict=True):
                found[key][t[a:b].encode()] = found[key].get(t[a:b].encode(), 0) + 1
    rows = [(k, n, copies, piece) for k, pieces in found.items() if len(pieces) > 10 for n, (piece, copies) in enumerate(pieces.items())]
    segs = spark.createDataFrame(rows, "key long, seg long, n long, bytes binary").repartition(3)
    members, parts = repeats.crowd_parts(segs, 28)
    held = members.join(parts.select("key", "seg", "n", "bytes").toDF("up_key", "up_seg", "n", "part"), ["up_key", "up_seg"]).collect()
    own = {(r[0], r[1]): r[3] for r in rows}
    assert held and all(bytes(r["part"]) == own[r["key"], r["seg"]][r["at"] : r["at"] + len(r["part"])] for r in held)
    assert 2 * parts.count() < len(held)  # before, one row for each of these was indexed and divided again
    got = {r["doc_id"]: r for r in repeats.strip_repeats(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), crowd=3).collect()}
    for i, (kept, _, gone, _) in enumerate(brute_repeats([t.encode() for t in docs], 200)):
        assert (bytes(got[i]["kept"]), got[i]["n_removed"]) == (kept, gone)


def duck(name, columns, rows, query):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE {name} ({columns})")
    con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con.sql(queries.ORACLE_SQL[query]).fetchall()


def test_sql_of_repeats():
    docs = passages(11)
    got = {r[0]: r[1:] for r in duck("documents", "doc_id BIGINT, text VARCHAR", list(enumerate(docs)), "op12_repeated_passages")}
    want = brute_repeats([(t or "").encode() for t in docs], 200)
    assert got == {i: (n, gone, len(spans), hashlib.sha256(kept).hexdigest()) for i, (kept, n, gone, spans) in enumerate(want)}


def test_repeats_of_long_text_cross_slabs(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLAB", 1000)
    rnd = random.Random(5)
    text = "".join(rnd.choices("abcdefgh ", k=6000))
    text += text[900:1500]
    got = list(repeats.segments(text.encode()))
    covered = [t for a, b, _ in got for x, y in zip(a, b) for t in range(x, y - 199)]
    assert covered == list(range(len(text) - 199))
    marks = repeats.long_matches([text.encode()], [1])
    want = brute_repeats([text.encode()], 200)[0]
    assert marks[0] == want[3]
    df = spark.createDataFrame([(1, text * 30)], "doc_id long, text string")  # 200,000 bytes, all repeated
    r = repeats.strip_repeats(df).first()
    assert (r["n_removed"], len(r["spans"]), bytes(r["kept"])) == (len(text) * 30, 1, b"")


def test_repeats_of_empty_table(spark):
    assert repeats.strip_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_run_index():
    rnd = random.Random(7)
    for trial in range(60):
        pieces = ["".join(rnd.choices("ab", k=rnd.randint(0, 30))).encode() for _ in range(rnd.randint(1, 8))]
        copies = [rnd.choice((1, 1, 2)) for _ in pieces]
        every = [p for p, n in zip(pieces, copies) for _ in range(n)]
        seen = Counter(p[i : i + 5] for p in every for i in range(len(p) - 4))
        want = [repeats.union_of((i, i + 5) for i in range(len(p) - 4) if seen[p[i : i + 5]] > 1) for p in pieces]
        assert repeats.long_matches(pieces, copies, 5) == want, trial
    index = repeats.build_index([b"abcabcabcabcabcabc"] * 20, 6)
    assert len(index.start) < len(index.segment) / 3  # runs, not suffixes


def test_sieve_loses_no_key(spark):
    keys = [5, -7, 1 << 40, -(1 << 63), (1 << 63) - 1, 32768, 32767]
    made = repeats._sieve_of(spark.createDataFrame([(k,) for k in keys], "key long"))
    import numpy as np
    look = repeats.Sieve(made.value)
    assert look(np.array(keys)).all() and not look(np.array([6, -8, 99])).any()


# ---------------------------------------------------------------- structure
def brute_edits(rows, first=0, last=-1):
    """Least (cost, audit) by a table over all states, inserts allowed anywhere."""
    def inserted(have):
        have = dict(have)
        for _ in range(3):
            for s, (k, a) in list(have.items()):
                new = (k + 2, a + "I")
                if have.get(structure.WANT[s], (1 << 60, "")) > new:
                    have[structure.WANT[s]] = new
        return have

    now = {first: (0, "")}
    for initial, must_go, cut in rows:
        after = {}
        for s, (k, a) in inserted(now).items():
            ways = [(s, k + 3, a + "D")]
            if not must_go:
                ways += [(initial, k + cut, a + "K")] if structure.keeps(s, initial) else []
                ways.append((structure.WANT[s], k + 2 + cut, a + "R"))
            for n, cost, audit in ways:
                if after.get(n, (1 << 60, "")) > (cost, audit):
                    after[n] = cost, audit
        now = after
    return min(v for s, v in inserted(now).items() if s in (0, 3)) if last == -1 else now.get(last)


def sequences(seed, n, longest):
    rnd = random.Random(seed)
    letters = [structure.code(i, g, c) for i in range(4) for g in (False, True) for c in (False, True) if not (g and c)]
    for _ in range(n):
        yield "".join(rnd.choices(letters, [rnd.random() ** 3 for _ in letters], k=rnd.randint(0, longest)))


def test_branch_and_bound_is_optimal():
    for w in sequences(1, 1500, 14):
        rows = [structure._read(x) for x in w]
        assert structure.cheapest(w) == brute_edits(rows), w
        bound = structure.Bounds(rows, structure.END)
        for i in range(len(rows) + 1):
            for s in range(4):
                assert bound(i, s) <= brute_edits(rows[i:], s)[0]


def test_long_conversations_in_chunks_and_pieces(monkeypatch):
    monkeypatch.setattr(structure, "CHUNK", 4)
    rnd = random.Random(2)
    for w in sequences(3, 300, 40):
        want = brute_edits([structure._read(x) for x in w])
        assert structure.best_edits(w) == want, w
        cuts = sorted(rnd.randint(0, len(w)) for _ in range(3))
        parts = [p for a, b in zip([0, *cuts], [*cuts, len(w)]) if (p := w[a:b])]
        if parts:
            got = [structure.best_edits(p, a, b) for p, (a, b) in zip(parts, structure.cut_states([structure.piece_matrix(p) for p in parts]))]
            assert (sum(c for c, _ in got), "".join(a for _, a in got)) == want, (w, parts)


def brute_repair(turns):
    by = defaultdict(list)
    for c, t, r, x in turns:
        by[c].append((t, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        new = []
        for t, r, x in rows:
            fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
            new += [] if fault == 0 else [(t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1)
        numbers = [t for t, _, _ in new if t is not None]
        seen, rows, n = set(), [], [0, 0, 0]
        for _, r, x in new:
            signs = re.findall(r"[^\x20\x09-\x0D]", x)
            faults = not signs, bool(signs) and (r, x) in seen, bool(signs) and (r, x) not in seen and signs[-1] not in ".!?"
            seen.add((r, x))
            n = [a + b for a, b in zip(n, faults)]
            rows.append((structure.INITIAL.get(r[:1], 0), faults[0] or faults[1], faults[2]))
        initials = [r[:1] for _, r, _ in new]
        cost, audit = brute_edits(rows)
        text = "".join(structure.repaired(new, audit, 0))
        out[c] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *n,
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def odd_turns(seed):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "User", "", None, "sage", "tool"]
    texts = ["Yes.", "No?", "no", " ", "", None, "a\n", "Ends! ", "é.", "long " * 3000 + "."]
    rows = [(c, rnd.choice([None, *range(8)]), rnd.choice(roles), rnd.choice(texts)) for c in (None, -150, -3, 0, 1, 2, 99, 100, 207, 300) for _ in range(rnd.randint(1, 14))]
    rows += [(5, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(400)]  # crosses partitions
    rows += [(6, t, "user", f"say {t % 90}") for t in range(300)]  # duplicates in other partitions
    rows += [(205, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(300)]
    rows += [(100, 0, "user", "Yes."), (100, 0, "user", "Yes.")]
    rnd.shuffle(rows)
    return rows


def table(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("partitions", [1, 9])
def test_repair_query_equals_brute_force(spark, tmp_path, partitions):
    rows = odd_turns(4)
    where = table(spark, tmp_path, "conversations", [(*r, "x", 1) for r in rows], TURNS + ", conv string, part int")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r[0]: tuple(r)[1:] for r in queries.op13_structure_repair(spark, where).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_repair(rows)


def test_sql_of_repair():
    rows = odd_turns(9)
    got = duck("conversations", "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", rows, "op13_structure_repair")
    assert {r[0]: r[1:] for r in got} == brute_repair(rows)


def test_repair_in_blocks(spark, monkeypatch):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t}." * 20) for t in range(50)]
    text = "\n".join(f"{r}:{x}" for _, _, r, x in rows)
    monkeypatch.setattr(structure, "BLOCK", 500)  # seen by the driver's functions only
    pieces = list(structure._result("c1", 1, 0, [r[1:] for r in rows], [False] * 50, 0))
    assert len(pieces) > 5 and "".join(p[-1] for p in pieces) == text and not any(p[4] for p in pieces)
    df = spark.createDataFrame([(p[0], p[2], p[3], p[-1]) for p in reversed(pieces)], "conv string, part int, block int, text string")
    assert structure.digests(df, "conv", ["part", "block"], "text").collect()[0]["sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --------------------------------------------------------------------- trie
def sql_trie(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.sql(queries.OP11_SQL).fetchall(), key=repr)


@pytest.mark.parametrize("partitions", [1, 9])
def test_trie_equals_sql(spark, tmp_path, partitions):
    rows = [r for r in odd_turns(8) if r[0] is None or r[0] >= 0]
    rows += [(c, t, "user", f"hello {t}") for c in range(300, 330) for t in range(c % 7)]  # shared paths that end at many depths
    where = table(spark, tmp_path, "conversations", [(*r, 1, "x") for r in rows], TURNS + ", high long, node string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted((tuple(r) for r in queries.op11_prefix_trie(spark, where).collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sql_trie(rows)


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).collect() == []


def test_contraction_of_chains_and_stars(spark):
    """A chain whose every node belongs to another conversation (spliced by the coin),
    with a star at its end, against a walk over the tree."""
    rnd = random.Random(1)
    parents = {0: None} | {k: k - 1 for k in range(1, 60)} | {k: 59 for k in range(60, 100)} | {k: rnd.randint(0, 30) for k in range(100, 120)}
    kids = Counter(p for p in parents.values() if p is not None)
    rows = [(k, 0, p, None if p is None else 0, (k * 37) % 1000, k, kids[k], int(kids[k] == 0), k) for k, p in parents.items()]
    nodes = spark.createDataFrame(rows, "high long, low long, up_high long, up_low long, conv_id long, depth long, kids long, leaves long, saved long")
    got = {r["high"]: (r["leaves"], r["saved"]) for r in trie.subtree_totals(nodes).collect()}
    want = {k: [int(kids[k] == 0), k] for k in parents}
    for k in sorted(parents, reverse=True):
        if parents[k] is not None:
            want[parents[k]] = [a + b for a, b in zip(want[parents[k]], want[k])]
    assert got == {k: tuple(v) for k, v in want.items()}


# ----------------------------------------------------------------- labelled
def test_sample_is_of_labelled_documents(spark):
    from quarry.llm.labelled import labelled_sample
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)], "doc_id long, quality int")
    got = labelled_sample(docs, labels, "quality", 40).collect()
    assert len(got) == 40 and all(r["doc_id"] < 50 and r["label"] == r["doc_id"] % 2 for r in got)


# ------------------------------------------------------------------- mixing
def test_rows_without_or_with_repeated_ids_draw_by_their_texts(spark, tmp_path):
    from quarry.llm import mixing
    rows = [(None if i % 2 else i % 5, f"word{i} " * 10, "abc"[i % 3]) for i in range(3000)]
    where = table(spark, tmp_path, "documents", rows, "doc_id long, text string, source string")
    got = queries.op5_source_mixing(spark, where).toPandas()
    assert set(got["source_size"]) == {10_000}
    for target, own in got.groupby("target"):  # three sources, three targets
        assert len(own) == 1000 and abs(own["taken"].sum() - target) < 600
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{where}/documents.parquet/*.parquet'")
    want = con.sql(queries.ORACLE_SQL["op5_source_mixing"]).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in queries.op5_source_mixing(spark, where).collect())
    df = spark.read.parquet(f"{where}/documents.parquet")
    assert sorted(map(str, mixing.mix(df).collect())) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
