"""Quality rules, additive classifier, personal data and fingerprints against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import components, lines, pii, quality_gam, quality_rules, runs, simhash
from quarry.llm.components import connected_components
from quarry.llm.textbuf import TextSlice, base_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, "one", "a b\nc d\na b\n\n\nc d", "x " * 50, "é ü z # $\tend", "| a | b |\r\n| a | b |", "\n\n", "w" * 5000,
         " ".join(f"w{i % 11}" for i in range(3000)), "𝔘nicode 😀 # <&>"]


def brute_counts(t):
    t = t or ""
    words, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(inside)


def test_base_counts():
    made = base_counts(TextSlice(pa.array(TEXTS)))
    got = list(zip(*(made[c].tolist() for c in quality_rules.COUNTS)))
    assert got == [brute_counts(t) for t in TEXTS]


def frame(spark, tmp_path, rows, schema, name="t"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def corpus(n=160):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("lo", "ra", "mi", "tu", "ves") for b in ("na", "ter", "so", "pil")]
    good = [" ".join(rng.choice(words) for _ in range(rng.randint(25, 60))) + "." for _ in range(n)]
    bad = [" ".join(rng.choice(words).upper() + "!!" for _ in range(rng.randint(25, 60))) for _ in range(n // 4)]
    return [(i, t) for i, t in enumerate(good + bad)], [(i, int(i < n), 0) for i in range(n + n // 4)]


def test_quality_rules(spark, tmp_path):
    docs, labels = corpus()
    extra = [(None, None), (900, ""), (900, ""), (901, "x " * 100)]
    d = frame(spark, tmp_path, [(i, t, "q") for i, t in docs + extra], "doc_id long, text string, kept string")
    lab = frame(spark, tmp_path, [*labels, (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int", "l")
    rows = quality_rules.judge(d, quality_rules.fit(d, lab, steps=60)).collect()
    assert len(rows) == len(docs) + 4
    for r in rows:
        assert r["in_kept"] == "q"
        if r["doc_id"] is not None and r["doc_id"] < 900:
            assert r["kept"] == (r["doc_id"] < 160) and not r["base_failed"]
        else:
            assert r["base_failed"] and not r["kept"]
    empty = quality_rules.judge(d.limit(0), quality_rules.fit(d.limit(0), lab.limit(0)))
    assert empty.count() == 0


def test_additive_classifier(spark, tmp_path):
    docs, labels = corpus()
    d = frame(spark, tmp_path, [*docs, (None, None), (901, "")], "doc_id long, text string")
    lab = frame(spark, tmp_path, labels, "doc_id long, quality int, toxic int", "l")
    model = quality_gam.fit(d, lab, learn_from=lambda c: ~quality_gam.held_out(c))
    rows = quality_gam.score(d, model).withColumn("held", quality_gam.held_out()).collect()
    held = [r for r in rows if r["held"] and r["doc_id"] < 200]
    assert held and all(r["predicted"] == (r["doc_id"] < 160) for r in held)
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == len(docs) + 2
    assert quality_gam.score(d.limit(0), quality_gam.fit(d.limit(0), lab)).count() == 0


def test_additive_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (2000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality_gam.train(x, y, rounds=20, n_pairs=1, pair_rounds=80)
    assert model.pairs == [(0, 1)]
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9


def brute_spans(t):
    t, out = t or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_rule_spans():
    rng = random.Random(1)
    for _ in range(5000):
        t = "".join(rng.choice("019 .-+()@aZ%_\t") for _ in range(rng.randint(0, 60)))
        assert pii.rule_spans(t) == brute_spans(t), t


def test_best_spans_are_best():
    """The dynamic programme against all segmentations."""
    w = np.random.default_rng(2).normal(size=(len(pii.KINDS), len(pii._FEATURES)))
    for text in ("a 1.2.3.4 55 b", "call +1 (555) 12-3 x@y.z 9", "1 2 3 4 5"):
        lat = pii.lattice(text, [m.span() for m in WORD.finditer(text)])
        s = pii._scores(lat, w).max(axis=1)

        def best(i):
            if i == lat.n:
                return 0.0
            return max([best(i + 1), *(s[k] + best(b) for k, (a, b) in enumerate(lat.bounds) if a == i)])

        number = {(a, e): k for k, (a, e) in enumerate(lat.spans)}
        got = sum(pii._scores(lat, w)[number[a, e]].max() for _, a, e in pii.best_spans(lat, w))
        assert abs(got - best(0)) < 1e-9


def test_gradient_of_the_field():
    rng = np.random.default_rng(4)
    w = rng.normal(size=(len(pii.KINDS), len(pii._FEATURES))) * 0.3
    text = "x 10.0.0.1 7 y"
    lat = pii.lattice(text, [m.span() for m in WORD.finditer(text)])
    gold = [(1, lat.spans.index((2, 10)))]

    def loss(v):
        s, total = pii._scores(lat, v), [0.0] + [0.0] * lat.n
        for j in range(1, lat.n + 1):
            total[j] = np.logaddexp.reduce([total[j - 1], *(total[lat.bounds[k][0]] + np.logaddexp.reduce(s[k]) for k in range(len(s)) if lat.bounds[k][1] == j)])
        return total[lat.n] - sum(s[k, kind] for kind, k in gold)

    g = pii._gradient(lat, gold, w)
    for kind, f in ((1, 0), (1, pii._AT_FEATURE["four octets"]), (3, 0), (2, pii._AT_FEATURE["digits 4-7"])):
        step = np.zeros_like(w)
        step[kind, f] = 1e-5
        assert abs((loss(w + step) - loss(w - step)) / 2e-5 - g[kind, f]) < 1e-5


def test_personal_data(spark, tmp_path):
    texts = [None, "", "mail a.b@c.example.org or 192.0.2.7, card 4111 1111 1111 1111, call +1 (555) 555-0100.", "nothing at all",
             "ask (555) 555-0199 now", "on 2024-01-15 at 10:30", "1" * 20000, "host 10[.]0[.]0[.]1 there"] * 2
    d = frame(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string")
    weights = pii.fit(d)
    rows = {r["doc_id"]: r for r in pii.detect(d, weights).collect()}
    for i, t in enumerate(texts):
        assert rows[i]["rule_spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(t))
    assert rows[4]["spans"] == "phone:4:18" and rows[7]["spans"] == "ip:5:19"
    assert rows[5]["spans"] == rows[3]["spans"] == rows[0]["spans"] == rows[1]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.mask(d, weights).collect()}
    assert masked[0] is None and masked[2] == "mail <email> or <ip>, card <card>, call <phone>."
    assert pii.detect(d.limit(0), pii.fit(d.limit(0))).count() == 0


def brute_components(values, linked):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(values), 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprint():
    import xxhash
    for t in ("A b  c D\te", "one two", "x", "", "Ä Ö a B c", "r " * 1000):
        words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(t)]
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        expected = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint_text(t) == expected


def test_anchors_of_neighbours_meet():
    half = np.random.default_rng(1).integers(0, 1 << 31, 40, dtype=np.uint64)
    at, word = simhash.anchors(half)
    for k in range(40):
        own = set(word[at == k].tolist())
        assert all(bin(int(half[k]) ^ a).count("1") <= 2 for a in own)
        for bit in range(31):
            _, other = simhash.anchors(half[k : k + 1] ^ np.uint64(1 << bit))
            assert own & set(other.tolist())


@pytest.mark.parametrize("limit", [4, 64])
def test_simhash_links(spark, monkeypatch, limit):
    rng = np.random.default_rng(limit)
    far = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [far[0]]
    for _ in range(120):
        v = int(far[0])
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            v ^= 1 << int(b)
        near.append(np.uint64(v))
    f = np.unique(np.concatenate([far, far[:9] ^ np.uint64(5 << 30), np.array(near)])).view(np.int64)
    monkeypatch.setattr(simhash, "ANCHOR_LIMIT", limit)
    links = simhash.links(spark.createDataFrame([(int(x),) for x in f], "fingerprint long"))
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    expected = brute_components([int(x) for x in f], lambda a, b: bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 2)
    assert {v: got.get(v, v) for v in expected} == expected


def test_simhash_documents(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long, "a"), (3, long.upper(), "b"), (3, long.upper(), "b"), (9, long + " tail", "c"), (4, "", "d"), (2, None, "e"),
            (None, "only me here today", "f"), (8, "quite another text of some words", "g")]
    d = frame(spark, tmp_path, rows, "doc_id long, text string, _place string")
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(d).collect())
    assert got == [(-1, None), (2, 2), (3, 3), (3, 3), (4, 2), (5, 3), (8, 8), (9, got[-1][1])]
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    ids = sorted(r["doc_id"] or -1 for r in kept.collect())
    assert ids[:4] == [-1, 2, 3, 8]
    assert simhash.near_duplicates(d.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_at_crowded_anchors(spark, monkeypatch, bits):
    monkeypatch.setattr(simhash, "ANCHOR_LIMIT", 2)
    rng = random.Random(bits)
    values = {0, 1 << 5}
    while len(values) < 60:
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(40)) ^ rng.choice([0, 1 << rng.randrange(40)]))
    d = spark.createDataFrame([(v,) for v in sorted(values)], "fingerprint long")
    root = brute_components(values, lambda a, b: bin(a ^ b).count("1") <= bits)
    got = {r["node"]: r["root"] for r in components.connected_components(simhash.links(d, bits)).collect()}
    assert {v: got.get(v, v) for v in values} == root


def test_key_runs_in_any_batches():
    rng = np.random.default_rng(0)
    key = np.sort(rng.integers(0, 40, 500))
    key[200:320] = key[200]
    key.sort()
    f = rng.integers(0, 8, 500)
    for size in (1, 7, 100, 500):
        batches = [pa.RecordBatch.from_pydict({"k": key[a : a + size], "f": f[a : a + size]}) for a in range(0, 500, size)]
        whole, spilled = [], []
        for (k, v), over in runs.key_runs(iter(batches), ["k", "f"], 20):
            (spilled if over else whole).append((k, v))
        merged = np.concatenate([k for k, _ in whole + spilled])
        assert sorted(merged.tolist()) == key.tolist()
        counts = Counter(key.tolist())
        assert all(counts[k] > 20 for ks, _ in spilled for k in ks.tolist())
        parts = [set(k.tolist()) for k, _ in whole]
        assert sum(map(len, parts)) == len(set().union(*parts)) if parts else True


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(row[j] + (x != y), row[j + 1] + 1, now[j] + 1))
        row = now
    return row[-1]


@pytest.mark.parametrize("limit", [3, 1024])
def test_fuzzy_lines(spark, tmp_path, monkeypatch, limit):
    rng = random.Random(limit)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("ar", "el", "ino", "u")]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 40))) for _ in range(12)]
    docs = []
    for i in range(40):
        own = []
        for _ in range(rng.randint(0, 5)):
            words = rng.choice(base).split()
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            own.append((" ".join(words)).upper() if rng.random() < 0.2 else " ".join(words) + ".")
        docs.append((i, "\n".join(own)))
    docs += [(50, docs[1][1]), (50, docs[1][1]), (None, docs[2][1]), (60, None), (61, ""), (62, "\n\nshort one\n")]
    d = frame(spark, tmp_path, [(i, t, "z") for i, t in docs], "doc_id long, text string, _place string").coalesce(1)
    monkeypatch.setattr(lines, "BUCKET_LIMIT", limit)
    order = [(r["doc_id"], r["text"]) for r in d.collect()]
    seen = [(i is None, i or 0, k, p, n) for p, (i, t) in enumerate(order) for k, n, _ in lines.normal_lines(t or "")]
    distinct = sorted({x[-1] for x in seen})
    prints = dict(zip(distinct, lines.fingerprints(distinct, np.array([len(x.split()) for x in distinct])).tolist()))

    def linked(a, b):
        x, y = a.decode(), b.decode()
        return bin(prints[a] ^ prints[b]).count("1") <= 3 and 1 - levenshtein(x, y) / max(len(x), len(y)) >= 0.8 - 1e-9

    root = brute_components(distinct, linked)
    keep = {}
    for x in seen:
        keep[root[x[-1]]] = min(keep.get(root[x[-1]], x), x)
    gone = {(x[3], x[2]) for x in seen if keep[root[x[-1]]] != x}
    expected = [(i, t if t is None else "\n".join(s for k, s in enumerate(t.split("\n")) if (p, k) not in gone)) for p, (i, t) in enumerate(order)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    got = [(r["doc_id"], r["text"]) for r in lines.dedup_lines(d).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert lines.dedup_lines(d.select("doc_id", "text").limit(0)).count() == 0


@pytest.mark.parametrize(("words", "limit"), [(5, 1024), (10, 8), (20, 1024), (30, 1024)])
def test_lines_by_similarity_alone(spark, tmp_path, monkeypatch, words, limit):
    """Recall against edit similarity alone, by line length: lines with one word replaced, added or taken away."""
    rng = random.Random(words)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvwz") for _ in range(rng.randint(2, 8)))
    texts = []
    for _ in range(12):
        line = [word() for _ in range(words)]
        texts.append(" ".join(line))
        for _ in range(3):
            other, at = list(line), rng.randrange(words)
            other[at : at + rng.randint(0, 1)] = [word()]
            texts.append(" ".join(other))
    common = [f"{word()} {' '.join(texts[0].split()[:4])} {' '.join(word() for _ in range(words))}" for _ in range(9)]
    texts = list(dict.fromkeys(texts + common))
    monkeypatch.setattr(lines, "BUCKET_LIMIT", limit)
    d = frame(spark, tmp_path, [(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, z int")
    near = lambda a, b: 1 - levenshtein(a, b) / max(len(a), len(b)) >= 0.8 - 1e-9
    root = brute_components(texts, near)
    gone = {t for t in texts if any(root[t] == root[u] for u in texts[: texts.index(t)])}
    got = {texts[r["doc_id"]] for r in lines.dedup_lines(d, bits=None).collect() if not r["text"]}
    assert got <= gone and len(got) >= 0.98 * len(gone) and len(gone) >= 10


def test_short_lines_and_lines_without_blanks(spark, tmp_path):
    one, url = "东京都的天气今天很好我们一起去公园散步吧然后再去喝一杯热咖啡好吗", "https://example.org/a-rather-long-path/with/many-parts"
    texts = ["Read more", f"read more!\n\n{one}\n{url}", f"read mode\n{one[:-2]}了吗\n{url.replace('/', '_')}", "- - -\n- - -\nok", f"OK\n{one}"]
    d = frame(spark, tmp_path, [(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, z int")
    got = [r["text"] for r in lines.dedup_lines(d, bits=None).orderBy("doc_id").collect()]
    assert got == ["Read more", f"\n{one}\n{url}", "read mode", "- - -\n- - -\nok", ""]


def test_grams_of_any_lines():
    many = [b"a", b"xyzxyzxyz" * 400, b"", bytes(range(97, 123)) * 3, b"the same words in a line"]
    h, line = lines.grams(many, 8)
    for i, x in enumerate(many):
        alone, _ = lines.grams([x], 8)
        assert sorted(h[line == i].tolist()) == alone.tolist()
        assert len(alone) == min(lines.GRAMS, len({x[k : k + 8] for k in range(max(len(x) - 7, 1))}) if x else 0)


def test_line_fingerprints_of_long_lines():
    many = " ".join(f"w{i % 997}" for i in range(2000)).encode()
    one = lines.fingerprints([many], np.array([2000]))
    two = lines.fingerprints([b"a b c d e", many, b"f g h i j"], np.array([5, 2000, 5]))
    assert one[0] == two[1]


@pytest.mark.parametrize("limit", [60, 500_000])
def test_components_of_a_chain(spark, monkeypatch, limit):
    monkeypatch.setattr(components, "EDGES_PER_TASK", limit)
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}
    assert connected_components(edges.limit(0)).count() == 0


