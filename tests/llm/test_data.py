"""Mixing, encoding, archives, chat, neighbours and the pipeline."""

import base64
import hashlib
import heapq
import itertools
import random

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from pyspark.sql import functions as F
from quarry.llm import ann, bpe, chat, mixing, queries, warc
from tests.conftest import SF

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, tmp_path, rows, schema, name="t"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def brute_targets(sizes, weights=(5, 2, 1)):
    """Share by weight, cut at twice the size, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, total, out = set(names), 1.5 * sum(sizes.values()), {}
    while left:
        budget = total - sum(out.values())
        share = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            return out | share
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= set(over)
    return out


def test_mixing(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice(["b", "a", "ü", None, "c", "z", "aa"]), "w " * rng.randint(0, 40), 1) for i in range(400)]
    rows += [(None, "a", "x y", 2), (None, "a", "x y", 2), (7, None, None, 3), (8, "empty", "", 4)]
    d = frame(spark, tmp_path, rows, "doc_id long, source string, text string, mix_copies int")
    sizes = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    sized = d.select("source", mixing.n_words().alias("size"))
    table = mixing.rates(sized)
    got = {r["source"]: r for r in table.collect()}
    for s, t in brute_targets(sizes).items():
        assert abs(got[s]["target"] - t) < 1e-6 and got[s]["source_size"] == sizes[s]
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns
    out = mixed.collect()
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(d.repartition(3)).collect()))
    times = {}
    for r in out:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times[k] for k in times if k not in (None, 7, 8)) <= 2
    assert mixing.mix(d.limit(0)).count() == 0


def test_mixing_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    expected = sorted(con.sql(queries.ORACLE_SQL["op5_source_mixing"]).fetchall())
    got = sorted(tuple(r) for r in queries.op5_source_mixing(spark, SF).collect())
    assert got == expected


def test_draws_are_uniform(spark):
    mean, least, most = spark.range(20000).select(mixing.draw(F.col("id").cast("string")).alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(mean - 0.5) < 0.02 and 0 <= least and most < 1


ODD = ["it's <|endoftext|>b<|startoftext|> we'LL", "", None, " \u0085\x1c x", "\x00 ﻿ 12345 ¼½ 中文字 😀👍🏽", "'s 't", "  \n\t ",
       "<|ENDOFTEXT|>", "a" * 3000, "ΑΣ ΑΣΑ é İI", "same words same words"] * 2


def test_bpe(spark, tmp_path, monkeypatch):
    t = Tokenizer.from_file(TOKENIZER)
    d = frame(spark, tmp_path, [(i if i else None, x, "k", 1) for i, x in enumerate(ODD)], "doc_id long, text string, block string, ids int")
    for size in (40, 1 << 24):
        monkeypatch.setattr(bpe, "BLOCK_BYTES", size)
        out = bpe.decode(bpe.encode(d, TOKENIZER), bpe.pieces(spark, TOKENIZER)).collect()
        assert len(out) == len(ODD)
        for r in out:
            e = t.encode(ODD[r["doc_id"] or 0] or "", add_special_tokens=False)
            assert list(r["ids"]) == e.ids and r["in_block"] == "k" and r["in_ids"] == 1
            assert r["decoded"] == t.decode(e.ids, skip_special_tokens=False)
    assert bpe.encode(d.limit(0), TOKENIZER).count() == 0


def test_decode_leaves_unknown_ids_out(spark):
    d = spark.createDataFrame([(1, [320, 10 ** 6, 320]), (2, []), (3, None)], "n int, ids array<int>")
    got = {r["n"]: r["decoded"] for r in bpe.decode(d, bpe.pieces(spark, TOKENIZER)).collect()}
    piece = Tokenizer.from_file(TOKENIZER).id_to_token(320)
    assert got[1] == f"{piece} {piece}" and got[2] == "" and not got[3]


def test_loser_tree():
    rng = random.Random(1)
    for n in range(9):
        own = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 9))) for _ in range(n)]
        assert [own[r][k] for r, k in warc.LoserTree(own)] == sorted(sum(own, []))


def test_archives(spark, tmp_path):
    rows = [(1, "http://a.example/x", "same"), (5, "http://a.example/x", "same"), (3, "https://www.b.example:443/?q=1#f", "same"),
            (2, None, ""), (4, "http://c d\r\nX: y", None), (6, "http://a.example/x", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\né"),
            (None, "http://n.example/", "alone"), (7, "http://big.example/", "z" * 200000), (8, "http://r.example/", "twice"), (8, "http://r.example/", "twice")]
    pages = frame(spark, tmp_path, rows, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "archives")
    warc.write(pages, path)
    index = warc.merge(warc.read(spark, path)).collect()
    assert len(index) == len(rows)
    order = [(r["url_key"].encode(), r["captured"], (r["page_id"] is not None, r["page_id"] or 0)) for r in index]
    assert order == sorted(order)
    lead = {}
    for i, _, h in rows:
        lead[h or ""] = max(lead.get(h or "", -1), -1 if i is None else i)
    for r in index:
        html = next((h or "") for i, _, h in rows if i == r["page_id"])
        data = html.encode()
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = r["page_id"] is None or lead[html] == r["page_id"]
        assert r["record_type"] == ("response" if first else "revisit")
        assert r["refers_to"] == (None if first else lead[html])
    none = str(tmp_path / "none")
    warc.write(pages.limit(0), none)
    assert warc.merge(warc.read(spark, none)).count() == 0


def test_url_keys():
    assert warc.url_key("https://www.Mail.Example.org:443/a?b=1#c") == "org,example,mail)/a?b=1"
    assert warc.url_key("http://x.example:8080") == "example,x):8080)/".replace("):", ":", 1)
    assert warc.url_key("") == "" and warc.url_key("http://[bad/") == "http://[bad/"


def cheapest(roles):
    """Shortest path over (position, state)."""
    heap, done = [(0, 0, chat.START)], set()
    while heap:
        c, i, s = heapq.heappop(heap)
        if i == len(roles) and s == chat.FINAL:
            return c
        if (i, s) in done:
            continue
        done.add((i, s))
        for n in chat.NEXT[s]:
            heapq.heappush(heap, (c + chat.INSERT, i, n))
            if i < len(roles):
                heapq.heappush(heap, (c + chat._relabel(roles[i], n), i + 1, n))
        if s and i < len(roles):
            heapq.heappush(heap, (c + chat.MERGE + chat._relabel(roles[i], s), i + 1, s))


def test_repair_is_cheapest():
    for n in range(1, 6):
        for roles in itertools.product(range(4), repeat=n):
            path = chat.best_path(list(roles))
            assert sum(m[2] for m in path) + chat.end_cost(path[-1][1]) == cheapest(roles)
            cuts = [roles[: n // 3], roles[n // 3 : n // 2], roles[n // 2 :]]
            states = chat.cut_states([chat.piece_matrix(c) for c in cuts])
            parts = [m for c, s in zip(cuts, states) for m in chat.best_path(list(c), *s)]
            assert sum(m[2] for m in parts) + chat.end_cost(states[-1][1]) == cheapest(roles)
            assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_chat(spark, tmp_path):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "Human", "tool", None, " GPT "]), rng.choice(["hi", "", None, "a <|im_end|> b"]), 0)
            for c in range(30) for t in range(rng.randint(1, 7))]
    rows += [(99, t, rng.choice(["user", "assistant"]), f"t{t}", 0) for t in range(600)]
    rows += [(None, 1, "user", "x", 0), (98, None, "user", "x", 0), (98, None, "user", "x", 0), (98, 1, "user", "y", 0)]
    d = frame(spark, tmp_path, rows, "conv_id long, turn int, role string, text string, part int").repartition(4)
    out = chat.repair(d).collect()
    assert len(out) == len(rows)
    cost, whole = {}, {}
    for r in out:
        cost[r["conv_id"]] = cost.get(r["conv_id"], 0) + r["cost"]
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["rendered"]
    for c in cost:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        assert cost[c] == cheapest([chat.role_of(r[2]) for r in own])
        messages = whole[c].split("<|im_end|>\n")
        assert messages.pop() == ""
        names = [m.removeprefix("<|im_start|>").partition("\n")[0] for m in messages]
        state = chat.START
        for name in names:
            assert chat.role_of(name) in chat.NEXT[state]
            state = chat.role_of(name)
        assert state == chat.FINAL
    assert "".join(f"t{t}" for t in range(600)) == "".join(x for x in whole[99].replace("<|im_end|>", "").replace("<|im_start|>", "").replace("user\n", "").replace("assistant\n", "").split())
    assert chat.repair(d.limit(0)).count() == 0


def test_nearest(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(500 + i, x[7].tolist(), 0) for i in range(60)] + [(3, x[3].tolist(), 0), (700, None, 0), (750, [0.0] * 24, 0), (None, x[1].tolist(), 0),
             (800, [float("nan")] * 24, 0), (850, [None] * 24, 0), (900, [float("inf")] * 24, 0), (950, [1.0, 2.0], 0), (1000, [2.0, 1.0], 0), (1050, [], 0)]
    d = frame(spark, tmp_path, rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in ann.nearest(d, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    usable = {i: np.array(v, dtype=float) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    hits = total = 0
    for q in [i for i in usable if i % 50 == 0]:
        cos = {i: (usable[q] * v).sum() / np.sqrt((usable[q] ** 2).sum() * (v ** 2).sum()) for i, v in usable.items() if i != q and len(v) == len(usable[q])}
        best = sorted(cos, key=lambda i: (-cos[i], i))[:5]
        mine = got.get(q, [])
        assert all(abs(cos[i] - s) < 1e-12 for i, s in mine) and len(mine) == len(best)
        hits += len({i for i, _ in mine} & set(best))
        total += len(best)
    assert hits / total >= 0.9
    assert [i for i, _ in got[500]] == [7, 501, 502, 503, 504] and [i for i, _ in got[950]] == [1000]
    assert ann.nearest(d.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_of_few_vectors(spark, tmp_path):
    """All candidates come back where a length has fewer than five, or about as many."""
    rng = np.random.default_rng(5)
    rows = [(100 * d + i, rng.normal(size=d).tolist(), 0) for d, n in ((64, 6), (256, 4), (768, 9)) for i in range(n)]
    rows += [(100 * 256 + 50, rows[6][1], 0)]  # an equal vector
    d = frame(spark, tmp_path, rows, "vec_id long, embedding array<double>, score int")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    got = {}
    for r in ann.nearest(d, F.lit(True)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert [len(got[i]) for i, v, _ in rows] == [5 if len(v) != 256 else 4 for _, v, _ in rows]
    for q in (i for i in unit if len(unit[i]) < 768):
        assert got[q] == sorted((i for i in unit if i != q and len(unit[i]) == len(unit[q])),
                                key=lambda i: (-round(float(unit[q] @ unit[i]), 12), i))


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(ann.rotate(x, 3), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(ann.hadamard(ann.hadamard(x)), x)


def test_pipeline(spark):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = E.queries()["pipeline"](spark, SF).collect()
    t = Tokenizer.from_file(TOKENIZER)
    assert 0 < len(out) <= 2 * docs.count()
    ids = {r["doc_id"] for r in docs.collect()}
    for r in out:
        assert r["doc_id"] in ids and r["n_tokens"] == len(r["ids"])
        assert r["decoded"] == t.decode(list(r["ids"]), skip_special_tokens=False)


def test_stages_take_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.count() == 0 and (k == 4 or out.columns == docs.columns)
        docs = out


def test_every_operator_has_a_query():
    names = E.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names
