"""One query per operator, over whole tables, and the pipeline's query."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ann, bpe, chat, lines, mixing, pii, quality_gam, quality_rules, repeats, simhash, structure, trie, warc
from quarry.session import checkpoint_dir, cut_lineage, scratch_path, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    checkpoint_dir(spark)
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model, carry=["doc_id"])


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_gam.fit(docs, _table(spark, sf_dir, "labels"), learn_from=lambda c: ~quality_gam.held_out(c))
    return quality_gam.score(docs, model, carry=["doc_id"]).select(
        "doc_id", quality_gam.held_out().alias("held_out"), "score", "predicted")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(_table(spark, sf_dir, "documents"), path, carry=["doc_id"])
    text = bpe.decode(coded, bpe.pieces(spark, path))
    return text.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(bpe.ids_text(), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words().alias("size"), mixing.text_digest().alias("digest"))
    docs = cut_lineage(docs)  # narrow; texts are read once
    mixed = mixing.with_copies(docs, mixing.rates(docs.select("source", "size")), digest=F.col("digest"))
    return mixed.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                        (F.col("size") * F.col("mix_copies")).cast("long").alias("taken"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         sum(source_size) OVER () * 1.5::DOUBLE AS budget, source_size * 2.0::DOUBLE AS cap
  FROM s),
c AS (
  SELECT *, cap / weight <= (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
  FROM w),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap ELSE (budget - coalesce(sum(cap) FILTER (capped) OVER (), 0))
              / sum(weight) FILTER (NOT capped) OVER () * weight END AS target
  FROM c),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size END AS rate,
         CAST(('0x' || substr(md5('mix:' || d.k), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * coalesce(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 0) AS BIGINT) AS taken
FROM r
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write(pages, path)
    index = warc.merge(warc.read(spark, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(_table(spark, sf_dir, "conversations"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.fit(docs), carry=["doc_id"])
    return found.select("doc_id", *(pii.n_spans(k).alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2("rule_spans", 256).alias("base_sha256"), "spans")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = lines.dedup_lines(docs.withColumn("before", F.size(F.split("text", "\n", -1))), bits=None)
    return clean.select("doc_id", F.col("before").cast("long").alias("n_lines"),
                        F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("clean_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n, CAST(c AS VARCHAR) AS s FROM t GROUP BY c),
h AS (
  SELECT c, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(s) + 1),
           lambda i: [CAST(ord(substr(s, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)), CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM n),
m AS (SELECT h.c, h.h, least(h.h, coalesce(f.n, 0)) AS m FROM h LEFT JOIN n f ON f.c = h.c - h.c % 100),
b AS (
  SELECT m.c, t.pos AS d, r, x FROM m JOIN t ON t.c = m.c - m.c % 100 AND t.pos <= m.h
  UNION ALL SELECT m.c, m.m + t.pos - m.h, r, x FROM m JOIN t ON t.c = m.c AND t.pos > m.h),
p AS (
  SELECT c, d, length(x) AS chars, sha256(string_agg(length(r) || ':' || r || length(x) || ':' || x, '') OVER (
           PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS node
  FROM b
  UNION ALL SELECT c, 0, 0, 'root' FROM n),
v AS (SELECT node, min(c) AS c, min(d) AS d, count(*) AS n_convs, max(chars) AS chars FROM p GROUP BY node),
u AS (SELECT v.*, up.node AS up FROM v LEFT JOIN p up ON up.c = v.c AND up.d = v.d - 1),
k AS (SELECT up AS node, count(*) AS kids FROM u WHERE up IS NOT NULL GROUP BY up),
s AS (
  SELECT a.node, sum(CASE WHEN k.kids IS NULL THEN 1 ELSE 0 END) AS leaves, sum((v.n_convs - 1) * v.chars) AS saved
  FROM v LEFT JOIN k USING (node) JOIN p a ON a.c = v.c AND a.d <= v.d GROUP BY a.node),
e AS (
  SELECT p.node, string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) AS ids
  FROM p JOIN (SELECT c, max(d) AS d FROM p GROUP BY c) l ON l.c = p.c AND l.d = p.d GROUP BY p.node)
SELECT u.c AS conv_id, CAST(u.d AS BIGINT) AS depth, w.c AS parent_conv_id, u.n_convs, CAST(coalesce(k.kids, 0) AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM u LEFT JOIN v w ON w.node = u.up LEFT JOIN k ON k.node = u.node JOIN s ON s.node = u.node LEFT JOIN e ON e.node = u.node
"""


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.strip_repeats(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT *, length(h) // 2 AS n FROM d),
p AS (SELECT r, h, unnest(range(0, greatest(0, n - 199))) AS i FROM n),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM p),
m AS (SELECT r, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM m),
s AS (SELECT r, min(i) AS a, max(i) + 200 AS e FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM g) GROUP BY r, run),
t AS (SELECT r, sum(e - a) AS gone, count(*) AS spans FROM s GROUP BY r),
k AS (
  SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS lo, a AS hi FROM s
  UNION ALL SELECT r, max(e), max(n) FROM s JOIN n USING (r) GROUP BY r),
x AS (SELECT r, string_agg(substr(h, CAST(2 * lo + 1 AS INT), CAST(2 * (hi - lo) AS INT)), '' ORDER BY lo, hi) AS kept FROM k JOIN n USING (r) GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM n LEFT JOIN t USING (r) LEFT JOIN x USING (r)
"""


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    fixed = structure.repair(structure.damage(turns), order=["role0", "text0", "hash0"]).withColumnRenamed("conv_id", "own")
    every = turns.select("conv_id").distinct().join(fixed, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    return every.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _op13_sql() -> str:
    """Damage, faults and the cheapest edits by a table over the four states, row by row."""
    def add(state: str, cost: str, edit: str) -> str:  # a state is its cost in six digits and its audit
        return f"(lpad(CAST(CAST(substr({state}, 1, 6) AS INT) + {cost} AS VARCHAR), 6, '0') || substr({state}, 7) || '{edit}')"

    def step(after: str, initial: str, before: list[str]) -> str:
        from_here = [add(f"b.s{after}", "3", "D")]
        for x in before:
            from_here += [f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {add(x, 'cut', 'K')} END", f"CASE WHEN NOT must_go THEN {add(x, '2 + cut', 'R')} END"]
        return f"least({', '.join(from_here)})"

    white = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    inserted_user = f"least({add('b.s0', '2', 'I')}, {add('b.s1', '2', 'I')}, {add('b.s3', '2', 'I')})"
    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS k, turn, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name
  FROM conversations),
faulty AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(name) + 1),
           lambda i: [CAST(ord(substr(name, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)), CAST(4294967295 AS BIGINT)) % 20 AS fault
  FROM src),
damaged AS (
  SELECT k, turn, role0, text0, CASE WHEN fault = 4 THEN 'user' ELSE role0 END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text, c.copy
  FROM faulty JOIN range(0, 2) c(copy) ON c.copy = 0 OR fault = 3 WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn ASC NULLS FIRST, role0, text0, copy) AS pos, substr(role, 1, 1) AS initial, rtrim(text, {white}) AS bare
  FROM damaged),
seen AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY k, role, text ORDER BY pos) > 1 AS again,
         CASE WHEN pos > 1 AND concat(lag(initial) OVER (PARTITION BY k ORDER BY pos), initial) NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS bad
  FROM placed),
turns AS (
  SELECT *, blank OR again AS must_go, CASE WHEN NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut FROM seen),
sums AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
         sum(cut) AS truncated, sum(bad) AS illegal, max(pos) AS n FROM turns GROUP BY k),
best AS (
  SELECT k, CAST(0 AS BIGINT) AS pos, '000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3 FROM sums
  UNION ALL
  SELECT k, pos, {add("s0", "3", "D")}, least({add("s1", "3", "D")}, CASE WHEN NOT must_go AND initial = 's' THEN {add("s0", "cut", "K")} END),
         {step("2", "u", ["b.s0", "b.s1", "b.s3", "b.i3"])}, {step("3", "a", ["b.s2", "b.i2"])}
  FROM (SELECT b.k, t.pos, b.s0, b.s1, b.s2, b.s3, {inserted_user} AS i2, {add("b.s2", "2", "I")} AS i3, t.initial, t.must_go, t.cut
        FROM best b JOIN turns t ON t.k = b.k AND t.pos = b.pos + 1) b),
ends AS (
  SELECT b.k, least(s0, s3, {add("s2", "2", "I")}, {add("s1", "4", "II")}) AS e FROM best b JOIN sums ON sums.k = b.k AND b.pos = n),
edits AS (
  SELECT k, i, substr(e, CAST(6 + i AS INT), 1) AS edit, length(replace(substr(e, 7, CAST(i AS INT)), 'I', '')) AS pos FROM ends, range(1, length(e) - 5) t(i)),
said AS (
  SELECT d.k, i, edit, role, text, row_number() OVER (PARTITION BY d.k ORDER BY i) - (CASE WHEN first_value(edit = 'K' AND initial = 's') OVER (PARTITION BY d.k ORDER BY i) THEN 1 ELSE 0 END) AS place
  FROM edits d LEFT JOIN turns t ON t.k = d.k AND t.pos = d.pos WHERE edit <> 'D'),
texts AS (
  SELECT k, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS text
  FROM said GROUP BY k)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(substr(e, 1, 6) AS INT), 0) AS BIGINT) AS cost,
       coalesce(substr(e, 7), '') AS audit, sha256(coalesce(x.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM src) c LEFT JOIN sums USING (k) LEFT JOIN ends USING (k) LEFT JOIN texts x USING (k)
"""


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_quality_classifier, op3_bpe, op4_simhash_near_dedup, op5_source_mixing, op6_warc, op7_chat_format,
    op8_nearest_neighbours, op9_pii, op10_line_dedup, op11_prefix_trie, op12_repeated_passages,
    op13_structure_repair,
)}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op5_source_mixing": OP5_SQL, "op11_prefix_trie": OP11_SQL, "op12_repeated_passages": OP12_SQL, "op13_structure_repair": _op13_sql()}
