"""Mixing sources to target weights, in DataFrame operations only.

Tokens are summed per source; the sums and weights give every source a target
and a repetition rate (target over size); each document is then emitted
floor(rate) times, and once more if a hash of its id and text, read as a number in
[0, 1), is below the rate's fraction.  The draw depends on nothing but these and the
seed, so reruns and recomputed tasks agree.

Targets: the sources, in code point order with null last, take the weights in
turn and share `share` times all tokens in proportion to them, but none above
`cap` times its own size; what is cut off is shared again by weight among the
rest until none is above.  That end state is computed directly: with sources
in order of cap over weight, a source is capped exactly if its cap is at most
what it would get were all before it capped.

Edge cases: a null text has no words; a null source is a source of its own;
a source without words has target 0 and emits nothing; documents with a null or
repeated id draw by their texts, and only rows with the same id and text draw
alike; very long texts count whole; an empty table gives no rows.  ``mix`` works on columns by place, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.naming import by_place
from quarry.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix"
#: The table of rates is broadcast up to this measured number of sources.
BROADCAST_SOURCES = 100_000

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    """Words of a whole text."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def rates(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, target and rate of every source of (source, size)."""
    sums = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name)
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    t = sums.select("*", place.alias("place"), turn.alias("weight"),
                    (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"))
    t = t.withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("place").asc())
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("capped", F.col("limit") / F.col("weight") <= (F.col("budget") - before) / after)
    spent = F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("limit")).otherwise((F.col("budget") - spent) / open_weight * F.col("weight"))
    t = t.select("source", "source_size", target.alias("target"))
    return cut_lineage(t.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))))


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a hash of seed and key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def text_digest(text: str = "text") -> Column:
    """What a row's draw depends on beside its doc_id."""
    return F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def with_copies(docs: DataFrame, table: DataFrame, source: str = "source", doc_id: str = "doc_id",
                digest: Column | None = None, seed: str = SEED) -> DataFrame:
    """`docs` with mix_copies, mix_source_size and mix_target.

    A row's draw is a hash of its doc_id and `digest` (default: of the column
    text), so rows without an id, or with one that repeats, draw by their texts.

    The table of rates has one narrow row per source; it is broadcast if its
    measured row count is small, and joined by shuffle otherwise.
    """
    one = table.select(F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
                       F.col("target").alias("mix_target"), F.col("rate").alias("mix_rate"))
    if one.count() <= BROADCAST_SOURCES:
        one = F.broadcast(one)
    d = docs.join(one, docs[source].eqNullSafe(F.col("mix_source")), "left")
    key = F.concat_ws(":", F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")), text_digest() if digest is None else digest)
    whole = F.floor("mix_rate")
    extra = (draw(key, seed) < F.col("mix_rate") - whole).cast("int")
    return d.withColumn("mix_copies", F.coalesce(whole + extra, F.lit(0)).cast("int")).drop("mix_source", "mix_rate")


def emit(docs_with_copies: DataFrame) -> DataFrame:
    """Every document as often as its mix_copies says."""
    own = [c for c in docs_with_copies.columns if c not in ("mix_copies", "mix_source_size", "mix_target")]
    return (docs_with_copies.where("mix_copies > 0")
            .select(*(F.col(f"`{c}`") for c in own), F.explode(F.array_repeat(F.lit(0), F.col("mix_copies"))).alias("_copy"))
            .drop("_copy"))


def mix(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The mixed corpus: the rows of `docs`, repeated."""
    d, (source, doc_id, text) = by_place(docs, source, doc_id, text)
    sized = d.select(F.col(source).alias("source"), n_words(text).alias("size"))
    return emit(with_copies(d, rates(sized), source, doc_id, text_digest(text))).toDF(*docs.columns)
