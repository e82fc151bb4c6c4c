"""A bounded sample of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int,
                    learn_from=None) -> DataFrame:
    """Text and label of at most `max_rows` labelled documents.

    The rows with the smallest hash of doc_id are taken, so the sample does
    not depend on order or partitioning.  Labels per doc_id are averaged
    (a tie counts as 1), nulls are left out, and a doc_id that occurs with
    several texts contributes its smallest text.  The sample of ids is at
    most `max_rows` narrow rows, which is the proven bound for broadcasting
    it; only the texts it selects are shuffled.

    `learn_from` is an optional condition on doc_id.
    """
    one = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y"))
    one = one.where("_id is not null and _y is not null")
    if learn_from is not None:
        one = one.where(learn_from(F.col("_id")))
    one = one.groupBy("_id").agg((F.avg("_y") >= 0.5).cast("int").alias("label"))
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    # labels of other documents take no place in the sample
    one = one.join(texts.select("_id").distinct(), "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    return (texts.join(F.broadcast(one), "_id").groupBy("_id", "label").agg(F.min("text").alias("text"))
            .select(F.col("_id").alias("doc_id"), "text", "label"))
