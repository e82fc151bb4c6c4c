"""Corpus preparation in stages.

Each stage takes what its predecessor kept, as written Parquet, and returns
a DataFrame; ``run`` applies them in order to the documents table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, lines, mixing, quality_rules, simhash
from quarry.session import checkpoint_dir, scratch_path, ship_package

#: File of the tokenizer that the last stage encodes with.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    checkpoint_dir(spark)
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are repeated elsewhere; n_chars follows the text."""
    ship_package(spark)
    clean = lines.dedup_lines(docs, bits=None)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return simhash.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mix(docs).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    ship_package(spark)
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER)
    return bpe.decode(coded, bpe.pieces(spark, TOKENIZER)).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("source mixing", source_mixing),
    ("BPE encoding", encoding),
]

#: The fitted model, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"stage{k}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
