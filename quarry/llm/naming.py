"""Columns by place, so that no name of the input can clash with a working column."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_place(df: DataFrame, *names: str) -> tuple[DataFrame, list[str | None]]:
    """`df` with its columns named c0, c1, ..., and the new names of `names`
    (None for one that `df` lacks)."""
    new = {c: f"c{i}" for i, c in reversed(list(enumerate(df.columns)))}
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))), [new.get(n) for n in names]
