"""Counts by key, top groups and latest records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("c"))


def top_groups(rows: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` largest groups; equal counts are ordered by key, so the result is stable."""
    return count_by(rows, key).orderBy(F.desc("c"), F.asc(key)).limit(k)


def latest_for(rows: DataFrame, condition: str | Column, *order: str) -> DataFrame:
    """The latest row that satisfies ``condition``: at most one."""
    return rows.where(condition).orderBy(*[F.desc(name) for name in order]).limit(1)


def latest_by(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The latest row of every key. Each task keeps one row per key before the shuffle."""
    whole = F.struct(*[F.col(name) for name in rows.columns])
    newest = F.max_by(whole, F.struct(*order)).alias("row")
    return rows.groupBy(key).agg(newest).select("row.*")
