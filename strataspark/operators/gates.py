"""Quality gates: named checks over aggregates; a missing or unknown value blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_checks(metrics: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, passed) for a one-row table of metrics; null counts as failed."""
    rows = F.array(*[F.struct(F.lit(k).alias("check_name"), F.coalesce(v, F.lit(False)).alias("passed")) for k, v in checks.items()])
    return metrics.select(F.explode(rows).alias("c")).select("c.check_name", "c.passed")


def status(value: Column, passing: list[str], conditional: list[str]) -> Column:
    return F.when(value.isin(passing), "pass").when(value.isin(conditional), "conditional").otherwise("block")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def text_findings(df: DataFrame, key: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """(key, finding) for each pattern that a text holds; no shuffle."""
    hits = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), k) for k, p in patterns.items()]))
    return df.select(key, F.explode(hits).alias("finding"))
