"""Key uniqueness, check constraints and distinct rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count. Counted map-side before the shuffle."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where("row_count > 1")


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows, distinct keys, repeated keys, and whether the key is unique."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    report = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("repeated_keys"),
    )
    return report.withColumn("is_unique", F.col("repeated_keys") == 0)


def check_constraints(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows checked and failed per rule, all rules in one pass. A null result is a failure."""
    names = list(rules)
    totals = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *(F.count_if(~F.expr(rules[n]).eqNullSafe(True)).alias(f"f{i}") for i, n in enumerate(names)),
    )
    lines = F.array(*(
        F.struct(
            F.lit(n).alias("constraint_name"),
            F.lit(rules[n]).alias("predicate"),
            F.col("checked").alias("checked_rows"),
            F.col(f"f{i}").alias("failed_rows"),
        )
        for i, n in enumerate(names)
    ))
    return totals.select(F.inline(lines))


def split_constraints(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(passing rows, failing rows with the names of the rules they break in ``_failed``)."""
    broken = F.array_compact(F.array(*(
        F.when(~F.expr(rule).eqNullSafe(True), F.lit(name)) for name, rule in rules.items()
    )))
    marked = df.withColumn("_failed", broken)
    return marked.where(F.size("_failed") == 0).drop("_failed"), marked.where(F.size("_failed") > 0)


def distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()
