"""The change feed between two states of a table, computed by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators.skew import same_keys

#: Names of a feed's own columns and of its kinds of change.
CHANGE, VERSION = "_change_type", "_commit_version"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def change_feed(
    before: DataFrame, after: DataFrame, keys: list[str], run: str, run_column: str | None = None
) -> DataFrame:
    """What made ``after`` of ``before``: inserts, both images of updates, and deletes, with the run that made them.

    That is what ``run_column`` of ``after`` says, which is not compared, or else ``run``. Keys are unique in each
    state and may be null. A column that only one state has is null in rows of the other, and a row that differs in
    nothing else is not an update. One shuffle of each state by its key.
    """
    columns = list(dict.fromkeys(c for c in [*before.columns, *after.columns] if c != run_column))
    sides = []
    for df in (before, after):
        whole = F.struct(*(F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in columns))
        made = F.col(run_column) if run_column and df is after else F.lit(run)
        sides.append(df.select(*keys, whole.alias("_row"), made.alias("_run")))
    old, new = sides[0].alias("o"), sides[1].alias("n")
    joined = old.join(new, same_keys("o", "n", keys), "full").where(~F.col("o._row").eqNullSafe(F.col("n._row")))
    image = lambda kind, row: F.struct(F.lit(kind).alias(CHANGE), F.col(row).alias("row"))
    images = (
        F.when(F.col("o._row").isNull(), F.array(image(INSERT, "n._row")))
        .when(F.col("n._row").isNull(), F.array(image(DELETE, "o._row")))
        .otherwise(F.array(image(BEFORE, "o._row"), image(AFTER, "n._row")))
    )
    rows = joined.select(F.explode(images).alias("c"), F.coalesce("n._run", F.lit(run)).alias(VERSION))
    return rows.select(*(F.col(f"c.row.`{c}`").alias(c) for c in columns), f"c.{CHANGE}", VERSION)
