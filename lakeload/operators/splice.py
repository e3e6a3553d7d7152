"""Type 2 history kept up by splicing late changes into stored versions.

The stored form of a history is its *spans*: a maximal sequence of changes of one key in one state, deletes being
a state too. A span has the place of its first and of its last change, so a late change can be judged from the
spans around it: it starts a span, prolongs one, or joins two. Only a change in another state strictly inside a
span cannot, because where the span goes on is not stored; keys with such a change are computed from the changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.operators.cdc import END, START
from lakeload.operators.skew import same_keys
from lakeload.sinks.scratch import scratch_dir

#: Places of a span's first and last change.
FIRST, LAST, DELETED = "_first", "_last", "_deleted"


class Splicer:
    """How changes of a table are ordered and compared; the options mean what they do in ``scd2``."""

    def __init__(
        self,
        keys: list[str],
        sequence_by: str | list[str],
        except_cols: tuple[str, ...] = (),
        tie_cols: tuple[str, ...] = (),
        delete_when: Column | str | None = None,
        track_cols: list[str] | None = None,
    ):
        self.keys, self.except_cols, self.tie_cols, self.track_cols = keys, except_cols, list(tie_cols), track_cols
        self.sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
        deleted = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
        self.deleted = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))

    def output(self, changes: DataFrame) -> list[str]:
        return [c for c in changes.columns if c not in self.except_cols]

    def _points(self, changes: DataFrame) -> DataFrame:
        """Changes with their place; rows without a sequence value are left out."""
        output = self.output(changes)
        others = [c for c in output if c not in self.keys and c not in self.sequence and c not in self.tie_cols]
        tie = F.xxhash64(*others) if others else F.lit(0).cast("long")
        there = changes.where(" and ".join(f"`{c}` is not null" for c in self.sequence))
        marked = there.withColumns({DELETED: self.deleted, "_tie": tie})
        place = F.struct(*dict.fromkeys([*self.sequence, *self.tie_cols, DELETED, "_tie"]))
        tracked = self.track_cols or [c for c in output if c not in self.keys and c not in self.sequence]
        state = F.struct(DELETED, F.when(~F.col(DELETED), F.struct(*tracked) if tracked else F.struct(F.lit(0))).alias("row"))
        payload = F.struct(*[c for c in output if c not in self.keys]) if len(output) > len(self.keys) else F.struct(F.lit(0).alias("_"))
        return marked.select(*self.keys, place.alias(FIRST), place.alias(LAST), state.alias("_state"), payload.alias("_row"))

    def _spans(self, points: DataFrame) -> DataFrame:
        """Spans of points, which may be spans themselves; one shuffle and one sort by key."""
        along = Window.partitionBy(*self.keys).orderBy(FIRST)
        until = along.rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*self.keys)
        marked = points.withColumns({
            "_before": F.lag("_state").over(along),
            # A point inside an earlier span does not end it earlier.
            "_reached": F.max(LAST).over(until),
            "_end": F.max(LAST).over(whole),
        })
        kept = marked.where(~F.col("_before").eqNullSafe(F.col("_state")))
        return kept.withColumn(LAST, F.coalesce(F.lead("_reached").over(along), F.col("_end"))).select(
            *self.keys, FIRST, LAST, "_state", "_row"
        )

    def splice(self, spans: DataFrame | None, changes: DataFrame, log: Callable[[], DataFrame]) -> DataFrame:
        """Spans of the keys that ``changes`` has, from their stored ``spans`` and the changes.

        ``log`` gives all changes so far; it is called, and read, only if a key needs it.
        """
        points = self._points(changes)
        if spans is None:
            return self._spans(points)
        own = points.select(*self.keys).distinct()
        touched = spans.alias("s").join(own.alias("k"), same_keys("s", "k", self.keys), "left_semi")
        along = Window.partitionBy(*self.keys).orderBy(FIRST, F.col("_new"))
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        stored = F.when(~F.col("_new"), F.struct(LAST, "_state"))
        both = touched.withColumn("_new", F.lit(False)).unionByName(points.withColumn("_new", F.lit(True)))
        both = both.withColumn("_around", F.last(stored, ignorenulls=True).over(before))
        inside = F.col("_new") & (F.col(FIRST) < F.col(f"_around.{LAST}")) & ~F.col("_state").eqNullSafe(F.col("_around._state"))
        path = scratch_dir(changes.sparkSession, "spliced")
        both.withColumn("_inside", F.coalesce(inside, F.lit(False))).drop("_around").write.parquet(path)
        both = changes.sparkSession.read.parquet(path)
        split = both.where("_inside").select(*self.keys).distinct()
        both = both.select(*self.keys, FIRST, LAST, "_state", "_row")
        if not split.isEmpty():
            same = same_keys("b", "k", self.keys)
            again = self._points(log()).alias("b").join(split.alias("k"), same, "left_semi")
            both = both.alias("b").join(split.alias("k"), same, "left_anti").unionByName(again)
        return self._spans(both)

    def versions(self, spans: DataFrame, output: list[str]) -> DataFrame:
        """The history that readers see: rows of ``scd2``."""
        along = Window.partitionBy(*self.keys).orderBy(FIRST)
        position = lambda c: F.col(f"{c}.{self.sequence[0]}") if len(self.sequence) == 1 else F.struct(*(
            F.col(f"{c}.{s}").alias(s) for s in self.sequence
        ))
        rows = spans.withColumn("_next", F.lead(FIRST).over(along)).where(f"not _state.{DELETED}")
        columns = [F.col(c) if c in self.keys else F.col(f"_row.`{c}`").alias(c) for c in output]
        end = F.when(F.col("_next").isNotNull(), position("_next"))
        return rows.select(*columns, position(FIRST).alias(START), end.alias(END))
