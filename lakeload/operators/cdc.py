"""Current state and type 2 history from change rows that may be late and out of order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.operators.skew import SPLIT_ROWS, same_keys, split_hot_keys

START, END = "__START_AT", "__END_AT"


def _as_list(columns: str | list[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _sequenced(columns: list[str]) -> Column:
    return _all(F.col(c).isNotNull() for c in columns)


def unsequenced(df: DataFrame, sequence_by: str | list[str]) -> DataFrame:
    """Change rows without a sequence value: they cannot be ordered and belong in quarantine."""
    return df.where(~_sequenced(_as_list(sequence_by)))


def apply_cdc(
    df: DataFrame,
    keys: list[str],
    sequence_by: str | list[str],
    op_column: str | None = None,
    delete_ops: tuple[str, ...] = ("D",),
    except_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Current row per key (type 1): the last change wins, keys whose last change deletes go.

    The last row is an aggregate, so a hot key is reduced before the shuffle. Rows equal in the
    sequence are ordered by their other columns, whatever order they arrive in.
    """
    sequence = _as_list(sequence_by)
    rest = [c for c in df.columns if c not in keys and c not in sequence]
    last = (
        df.where(_sequenced(sequence))
        .groupBy(*keys)
        .agg(F.max(F.struct(*sequence, *rest)).alias("_last"))
        .select(*keys, "_last.*")
    )
    if op_column is not None:
        last = last.where(~F.coalesce(F.col(op_column).isin(*delete_ops), F.lit(False)))
    return last.select(*(c for c in df.columns if c not in except_cols))


def scd2(
    df: DataFrame,
    keys: list[str],
    sequence_by: str | list[str],
    except_cols: tuple[str, ...] = (),
    tie_cols: tuple[str, ...] = (),
    delete_when: Column | str | None = None,
    track_cols: list[str] | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Type 2 history: one row per version with ``__START_AT`` and ``__END_AT`` (null = open).

    Versions follow ``sequence_by``, not arrival. Consecutive rows equal in ``track_cols`` (by
    default all columns but keys, sequence and ``except_cols``) are one version. Rows where
    ``delete_when`` holds close the open version and emit none. Ties in the sequence are ordered
    by ``tie_cols``, then by a hash of the other columns and the columns themselves, so the result
    never depends on input order.
    Rows without a sequence value are left out; see ``unsequenced``.

    Normal keys cost one shuffle and one sort. A key above ``split_rows`` is cut into pieces along
    its order, versions are found within the pieces, and one small row per piece carries the
    state across the cuts.
    """
    sequence = _as_list(sequence_by)
    output = [c for c in df.columns if c not in except_cols]
    tracked = track_cols or [c for c in output if c not in keys and c not in sequence]
    others = [c for c in output if c not in keys and c not in sequence and c not in tie_cols]
    if delete_when is None:
        deleted = F.lit(False)
    else:
        deleted = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    deleted = F.coalesce(deleted, F.lit(False))

    # A short hash decides ties before whole rows do, so cut points need not hold whole rows.
    tie = F.xxhash64(*others) if others else F.lit(0).cast("long")
    rows = df.where(_sequenced(sequence)).withColumns({"_deleted": deleted, "_tie": tie})
    place = list(dict.fromkeys([*sequence, *tie_cols, "_deleted", "_tie"]))
    order = [*place, *others]
    rows = rows.select(*dict.fromkeys([*keys, *order, *tracked]))
    normal, hot = split_hot_keys(rows, keys, place, split_rows)
    versions = _versions(normal, keys, order, sequence, tracked).select(*output, START, END)
    if hot is not None:
        # Hot keys are taken piece by piece; each piece learns what comes before and after it.
        pieces = F.broadcast(_across_pieces(hot, keys, order, sequence, tracked))
        pieced = _versions(hot, [*keys, "_split"], order, sequence, tracked, pieces)
        versions = versions.unionByName(pieced.select(*output, START, END))
    return versions


def _with_previous(
    rows: DataFrame, group: list[str], order: list[str], tracked: list[str]
) -> tuple[DataFrame, Column, Column]:
    """Rows with the tracked columns of the row before, and conditions over them: is the row the
    first of its group, and does it repeat the state of the row before.

    Plain columns, not structs, go through the window, so the shuffle carries each value once.
    """
    along = Window.partitionBy(*group).orderBy(*order)
    compared = ["_deleted", *tracked]
    rows = rows.withColumns({f"_b{i}": F.lag(c).over(along) for i, c in enumerate(compared)})
    # The delete flag is never null, so its lag is null on the first row only.
    first = F.col("_b0").isNull()
    # A delete ends whatever was open, so deletes compare equal to each other.
    equal = F.col("_deleted") | _all(
        F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(tracked, start=1)
    )
    return rows, first, ~first & (F.col("_b0") == F.col("_deleted")) & equal


def _state(tracked: list[str]) -> Column:
    return F.struct("_deleted", F.when(~F.col("_deleted"), F.struct(*tracked)).alias("row"))


def _digest(state: Column) -> Column:
    """What pieces hand on instead of whole rows, so that their broadcast stays small."""
    return F.sha2(F.to_json(state, {"ignoreNullFields": "false"}), 256)


def _versions(
    rows: DataFrame,
    group: list[str],
    order: list[str],
    sequence: list[str],
    tracked: list[str],
    pieces: DataFrame | None = None,
) -> DataFrame:
    """The versions within each group, in one shuffle and one sort."""
    rows, first, repeats = _with_previous(rows, group, order, tracked)
    if pieces is not None:
        rows = rows.alias("r").join(pieces.alias("p"), same_keys("r", "p", group), "left")
        rows = rows.select("r.*", "p._carried", "p._next")
        carried = F.col("_carried").eqNullSafe(_digest(_state(tracked)))
        repeats = F.when(first, carried).otherwise(repeats)
    along = Window.partitionBy(*group).orderBy(*order)
    kept = rows.where(~repeats)
    kept = kept.withColumns({f"_n{i}": F.lead(c).over(along) for i, c in enumerate(sequence)})
    end = _position([F.col(f"_n{i}").alias(c) for i, c in enumerate(sequence)])
    end = F.when(F.col("_n0").isNotNull(), end)
    if pieces is not None:
        end = F.coalesce(end, F.col("_next"))
    start = _position([F.col(c) for c in sequence])
    return kept.where(~F.col("_deleted")).withColumns({START: start, END: end})


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _position(columns: list[Column]) -> Column:
    """The sequence value of a row: the column itself, or a struct of several."""
    return columns[0] if len(columns) == 1 else F.struct(*columns)


def _across_pieces(
    rows: DataFrame, keys: list[str], order: list[str], sequence: list[str], tracked: list[str]
) -> DataFrame:
    """Per piece of a hot key: the state before it, and where the next version after it starts."""
    rows, first, repeats = _with_previous(rows, [*keys, "_split"], order, tracked)
    place = F.struct(*order)
    start = _position([F.col(c) for c in sequence])
    pieces = rows.groupBy(*keys, "_split").agg(
        F.min_by(_state(tracked), place).alias("_first"),
        F.max_by(_state(tracked), place).alias("_last"),
        F.min(start).alias("_first_start"),
        F.min(F.when(~first & ~repeats, start)).alias("_first_change"),
    )
    pieces = pieces.withColumns({c: _digest(F.col(c)) for c in ("_first", "_last")})
    along = Window.partitionBy(*keys).orderBy("_split")
    after = along.rowsBetween(1, Window.unboundedFollowing)
    repeated = F.col("_carried").eqNullSafe(F.col("_first"))
    own_start = F.when(repeated, F.col("_first_change")).otherwise(F.col("_first_start"))
    return (
        pieces.withColumn("_carried", F.lag("_last").over(along))
        .withColumn("_own_start", own_start)
        .withColumn("_next", F.first("_own_start", ignorenulls=True).over(after))
        .select(*keys, "_split", "_carried", "_next")
    )


def key_filter(df: DataFrame, key: dict) -> DataFrame:
    """Rows of one composite key; a None value matches null."""
    for name, value in key.items():
        df = df.where(F.col(name).eqNullSafe(F.lit(value)))
    return df


def history(df: DataFrame, key: dict, order_by: str | list[str] = START) -> DataFrame:
    """The versions of one key in order."""
    return key_filter(df, key).orderBy(*_as_list(order_by))


def as_of(df: DataFrame, moment: Column | str) -> DataFrame:
    """The versions open at a moment (a column, or text in the session's time zone)."""
    at = F.lit(moment).cast(df.schema[START].dataType) if isinstance(moment, str) else moment
    return df.where((F.col(START) <= at) & (F.col(END).isNull() | (at < F.col(END))))
