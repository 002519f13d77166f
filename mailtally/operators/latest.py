"""Latest row per key, current versions, and numbering of resent reports.

``row_number() <= n`` is written so that Catalyst puts a group limit before the shuffle:
each map task sends at most ``n`` rows per key, whatever share of the rows a key holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from mailtally.session import RunFolder, materialize


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of every key.

    Catalyst cuts the groups of every task to ``n`` rows before the shuffle, for ``n`` up to
    its setting ``spark.sql.optimizer.windowGroupLimitThreshold``. Raise that setting for a
    larger ``n`` if keys are hot; the rows are the same without it.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; give a tie-breaker as last item."""
    return first_n_per_key(df, keys, order, 1)


def tie_break(df: DataFrame) -> Column:
    """A hash of the row: equal sort keys then give the same winner on every retry.

    Maps have no hash; columns that hold one anywhere are hashed by their sorted JSON text.
    """
    return F.xxhash64(*[comparable(df, f.name) for f in df.schema.fields]).desc()


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_holds_map(f.dataType) for f in kind.fields)


def comparable(df: DataFrame, name: str) -> Column:
    """A column that can be hashed and grouped, equal where the values are."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.MapType) and not _holds_map(kind.valueType):
        col, kind = F.sort_array(F.map_entries(col)), T.ArrayType(T.NullType())
    return F.to_json(F.struct(col)) if _holds_map(kind) else col


OWN = "_own"


def number_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a number of its own for every row with a null key, -1 for the others.

    Used next to the keys: such rows then neither meet in one group nor in one partition.
    """
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    number = F.when(any_null, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return df.withColumn(OWN, number.cast("long"))


def newest_copy(df: DataFrame, id_col: str, received: str = "received_ts") -> DataFrame:
    """One row per id, the newest; rows without an id are all kept."""
    order = [F.col(received).desc(), tie_break(df)]
    return latest_per_key(number_null_keys(df, [id_col]), [id_col, OWN], order).drop(OWN)


def scd2_current(
    df: DataFrame,
    keys: Sequence[str],
    change: str,
    delete: str,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Newest version per key, kept only if that version is not deleted."""
    order = [F.col(c).desc() for c in (change, *tie)]
    return latest_per_key(df, keys, order).filter(F.col(delete).isNull())


def number_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slot: Column,
    out: str = "version",
) -> DataFrame:
    """``row_number`` over a key that may hold a large share of all rows.

    ``slot`` is a coarse value that grows with ``order`` (such as the minute of a time).
    Rows are numbered inside (key, slot) and shifted by the rows of the earlier slots,
    which come from an aggregate with one row per key and slot.
    """
    inside = Window.partitionBy(*keys, "_slot").orderBy(*order)
    numbered = df.withColumn("_slot", slot).withColumn("_in_slot", F.row_number().over(inside))
    # From the numbered rows, so that both sides read one shuffle.
    sizes = numbered.groupBy(*keys, "_slot").agg(F.max("_in_slot").alias("_n"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_slot").alias("_k_slot"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    same.append(F.col("_slot").eqNullSafe(F.col("_k_slot")))
    return numbered.join(offsets, same).select(
        *df.columns, (F.col("_in_slot") + F.col("_before")).alias(out)
    )


RANGE = "_range"


def in_ranges(
    df: DataFrame, order: Sequence[Column], parts: int | None = None, run: RunFolder | None = None
) -> DataFrame:
    """Rows with ``_range``, the number of a range of ``order`` that holds about as many rows
    as any other. The cuts come from a sample of the rows, by Spark's range partitioning.

    Rows are written to the shared folder with their range, since a second evaluation might
    cut elsewhere. ``run`` names a folder that its owner removes.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn(RANGE, F.spark_partition_id())
    return run.keep(ranged, "ranges") if run else materialize(ranged, "ranges")


def number_in_ranges(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str = "version",
    parts: int | None = None,
    run: RunFolder | None = None,
) -> DataFrame:
    """``row_number`` over keys of any size, also if all rows of one have the same time.

    Ranges go over (key, order), so a hot key is cut into as many as its rows fill, wherever
    they lie close together. Rows that tie in all of ``order`` share a range and have no fixed
    order among themselves. Without ``keys`` it numbers all rows.
    """
    ranged = in_ranges(df, [*map(F.col, keys), *order], parts, run)
    return number_per_key(ranged, keys, order, F.col(RANGE), out).drop(RANGE)


def with_position(
    df: DataFrame, order: Sequence[Column], out: str = "position", run: RunFolder | None = None
) -> DataFrame:
    """Rows with their place from 1 in a global order, a column that survives any later shuffle."""
    return number_in_ranges(df, [], order, out, run=run)


def version_resends(
    df: DataFrame,
    keys: Sequence[str],
    received: str = "received_ts",
    tie: str = "id",
    mode: str = "versions",
    slot: Column | None = None,
    bursts: bool = False,
) -> DataFrame:
    """Resent reports: ``versions`` keeps all with 1, 2, ...; ``overwrite`` keeps the last.

    A key is split by the minute, or by ``slot``. ``bursts`` splits it by ranges instead, for
    reports that are resent many times within a moment; rows are written once for that.
    """
    if mode == "overwrite":
        return latest_per_key(df, keys, [F.col(received).desc(), F.col(tie).desc()])
    if mode != "versions":
        raise ValueError(f"unknown mode {mode!r}")
    order = [F.col(received).asc(), F.col(tie).asc()]
    if bursts:
        return number_in_ranges(df, keys, order)
    return number_per_key(
        df, keys, order, F.date_trunc("minute", received) if slot is None else slot
    )
