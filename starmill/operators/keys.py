"""Dense surrogate keys and key resolution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.session import materialise

# Most rows a window may hold in one task. Callers that stay below it say why.
ONE_TASK_ROWS = 1_000_000

# monotonically_increasing_id: partition in the upper bits, row position in the lower 33.
_ROW_BITS = 33


class DuplicateKeyError(ValueError):
    """A lookup key that must be unique is not."""


def dense_key(df: DataFrame, order: Sequence[str], out: str, max_rows: int | None = None) -> DataFrame:
    """Number rows 1..n in `order`, without gaps.

    With a proven bound `max_rows` up to ONE_TASK_ROWS this is a plain window. Otherwise rows
    are range-partitioned and written once with their slot, see `place_in_order`, so no task
    ever sees more than its range. `order` should be unique, then ids are repeatable.
    """
    if max_rows is not None and max_rows <= ONE_TASK_ROWS:
        position = F.row_number().over(Window.orderBy(*[F.col(f"`{c}`") for c in order]))
        return df.withColumn(out, position.cast("bigint"))
    return number_placed(place_in_order(df, order), out)


def place_in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition and sort `df`, note each row's slot in `_slot`, and write it once.

    Slots depend on the range boundaries of one run, so they must be written down before
    anything is derived from them twice.
    """
    columns = [F.col(f"`{c}`") for c in order]
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return materialise(placed.withColumn("_slot", F.monotonically_increasing_id()), "placed")


def number_placed(placed: DataFrame, out: str) -> DataFrame:
    """Turn `_slot` into a dense 1..n key without moving rows.

    The offsets have one row per range, of which there are `spark.sql.shuffle.partitions` at
    most, so they can be broadcast however many rows are numbered.
    """
    part = F.shiftright("_slot", _ROW_BITS)
    within = F.col("_slot") - F.shiftleft(part, _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + within + 1)
        .drop("_part", "_offset", "_slot")
    )


def require_unique(df: DataFrame, keys: Sequence[str], what: str, shown: int = 20) -> None:
    """Raise when a lookup key repeats: joining on it would multiply rows."""
    counts = df.groupBy(*keys).count().where("count > 1")
    repeated = counts.withColumn("_all", F.lit(counts.agg(F.count("*")).scalar())).limit(shown).collect()
    if repeated:
        found = ", ".join(str(tuple(row[k] for k in keys)) for row in repeated)
        total = repeated[0]["_all"]
        some = f"{len(repeated)} of {total} values: " if total > len(repeated) else ""
        raise DuplicateKeyError(f"{what}: key {tuple(keys)} repeats for {some}{found}")


@dataclass(frozen=True)
class Lookup:
    """A dimension to resolve: its table, its id column, and fact column -> dimension column.

    `bounded`: the table's rows are bounded by the calendar or a driver-side catalogue.
    """

    table: DataFrame
    id: str
    on: dict[str, str]
    bounded: bool = False


def resolve_keys(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join each dimension's id onto `df`; unmatched rows keep NULL.

    No broadcast is forced. Dimensions read from written tables have known sizes, so Spark
    broadcasts those under `autoBroadcastJoinThreshold` and shuffles larger ones.
    """
    for number, lookup in enumerate(lookups):
        names = {mine: f"_k{number}_{theirs}" for mine, theirs in lookup.on.items()}
        slim = lookup.table.select(
            lookup.id, *[F.col(theirs).alias(names[mine]) for mine, theirs in lookup.on.items()]
        )
        condition: list[Column] = [df[mine] == slim[alias] for mine, alias in names.items()]
        df = df.join(slim, condition, "left").drop(*names.values())
    return df
