"""Joins of rows with one lookup row per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than one in so many rows; fewer than so many keys can.
HOT_SHARE = 1024


def split_hot(counted: DataFrame, size: str, share: int = HOT_SHARE) -> tuple[DataFrame, DataFrame]:
    """Rows of `counted` (one per key, `size` its number of rows) for hot keys, and the others.

    The first has fewer than `share` rows whatever the data, so it may be broadcast.
    """
    total = counted.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) > total / share
    return counted.where(hot), counted.where(~hot)


def join_counted(rows: DataFrame, lookup: DataFrame, on: list[str], size: str, share: int = HOT_SHARE) -> DataFrame:
    """Inner join of `rows` with `lookup`, which has one row per key and the key's number of rows.

    Rows of hot keys meet their lookup row by broadcast and are not moved. All others meet it in a
    shuffle where no key holds more than one in `share` rows. `rows` and `lookup` are read twice:
    give them written. Null keys match nothing.
    """
    hot, rest = split_hot(lookup, size, share)
    near = rows.join(F.broadcast(hot), on)
    far = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(rest.hint("merge"), on)
    return near.unionByName(far)


def join_hot(rows: DataFrame, lookup: DataFrame, on: Mapping[str, str], how: str = "inner", share: int = HOT_SHARE) -> DataFrame:
    """Inner or left semi join of `rows` with a `lookup` that has one row per key, hot keys apart.

    `on` maps columns of `rows` to those of `lookup`. Hot keys are found by counting, in the same
    query, from the key columns alone; there are fewer than `share`, so their lookup rows are
    broadcast and their rows stay where they are. The rest is an ordinary join. `rows` is read
    three times: give it as a scan or a written table. Null keys match nothing.
    """
    mine, theirs = list(on), list(on.values())
    counts = rows.groupBy(*(F.col(f"`{c}`").alias(f"_hot_{n}") for n, c in enumerate(mine))).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    hot = counts.where(F.col("_n") * share > total).drop("_n")

    def same(frame: DataFrame, columns: list[str]) -> list:
        return [frame[f"`{c}`"] == hot[f"_hot_{n}"] for n, c in enumerate(columns)]

    few = lookup.join(F.broadcast(hot), same(lookup, theirs), "left_semi")
    near = rows.join(F.broadcast(few), [rows[f"`{a}`"] == few[f"`{b}`"] for a, b in on.items()], how)
    others = rows.join(F.broadcast(hot), same(rows, mine), "left_anti")
    far = others.join(lookup, [others[f"`{a}`"] == lookup[f"`{b}`"] for a, b in on.items()], how)
    return near.unionByName(far)
