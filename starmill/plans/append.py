"""Later years added to a published star, without touching what is stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.config import StarConfig
from starmill.plans import versions
from starmill.plans.build import build_grain, build_star
from starmill.plans.load import append_star, new_part, published, read_tables
from starmill.plans.star import Star


class LoadedYearsError(ValueError):
    """Years to append are not later than all stored ones."""


def append_years(
    wide: DataFrame, base: str, config: StarConfig, check: Callable[[Star, Star, Star], object] | None = None, attempts: int = 3
) -> Star:
    """Add the years of `wide` to the star published under `base`; the whole star as read back.

    `wide` has only years after the stored ones, since time ids follow the periods' order; others are
    refused. Ids that are stored do not change: new entities, categories and fact rows are numbered
    after the largest. An entity or category under another name than the stored one is refused. The
    new rows go to a folder of their own; `check` sees them as built, as read back, and the whole star.
    Then a version is published that names the stored folders and the new one. If another load publishes in between,
    everything is repeated on top of it, `attempts` times at most. Without rows nothing is published.
    """
    return append_grain(build_grain(wide, config), base, config, check, attempts)


def append_grain(
    grain: DataFrame, base: str, config: StarConfig, check: Callable[[Star, Star, Star], object] | None = None, attempts: int = 3
) -> Star:
    """`append_years` of a grain made by `build_grain`."""
    spark = grain.sparkSession
    while True:
        attempts -= 1
        number = versions.next_number(spark, base)
        known = published(spark, base).parts
        stored = read_tables(spark, *known)
        first = grain.agg(F.min("anio")).first()[0]
        if first is None:
            return stored
        _require_later(stored, first)
        target = new_part(base, number)
        built = build_star(grain, config, stored)
        append_star(built, target)
        whole = read_tables(spark, *known, target)
        if check:
            check(built, read_tables(spark, target), whole)
        try:
            versions.publish(spark, base, number, (*known, target))
        except versions.PublishConflict:
            if attempts <= 0:
                raise
        else:
            return whole


def _require_later(stored: Star, first: int) -> None:
    last = stored.dim_tiempo.agg(F.max("anio")).first()[0]
    if last is not None and first <= last:
        raise LoadedYearsError(f"the star holds years up to {last}; {first} cannot be appended, refresh instead")
