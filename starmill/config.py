"""What a wide source looks like and which catalogues classify it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Category:
    """Classification of one leaf of the category hierarchy."""

    name: str
    flagged: bool


@dataclass(frozen=True)
class StarConfig:
    """Source column names, catalogues and constants of one star.

    `categories` is held on the driver and is therefore small; it decides which rows enter
    the star. `regions` maps entity name to region: a mapping when it is small enough to be
    a literal, else a DataFrame (entity name, region) that is joined. The two types are those
    of the declared star; a source with more entities or larger sums widens them.
    """

    year: str
    entity_key: str
    entity_name: str
    good: str
    kind: str
    leaf: str
    months: tuple[str, ...]
    categories: Mapping[str, Category]
    regions: Mapping[str, str] | DataFrame
    flagged_years: frozenset[int]
    source_label: str
    detail: tuple[str, ...] = ()
    entity_key_type: str = "smallint"
    measure_type: str = "int"

    @property
    def ids(self) -> tuple[str, ...]:
        return (self.year, self.entity_key, self.entity_name, self.good, self.kind, self.leaf)
