"""Hand-made wide rows, one case per rule that is easy to get wrong."""

from starmill.config import Category, StarConfig
from starmill.presets import MONTHS, SOURCE_COLUMNS
from starmill.sources.wide import wide_schema

CONFIG = StarConfig(
    **SOURCE_COLUMNS,
    categories={
        "lethal": Category("intentional", True),
        "late": Category("other", True),
        "harm": Category("not lethal", False),
    },
    regions={"North": "Norte", "South": "Sur", "Bare": "Centro"},
    flagged_years=frozenset({2020}),
    source_label="hand-made",
)


def row(year, key, name, leaf, detail="x", good="life", kind="type", **months):
    return (year, key, name, good, kind, leaf, detail, *[months.get(m) for m in MONTHS])


def frame(spark, rows, config=CONFIG):
    return spark.createDataFrame(rows, wide_schema(config))


def full(value):
    """Every month the same value."""
    return dict.fromkeys(MONTHS, value)
