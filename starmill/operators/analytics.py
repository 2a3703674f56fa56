"""Ranking, change, shares, percentiles and top-n over grouped measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.scalars import percent
from starmill.operators.keys import ONE_TASK_ROWS
from starmill.session import materialise

# A histogram pass splits a value range into 2^16 buckets.
_BUCKET_BITS = 16
BUCKETS = 1 << _BUCKET_BITS

_WANTED = "struct<i:int,side:string,weight:double,rank:bigint>"
_EARLIER = (Window.unboundedPreceding, -1)

# Most counted rows that a broadcast hint is given for.
BROADCAST_ROWS = 50_000


def totals(df: DataFrame, by: Sequence[str], measure: str, out: str) -> DataFrame:
    """SUM by group; NULL when a group has no value."""
    return df.groupBy(*by).agg(F.sum(measure).alias(out))


def rank_within(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    measure: str,
    out: str,
    max_group: int | None = None,
) -> DataFrame:
    """RANK() of `measure` as BIGINT, largest first, inside each `by` group; ties share a rank, then a gap.
    A collated text (`scalars.collated`) is ranked, and tied, by its collation.

    `df` has one row per (by, keys). With a proven bound on the rows of a group this is one
    window. Otherwise a group, however large, is spread over range partitions and ranked inside
    each; a carry per range adds the rows ahead of it, less those in earlier ranges that tie with
    its first value. Carries are one row per range and group, so a value held by very many rows
    costs no more than others.
    """
    largest = F.col(measure).desc_nulls_first()
    if max_group is not None and max_group <= ONE_TASK_ROWS:
        return df.withColumn(out, F.rank().over(Window.partitionBy(*by).orderBy(largest)).cast("bigint"))

    ordered = df.repartitionByRange(*by, largest, *keys)
    rows = materialise(ordered.withColumn("_range", F.spark_partition_id()), "ranked")
    here = [*by, "_range"]
    values = rows.groupBy(*here, measure).agg(F.count("*").alias("_n"))
    some = F.col(measure).isNotNull()
    ranges = values.groupBy(*here).agg(
        F.sum("_n").alias("_rows"),
        F.when(F.bool_and(some), F.max(measure)).alias("_first"),
        F.min(measure).alias("_last"),
        F.coalesce(F.min_by("_n", measure), F.sum("_n")).alias("_last_rows"),
    )
    in_order = Window.partitionBy(*by).orderBy("_range")
    tied = Window.partitionBy(*by, "_last").orderBy("_range")
    carries = (
        ranges.withColumn("_ahead", F.coalesce(F.sum("_rows").over(in_order.rowsBetween(*_EARLIER)), F.lit(0)))
        .withColumn("_held", F.sum("_last_rows").over(tied.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_earlier", F.lag("_last").over(in_order))
        .withColumn("_same", F.col("_earlier").eqNullSafe(F.col("_first")))
        .withColumn("_before", F.coalesce(F.lag("_held").over(in_order), F.lit(0)))
        .select(*here, "_ahead", F.when(F.col("_same"), F.col("_before")).otherwise(0).alias("_tied"))
    )
    inside = F.rank().over(Window.partitionBy(*here).orderBy(largest))
    ranked = _join_groups(rows.withColumn("_inside", inside), carries, here)
    tie = F.when(F.col("_inside") == 1, F.col("_tied")).otherwise(0)
    return ranked.withColumn(out, (F.col("_ahead") + F.col("_inside") - tie).cast("bigint")).select(*df.columns, out)


def change_from_previous(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    measure: str,
    previous: str,
    change: str,
    pct: str,
    consecutive: bool = False,
) -> DataFrame:
    """Value, difference and percent change against the previous row of the same group.

    The previous row is the nearest earlier period that exists; with `consecutive` it must be
    exactly one period earlier, else NULL. `df` has one row per (by, order), so a group holds
    no more rows than there are periods.
    """
    window = Window.partitionBy(*by).orderBy(order)
    before = F.lag(measure).over(window)
    if consecutive:
        before = F.when(F.lag(order).over(window) == F.col(order) - 1, before)
    delta = F.col(measure) - F.col(previous)
    return (
        df.withColumn(previous, before)
        .withColumn(change, delta)
        .withColumn(pct, percent(delta, F.col(previous)))
    )


def share_where(
    df: DataFrame, by: Sequence[str], measure: str, where: Column, total: str, part: str, pct: str
) -> DataFrame:
    """Total, total of the matching rows (NULL when none match) and their percentage."""
    return (
        df.groupBy(*by)
        .agg(F.sum(measure).alias(total), F.sum(F.when(where, F.col(measure))).alias(part))
        .withColumn(pct, percent(F.col(part), F.col(total)))
    )


def top_n(df: DataFrame, measure: str, n: int, tie_break: Sequence[str | Column]) -> DataFrame:
    """The `n` largest rows, ties decided by `tie_break`, which may be collated keys."""
    return df.orderBy(F.col(measure).desc_nulls_first(), *tie_break).limit(n)


def percentiles(
    df: DataFrame, by: Sequence[str], measure: str, outputs: Mapping[str, float], largest: str | None = None
) -> DataFrame:
    """Exact PERCENTILE_CONT (linear interpolation, NULLs ignored) of any numeric measure, and its
    maximum where `largest` names a column for it. A group of NULLs alone gets NULLs.

    Values are narrowed by histograms: row counts per bucket tell which bucket holds each wanted
    rank, and the next pass splits only those buckets. A task holds at most BUCKETS counts of a
    group, however many rows the group has. A value is one or two 64-bit words whose order is the
    value's, see `with_words`; a pass narrows by 16 bits, and leading bits that the least and the
    largest value of the column share cost no pass. How many passes there are changes no result.
    Floating values: -0.0 is 0.0, NaN is larger than any other value.
    """
    kind = df.schema[measure].dataType
    rows, words = with_words(df, by, measure)
    shares = [*outputs.values(), *([1.0] if largest else [])]
    shift = _first_shift(rows, words[0])
    if shift or len(words) > 1:
        rows = materialise(rows, "measures")
    found = _first_buckets(rows.withColumn("_value", F.col(words[0])), by, shares, shift)
    known = list(by)
    for place, word in enumerate(words):
        values = rows.withColumn("_value", F.col(word))
        if place:
            known.append(words[place - 1])
            found, shift = found.withColumnRenamed("_bucket", known[-1]).withColumn("_bucket", F.lit(0).cast("bigint")), 64
        while shift:
            shift -= _BUCKET_BITS
            found = _next_buckets(values, materialise(found, "buckets"), known, shift)

    found = found.withColumn("_at", of_words([*(F.col(w) for w in words[:-1]), F.col("_bucket")], kind))

    def at(i: int, side: str) -> Column:
        return F.max(F.when((F.col("w.i") == i) & (F.col("w.side") == side), F.col("_at")))

    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    picked = []
    for i, out in enumerate(outputs):
        below, above = at(i, "low").cast("double"), at(i, "high").cast("double")
        weight = F.max(F.when(F.col("w.i") == i, F.col("w.weight")))
        # no difference is taken where none is needed: that of two infinities is no number
        between = F.when((weight == 0) | (below == above), below).otherwise(below + weight * (above - below))
        picked.append((between / F.lit(float(10**scale)) if scale else between).alias(out))
    if largest:
        top = at(len(outputs), "high")
        picked.append((_pointed(top, scale) if scale else top).cast(kind).alias(largest))
    return found.groupBy(*by).agg(*picked)


_DOUBLE_INFINITY, _DOUBLE_NAN = 0x7FF << 52, 0xFFF << 51
_TWO_64 = Decimal(1 << 64)


def with_words(df: DataFrame, by: Sequence[str], measure: str) -> tuple[DataFrame, list[str]]:
    """`by` and the measure as columns of 64-bit words in the value's order, and their names.

    Whole numbers and decimals of up to 18 digits (without their point) are one word; wider decimals
    are two, the second shifted so that its order is that of signed numbers. A floating value is its
    exponent and fraction side by side, as stored, negated if the value is negative.
    """
    kind, value = df.schema[measure].dataType, F.col(f"`{measure}`")
    keys = [F.col(f"`{c}`") for c in by]
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df.select(*keys, value.cast("bigint").alias("_word0")), ["_word0"]
    if isinstance(kind, T.DecimalType):
        if kind.precision <= 18:
            return df.select(*keys, (value * F.lit(Decimal(10) ** kind.scale)).cast("bigint").alias("_word0")), ["_word0"]
        # a product with a power of ten would need more than 38 digits
        digits = F.regexp_replace(F.format_number(value, kind.scale), "[,.]", "")
        whole = df.select(*keys, digits.cast("decimal(38,0)").alias("_whole"))
        parts = whole.withColumn("_rest", F.expr(f"CAST(_whole % {1 << 64}BD AS DECIMAL(38,0))"))
        below = F.when(F.col("_rest") < 0, 1).otherwise(0)
        high = F.expr(f"_whole div {1 << 64}BD") - below
        low = (F.col("_rest") + below * F.lit(_TWO_64) - F.lit(Decimal(1 << 63))).cast("bigint")
        return parts.select(*keys, high.alias("_word0"), low.alias("_word1")), ["_word0", "_word1"]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _float_words(df.select(*keys, value.cast("double").alias("_x"))).select(*keys, "_word0"), ["_word0"]
    raise TypeError(f"percentiles needs a number, {measure} is {kind.simpleString()}")


def _float_words(rows: DataFrame) -> DataFrame:
    """`_word0` for the double `_x`, by exact arithmetic: scaling by a power of two changes no digit."""
    size = F.abs("_x")
    tiny, large = size < 2.0**-1022, size == float("inf")
    usual = F.when(F.isnan("_x") | tiny | large, 1.0).otherwise(size)
    # a logarithm may be off by one next to a power of two
    guessed = rows.withColumn("_size", usual).withColumn("_guess", F.floor(F.log2("_size")).cast("int"))
    power = F.pow(F.lit(2.0), "_guess")
    off = F.when(F.col("_size") < power, -1).when(F.col("_size") >= power * 2, 1).otherwise(0)
    placed = guessed.withColumn("_exponent", F.col("_guess") + off)
    fraction = ((F.col("_size") / F.pow(F.lit(2.0), "_exponent") - 1) * 2.0**52).cast("bigint")
    bits = (
        F.when(F.isnan("_x"), F.lit(_DOUBLE_NAN))
        .when(large, F.lit(_DOUBLE_INFINITY))
        .when(tiny, (size * 2.0**537 * 2.0**537).cast("bigint"))
        .otherwise((F.col("_exponent") + 1023).cast("bigint") * (1 << 52) + fraction)
    )
    return placed.withColumn("_bits", bits).withColumn(
        "_word0", F.when(F.col("_x") < 0, -F.col("_bits")).otherwise(F.col("_bits"))
    )


def of_words(words: Sequence[Column], kind: T.DataType) -> Column:
    """The value that words stand for; a decimal without its point."""
    if len(words) == 2:
        # towards zero first: the largest values leave no digit to spare
        up = F.when(words[0] < 0, 1).otherwise(0)
        low = words[1].cast("decimal(38,0)") + F.lit(Decimal(1 << 63)) - up * F.lit(_TWO_64)
        return ((words[0] + up).cast("decimal(38,0)") * F.lit(_TWO_64) + low).cast("decimal(38,0)")
    if isinstance(kind, T.DecimalType):
        return words[0].cast("decimal(38,0)")
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return words[0]
    bits = F.abs(words[0])
    exponent, fraction = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1))
    size = (
        F.when(bits > _DOUBLE_INFINITY, float("nan"))
        .when(bits == _DOUBLE_INFINITY, float("inf"))
        .when(exponent == 0, fraction * 2.0**-1074)
        .otherwise((fraction / 2.0**52 + 1) * F.pow(F.lit(2.0), exponent - 1023))
    )
    return F.when(words[0] < 0, -size).otherwise(size)


def _pointed(whole: Column, scale: int) -> Column:
    """A whole number as text with its point `scale` digits from the right; no division, which rounds."""
    digits = F.abs(whole).cast("string")
    filled = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), F.lit("0"))
    before = F.length(filled) - scale
    sign = F.when(whole < 0, "-").otherwise("")
    return F.concat(sign, filled.substr(F.lit(1), before), F.lit("."), filled.substr(before + 1, F.lit(scale)))


def _first_shift(rows: DataFrame, word: str) -> int:
    """The finest first pass that splits the range of `word` into at most BUCKETS buckets."""
    low, high = rows.agg(F.min(word), F.max(word)).first()
    if low is None:
        return 0
    return next(s for s in range(0, 64, _BUCKET_BITS) if (high >> s) - (low >> s) < BUCKETS)


def percentiles_approx(
    df: DataFrame, by: Sequence[str], measure: str, outputs: Mapping[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Nearest-rank percentiles in one mergeable sketch per group, rank error below 1/accuracy."""
    sketch = F.percentile_approx(measure, list(outputs.values()), accuracy).alias("_p")
    picked = [F.col("_p")[i].alias(out) for i, out in enumerate(outputs)]
    return df.groupBy(*by).agg(sketch).select(*by, *picked)


def _first_buckets(rows: DataFrame, by: Sequence[str], shares: Sequence[float], shift: int) -> DataFrame:
    """Buckets of 2^shift values that hold a wanted rank; `w` says which and how far in."""
    group = Window.partitionBy(*by)
    size = F.col("_size")
    wanted = []
    for i, p in enumerate(shares):
        place = F.lit(float(p)) * (size - 1)
        weight = place - F.floor(place)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            wanted.append(
                F.struct(
                    F.lit(i).alias("i"),
                    F.lit(side).alias("side"),
                    weight.alias("weight"),
                    rank.cast("bigint").alias("rank"),
                )
            )
    # NULLs are a bucket that counts for nothing; through it a group of NULLs alone is kept
    buckets = (
        rows.groupBy(*by, F.shiftright("_value", shift).alias("_bucket"))
        .agg(F.count("_value").alias("_n"))
        .withColumn("_size", F.sum("_n").over(group))
        .withColumn("_wanted", F.when(size > 0, F.array(*wanted)))
    )
    empty = buckets.where(size == 0).select(*by, "_bucket", F.lit(None).cast(_WANTED).alias("w"))
    return _holding(buckets.where(size > 0), by, group).unionByName(empty)


def _next_buckets(rows: DataFrame, found: DataFrame, by: Sequence[str], shift: int) -> DataFrame:
    """Split the found buckets 2^16-fold and keep the parts that hold a wanted rank.

    Few found buckets are broadcast, so rows outside them are dropped where they are read.
    Many, as of very many groups, are joined to counts per value, which no hot value skews.
    """
    keys = [*by, "_parent"]
    few = found.count() <= BROADCAST_ROWS
    empty = found.where("w IS NULL")
    found = found.where("w IS NOT NULL")
    found = found.groupBy(*by, F.col("_bucket").alias("_parent")).agg(F.collect_list("w").alias("_wanted"))
    up = shift + _BUCKET_BITS
    parent = F.shiftright("_value", up) if up < 64 else F.when(F.col("_value").isNotNull(), F.lit(0).cast("bigint"))
    finer = rows.withColumn("_parent", parent)
    if few:
        inside = _join_groups(finer, F.broadcast(found.drop("_wanted")), keys).withColumn("_n", F.lit(1))
    else:
        counts = finer.groupBy(*keys, "_value").agg(F.count("*").alias("_n"))
        inside = _join_groups(counts, found.drop("_wanted"), keys)
    parts = inside.groupBy(*keys, F.shiftright("_value", shift).alias("_bucket")).agg(F.sum("_n").alias("_n"))
    return _holding(_join_groups(parts, found, keys), by, Window.partitionBy(*keys)).unionByName(empty)


def _holding(buckets: DataFrame, by: Sequence[str], group) -> DataFrame:
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before")
    inside = F.filter(
        "_wanted", lambda w: (w["rank"] >= before) & (w["rank"] < before + F.col("_n"))
    )
    moved = F.transform(inside, lambda w: w.withField("rank", w["rank"] - before))
    return (
        buckets.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(*by, "_bucket", F.explode(moved).alias("w"))
    )


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on grouping columns, where NULL is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, same).drop(*[f"_right_{k}" for k in keys])
