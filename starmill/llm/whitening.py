"""Whitening of embeddings by a covariance over distinct vectors with multiplicities.

Entries become whole numbers, `floor(scale * c) + shift`, and identical vectors of these are grouped
(counted before the shuffle), so a vector that a third of all rows share is one row from then on. The
fit weighs a distinct vector by one or by its count. Sums are exact. Residuals from the mean are
multiplied block by block in the tasks, entries of the products are summed by Spark, and the
covariance (width x width, whatever the number of rows) is decomposed on the driver. Every distinct
vector is whitened once, written, and joined back to the rows by a digest; digests with very many rows
are met by broadcast.

Components are numbered from 1 by falling eigenvalue; the sign makes the entry of largest size
positive. Directions in which the fit does not vary (eigenvalue below width x 2^-52 of the largest) are
no components, so one vector alone, or copies of one, give no rows. Rows are left out if the vector is
null or empty, holds a null, NaN or infinite entry or one whose whole number has more than 53 bits, or
is not as wide as most (of equally common widths the wider counts): they have no place in the space.
Rows that repeat give repeated rows, a null id stays null, an empty table gives an empty result. Only
the two named columns are read, so no other can clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.skew import join_counted
from starmill.session import materialise

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Most vectors that are multiplied at once.
BLOCK = 4096
#: Most digits of an exact sum of squares.
EXACT = "decimal(38,0)"
RESULT = f"n bigint, deviation {EXACT}, whitened array<double>, explained array<double>, identity_error double"


@dataclass(frozen=True)
class Fit:
    """`weight`: sum of weights (vectors, if each weighs one). `sums` per dimension are exact. `axes` has
    one column per component, of unit length; `values` are their eigenvalues, `trace` that of the covariance."""

    weight: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float


def whole(vector: str, scale: int, shift: int) -> Column:
    return F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * scale) + F.lit(shift))


def quantised(rows: DataFrame, vec_id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """`vec_id` and the whole numbers `x` of every row whose vector can be placed."""
    most = (2.0**53 - abs(shift)) / scale
    placed = F.forall(F.col(f"`{vector}`"), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < most))
    kept = rows.where(placed & (F.size(F.col(f"`{vector}`")) > 0))
    return kept.select(F.col(f"`{vec_id}`").alias("vec_id"), whole(vector, scale, shift).alias("x"))


def digest() -> Column:
    return F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256)).alias("digest")


def distinct_vectors(x: DataFrame) -> DataFrame:
    """One row per distinct vector: `digest`, `x`, `copies`, written once."""
    counted = x.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    return materialise(counted.select(digest(), "x", "copies"), "distinct-vectors")


def common_width(vectors: DataFrame) -> int:
    """How wide most rows are; 0 without rows."""
    widths = vectors.groupBy(F.size("x").alias("width")).agg(F.sum("copies").alias("rows"))
    most = widths.orderBy(F.desc("rows"), F.desc("width")).first()
    return most["width"] if most else 0


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def weighted_sums(vectors: DataFrame, values: str, weight: str, width: int) -> tuple[int, list]:
    """Sum of weights, and of weighted values per dimension; whole numbers are summed exactly."""
    kind = EXACT if vectors.schema[values].dataType.elementType.simpleString() == "bigint" else "double"
    products = [F.sum(F.get(values, F.lit(i)).cast(kind) * F.col(weight)).alias(f"s{i}") for i in range(width)]
    row = vectors.agg(F.sum(weight).alias("n"), *products).first()
    return row["n"], list(row[1:])


def covariance(vectors: DataFrame, values: str, weight: str, total: int, sums: Sequence) -> np.ndarray:
    """Weighted covariance, divisor `total`: residuals from the mean are multiplied, not the values.

    A task emits the entries of one upper triangle, however many vectors it holds; Spark sums them.
    """
    width = len(sums)
    upper = np.triu_indices(width)
    exact = all(isinstance(s, int) for s in sums)
    # the mean as a whole part and a rest, so that residuals of whole numbers are right to the last bit
    whole_part = np.array([s // total if exact else 0 for s in sums], "int64")
    rest = np.array([(s % total) / total if exact else s / total for s in sums], "float64")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((width, width))
        for block in _blocks(batches):
            residuals = (_matrix(block.column(0)) - whole_part).astype("float64") - rest
            weights = block.column(1).to_numpy().astype("float64")
            products += residuals.T @ (residuals * weights[:, None])
        if products.any():
            columns = [pa.array(upper[0].astype("int32")), pa.array(upper[1].astype("int32")), pa.array(products[upper])]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "product"])

    parts = vectors.select(values, weight).mapInArrow(run, "i int, j int, product double")
    out = np.zeros((width, width))
    for i, j, product in parts.groupBy("i", "j").agg(F.sum("product")).collect():
        out[i, j] = out[j, i] = product / total
    return out


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS, counted: bool = False) -> Fit | None:
    """The components of distinct vectors of this width; None without vectors.

    A vector weighs one, or its number of copies if `counted`.
    """
    rows = vectors.where(F.size("x") == width).withColumn("weight", F.col("copies") if counted else F.lit(1).cast("bigint"))
    if not width:
        return None
    total, sums = weighted_sums(rows, "x", "weight", width)
    sums = [int(s) for s in sums]
    spread = covariance(rows, "x", "weight", total, sums)
    values, axes = np.linalg.eigh(spread)
    values, axes = values[::-1], axes[:, ::-1]
    some = int((values > width * np.finfo(float).eps * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    few = min(components, some)
    axes = axes[:, :few]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(few)])
    return Fit(total, tuple(sums), axes * signs, values[:few], float(np.trace(spread)))


def _deviations(x: np.ndarray, weight: int, sums: np.ndarray) -> pa.Array:
    """Exact sums over dimensions of (weight * x - sum)^2; in 64 bits where these are proven to suffice."""
    low, high = int(x.min()), int(x.max())
    reach = max(abs(weight * v - s) for v in (low, high) for s in (int(sums.min()), int(sums.max())))
    if reach * reach * x.shape[1] < 1 << 63:
        apart = weight * x - sums.astype("int64")
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    apart = weight * x.astype(object) - sums
    return pa.array((apart * apart).sum(axis=1), pa.decimal128(38, 0))


def whiten_distinct(vectors: DataFrame, width: int, model: Fit) -> DataFrame:
    """Every distinct vector once: `digest`, `copies`, `deviation`, `whitened` per component, written."""
    sums = np.array(model.sums, object)
    whole_part = np.array([s // model.weight for s in model.sums], "int64")
    rest = np.array([(s % model.weight) / model.weight for s in model.sums])
    weight, axes = model.weight, model.axes / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            x = _matrix(block.column(2))
            white = ((x - whole_part).astype("float64") - rest) @ axes
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype="int32") * white.shape[1], pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), _deviations(x, weight, sums), lists], ["digest", "copies", "deviation", "whitened"]
            )

    rows = vectors.where(F.size("x") == width).select("digest", "copies", "x")
    schema = f"digest binary, copies bigint, deviation {EXACT}, whitened array<double>"
    return materialise(rows.mapInArrow(run, schema), "whitened-vectors")


def identity_error(white: DataFrame, components: int, counted: bool) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    rows = white.withColumn("weight", F.col("copies") if counted else F.lit(1).cast("bigint"))
    total, sums = weighted_sums(rows, "whitened", "weight", components)
    spread = covariance(rows, "whitened", "weight", total, sums)
    return float(np.abs(spread - np.eye(components)).max())


def whiten(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
    counted: bool = False,
) -> DataFrame:
    """Per row that can be placed: `vec_id`, `n` (sum of weights of the fit), `deviation` (exact), the
    arrays `whitened` and `explained` with one entry per component, and `identity_error`."""
    x = quantised(rows, vec_id, vector, scale, shift)
    vectors = distinct_vectors(x.select("x"))
    width = common_width(vectors)
    model = fit(vectors, width, components, counted)
    few = 0 if model is None else len(model.values)
    keyed = x.where(F.size("x") == width).select("vec_id", digest())
    if not few:
        kind = keyed.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, {RESULT}")
    white = whiten_distinct(vectors, width, model)
    error = identity_error(white, few, counted)
    back = join_counted(materialise(keyed, "vector-digests"), white, ["digest"], "copies")
    return back.select(
        "vec_id",
        F.lit(model.weight).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.lit([float(v / model.trace) for v in model.values]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
