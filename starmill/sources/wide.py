"""The wide period table: CSV scan and profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.config import StarConfig


def wide_schema(config: StarConfig) -> T.StructType:
    """Declared schema: ids, detail columns, one measure column per month."""
    key = T.LongType() if config.entity_key_type == "bigint" else T.IntegerType()
    whole = {config.year: T.IntegerType(), config.entity_key: key}
    ids = [T.StructField(c, whole.get(c, T.StringType())) for c in config.ids]
    detail = [T.StructField(c, T.StringType()) for c in config.detail]
    months = [T.StructField(c, T.LongType()) for c in config.months]
    return T.StructType(ids + detail + months)


def read_wide_csv(spark: SparkSession, path: str, config: StarConfig, encoding: str = "ISO-8859-1") -> DataFrame:
    """Scan the source, finding columns by the names in its header.

    Types are declared, so there is no inference pass and files split. Further columns stay
    as text and are not parsed unless used. All files must have the same header, and a
    malformed row or cell fails the scan.
    """
    text = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    types = {field.name: field.dataType for field in wide_schema(config)}
    missing = [c for c in (*config.ids, *config.months) if c not in text.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return text.select(
        *[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in text.columns]
    )


#: Marks of a row: what is wrong with it (empty: nothing), and its text.
FAULTS, TEXT = "_faults", "_text"
MALFORMED = "malformed row"


def read_wide_csv_marked(spark: SparkSession, path: str, config: StarConfig, encoding: str = "ISO-8859-1") -> DataFrame:
    """`read_wide_csv` that fails on no row: cells that are not of their type become NULL.

    FAULTS names them, or says that the row has too few or too many cells; TEXT is the row as read. A blank
    cell is no fault. Rows without faults are those that `read_wide_csv` would return.
    """
    names = read_wide_csv(spark, path, config, encoding).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, "_line")])
    text = (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line")
        # else a row's cells are counted only as far as a query reads them
        .option("columnPruning", False)
        .csv(path)
    )
    types = {field.name: field.dataType for field in wide_schema(config) if field.dataType != T.StringType()}
    cells = {c: F.col(f"`{c}`").try_cast(types[c]) if c in types else F.col(f"`{c}`") for c in names}
    faults = [F.when(F.col("_line").isNotNull(), MALFORMED)]
    faults += [F.when(F.col(f"`{c}`").isNotNull() & cells[c].isNull(), c) for c in names if c in types]
    line = F.coalesce("_line", F.to_csv(F.struct(*(F.col(f"`{c}`") for c in names))))
    return text.select(
        *(cell.alias(c) for c, cell in cells.items()), F.array_compact(F.array(*faults)).alias(FAULTS), line.alias(TEXT)
    )


def write_rejects(marked: DataFrame, path: str) -> int:
    """Write the rows with faults (`file`, FAULTS, TEXT) to `path`; how many they are."""
    rejects = marked.where(F.size(FAULTS) > 0).select(F.input_file_name().alias("file"), FAULTS, TEXT)
    rejects.write.parquet(path)
    return marked.sparkSession.read.schema(rejects.schema).parquet(path).count()


def write_wide_csv(df: DataFrame, path: str, config: StarConfig, encoding: str = "ISO-8859-1") -> None:
    """Write a wide table in the form `read_wide_csv` expects."""
    columns = wide_schema(config).fieldNames()
    df.select(*[F.col(f"`{c}`") for c in columns]).write.csv(path, header=True, encoding=encoding)


def profile(df: DataFrame) -> DataFrame:
    """Row and column count as one row."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
