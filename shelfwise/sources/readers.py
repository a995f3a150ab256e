"""Sources with canonical names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import expressions, kept


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options) -> DataFrame:
    """A table of any format that the session knows (parquet, orc, csv, json, delta where its jar is there). CSV has a
    header unless told otherwise and infers its types only if no schema is given."""
    if fmt == "csv":
        options = {"header": True, "inferSchema": schema is None} | options
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def renamed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Source columns under canonical names; an error if one is missing, where a plain rename would do nothing."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return reduce(lambda d, item: d.withColumnRenamed(*item), columns.items(), df)


def window(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows of a window of days, on the raw column so that files can be skipped: dates and timestamps are compared as
    such, strings as ISO text."""
    kind = dict(df.dtypes)[column]
    first, after = F.lit(start), F.date_add(F.lit(end).cast("date"), 1)
    if kind != "string":
        first = first.cast("date")
    else:
        after = after.cast("string")
    return df.where((F.col(column) >= first) & (F.col(column) < after))


def by_product(df: DataFrame, levels: DataFrame) -> DataFrame:
    """Rows of planning levels as rows of their products (a level may have many); unknown levels drop out, and rows that
    have a product stay as they are."""
    if "product_id" in df.columns:
        return df
    return df.join(levels.select("planning_level_id", "product_id").distinct(), "planning_level_id").drop("planning_level_id")


def clusters(df: DataFrame, attribute: str = "sales_speed", column: str | None = None) -> DataFrame:
    """``product_id`` and ``attribute_value``, from a long table of attributes or from a column of a wide one."""
    rows = df.select("product_id", F.col(column).cast("string").alias("attribute_value")) if column else df.where(F.col("attribute_name") == attribute).select("product_id", "attribute_value")
    return rows.groupBy("product_id").agg(F.min("attribute_value").alias("attribute_value"))


def coverage(label: str, df: DataFrame, column: str = "date", conditions: Sequence[str] = ()) -> DataFrame:
    """First and last date of a source, of all its rows and of those that its conditions keep, and both counts."""
    keep, day = kept(conditions), F.col(column).cast("date")
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.min(F.when(keep, day)).alias("kept_first_day"), F.max(F.when(keep, day)).alias("kept_last_day"), F.count("*").alias("n_rows"), F.count(F.when(keep, 1)).alias("kept_rows")).withColumn("source", F.lit(label))


def coverage_table(sources: Mapping[str, tuple[DataFrame, Mapping[str, tuple[str, Sequence[str]]]]]) -> DataFrame:
    """``source``, ``label``, ``first_day``, ``last_day`` and ``n_rows``: by source the labels of what it offers, each with a date
    column and conditions (null counts as not met). A source is read once for all of its labels; a label without rows has
    null dates and 0."""
    out = []
    for source, (df, labels) in sources.items():
        spans = []
        for label, (column, conditions) in labels.items():
            keep, day = kept(conditions), F.col(column).cast("date")
            spans.append(F.struct(F.lit(label).alias("label"), F.min(F.when(keep, day)).alias("first_day"), F.max(F.when(keep, day)).alias("last_day"), F.count(F.when(keep, 1)).alias("n_rows")))
        out.append(df.agg(F.array(*spans).alias("spans")).select(F.lit(source).alias("source"), F.inline("spans")))
    return reduce(DataFrame.unionByName, out)


def preview(df: DataFrame, column: str, start: str, end: str, rows: int = 20) -> tuple[int, DataFrame]:
    """How many rows a window has, and the first few of them."""
    inside = window(df, column, start, end)
    return inside.count(), inside.limit(rows)


def daily_data(spark: SparkSession, path: str, columns: Mapping[str, str], start: str, end: str, conditions: Sequence[str] = ("usable = 1",), fmt: str = "parquet") -> DataFrame:
    """Daily product-store rows of a window under the source's conditions, with typed dates."""
    rows = expressions(renamed(read(spark, path, fmt), columns), conditions)
    return window(rows, "date", start, end).withColumn("date", F.to_date("date"))
