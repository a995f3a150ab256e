"""Daily facts from a stream of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def transactions(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def daily_sales(sales: DataFrame, late: str = "7 days") -> DataFrame:
    """Sales per product, store and day of a stream with a column ``sold_at``; days close when the watermark passes."""
    day = F.window("sold_at", "1 day")
    summed = sales.withWatermark("sold_at", late).groupBy("product_id", "store_id", day.alias("day")).agg(F.sum("sales_revenue").alias("sales_revenue"), F.sum("sales_quantity").alias("sales_quantity"))
    return summed.select("product_id", "store_id", F.to_date("day.start").alias("date"), "sales_revenue", "sales_quantity")


def append(daily: DataFrame, folder: str, checkpoint: str):
    """Closed days appended to a table partitioned by date, each batch once."""
    return daily.writeStream.outputMode("append").format("parquet").option("path", folder).option("checkpointLocation", checkpoint).partitionBy("date").trigger(availableNow=True).start()
