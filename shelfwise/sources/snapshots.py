"""Saved result tables: one folder per run date, merged by key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = {
    "kpi_long": ["period_type", "period", "root", "dimension", "dimension_value"],
    "comparison": ["comparison_type", "root", "dimension", "dimension_value", "metric_key", "current_period"],
    "scope_diff": ["year", "metric"],
}
MODES = ("initial", "incremental", "full_refresh")


def run_dates(spark: SparkSession, root: str, table: str) -> list[str]:
    """Run dates that a table was saved for, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n.removeprefix("run_date=") for n in names if n.startswith("run_date="))


def latest(spark: SparkSession, root: str, table: str, until: str) -> DataFrame | None:
    """The table of the last run date up to ``until``; None if there is none."""
    found = [d for d in run_dates(spark, root, table) if d <= until]
    return spark.read.parquet(f"{root}/{table}/run_date={found[-1]}") if found else None


def keyed(df: DataFrame, keys: Sequence[str]):
    """Keys as text, null as such, for comparing tables whose types drifted."""
    return F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))


def merged(saved: DataFrame, new: DataFrame, keys: Sequence[str], overwrite: bool = False, always: str | None = None) -> DataFrame:
    """Saved rows with new ones: new keys are appended; of keys in both the saved row stays, or the new one with
    ``overwrite``, or where the SQL condition ``always`` holds for it (and then no saved row under it stays)."""
    old = saved.where(~F.coalesce(F.expr(always), F.lit(False))) if always else saved
    old, fresh = old.withColumn("_key", keyed(old, keys)), new.withColumn("_key", keyed(new, keys))
    if overwrite:
        old = old.join(fresh.select("_key"), "_key", "left_anti")
    else:
        fresh = fresh.join(old.select("_key"), "_key", "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True).drop("_key")


def plan(saved: DataFrame | None, new: DataFrame, keys: Sequence[str], overwrite: bool = False, always: str | None = None) -> DataFrame:
    """How many new rows would be appended, overwrite a saved one, or be skipped."""
    fresh = new.withColumn("_key", keyed(new, keys)).withColumn("_always", F.coalesce(F.expr(always), F.lit(False)) if always else F.lit(False))
    known = saved.select(keyed(saved, keys).alias("_key"), F.lit(True).alias("_known")).distinct() if saved is not None else None
    both = fresh.join(known, "_key", "left") if known is not None else fresh.withColumn("_known", F.lit(None).cast("boolean"))
    action = F.when(F.col("_known").isNull(), "append").when(F.lit(overwrite) | F.col("_always"), "overwrite").otherwise("skip")
    return both.groupBy(action.alias("action")).agg(F.count("*").alias("n"))


def stamped(df: DataFrame, as_of: str, saved_at: str) -> DataFrame:
    """``df`` with its run and time of saving where it has none yet."""
    for name, value in (("_run_as_of", as_of), ("_saved_at", saved_at)):
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))
    return df


def save_recomputed(df: DataFrame, root: str, table: str, run_date: str, keys: Sequence[str], comparisons: Mapping[str, Callable[[DataFrame], DataFrame]], overwrite: bool = False, always: str | None = None, saved_at: str = "") -> DataFrame | None:
    """Merges a table onto its last run and saves what is compared anew from all its periods, whole, so that a comparison
    can reach back beyond this run. ``comparisons``: table name to a function of the merged table, which is returned."""
    save(df, root, table, run_date, keys, "incremental", overwrite, always, saved_at)
    history = latest(df.sparkSession, root, table, run_date)
    for name, compared in comparisons.items() if history is not None else ():
        save(compared(history), root, name, run_date, KEYS["comparison"], "full_refresh", saved_at=saved_at)
    return history


def save(df: DataFrame, root: str, table: str, run_date: str, keys: Sequence[str], mode: str = "incremental", overwrite: bool = False, always: str | None = None, saved_at: str = "") -> bool:
    """Saves a table for a run date; whether it had rows (an empty one is never written). ``initial`` refuses if any
    run is there; ``incremental`` merges onto the last run up to this one; ``full_refresh`` writes the rows as they are."""
    spark = df.sparkSession
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if mode == "initial" and run_dates(spark, root, table):
        raise ValueError(f"{table} has runs already")
    if df.isEmpty():
        return False
    rows = stamped(df, run_date, saved_at)
    saved = latest(spark, root, table, run_date) if mode == "incremental" else None
    if saved is not None:
        rows = merged(saved, rows, keys, overwrite, always)
    target, staged = f"{root}/{table}/run_date={run_date}", f"{root}/{table}/_staged-{run_date}"
    rows.write.mode("overwrite").parquet(staged)  # the merge may read what it replaces
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(at(target), True)  # the staged rows are whole by now
    if not files.rename(at(staged), at(target)):
        raise OSError(f"{staged} could not be renamed to {target}; its rows are whole")
    return True
