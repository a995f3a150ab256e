"""Roots (populations) and cuts (breakdowns): the slices that rows are in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import value_filter

SLICE = ["root", "dimension", "dimension_value"]
ROOTS = "_roots"


def derived(products: DataFrame, dimensions: Mapping[str, str]) -> DataFrame:
    """``products`` with columns from SQL expressions."""
    return products.withColumns({name: F.expr(sql) for name, sql in dimensions.items()})


@dataclass(frozen=True)
class Slices:
    """Which slices a row is in: every root (value filters by column; none for all rows) by every cut (a string column; None
    for the whole), where the cut's own filter keeps it. A null value is a slice of its own unless a filter drops it.

    Columns are those of ``products`` (by product_id), of ``stores`` (by store_id) and of ``warehouses`` (by warehouse_id),
    or the frame's own, a measure for instance. Attributes are looked up, so a row of an unknown product or place stays,
    with nulls; a column that a frame cannot tell of, as a store's of a warehouse row, is null there too."""

    products: DataFrame
    roots: Mapping[str, Mapping] = field(default_factory=lambda: {"overall": {}})
    cuts: Sequence[str | None] = (None,)
    cut_filters: Mapping[str, object] = field(default_factory=dict)
    stores: DataFrame | None = None
    warehouses: DataFrame | None = None

    def __post_init__(self):
        types = dict(self.products.dtypes) | {c: t for place in (self.stores, self.warehouses) if place is not None for c, t in place.dtypes}
        for cut in self.cuts:
            if cut is not None and types.get(cut) != "string":
                raise ValueError(f"cut {cut} is not a string column of the products, stores or warehouses")

    def reads(self) -> set[str]:
        """Columns that roots, cuts and their filters read."""
        return {c for conditions in self.roots.values() for c in conditions} | {c for c in self.cuts if c}

    def attached(self, rows: DataFrame, wanted: set[str]) -> DataFrame:
        """``rows`` with these columns."""
        for table, key in ((self.products, "product_id"), (self.stores, "store_id"), (self.warehouses, "warehouse_id")):
            new = [c for c in sorted(wanted) if table is not None and c in table.columns and c not in rows.columns]
            if new and key in rows.columns:
                rows = rows.join(table.select(key, *new), key, "left")
        return rows.withColumns({c: F.lit(None).cast("string") for c in sorted(wanted) if c not in rows.columns})

    def marks(self) -> list[str]:
        """Columns of ``marked`` rows that say which slices they are in."""
        return [ROOTS, *dict.fromkeys(c for c in self.cuts if c)]

    def marked(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the numbers of the roots that they are in, and the cuts' columns: rows with equal ``marks`` are in the
        same slices, so that they can be summed before they are ``labelled``. Rows of no root drop out."""
        keep = [F.when(reduce(lambda a, f: a & value_filter(*f), conditions.items(), F.lit(True)), F.lit(k)) for k, conditions in enumerate(self.roots.values())]
        return self.attached(rows, self.reads()).withColumn(ROOTS, F.array_compact(F.array(*keep))).where(F.size(ROOTS) > 0)

    def labelled(self, rows: DataFrame) -> DataFrame:
        """A copy of each row, of ``marked`` ones too, for every slice that it is in, named by ``root``, ``dimension`` and
        ``dimension_value``."""
        rows, labels = rows if ROOTS in rows.columns else self.marked(rows), []
        for k, root in enumerate(self.roots):
            for cut in self.cuts:
                keep = F.array_contains(ROOTS, F.lit(k))
                if cut in self.cut_filters:
                    keep &= value_filter(cut, self.cut_filters[cut])
                value = F.lit("overall") if cut is None else F.col(cut)
                labels.append(F.when(keep, F.struct(F.lit(root).alias("root"), F.lit(cut or "overall").alias("dimension"), value.alias("dimension_value"))))
        return rows.withColumn("_slice", F.explode(F.array_compact(F.array(*labels)))).select("*", *[F.col(f"_slice.{c}") for c in SLICE]).drop("_slice", ROOTS)


def trim_recent(table: DataFrame, limits: Mapping[str, int], weeks: DataFrame | None = None) -> DataFrame:
    """The most recent periods of each kind that has a limit; other kinds whole. With ``weeks``, those of the window, the
    limit of weeks counts weeks of the calendar, whether they have rows or not."""
    if weeks is not None and "week" in limits:
        recent = F.broadcast(weeks.orderBy(F.desc("week_start_date")).limit(limits["week"]).select(F.lit("week").alias("period_type"), F.col("year_week").alias("period")))
        others = {k: v for k, v in limits.items() if k != "week"}
        return trim_recent(table.where("period_type <> 'week'"), others).unionByName(table.join(recent, ["period_type", "period"], "left_semi").select(*table.columns))
    if not limits:
        return table
    rank = F.dense_rank().over(Window.partitionBy("period_type").orderBy(F.desc("period")))
    limit = reduce(lambda a, item: F.when(F.col("period_type") == item[0], item[1]).otherwise(a), limits.items(), F.lit(2**31 - 1))
    return table.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")
