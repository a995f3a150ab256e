"""The 23 measures for every period and slice at once.

Every family of metrics is brought to states that add up: sums, and days as bits of a mask, by product and week. The states
of all families are one union with a column for each, which is summed by slice and week, joined with the bridge of periods
and summed again: no family is joined to another, and each source is read once (daily rows once more for distinct counts).
An average of daily stock is the sum of the stock over the number of days, which are bits that products' masks are or-ed
to. States are labelled with slices after stores are summed away, unless a slice or population reads a place or a measure:
then rows are marked with the roots that they are in, and sums are kept apart by these marks until they are labelled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import at_least_zero, filtered, gated, ratio, value_filter
from .slices import ROOTS, SLICE, Slices

METRICS = (
    "total_sales_quantity", "total_sales_revenue", "AUR", "AUC", "total_inventory", "distinct_product_count", "distinct_store_count",
    "distinct_pair_count", "mean_stock", "mean_stock_retail", "mean_stock_cost", "dc_mean_stock", "total_mean_stock", "WOS", "wos_revenue",
    "wos_cost", "WOS_DC", "WOS_TOTAL", "inventory_turnover_rate", "in_stock_rate", "weighted_instock_rate", "dc_in_stock_rate", "lost_sales_pct",
)
KEYS = ["period_type", "period", "root", "dimension", "dimension_value"]
#: Metric, column of stock without and with transit (None: warehouse stock only), column of sales.
SUPPLY = {
    "WOS": ("inventory", "inventory_git", "sales_quantity"), "wos_revenue": ("inventory_retail", "inventory_retail_git", "sales_revenue"),
    "wos_cost": ("inventory_cost", "inventory_cost_git", "sales_cost"), "WOS_DC": (None, None, "sales_quantity"), "WOS_TOTAL": ("inventory", "inventory_git", "sales_quantity"),
}
STOCK = {"mean_stock": ("inventory", "inventory_git"), "mean_stock_retail": ("inventory_retail", "inventory_retail_git"), "mean_stock_cost": ("inventory_cost", "inventory_cost_git")}


@dataclass(frozen=True)
class Facts:
    """The frames that metrics read; those that are None leave their metrics null. ``daily``: ``facts.scoped_daily``;
    ``instock``: in-stock days by pair and week; ``dc_daily``: product, warehouse, date, inventory, git_quantity,
    has_inventory_row, is_blocked; ``dc_instock``: ``facts.dc_instock``; ``lost``: ``facts.lost_base``."""

    daily: DataFrame
    instock: DataFrame | None = None
    dc_daily: DataFrame | None = None
    dc_instock: DataFrame | None = None
    lost: DataFrame | None = None


@dataclass(frozen=True)
class Rules:
    """``metrics``: which are reported. ``gated``: those that leave out blocked days. ``transit``: those whose stock
    includes goods in transit. ``populations``: value filters by column for a metric, for its
    whole group."""

    metrics: tuple[str, ...] = METRICS
    gated: frozenset[str] = frozenset()
    transit: frozenset[str] = frozenset()
    populations: Mapping[str, Mapping] = field(default_factory=dict)

    def __post_init__(self):
        known = set(METRICS)
        for name in {*self.metrics, *self.gated, *self.transit, *self.populations}:
            if name not in known:
                raise ValueError(f"unknown metric {name}")


#: Metrics that are computed together: a population filter of one holds for all of its group.
GROUPS = {
    "sales": ("total_sales_quantity", "total_sales_revenue", "AUR", "AUC", "total_inventory", "distinct_product_count", "distinct_store_count", "distinct_pair_count"),
    "wos": ("WOS", "wos_revenue", "wos_cost"), "wos_dc_total": ("WOS_DC", "WOS_TOTAL"), "mean_stock": tuple(STOCK), "dc_inventory": ("dc_mean_stock", "total_mean_stock"),
    "turnover": ("inventory_turnover_rate",), "instock": ("in_stock_rate",), "weighted_instock": ("weighted_instock_rate",), "dc_instock": ("dc_in_stock_rate",), "lost_sales": ("lost_sales_pct",),
}
MEASURES = {"sales_revenue", "sales_quantity", "sales_cost", "inventory", "inventory_retail", "inventory_cost", "inventory_git", "inventory_retail_git", "inventory_cost_git"}
WEEK = ["year", "week", "part"]


def conditions(rules: Rules, group: str) -> dict[str, object]:
    """The group's population filters by column; an error if two of its metrics filter a column differently."""
    merged: dict[str, object] = {}
    for metric in GROUPS[group]:
        for column, spec in (rules.populations.get(metric) or {}).items():
            if merged.setdefault(column, spec) != spec:
                raise ValueError(f"metrics of the group {group} have different populations of {column}")
    return merged


def member(rules: Rules, group: str) -> Column:
    """Whether a row is of the group's population."""
    return reduce(lambda a, f: a & value_filter(*f), conditions(rules, group).items(), F.lit(True))


def population(rows: DataFrame, rules: Rules, group: str, products: DataFrame) -> DataFrame:
    """The rows of products that the group's population filters take."""
    found = conditions(rules, group)
    return rows.join(filtered(products, found).select("product_id"), "product_id", "left_semi") if found else rows


def kpi_table(facts: Facts, slices: Slices, periods: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """One row per period and slice that has a sales row, with the reported metrics.

    A slice whose value is null has only the sales family and the pair counts. Rows of products that the master lacks are
    in slices that null attributes are in, but for sales, whose rows had to know their product. ``periods``:
    ``calendar.period_bridge``; a frame without ``part`` has whole weeks. States of no rows are null, not 0.
    """
    wanted = set(rules.metrics)
    every = {c for g in GROUPS if wanted & set(GROUPS[g]) for c in conditions(rules, g)}
    states = [_daily_states(facts.daily, slices, rules, wanted, every)]
    if facts.dc_daily is not None and wanted & {"dc_mean_stock", "total_mean_stock", "WOS_DC", "WOS_TOTAL"}:
        states.append(_warehouse_states(facts.dc_daily, slices, rules, wanted, every))
    supply = [m for m in SUPPLY if m in wanted]
    whole = _merged(states, [*SLICE, "product_id", *WEEK, "day"])[0] if len(states) > 1 and {"WOS_DC", "WOS_TOTAL"} & wanted else _union(states)
    if supply:
        whole = _weeks_of_supply(whole, supply)
    more = []
    instock, dc_instock, lost = facts.instock, facts.dc_instock, facts.lost
    if instock is not None and wanted & {"in_stock_rate", "weighted_instock_rate"}:
        both = {"is": ("in_stock_rate", "instock"), "wi": ("weighted_instock_rate", "weighted_instock")}
        more.append(_summed(instock, slices, rules, every, {f"{p}_{name}": (group, c) for p, (m, group) in both.items() if m in wanted for name, c in (("stocked", "stocked_pairs"), ("days", "available_days"))}))
    if dc_instock is not None and "dc_in_stock_rate" in wanted:
        more.append(_summed(dc_instock, slices, rules, every, {"di_stocked": ("dc_instock", "dc_stocked_days"), "di_days": ("dc_instock", "dc_available_days")}))
    if lost is not None and "lost_sales_pct" in wanted:
        more.append(_summed(lost, slices, rules, every, {"lost": ("lost_sales", "lost_sales"), "could": ("lost_sales", "could_sell")}))
    labelled = _union([whole, *more]).drop("product_id")
    if "total_mean_stock" in wanted:  # the only one that needs a day's stores and warehouses together
        labelled, _ = _merged([labelled], [*SLICE, *WEEK, "day"])
        dc = F.coalesce("td_dc", F.lit(0.0)) if "td_dc" in labelled.columns else F.lit(0.0)
        counts = F.coalesce(F.bit_count("td_mask") > 0, F.lit(False))
        labelled = labelled.withColumns({"total_value": F.when(counts, F.col("td_stock") + dc), "total_days": F.when(counts, F.lit(1).cast("long"))}).drop("td_stock", "td_mask", "td_dc", "day")
    weekly, masks = _merged([labelled], [*SLICE, *WEEK])
    derived = {f"{m}_days" if m.endswith("_mask") else m: F.bit_count(m).cast("long") for m in masks}
    if "wi_days" in weekly.columns:
        rate = at_least_zero(ratio(F.col("wi_stocked"), F.col("wi_days")))
        derived |= {"wi_value": F.when(F.col("wi_days").isNotNull(), rate * F.col("wi_units")), "wi_weight": F.when(F.col("wi_days").isNotNull(), F.col("wi_units"))}
    weekly = weekly.withColumns(derived).drop(*masks, "wi_stocked", "wi_units")
    bridge = periods.withColumns({c: F.lit(v).cast(t) for c, v, t in (("part", 0, "int"), ("family", None, "string")) if c not in periods.columns})
    sums = [c for c in weekly.columns if c not in (*SLICE, *WEEK)]
    of_lost = {"lost", "could"}
    own = lambda c: F.when(F.col("family").isNull() | (F.col("family") == F.lit("lost" if c in of_lost else "daily")), F.col(c)).alias(c)
    spread = weekly.join(F.broadcast(bridge), WEEK).select(*KEYS, *map(own, sums))  # the bridge has as many rows as the calendar has weeks and kinds
    parts = [spread]
    if wanted & {"distinct_product_count", "distinct_store_count", "distinct_pair_count"}:
        parts += _distinct_counts(facts.daily, slices, rules, wanted, every, bridge)
    table = _merged(parts, KEYS)[0].where("sold > 0")
    return table.select(*KEYS, *[_final(m, table.columns).alias(m) for m in rules.metrics])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _merged(parts: list[DataFrame], keys: list[str]) -> tuple[DataFrame, list[str]]:
    """States of all parts by the keys that they have: sums, and masks or-ed; and the names of the masks."""
    rows = _union(parts)
    keys = [k for k in keys if k in rows.columns]
    masks = [c for c in rows.columns if c.endswith("_mask")]
    sums = [c for c in rows.columns if c not in keys and c not in masks]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.bit_or(c).alias(c) for c in masks]), masks


def _framed(rows: DataFrame, slices: Slices, rules: Rules, every: set[str]) -> tuple[DataFrame, bool]:
    """Rows with ``part`` and all that populations read, and whether they had to be marked with slices before sums."""
    if "part" not in rows.columns:
        rows = rows.withColumn("part", F.lit(0))
    places = {c for t in (slices.stores, slices.warehouses) if t is not None for c in t.columns}
    first = bool((slices.reads() | every) & (MEASURES | places | {"store_id", "warehouse_id"}))
    rows = slices.attached(rows, every)
    return (slices.marked(rows) if first else rows), first


def _by_product(rows: DataFrame, first: bool, slices: Slices, aggregates: dict[str, Column], extra: tuple[str, ...] = ()) -> DataFrame:
    """One aggregation to product and week, of each kind of marks if there are any, then labelled with slices."""
    marks = slices.marks() if first else []
    keys = [*(["product_id"] if "product_id" in rows.columns else []), *WEEK, *extra]
    summed = rows.groupBy(*marks, *keys).agg(*[c.alias(name) for name, c in aggregates.items()])
    states = slices.labelled(summed).select(*SLICE, *keys, *aggregates)
    if not first:
        return states
    again = lambda name: F.bit_or(name) if name.endswith("_mask") else F.max(name) if name == "week_days" else F.sum(name)
    return states.groupBy(*SLICE, *keys).agg(*[again(name).alias(name) for name in aggregates])  # rows of different marks may be in one slice


def _day_bit() -> Column:
    """A bit for the day; two days of a week have different bits."""
    return F.expr("shiftleft(1L, cast(pmod(unix_date(date), 64) as int))")


def _gate(rules: Rules, metric: str, value: Column) -> Column:
    return gated(value, metric in rules.gated)


def _day_stock(rules: Rules, metric: str, plain: str, moving: str) -> tuple[Column, Column]:
    """Stock of a row and whether its day counts."""
    transit = metric in rules.transit
    counts = F.col("has_stock_row" if transit else "has_daily_row")
    value = F.col(moving) if transit else F.when(counts, F.col(plain))
    return _gate(rules, metric, value), counts & ~F.col("is_blocked") if metric in rules.gated else counts


def _sold(rules: Rules, wanted: set[str]) -> Column:
    return F.col("has_sales_row") & (~F.col("is_blocked") if wanted <= rules.gated else F.lit(True))


def _daily_states(daily: DataFrame, slices: Slices, rules: Rules, wanted: set[str], every: set[str]) -> DataFrame:
    rows, first = _framed(daily, slices, rules, every)
    of, gate = (lambda group: member(rules, group)), (lambda m, c: _gate(rules, m, F.col(c)))
    sold = _sold(rules, wanted) & of("sales")
    states = {"sold": F.sum(F.when(sold, F.lit(1).cast("long")))}
    for m, c in (("total_sales_quantity", "sales_quantity"), ("total_sales_revenue", "sales_revenue")):
        states[m] = F.sum(F.when(sold, gate(m, c)))
    if "total_inventory" in rules.transit:
        states["total_inventory"] = F.sum(F.when(of("sales"), gate("total_inventory", "inventory_git")))
    else:
        states["total_inventory"] = F.sum(F.when(sold, gate("total_inventory", "inventory")))
    for m, c in (("AUR", "sales_revenue"), ("AUC", "sales_cost")):
        states |= {f"{m}_value": F.sum(F.when(sold, gate(m, c))), f"{m}_units": F.sum(F.when(sold, gate(m, "sales_quantity")))}
    states = {n: c for n, c in states.items() if n == "sold" or n.rsplit("_", 1)[0] in wanted or n in wanted}
    for m in (*STOCK, "inventory_turnover_rate"):
        if m in wanted:
            group = "turnover" if m == "inventory_turnover_rate" else "mean_stock"
            value, counts = _day_stock(rules, m, *STOCK.get(m, STOCK["mean_stock"]))
            states |= {f"{m}_stock": F.sum(F.when(of(group), value)), f"{m}_mask": F.bit_or(F.when(of(group) & counts, _day_bit()))}
    units = lambda group, m: F.sum(F.when(F.col("has_sales_row") & of(group), gate(m, "sales_quantity")))
    if "inventory_turnover_rate" in wanted:
        states["turnover_units"] = units("turnover", "inventory_turnover_rate")
    if "weighted_instock_rate" in wanted:
        states["wi_units"] = units("weighted_instock", "weighted_instock_rate")
    for m in SUPPLY:
        if m in wanted:
            plain, moving, sales = SUPPLY[m]
            group = of("wos_dc_total" if m in GROUPS["wos_dc_total"] else "wos")
            states[f"{m}_sales"] = F.sum(F.when(group, gate(m, sales)))
            states["week_days"] = F.max("week_days")
            if plain:
                value, counts = _day_stock(rules, m, plain, moving)
                states |= {f"{m}_stock": F.sum(F.when(group, value)), f"{m}_mask": F.bit_or(F.when(group & counts, _day_bit()))}
    whole = _by_product(rows, first, slices, states)
    if "total_mean_stock" not in wanted:
        return whole
    value, counts = _day_stock(rules, "total_mean_stock", *STOCK["mean_stock"])
    group = of("dc_inventory")
    days = _by_product(rows.withColumn("day", F.col("date")), first, slices, {"td_stock": F.sum(F.when(group, value)), "td_mask": F.bit_or(F.when(group & counts, _day_bit()))}, ("day",))
    return _union([whole, days])


def _warehouse_states(days: DataFrame, slices: Slices, rules: Rules, wanted: set[str], every: set[str]) -> DataFrame:
    rows, first = _framed(days.withColumn("inventory_git", F.col("inventory") + F.col("git_quantity")), slices, rules, every)
    stock = lambda m: _gate(rules, m, F.col("inventory_git") if m in rules.transit else F.when(F.col("has_inventory_row"), F.col("inventory")))
    states = {}
    for m in ("dc_mean_stock", "WOS_DC", "WOS_TOTAL"):
        if m in wanted:
            value = F.when(member(rules, "dc_inventory" if m == "dc_mean_stock" else "wos_dc_total"), stock(m))
            states |= {f"{m}_dc": F.sum(value), f"{m}_dc_mask": F.bit_or(F.when(value.isNotNull(), _day_bit()))}
    parts = [_by_product(rows, first, slices, states)] if states else []
    if "total_mean_stock" in wanted:
        parts.append(_by_product(rows.withColumn("day", F.col("date")), first, slices, {"td_dc": F.sum(F.when(member(rules, "dc_inventory"), stock("total_mean_stock")))}, ("day",)))
    return _union(parts)


def _weeks_of_supply(states: DataFrame, supply: list[str]) -> DataFrame:
    """A product's average stock of a day, weighed by the share of the week that is in, where the week has sold anything."""
    mean = lambda value, mask: F.try_divide(F.col(value), F.bit_count(mask))
    values, gone = {}, ["week_days"]
    for m in supply:
        value = F.lit(0.0)
        if SUPPLY[m][0]:
            value = mean(f"{m}_stock", f"{m}_mask")
            gone += [f"{m}_stock", f"{m}_mask"]
        if f"{m}_dc" in states.columns:
            value += F.coalesce(mean(f"{m}_dc", f"{m}_dc_mask"), F.lit(0.0))
            gone += [f"{m}_dc", f"{m}_dc_mask"]
        values[f"{m}_value"] = F.when(F.col(f"{m}_sales") > 0, value * F.col("week_days") / 7.0)
    return states.withColumns(values).drop(*gone)


def _summed(rows: DataFrame, slices: Slices, rules: Rules, every: set[str], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Sums of a frame's columns by product and week, each of its group's population."""
    framed, first = _framed(rows, slices, rules, every)
    return _by_product(framed, first, slices, {name: F.sum(F.when(member(rules, group), F.col(c))) for name, (group, c) in columns.items()})


def _distinct_counts(daily: DataFrame, slices: Slices, rules: Rules, wanted: set[str], every: set[str], bridge: DataFrame) -> list[DataFrame]:
    """Products, stores and pairs of each period and slice, as states that add up. A product's rows are brought together once;
    periods of a pair or of a slice's store are one list, without the repeats of its weeks, so pairs are neither shuffled nor
    kept by period."""
    rows, first = _framed(daily, slices, rules, every)
    rows = rows.where(_sold(rules, wanted) & member(rules, "sales"))
    bridge = bridge.where("family is null or family = 'daily'")
    named = bridge.select("period_type", "period").distinct().withColumn("id", F.row_number().over(Window.orderBy("period_type", "period")))  # as many rows as the calendar has periods
    ids = F.broadcast(bridge.join(F.broadcast(named), ["period_type", "period"]).groupBy(*WEEK).agg(F.collect_set("id").alias("ids")))
    gate = bool(rules.gated & set(GROUPS["sales"]))
    one = lambda m: F.when(_gate(rules, m, F.lit(True)).isNotNull(), F.lit(1).cast("long"))

    def listed(frame: DataFrame, keys: list[str], numbers: Column) -> DataFrame:
        """Each key once for each number of its rows, blocked if all of its rows there are."""
        held = frame.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_set(numbers))).alias("all"), *([F.flatten(F.collect_set(F.when(~F.col("is_blocked"), numbers))).alias("free")] if gate else []))
        blocked = (lambda i: ~F.array_contains("free", i)) if gate else lambda i: F.lit(False)
        return held.select(*keys, F.inline(F.transform("all", lambda i: F.struct(i.alias("id"), blocked(i).alias("is_blocked")))))

    out = []
    if wanted & {"distinct_product_count", "distinct_pair_count"}:
        marks, roots = slices.marks() if first else [], len(slices.roots)
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.select(*marks, "product_id", "store_id", *WEEK, "is_blocked").repartition(parts, "product_id").join(ids, WEEK)
        numbers = F.flatten(F.transform("ids", lambda i: F.transform(ROOTS, lambda r: i * roots + r))) if first else F.col("ids")
        pairs = listed(placed, [*marks[1:], "product_id", "store_id"], numbers)
        products = pairs.groupBy(*marks[1:], "id", "product_id").agg(F.max(one("distinct_product_count")).alias("n_products"), F.sum(one("distinct_pair_count")).alias("n_pairs"))
        if first:
            products = products.withColumns({ROOTS: F.array((F.col("id") % roots).cast("int")), "id": F.expr(f"id div {roots}")})
        products = slices.labelled(products)
        if first:  # a product's stores may have different marks
            products = products.groupBy(*SLICE, "id", "product_id").agg(F.max("n_products").alias("n_products"), F.sum("n_pairs").alias("n_pairs"))
        out.append(products.join(F.broadcast(named), "id").select(*KEYS, "n_products", "n_pairs"))
    if "distinct_store_count" in wanted:
        stores = listed(slices.labelled(rows).select(*SLICE, "store_id", *WEEK, "is_blocked").join(ids, WEEK), [*SLICE, "store_id"], F.col("ids"))
        out.append(stores.withColumn("n_stores", one("distinct_store_count")).join(F.broadcast(named), "id").select(*KEYS, "n_stores"))
    return out


def _final(metric: str, known: list[str]) -> Column:
    """A metric of a period's states; null where its frame was not there, and for slices of a null value unless it is of the
    sales family."""
    col = F.col
    of = {
        "AUR": ("AUR_value", lambda: ratio(col("AUR_value"), col("AUR_units"))), "AUC": ("AUC_value", lambda: ratio(col("AUC_value"), col("AUC_units"))),
        "distinct_product_count": ("n_products", lambda: F.coalesce("n_products", F.lit(0))), "distinct_store_count": ("n_stores", lambda: F.coalesce("n_stores", F.lit(0))), "distinct_pair_count": ("n_pairs", lambda: F.coalesce("n_pairs", F.lit(0))),
        "inventory_turnover_rate": ("turnover_units", lambda: ratio(col("turnover_units"), ratio(col("inventory_turnover_rate_stock"), col("inventory_turnover_rate_mask_days")))),
        "dc_mean_stock": ("dc_mean_stock_dc", lambda: ratio(col("dc_mean_stock_dc"), col("dc_mean_stock_dc_mask_days"))), "total_mean_stock": ("total_value", lambda: ratio(col("total_value"), col("total_days"))),
        "in_stock_rate": ("is_days", lambda: F.when(col("is_days").isNotNull(), at_least_zero(ratio(col("is_stocked"), col("is_days"))))), "weighted_instock_rate": ("wi_value", lambda: ratio(col("wi_value"), col("wi_weight"))),
        "dc_in_stock_rate": ("di_days", lambda: F.when(col("di_days").isNotNull(), at_least_zero(ratio(col("di_stocked"), col("di_days"))))), "lost_sales_pct": ("lost", lambda: ratio(col("lost"), col("could")) * 100),
    } | {m: (f"{m}_stock", lambda m=m: ratio(col(f"{m}_stock"), col(f"{m}_mask_days"))) for m in STOCK} | {m: (f"{m}_sales", lambda m=m: ratio(col(f"{m}_value"), col(f"{m}_sales"))) for m in SUPPLY}
    needs, value = of.get(metric, (metric, lambda: col(metric)))
    if needs not in known:
        return F.lit(None).cast("double")
    return value() if metric in GROUPS["sales"] else F.when(col("dimension_value").isNotNull(), value())


def unpivoted(table: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """``table``'s metrics as rows of ``metric_key`` and ``value``."""
    names = list(metrics)
    stack = ", ".join(f"'{m}', cast(`{m}` as double)" for m in names)
    return table.selectExpr(*KEYS, f"stack({len(names)}, {stack}) as (metric_key, value)")
