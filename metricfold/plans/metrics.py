"""The six metrics as declarative specifications.

A :class:`MetricSpec` says which fact table it reads, which columns it needs,
how to reduce an increment to an additive *partial* (``keys`` + ``sums``), and
how to turn the merged partials into the result users read.  Storage only ever
holds the partials, so merging increments is a plain ``sum`` per key; ranks,
means, shares and names are derived at read time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.functions.columns import first_positive
from metricfold.operators.aggregates import (
    count_non_null,
    mean_from_parts,
    share_of_total,
    sum_by,
)
from metricfold.operators.joins import attach, attach_where, side_by_side, with_dimension
from metricfold.operators.ranking import check_direction, position_within, rank_within, top_n
from metricfold.operators.reductions import Reduction, reduced
from metricfold.plans.analogues import (
    REASON_COLUMNS,
    lead_by_weekday,
    lead_sums,
    reason_sums,
    route_lines,
    user_day,
    with_origin,
)

Partial = Callable[[Mapping[str, DataFrame], DataFrame], DataFrame]
Finalize = Callable[[Mapping[str, DataFrame], DataFrame, int, str], DataFrame]


@dataclass(frozen=True)
class MetricSpec:
    name: str
    source: str                                   # fact table whose day drives increments
    required: Mapping[str, tuple[str, ...]]       # table -> columns the metric reads
    keys: tuple[str, ...]                         # partial's group columns ((): global)
    sums: tuple[str, ...]                         # partial's additive columns
    finalize: Finalize                            # (tables, merged, top, order) -> result
    # How an increment becomes the partial (keys + sums): a reduction of its rows, which several
    # metrics of one fact table share a scan for, and what is made of the reduced rows ...
    reduction: Reduction | None = None
    finish: Partial | None = None                 # (tables, reduced rows) -> keys + sums
    # ... or any other way: (tables, increment) -> keys + sums.
    custom: Partial | None = None
    top: int = 10
    order: str = "desc"
    # The form a stream stores, where ``partial`` adds up only over whole days.
    streamed: MetricSpec | None = None
    # Whether the top result is a top-N (False: a rank depth per group, as long as the groups).
    bounded_top: bool = True
    # (tables, saved full result) -> partial, where a result saved elsewhere can be added to.
    import_saved: Partial | None = None
    # The sum, never negative, that a top-N is ordered by: windows keep heads of it.  ``known`` (tables, rows) keeps
    # the rows whose keys the result can name.
    ranked: str | None = None
    known: Partial | None = None
    description: str = field(default="", compare=False)

    def partial(self, tables: Mapping[str, DataFrame], rows: DataFrame) -> DataFrame:
        """``keys + sums`` of an increment's rows."""
        if self.custom is not None:
            return self.custom(tables, rows)
        return self.finished(tables, reduced(rows, self.reduction))

    def finished(self, tables: Mapping[str, DataFrame], rows: DataFrame) -> DataFrame:
        """``keys + sums`` of rows that ``reduction`` made."""
        return rows if self.finish is None else self.finish(tables, rows)


def one():
    return F.lit(1)


# ---- M1: origins by departures ----------------------------------------------------------

LINES_BY_SUPPLIER = Reduction(keys=lambda: {"l_suppkey": F.col("l_suppkey")}, sums=lambda: {"departures": one()})


def origins_of(tables, by_supplier: DataFrame) -> DataFrame:
    rows = with_origin(by_supplier, tables["supplier"], ["departures"], pre_aggregate=False)
    return sum_by(rows, ["origin"], {"departures": "departures"})


def name_origins(tables, merged: DataFrame) -> DataFrame:
    return attach(merged, tables["nation"], "origin", "n_nationkey", {"n_name": "origin_name"})


def origins_finalize(tables, merged: DataFrame, top: int, order: str) -> DataFrame:
    named = name_origins(tables, merged).select("origin", "origin_name", "departures")
    return top_n(named, ["departures"], top, order, tie_break=["origin_name", "origin"])


def code_of(saved: DataFrame, name: str, dim: DataFrame, dim_key: str, dim_name: str, out: str) -> DataFrame:
    """``saved`` with its names turned back into codes; ValueError unless each name has exactly one."""
    codes = dim.groupBy(F.col(dim_name).alias(name)).agg(
        F.count_distinct(dim_key).alias("__codes"), F.min(dim_key).alias(out))
    coded = saved.join(codes, [name], "left")
    unclear = coded.filter(F.coalesce("__codes", F.lit(0)) != 1).select(name).take(5)
    if unclear:
        raise ValueError(f"saved names without exactly one code: {[row[0] for row in unclear]}")
    return coded.drop("__codes", name)


def saved_count(column: str):
    """A count from a saved result, which may be written as a decimal."""
    return F.col(column).cast("double").cast("bigint").alias(column)


def origins_saved(tables, saved: DataFrame) -> DataFrame:
    saved = saved.select("origin_name", saved_count("departures"))
    return code_of(saved, "origin_name", tables["nation"], "n_nationkey", "n_name", "origin")


TOP_ORIGINS = MetricSpec(
    name="top_origins", source="lineitem",
    required={"lineitem": ("l_suppkey", "l_shipdate"), "supplier": ("s_suppkey", "s_nationkey"),
              "nation": ("n_nationkey", "n_name")},
    keys=("origin",), sums=("departures",), finalize=origins_finalize,
    reduction=LINES_BY_SUPPLIER, finish=origins_of, import_saved=origins_saved,
    ranked="departures", known=lambda tables, rows: with_dimension(rows, tables["nation"], "origin", "n_nationkey"),
    description="departures per origin nation, named, top N",
)


# ---- M2: on-time suppliers --------------------------------------------------------------

ON_TIME_BY_SUPPLIER = Reduction(
    keys=lambda: {"supplier": F.col("l_suppkey")}, sums=lambda: {"on_time": one()}, where=lambda: F.col("l_discount") == 0)


def on_time_finalize(tables, merged: DataFrame, top: int, order: str) -> DataFrame:
    named = attach(merged, tables["supplier"], "supplier", "s_suppkey", {"s_name": "supplier_name"})
    named = named.select("supplier", "supplier_name", "on_time")
    return top_n(named, ["on_time"], top, order, tie_break=["supplier_name", "supplier"])


ON_TIME_SUPPLIERS = MetricSpec(
    name="on_time_suppliers", source="lineitem",
    required={"lineitem": ("l_suppkey", "l_discount", "l_shipdate"),
              "supplier": ("s_suppkey", "s_name")},
    keys=("supplier",), sums=("on_time",), reduction=ON_TIME_BY_SUPPLIER, finalize=on_time_finalize,
    ranked="on_time", known=lambda tables, rows: with_dimension(rows, tables["supplier"], "supplier", "s_suppkey"),
    description="lines with zero discount per supplier, named, top N",
)


# ---- M3: best carriers and destinations per origin --------------------------------------

ON_TIME_LINES = Reduction(
    keys=lambda: {c: F.col(c) for c in ("l_orderkey", "l_suppkey", "l_partkey")}, sums=lambda: {"flights": one()},
    where=lambda: F.col("l_tax") == 0)


def routes_of(tables, lines: DataFrame) -> DataFrame:
    rows = route_lines(lines, tables, "flights")
    return sum_by(rows, ["origin", "carrier", "destination"], {"flights": "flights"})


def routes_partial(tables, lines: DataFrame) -> DataFrame:
    """Route counts of an increment.  Alone, nothing is gained by reducing lines before they are joined."""
    on_time = lines.filter(ON_TIME_LINES.where()).select(*ON_TIME_LINES.keys(), one().alias("flights"))
    return routes_of(tables, on_time)


def ranked_members(routes: DataFrame, member: str, k: int | None, order: str = "asc") -> DataFrame:
    """``<member>_total`` and its dense ``<member>_rank`` (largest total first) per origin.

    Kept are the rows of the ``k`` first ranks (None: all) in ``order``: "asc" from the best,
    "desc" from the last.
    """
    total, rank = f"{member}_total", f"{member}_rank"
    totals = sum_by(routes, ["origin", member], {total: "flights"})
    ranked = rank_within(totals, ["origin"], total, rank)
    if check_direction(order) == "asc":
        return ranked if k is None else ranked.filter(F.col(rank) <= k)
    if k is None:
        return ranked
    return rank_within(ranked, ["origin"], total, "__last", "asc").filter(F.col("__last") <= k).drop("__last")


def ranked_carriers(routes: DataFrame, k: int | None, order: str = "asc") -> DataFrame:
    return ranked_members(routes, "carrier", k, order)


def ranked_destinations(routes: DataFrame, k: int | None, order: str = "asc") -> DataFrame:
    return ranked_members(routes, "destination", k, order)


def ranked_list(routes: DataFrame, k: int | None, order: str = "asc") -> DataFrame:
    """Both rankings of every origin as one long list: ``origin, of_destination, carrier, destination, total, rank``.

    One aggregate over two grouping sets gives the carriers' and the destinations' totals (of the other member
    the row holds null), one exchange by the origin serves every later step.  Kept are the rows of the ``k``
    first ranks, as in :func:`ranked_members`.
    """
    totals = routes.groupingSets([["origin", "carrier"], ["origin", "destination"]], "origin", "carrier", "destination").agg(
        F.grouping("carrier").cast("int").alias("of_destination"), F.sum("flights").alias("total"))
    group = ["origin", "of_destination"]
    ranked = rank_within(totals.repartition("origin"), group, "total", "rank")
    if k is None:
        return ranked
    if check_direction(order) == "asc":
        return ranked.filter(F.col("rank") <= k)
    return rank_within(ranked, group, "total", "__last", "asc").filter(F.col("__last") <= k).drop("__last")


def rank_and_pair(routes: DataFrame, k: int | None, order: str = "asc",
                  name: Callable[[DataFrame], DataFrame] = lambda ranked: ranked,
                  names: Mapping[str, str] | None = None) -> DataFrame:
    """Carriers and destinations of each origin ranked by their totals, side by side by position.

    ``name`` adds name columns to the long list and drops rows of unknown codes, before positions are given;
    ``names`` maps each to the list it belongs to ("carrier" or "destination").  Routes are summed
    inside each task before anything moves, so a hot origin moves one row per member and task.
    """
    ranked = name(ranked_list(routes, k, order))
    first = F.col("rank").asc() if check_direction(order) == "asc" else F.col("rank").desc()
    placed = position_within(ranked, ["origin", "of_destination"], [first, F.col("carrier").asc(), F.col("destination").asc()])
    of = {"carrier": F.col("of_destination") == 0, "destination": F.col("of_destination") == 1}
    columns = [("carrier", "carrier", "carrier"), ("carrier", "total", "carrier_total"), ("carrier", "rank", "carrier_rank"),
               ("destination", "destination", "destination"), ("destination", "total", "destination_total"),
               ("destination", "rank", "destination_rank"), *((member, c, c) for c, member in (names or {}).items())]
    return side_by_side(placed, ["origin", "position"], [(of[member], c, out) for member, c, out in columns])


def departures_finalize(tables, merged: DataFrame, top: int, order: str) -> DataFrame:
    nation = tables["nation"]
    paired = rank_and_pair(
        merged, top, order, names={"destination_name": "destination"},
        name=lambda ranked: attach_where(ranked, F.col("of_destination") == 1, nation, "destination", "n_nationkey",
                                         {"n_name": "destination_name"}))
    return name_origins(tables, paired).select(
        "origin", "origin_name", "position", "carrier", "carrier_total", "carrier_rank",
        "destination", "destination_name", "destination_total", "destination_rank",
    )


ON_TIME_DEPARTURES = MetricSpec(
    name="on_time_departures", source="lineitem",
    required={"lineitem": ("l_orderkey", "l_suppkey", "l_partkey", "l_tax", "l_shipdate"),
              "orders": ("o_orderkey", "o_custkey"), "customer": ("c_custkey", "c_nationkey"),
              "supplier": ("s_suppkey", "s_nationkey"), "part": ("p_partkey", "p_brand"),
              "nation": ("n_nationkey", "n_name")},
    keys=("origin", "carrier", "destination"), sums=("flights",),
    reduction=ON_TIME_LINES, finish=routes_of, custom=routes_partial, finalize=departures_finalize, top=3, order="asc", bounded_top=False,
    description="zero-tax lines: carrier and destination totals per origin, dense rank <= top",
)


# ---- M4: mean lead time per weekday -----------------------------------------------------

LINES_BY_ORDER = Reduction(keys=lambda: {"l_orderkey": F.col("l_orderkey")}, sums=lead_sums)


def lead_finalize(tables, merged: DataFrame, top: int, order: str) -> DataFrame:
    means = mean_from_parts(merged, "lead_sum", "lead_count", "average_lead")
    return top_n(means, ["average_lead"], top, order, tie_break=["day_of_week"])


MEAN_LEAD_BY_WEEKDAY = MetricSpec(
    name="mean_lead_by_weekday", source="lineitem",
    required={"lineitem": ("l_orderkey", "l_shipdate"), "orders": ("o_orderkey", "o_orderdate")},
    keys=("day_of_week",), sums=("lead_sum", "lead_count"),
    reduction=LINES_BY_ORDER, finish=lambda tables, by_order: lead_by_weekday(by_order, tables["orders"]),
    finalize=lead_finalize,
    description="mean datediff(l_shipdate, o_orderdate) per ISO weekday of the ship day",
)


# ---- M5: rows per first positive reason -------------------------------------------------

def first_reason_column():
    return first_positive({label: c for label, c in REASON_COLUMNS.items()})


AMOUNTS_BY_USER_DAY = Reduction(keys=user_day, sums=reason_sums)
AMOUNTS = Reduction(keys=dict, sums=reason_sums)


def reasons_of(tables, user_days: DataFrame) -> DataFrame:
    reasons = user_days.select(first_reason_column().alias("reason"))
    return count_non_null(reasons, "reason", "days")


def reasons_finalize(tables, merged: DataFrame, top: int, order: str) -> DataFrame:
    # A reason that all its user-days left again has differences that add up to 0.
    held = merged.filter(F.col("days") > 0)
    return top_n(held.select("reason", "days"), ["days"], top, order, tie_break=["reason"])


def classified_finalize(tables, merged: DataFrame, top: int, order: str) -> DataFrame:
    return reasons_finalize(tables, reasons_of(tables, merged), top, order)


# A micro-batch may hold part of a user-day, so its amounts are stored and classified when read.
REASONS_REQUIRED = {"events": ("user_id", "ts", "event_type", "value")}

STREAMED_FIRST_REASONS = MetricSpec(
    name="first_reason_counts", source="events", required=REASONS_REQUIRED,
    keys=("user_id", "day"), sums=tuple(REASON_COLUMNS.values()),
    reduction=AMOUNTS_BY_USER_DAY, finalize=classified_finalize,
    description="amounts per user-day, classified when read",
)

FIRST_REASON_COUNTS = MetricSpec(
    name="first_reason_counts", source="events", required=REASONS_REQUIRED,
    keys=("reason",), sums=("days",), reduction=AMOUNTS_BY_USER_DAY, finish=reasons_of, finalize=reasons_finalize,
    streamed=STREAMED_FIRST_REASONS,
    description="user-days per first event type with a positive amount",
)


# ---- M6: share of the total amount per reason -------------------------------------------

def share_finalize(tables, merged: DataFrame, top: int, order: str) -> DataFrame:
    shares = share_of_total(merged, REASON_COLUMNS, "reason", "percent")
    return top_n(shares, ["percent"], top, order, tie_break=["reason"])


SHARE_BY_REASON = MetricSpec(
    name="share_by_reason", source="events",
    required={"events": ("ts", "event_type", "value")},
    keys=(), sums=tuple(REASON_COLUMNS.values()), reduction=AMOUNTS, finalize=share_finalize,
    description="percent of all cents per event type",
)


ALL_METRICS = (
    TOP_ORIGINS, ON_TIME_SUPPLIERS, ON_TIME_DEPARTURES, MEAN_LEAD_BY_WEEKDAY,
    FIRST_REASON_COUNTS, SHARE_BY_REASON,
)

BY_NAME = {m.name: m for m in ALL_METRICS}
