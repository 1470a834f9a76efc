"""Fact relations of the metrics, built on the driver's TPC-H-like tables.

``shipments`` stands for flights: a lineitem is a flight, its supplier's nation
the origin, its customer's nation the destination, the part's brand the
carrier, ``l_discount`` the arrival delay and ``l_tax`` the departure delay
(0 means on time), ``l_shipdate`` the flight day and
``datediff(l_shipdate, o_orderdate)`` a lead time measured in days.

``daily_wide`` stands for the per-flight delay-reason columns: events summed
per user and day into one integer column (cents) per event type; a type with no
event that day is null, like a blank reason column.

Only the tables a query needs are joined, and facts are reduced to additive
columns as early as possible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricfold.functions.columns import cents, iso_weekday
from metricfold.operators.joins import roll_up
from metricfold.operators.reductions import Reduction, reduced
from metricfold.operators.skew import attach_spread, hot_keys

# Column holding the day of each fact table (the increment is cut on it).
DATE_COLUMN = {"lineitem": "l_shipdate", "events": "ts"}

# Event types in their priority order, and the wide column each one fills.
REASON_COLUMNS = {
    "click": "click_cents",
    "error": "error_cents",
    "purchase": "purchase_cents",
    "signup": "signup_cents",
    "view": "view_cents",
}


def user_day() -> dict[str, Column]:
    return {"user_id": F.col("user_id"), "day": F.to_date("ts")}


def reason_sums() -> dict[str, Column]:
    amount = cents("value")
    return {c: F.when(F.col("event_type") == F.lit(t), amount) for t, c in REASON_COLUMNS.items()}


def daily_wide(events: DataFrame) -> DataFrame:
    """``(user_id, day, click_cents, ..., view_cents)``, one row per user and day.

    Written as conditional sums in a single aggregate: one shuffle on
    ``(user_id, day)`` with map-side combining, and no discovery pass for the
    pivot values.
    """
    return reduced(events, Reduction(keys=user_day, sums=reason_sums))


def with_origin(lines: DataFrame, supplier: DataFrame, sums: list[str],
                pre_aggregate: bool = True) -> DataFrame:
    """Swap ``l_suppkey`` for ``origin`` (the supplier's nation)."""
    return roll_up(lines, "l_suppkey", supplier, "s_suppkey", {"s_nationkey": "origin"},
                   sums=sums, pre_aggregate=pre_aggregate)


def route_lines(lines: DataFrame, tables, weight: str = "flights") -> DataFrame:
    """``(origin, carrier, destination, weight)`` rows for the given lines (keys and ``weight``).

    Each dimension swap is one join; the rows of hot suppliers, parts, orders and customers are spread
    (``operators/skew.py``).  The (usually filtered) lines are joined through orders to customers rather
    than resolving every order's customer first: with fewer lines than orders that shuffles less
    (measured in PLANS.md).  Facts are not pre-aggregated on (join key + other
    keys): that aggregate would be hashed on all its keys and then re-shuffled on
    the join key.  The caller aggregates once at the end, with partial aggregation
    before that shuffle.
    """
    rows = lines.select("l_orderkey", "l_suppkey", "l_partkey", weight)
    hot = hot_keys(rows, ["l_orderkey", "l_suppkey", "l_partkey"])
    hot["custkey"] = hot_keys(tables["orders"], ["o_custkey"])["o_custkey"]
    steps = [
        ("l_orderkey", tables["orders"], "o_orderkey", {"o_custkey": "custkey"}),
        ("custkey", tables["customer"], "c_custkey", {"c_nationkey": "destination"}),
        ("l_suppkey", tables["supplier"], "s_suppkey", {"s_nationkey": "origin"}),
        ("l_partkey", tables["part"], "p_partkey", {"p_brand": "carrier"}),
    ]
    # Keys stay to the end: the order's key tells the rows of one hot supplier or part apart.
    for key, dim, dim_key, attrs in steps:
        rows = attach_spread(rows, dim, key, dim_key, attrs, hot[key])
    return rows.select("origin", "carrier", "destination", weight)


def lead_parts_by_weekday(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """``(day_of_week, lead_sum, lead_count)`` of ``datediff(l_shipdate, o_orderdate)``, by ISO weekday of the ship day."""
    by_order = lines.groupBy("l_orderkey").agg(*[F.sum(c.cast("bigint")).alias(name) for name, c in lead_sums().items()])
    return lead_by_weekday(by_order, orders)


WEEKDAYS = (None, 1, 2, 3, 4, 5, 6, 7)      # None: no ship day


def lead_sums() -> dict[str, Column]:
    """For each weekday of the ship day: the number of lines, and the sum of their days' numbers."""
    day = F.to_date("l_shipdate")
    sums = {}
    for w in WEEKDAYS:
        on = day.isNull() if w is None else iso_weekday(day) == w
        sums[f"lines_{w}"] = F.when(on, F.lit(1))
        if w is not None:
            sums[f"days_{w}"] = F.when(on, F.unix_date(day))
    return sums


def lead_by_weekday(by_order: DataFrame, orders: DataFrame) -> DataFrame:
    """Lead parts from one row per order (``lead_sums``), which carries its lines of every weekday.

    Facts are reduced to one row per order inside each task, move once, by the order, and meet the
    orders in that partitioning; a hot order moves one row per task.  The weekdays' totals are a
    global aggregate, unpivoted at the end.  A weekday whose leads are all unknown keeps a count of 0.
    """
    order_days = orders.select("o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("order_day"))
    joined = by_order.join(order_days, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    totals, rows = [], []
    for w in WEEKDAYS:
        lines, ordered = F.col(f"lines_{w}"), F.col("order_day")
        lead = F.lit(None).cast("bigint") if w is None else F.col(f"days_{w}") - lines * ordered
        known = F.lit(None).cast("bigint") if w is None else F.when(ordered.isNotNull(), lines)
        totals += [F.sum(lines).alias(f"lines_{w}"), F.sum(lead).alias(f"lead_{w}"), F.sum(known).alias(f"known_{w}")]
        rows.append(F.struct(F.lit(w).cast("int").alias("day_of_week"), F.col(f"lead_{w}").alias("lead_sum"),
                             F.coalesce(f"known_{w}", F.lit(0).cast("bigint")).alias("lead_count"), F.col(f"lines_{w}").alias("lines")))
    parts = joined.agg(*totals).select(F.explode(F.array(*rows)).alias("part")).select("part.*")
    return parts.filter("lines > 0").drop("lines")
