"""Registered queries: one per operator of the inventory, on the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Queries that write (CSV round trips, metric runs) do so below the
session's checkpoint folder, in a fresh directory per call.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.functions.columns import day_from_parts
from metricfold.operators.aggregates import (
    column_totals,
    count_by,
    count_non_null,
    mean_from_parts,
    merge_sums,
    share_of_total,
)
from metricfold.operators.increment import after, as_of, bounds
from metricfold.operators.joins import attach, limit_then_join, merge_join
from metricfold.operators.projections import drop_incomplete, only_zero, project, rename_all
from metricfold.operators.ranking import rank_spread, rank_within, sort_all, top_n
from metricfold.operators.validate import require_columns
from metricfold.plans import metrics as M
from metricfold.plans.analogues import REASON_COLUMNS, daily_wide, lead_parts_by_weekday
from metricfold.plans.runner import full_recompute, results, run_job, run_metrics, seed_from_saved
from metricfold.plans.facts import FACT_TABLES
from metricfold.plans.late_days import audit, recount
from metricfold.plans.state import StateStore
from metricfold.schemas import CATALOG, DRIVER, struct
from metricfold.session import scratch_dir
from metricfold.sinks.files import as_view, save, write_csv_dir, write_single_csv
from metricfold.sources.catalog import path_for
from metricfold.sources.csv import cast_to, read_csv, read_csv_checked, read_csv_inferred
from metricfold.sources.tables import DRIVER_TABLES, Tables
from metricfold.streaming.keyed_reasons import start_reason_stream
from metricfold.streaming.micro_batch import apply_batch, start_metric_stream

# Replay cut days (first increment ends here, the second holds the rest).
LINEITEM_CUT = dt.date(1998, 12, 31)
EVENTS_CUT = dt.date(2024, 1, 15)
ORDERS_CUT = dt.date(1996, 6, 30)
CUTS = {"lineitem": LINEITEM_CUT, "events": EVENTS_CUT}

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# ---- sources and sinks ------------------------------------------------------------------

def csv_round_trip(spark, sf_dir):
    t = _tables(spark, sf_dir)
    path = write_csv_dir(t["supplier"], scratch_dir(spark, "csv-supplier"))
    return read_csv(spark, path, DRIVER["supplier"])


def csv_infer_scan(spark, sf_dir):
    t = _tables(spark, sf_dir)
    path = write_csv_dir(t["nation"], scratch_dir(spark, "csv-nation"))
    return cast_to(read_csv_inferred(spark, path), DRIVER["nation"])


def single_file_csv(spark, sf_dir):
    top = metric_top_origins(spark, sf_dir)
    path = write_single_csv(top, scratch_dir(spark, "top-origins-csv"))
    return read_csv(spark, path, struct("origin int, origin_name string, departures bigint"))


def path_lookup(spark, sf_dir):
    t = _tables(spark, sf_dir)
    rows = [(name, t.path(name)) for name in DRIVER_TABLES]
    catalog_path = write_csv_dir(spark.createDataFrame(rows, CATALOG).coalesce(1),
                                 scratch_dir(spark, "catalog"))
    catalog = read_csv(spark, catalog_path, CATALOG)
    supplier = spark.read.parquet(path_for(catalog, "supplier"))
    return supplier.agg(F.count(F.lit(1)).alias("row_count"))


def _fresh_store(spark, label: str) -> StateStore:
    return StateStore(spark, scratch_dir(spark, label))


def _two_runs(spark, sf_dir, specs, label: str):
    """Run ``specs`` up to the cut days, then again over everything."""
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, label)
    run_metrics(spark, t, specs, store, cut=CUTS)
    run_metrics(spark, t, specs, store)
    return results(t, specs, store), store


def state_lookup(spark, sf_dir):
    _, store = _two_runs(spark, sf_dir, [M.TOP_ORIGINS], "state-lookup")
    version = store.latest_version()
    return store.table().filter((F.col("version") == version) & (F.col("metricName") == "top_origins")).select(
        F.col("metricName").alias("metric_name"), "top", F.col("order").alias("sort_order"),
        F.col("dateFrom").alias("date_from"), F.col("dateTo").alias("date_to"),
    )


def merge_when_no_prior(spark, sf_dir):
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, "no-prior")
    assert store.merged(M.TOP_ORIGINS.name, M.TOP_ORIGINS.keys, M.TOP_ORIGINS.sums) is None
    run_metrics(spark, t, [M.TOP_ORIGINS], store)
    return results(t, [M.TOP_ORIGINS], store)[M.TOP_ORIGINS.name].full


def sql_view_top(spark, sf_dir):
    t = _tables(spark, sf_dir)
    view = as_view(count_by(t["lineitem"], ["l_suppkey"]), f"supplier_counts_{uuid.uuid4().hex[:8]}")
    return spark.sql(f"SELECT l_suppkey, n FROM {view} ORDER BY n DESC, l_suppkey LIMIT 10")


# ---- validation, projections, filters -----------------------------------------------------

def required_columns(spark, sf_dir):
    nation = require_columns(_tables(spark, sf_dir)["nation"], ["n_nationkey", "n_name"])
    return project(nation, ["n_nationkey", "n_name"])


def date_from_parts(spark, sf_dir):
    orders = _tables(spark, sf_dir)["orders"]
    day = day_from_parts(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    return count_by(orders.select(day.alias("day")), ["day"])


def increment_after(spark, sf_dir):
    lines = after(_tables(spark, sf_dir)["lineitem"], "l_shipdate", LINEITEM_CUT)
    return count_by(lines, ["l_suppkey"])


def increment_null_watermark(spark, sf_dir):
    lines = after(_tables(spark, sf_dir)["lineitem"], "l_shipdate", None)
    return count_by(lines, ["l_suppkey"])


def zero_filter(spark, sf_dir):
    return only_zero(_tables(spark, sf_dir)["lineitem"], "l_discount")


def project_rename(spark, sf_dir):
    lines = project(_tables(spark, sf_dir)["lineitem"],
                    ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])
    return rename_all(lines, ["order_key", "line_number", "quantity", "ship_date"])


def alias_qualified(spark, sf_dir):
    """Customer nation next to supplier nation for every line.

    ``nation`` appears twice, as ``c`` and ``s``; columns are picked by alias.  Each
    side's nation is resolved on the (smaller) order and supplier side first, so
    the line rows take part in two joins, not four.
    """
    t = _tables(spark, sf_dir)
    c = t["nation"].alias("c")
    s = t["nation"].alias("s")
    cu = t["customer"].alias("cu")
    o = t["orders"].alias("o")
    su = t["supplier"].alias("su")
    l = t["lineitem"].alias("l")
    order_nation = (o.join(cu, F.col("o.o_custkey") == F.col("cu.c_custkey"))
                    .join(c, F.col("cu.c_nationkey") == F.col("c.n_nationkey"))
                    .select(F.col("o.o_orderkey").alias("ok"), F.col("c.n_name").alias("customer_nation"))
                    .alias("on"))
    supplier_nation = (su.join(s, F.col("su.s_nationkey") == F.col("s.n_nationkey"))
                       .select(F.col("su.s_suppkey").alias("sk"), F.col("s.n_name").alias("supplier_nation"))
                       .alias("sn"))
    joined = (l.join(order_nation, F.col("l.l_orderkey") == F.col("on.ok"))
              .join(supplier_nation, F.col("l.l_suppkey") == F.col("sn.sk")))
    return joined.select(
        F.col("l.l_orderkey").alias("l_orderkey"), F.col("l.l_linenumber").alias("l_linenumber"),
        F.col("on.customer_nation").alias("customer_nation"),
        F.col("sn.supplier_nation").alias("supplier_nation"),
    )


def _daily_wide(spark, sf_dir) -> DataFrame:
    return daily_wide(_tables(spark, sf_dir)["events"])


def first_reason(spark, sf_dir):
    wide = _daily_wide(spark, sf_dir)
    return wide.select("user_id", "day", M.first_reason_column().alias("reason"))


def drop_nulls(spark, sf_dir):
    return drop_incomplete(_daily_wide(spark, sf_dir), list(REASON_COLUMNS.values()))


# ---- aggregates and joins -----------------------------------------------------------------

def count_then_name(spark, sf_dir):
    t = _tables(spark, sf_dir)
    counts = count_by(t["lineitem"], ["l_suppkey"])
    return attach(counts, t["supplier"], "l_suppkey", "s_suppkey", {"s_name": "s_name"}).select(
        "l_suppkey", "s_name", "n")


def zero_count_then_name(spark, sf_dir):
    t = _tables(spark, sf_dir)
    counts = count_by(only_zero(t["lineitem"], "l_discount"), ["l_suppkey"])
    return attach(counts, t["supplier"], "l_suppkey", "s_suppkey", {"s_name": "s_name"}).select(
        "l_suppkey", "s_name", "n")


def _routes(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    lines = t["lineitem"] if lines is None else lines
    return M.routes_partial(t, lines)


def route_counts(spark, sf_dir):
    return _routes(_tables(spark, sf_dir))


def mean_by_weekday(spark, sf_dir):
    t = _tables(spark, sf_dir)
    parts = lead_parts_by_weekday(t["lineitem"], t["orders"])
    return mean_from_parts(parts, "lead_sum", "lead_count", "average_lead")


def reason_counts(spark, sf_dir):
    reasons = _daily_wide(spark, sf_dir).select(M.first_reason_column().alias("reason"))
    return count_non_null(reasons, "reason", "n")


def column_totals_query(spark, sf_dir):
    return column_totals(_daily_wide(spark, sf_dir), list(REASON_COLUMNS.values()))


def merge_additive(spark, sf_dir):
    lines = _tables(spark, sf_dir)["lineitem"]
    early = count_by(as_of(lines, "l_shipdate", LINEITEM_CUT), ["l_suppkey"])
    late = count_by(after(lines, "l_shipdate", LINEITEM_CUT), ["l_suppkey"])
    return merge_sums([early, late], ["l_suppkey"], ["n"])


def merge_routes(spark, sf_dir):
    t = _tables(spark, sf_dir)
    lines = t["lineitem"]
    early = _routes(t, as_of(lines, "l_shipdate", LINEITEM_CUT))
    late = _routes(t, after(lines, "l_shipdate", LINEITEM_CUT))
    return merge_sums([early, late], ["origin", "carrier", "destination"], ["flights"])


def share_of_total_query(spark, sf_dir):
    totals = column_totals(_daily_wide(spark, sf_dir), list(REASON_COLUMNS.values()))
    return share_of_total(totals, REASON_COLUMNS, "reason", "percent")


def date_bounds(spark, sf_dir):
    t = _tables(spark, sf_dir)
    first, last = bounds(t["lineitem"], "l_shipdate")
    return t["supplier"].select(
        "s_suppkey", "s_name", F.lit(first).cast("date").alias("min_day"),
        F.lit(last).cast("date").alias("max_day"),
    )


# ---- windows, sorts, limits ---------------------------------------------------------------

def rank_routes_by_origin(spark, sf_dir):
    return rank_spread(route_counts(spark, sf_dir), ["origin"], "flights", save, "origin_rank")


def rank_routes_by_destination(spark, sf_dir):
    return rank_spread(route_counts(spark, sf_dir), ["destination"], "flights", save, "destination_rank")


def top_per_origin(spark, sf_dir):
    t = _tables(spark, sf_dir)
    ranked = M.ranked_carriers(_routes(t), 10)
    named = attach(ranked, t["nation"], "origin", "n_nationkey", {"n_name": "origin_name"})
    return named.select("origin", "origin_name", "carrier", "carrier_total", "carrier_rank")


def top_destinations_per_origin(spark, sf_dir):
    t = _tables(spark, sf_dir)
    ranked = M.ranked_destinations(_routes(t), 10)
    named = attach(ranked, t["nation"], "destination", "n_nationkey",
                   {"n_name": "destination_name"})
    return named.select("origin", "destination", "destination_name", "destination_total",
                        "destination_rank")


def pair_rankings(spark, sf_dir):
    paired = M.rank_and_pair(route_counts(spark, sf_dir), 3)
    return paired.select("origin", "position", "carrier", "carrier_total", "carrier_rank",
                         "destination", "destination_total", "destination_rank")


def limit_then_join_query(spark, sf_dir):
    t = _tables(spark, sf_dir)
    counts = count_by(t["lineitem"], ["l_suppkey"])
    head = limit_then_join(counts, [F.col("n").desc(), F.col("l_suppkey").asc()], 10,
                           t["supplier"], "l_suppkey", "s_suppkey", {"s_name": "s_name"})
    return head.select("l_suppkey", "s_name", "n")


def merge_join_hint(spark, sf_dir):
    """Orders per market segment through a sort-merge join.

    Orders are first counted per customer (partial aggregation before the
    shuffle), so the join sees one row per customer, and the count output is
    already partitioned by the join key.
    """
    t = _tables(spark, sf_dir)
    per_customer = count_by(t["orders"], ["o_custkey"], "orders")
    customer = t["customer"].select("c_custkey", "c_mktsegment")
    joined = merge_join(per_customer, customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("orders").alias("n"))


def top_n_two_keys(spark, sf_dir):
    routes = route_counts(spark, sf_dir)
    ranked = rank_within(rank_within(routes, ["origin"], "flights", "origin_rank"),
                         ["destination"], "flights", "destination_rank")
    return top_n(ranked, ["origin_rank", "destination_rank"], 10, "asc",
                 tie_break=["origin", "carrier", "destination"])


def sorted_means(spark, sf_dir):
    return sort_all(mean_by_weekday(spark, sf_dir), ["average_lead"], "asc")


# ---- metrics, job -------------------------------------------------------------------------

def _metric(spec):
    def run(spark, sf_dir):
        results, _ = _two_runs(spark, sf_dir, [spec], spec.name)
        return results[spec.name].top
    run.__name__ = f"metric_{spec.name}"
    return run


metric_top_origins = _metric(M.TOP_ORIGINS)
metric_on_time_suppliers = _metric(M.ON_TIME_SUPPLIERS)
metric_on_time_departures = _metric(M.ON_TIME_DEPARTURES)
metric_mean_lead_by_weekday = _metric(M.MEAN_LEAD_BY_WEEKDAY)
metric_first_reason_counts = _metric(M.FIRST_REASON_COUNTS)
metric_share_by_reason = _metric(M.SHARE_BY_REASON)


def stream_first_reason_counts(spark, sf_dir):
    """M5 fed by Structured Streaming: the events table read as a file stream.

    Each micro-batch is committed as one increment (window ``batch-<id>``); the
    query stops once all available files are processed (``availableNow``).
    """
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, "stream")
    # The table's own path, one file or a directory of part files.  As a pattern (that only it
    # matches), since the file stream refuses a plain path that is a file.
    path = t.path("events")
    stream = spark.readStream.schema(t["events"].schema).parquet(f"{path[:-1]}[{path[-1]}]")
    query = start_metric_stream(spark, stream, "events", t, [M.FIRST_REASON_COUNTS], store,
                                scratch_dir(spark, "stream-checkpoint"))
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return results(t, [M.FIRST_REASON_COUNTS], store)[M.FIRST_REASON_COUNTS.name].top


def stream_keyed_reason_counts(spark, sf_dir):
    """M5 as keyed streaming state: two arrivals that split user-days, the second after a restart from the checkpoint."""
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, "keyed")
    inbox, checkpoint = scratch_dir(spark, "keyed-inbox"), scratch_dir(spark, "keyed-checkpoint")
    for part in (0, 1):
        t["events"].filter(F.col("event_id") % 2 == part).write.parquet(f"{inbox}/part={part}")
        stream = spark.readStream.schema(t["events"].schema).parquet(f"{inbox}/*")
        query = start_reason_stream(spark, stream, t, store, checkpoint)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return results(t, [M.FIRST_REASON_COUNTS], store)[M.FIRST_REASON_COUNTS.name].top


def stream_replay_after_compaction(spark, sf_dir):
    """M5 from two micro-batches that split every user-day, compacted, and the second replayed."""
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, "replay")
    halves = [t["events"].filter(F.col("event_id") % 2 == part) for part in (0, 1)]
    for number in (0, 1, 1):
        apply_batch(halves[number], number, "events", t, [M.FIRST_REASON_COUNTS], store, compact_after=2)
    return results(t, [M.FIRST_REASON_COUNTS], store)[M.FIRST_REASON_COUNTS.name].top


def seeded_merge(spark, sf_dir):
    """M1 continued from a result saved elsewhere: its CSV and state file, then the later rows."""
    t = _tables(spark, sf_dir)
    until = FACT_TABLES["lineitem"].as_of(t["lineitem"], LINEITEM_CUT)
    saved = M.origins_finalize(t, M.TOP_ORIGINS.partial(t, until), None, "desc")
    saved_path = write_csv_dir(saved.select("origin_name", "departures"), scratch_dir(spark, "saved-result"))
    first, _ = bounds(until, "l_shipdate")
    seed = spark.createDataFrame(
        [("top_origins", 10, "desc", first, LINEITEM_CUT, saved_path)],
        "metricName string, top int, order string, dateFrom date, dateTo date, pathAll string")
    seed_path = write_csv_dir(seed.coalesce(1), scratch_dir(spark, "saved-state"))
    store = _fresh_store(spark, "seeded")
    seed_from_saved(t, [M.TOP_ORIGINS], store, seed_path)
    run_metrics(spark, t, [M.TOP_ORIGINS], store)
    return results(t, [M.TOP_ORIGINS], store)["top_origins"].full


def csv_reordered_columns(spark, sf_dir):
    """Typed scan of a supplier file whose columns stand in another order, with one more."""
    supplier = _tables(spark, sf_dir)["supplier"]
    shuffled = supplier.select("s_acctbal", F.lit("x").alias("note"), "s_nationkey", "s_name", "s_suppkey")
    return read_csv(spark, write_csv_dir(shuffled, scratch_dir(spark, "csv-reordered")), DRIVER["supplier"])


def increment_from_parts(spark, sf_dir):
    """Orders after a day, cut on integer year, month and day columns."""
    orders = _tables(spark, sf_dir)["orders"].select(
        F.year("o_orderdate").alias("YEAR"), F.month("o_orderdate").alias("MONTH"),
        F.dayofmonth("o_orderdate").alias("DAY"))
    later = FACT_TABLES["flights"].after(orders, ORDERS_CUT)
    return count_by(later.select(FACT_TABLES["flights"].day().alias("day")), ["day"])


def csv_quarantine(spark, sf_dir):
    """Supplier files with two headers, in which every negative balance is a word: typed rows and quarantine."""
    supplier = _tables(spark, sf_dir)["supplier"]
    path = scratch_dir(spark, "csv-mixed")
    written = supplier.withColumn("s_acctbal", F.when(F.col("s_acctbal") < 0, F.lit("owed")).otherwise(F.col("s_acctbal").cast("string")))
    even = F.col("s_nationkey") % 2 == 0
    write_csv_dir(written.filter(even), f"{path}/part=1")
    write_csv_dir(written.filter(~even).select("s_acctbal", "s_name", F.lit("x").alias("note"), "s_suppkey", "s_nationkey"), f"{path}/part=2")
    scan = read_csv_checked(spark, f"{path}/*", DRIVER["supplier"])
    columns = DRIVER["supplier"].names
    return scan.rows.select(F.lit("typed").alias("status"), *columns).unionByName(
        scan.quarantine.select(F.col("reason").alias("status"), *columns))


def late_rows_recount(spark, sf_dir):
    """M1 and M2 counted while the first lines of every order are missing, and recounted when these have arrived."""
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, "late-rows")
    specs = [M.TOP_ORIGINS, M.ON_TIME_SUPPLIERS]
    early = t.replace("lineitem", t["lineitem"].filter("l_linenumber > 1"))
    run_metrics(spark, early, specs, store, cut=CUTS, ledger=True)
    run_metrics(spark, t, specs, store, ledger=True)
    recount(spark, t, specs, store)
    merged = results(t, specs, store)
    by_name = {"top_origins": ("origin_name", "departures"), "on_time_suppliers": ("supplier_name", "on_time")}
    origins, suppliers = [merged[name].full.select(F.lit(name).alias("metric"), F.col(key).alias("key"), F.col(n).alias("n"))
                          for name, (key, n) in by_name.items()]
    return origins.unionByName(suppliers)


def store_audit(spark, sf_dir):
    """What a store that missed the third lines of all orders differs in from the facts."""
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, "audit")
    run_metrics(spark, t.replace("lineitem", t["lineitem"].filter("l_linenumber <> 3")), [M.ON_TIME_SUPPLIERS], store)
    return audit(spark, t, M.ON_TIME_SUPPLIERS, store)


def full_recompute_query(spark, sf_dir):
    return full_recompute(_tables(spark, sf_dir), M.MEAN_LEAD_BY_WEEKDAY)


def long_format(tops) -> DataFrame:
    """Every metric's top result as ``(metric, key, value double)`` rows."""
    def rows(name, df, key, value):
        return df.select(F.lit(name).alias("metric"), key.alias("key"),
                         value.cast("double").alias("value"))

    r = dict(tops)
    sep = F.lit("|")
    dep = r["on_time_departures"]
    parts = [
        rows("top_origins", r["top_origins"], F.col("origin_name"), F.col("departures")),
        rows("on_time_suppliers", r["on_time_suppliers"], F.col("supplier_name"), F.col("on_time")),
        rows("on_time_departures", dep.filter(F.col("carrier").isNotNull()),
             F.concat(F.col("origin_name"), sep, F.lit("carrier"), sep, F.col("carrier")),
             F.col("carrier_rank")),
        rows("on_time_departures", dep.filter(F.col("destination").isNotNull()),
             F.concat(F.col("origin_name"), sep, F.lit("destination"), sep, F.col("destination_name")),
             F.col("destination_rank")),
        rows("mean_lead_by_weekday", r["mean_lead_by_weekday"], F.col("day_of_week").cast("string"),
             F.col("average_lead")),
        rows("first_reason_counts", r["first_reason_counts"], F.col("reason"), F.col("days")),
        rows("share_by_reason", r["share_by_reason"], F.col("reason"), F.col("percent")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def full_job(spark, sf_dir):
    """The whole job twice (history, then the rest); the written top results are read back."""
    t = _tables(spark, sf_dir)
    store = _fresh_store(spark, "full-job")
    specs = list(M.ALL_METRICS)
    run_job(spark, t, specs, store, cut=CUTS)
    done = run_job(spark, t, specs, store)
    return long_format({name: read_csv(spark, res.state.path, res.top.schema)
                        for name, res in done.items()})


QUERIES: dict[str, Query] = {
    "csv_round_trip": csv_round_trip,
    "csv_infer_scan": csv_infer_scan,
    "single_file_csv": single_file_csv,
    "path_lookup": path_lookup,
    "state_lookup": state_lookup,
    "merge_when_no_prior": merge_when_no_prior,
    "sql_view_top": sql_view_top,
    "required_columns": required_columns,
    "date_from_parts": date_from_parts,
    "increment_after": increment_after,
    "increment_null_watermark": increment_null_watermark,
    "zero_filter": zero_filter,
    "project_rename": project_rename,
    "alias_qualified": alias_qualified,
    "first_reason": first_reason,
    "drop_nulls": drop_nulls,
    "count_then_name": count_then_name,
    "zero_count_then_name": zero_count_then_name,
    "route_counts": route_counts,
    "mean_by_weekday": mean_by_weekday,
    "reason_counts": reason_counts,
    "column_totals": column_totals_query,
    "merge_additive": merge_additive,
    "merge_routes": merge_routes,
    "share_of_total": share_of_total_query,
    "date_bounds": date_bounds,
    "rank_routes_by_origin": rank_routes_by_origin,
    "rank_routes_by_destination": rank_routes_by_destination,
    "top_per_origin": top_per_origin,
    "top_destinations_per_origin": top_destinations_per_origin,
    "pair_rankings": pair_rankings,
    "limit_then_join": limit_then_join_query,
    "merge_join_hint": merge_join_hint,
    "top_n_two_keys": top_n_two_keys,
    "sorted_means": sorted_means,
    "metric_top_origins": metric_top_origins,
    "metric_on_time_suppliers": metric_on_time_suppliers,
    "metric_on_time_departures": metric_on_time_departures,
    "metric_mean_lead_by_weekday": metric_mean_lead_by_weekday,
    "metric_first_reason_counts": metric_first_reason_counts,
    "metric_share_by_reason": metric_share_by_reason,
    "stream_first_reason_counts": stream_first_reason_counts,
    "stream_keyed_reason_counts": stream_keyed_reason_counts,
    "stream_replay_after_compaction": stream_replay_after_compaction,
    "seeded_merge": seeded_merge,
    "csv_reordered_columns": csv_reordered_columns,
    "increment_from_parts": increment_from_parts,
    "csv_quarantine": csv_quarantine,
    "late_rows_recount": late_rows_recount,
    "store_audit": store_audit,
    "full_recompute": full_recompute_query,
    "full_job": full_job,
}
