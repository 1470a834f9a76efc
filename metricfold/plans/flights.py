"""The six metrics on the flight data model (flights, airports, airlines).

Same operators and the same incremental protocol as the driver-table metrics;
only the bindings differ.  ``run_flight_job`` is the batch job end to end:
path catalogue -> typed CSV scans -> state (seeded from a CSV file once) ->
increment per metric -> partials -> new state version -> results written as a
Parquet directory (full) and a single CSV file (top N).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.functions.columns import first_positive
from metricfold.operators.aggregates import mean_from_parts, share_of_total
from metricfold.operators.joins import attach, attach_where, with_dimension
from metricfold.operators.ranking import top_n
from metricfold.operators.reductions import Reduction
from metricfold.plans.metrics import MetricSpec, code_of, one, rank_and_pair, saved_count
from metricfold.plans.runner import MetricResult, run_job, seed_from_saved
from metricfold.plans.state import StateStore
from metricfold.schemas import AIRLINES, AIRPORTS, CATALOG, FLIGHTS
from metricfold.sources.catalog import path_for
from metricfold.sources.csv import read_csv

# Delay-reason columns in priority order; each is also its label.
REASONS = ("AIR_SYSTEM_DELAY", "SECURITY_DELAY", "AIRLINE_DELAY", "LATE_AIRCRAFT_DELAY",
           "WEATHER_DELAY")
DATE_PARTS = ("YEAR", "MONTH", "DAY")


# ---- M1 ------------------------------------------------------------------------------

DEPARTURES = Reduction(keys=lambda: {"ORIGIN_AIRPORT": F.col("ORIGIN_AIRPORT")}, sums=lambda: {"count": one()})


def airports_finalize(tables, merged, top, order):
    named = attach(merged, tables["airports"], "ORIGIN_AIRPORT", "IATA_CODE", {"AIRPORT": "AIRPORT"})
    named = named.select("ORIGIN_AIRPORT", "AIRPORT", "count")
    return top_n(named, ["count"], top, order, tie_break=["AIRPORT", "ORIGIN_AIRPORT"])


def airports_saved(tables, saved):
    saved = saved.select("AIRPORT", saved_count("count"))
    return code_of(saved, "AIRPORT", tables["airports"], "IATA_CODE", "AIRPORT", "ORIGIN_AIRPORT")


TOP_AIRPORTS_BY_FLIGHTS = MetricSpec(
    name="TopAirportsByFlights", source="flights",
    required={"flights": ("ORIGIN_AIRPORT",) + DATE_PARTS, "airports": ("IATA_CODE", "AIRPORT")},
    keys=("ORIGIN_AIRPORT",), sums=("count",),
    reduction=DEPARTURES, finalize=airports_finalize, import_saved=airports_saved, ranked="count",
    known=lambda tables, rows: with_dimension(rows, tables["airports"], "ORIGIN_AIRPORT", "IATA_CODE"),
    description="departures per origin airport, named, top N",
)


# ---- M2 ------------------------------------------------------------------------------

ON_TIME_ARRIVALS = Reduction(
    keys=lambda: {"AIRLINE_CODE": F.col("AIRLINE")}, sums=lambda: {"count": one()}, where=lambda: F.col("ARRIVAL_DELAY") == 0)


def airlines_finalize(tables, merged, top, order):
    named = attach(merged, tables["airlines"], "AIRLINE_CODE", "IATA_CODE", {"AIRLINE": "AIRLINE"})
    named = named.select("AIRLINE_CODE", "AIRLINE", "count")
    return top_n(named, ["count"], top, order, tie_break=["AIRLINE", "AIRLINE_CODE"])


def airlines_saved(tables, saved):
    saved = saved.select("AIRLINE", saved_count("count"))
    return code_of(saved, "AIRLINE", tables["airlines"], "IATA_CODE", "AIRLINE", "AIRLINE_CODE")


ON_TIME_AIRLINES = MetricSpec(
    name="OnTimeAirlines", source="flights",
    required={"flights": ("AIRLINE", "ARRIVAL_DELAY") + DATE_PARTS,
              "airlines": ("IATA_CODE", "AIRLINE")},
    keys=("AIRLINE_CODE",), sums=("count",),
    reduction=ON_TIME_ARRIVALS, finalize=airlines_finalize, import_saved=airlines_saved, ranked="count",
    known=lambda tables, rows: with_dimension(rows, tables["airlines"], "AIRLINE_CODE", "IATA_CODE"),
    description="flights arriving with delay exactly 0 per airline, named, top N",
)


# ---- M3 ------------------------------------------------------------------------------

ON_TIME_ROUTES = Reduction(
    keys=lambda: {"origin": F.col("ORIGIN_AIRPORT"), "carrier": F.col("AIRLINE"), "destination": F.col("DESTINATION_AIRPORT")},
    sums=lambda: {"flights": one()}, where=lambda: F.col("DEPARTURE_DELAY") == 0)


def routes_finalize(tables, merged, top, order):
    def name(ranked):
        named = attach_where(ranked, F.col("of_destination") == 0, tables["airlines"], "carrier", "IATA_CODE",
                             {"AIRLINE": "AIRLINE_NAME"})
        return attach_where(named, F.col("of_destination") == 1, tables["airports"], "destination", "IATA_CODE",
                            {"AIRPORT": "DESTINATION_AIRPORT_NAME"})

    paired = rank_and_pair(merged, top, order, name,
                           {"AIRLINE_NAME": "carrier", "DESTINATION_AIRPORT_NAME": "destination"})
    named = attach(paired, tables["airports"], "origin", "IATA_CODE", {"AIRPORT": "ORIGIN_AIRPORT_NAME"})
    return named.select(
        F.col("origin").alias("ORIGIN_AIRPORT"), "ORIGIN_AIRPORT_NAME", "position",
        F.col("carrier").alias("AIRLINE"), "AIRLINE_NAME", "carrier_total", "carrier_rank",
        F.col("destination").alias("DESTINATION_AIRPORT"), "DESTINATION_AIRPORT_NAME",
        "destination_total", "destination_rank",
    )


ON_TIME_FLIGHTS = MetricSpec(
    name="OnTimeFlights", source="flights",
    required={"flights": ("DEPARTURE_DELAY", "ORIGIN_AIRPORT", "AIRLINE", "DESTINATION_AIRPORT")
              + DATE_PARTS,
              "airports": ("IATA_CODE", "AIRPORT"), "airlines": ("IATA_CODE", "AIRLINE")},
    keys=("origin", "carrier", "destination"), sums=("flights",),
    reduction=ON_TIME_ROUTES, finalize=routes_finalize, top=3, order="asc", bounded_top=False,
    description="on-time departures: best carriers and destinations per airport, ranks <= top",
)


# ---- M4 ------------------------------------------------------------------------------

ARRIVAL_DELAYS = Reduction(
    keys=lambda: {"DAY_OF_WEEK": F.col("DAY_OF_WEEK")},
    sums=lambda: {"delay_sum": F.col("ARRIVAL_DELAY"), "delay_count": F.col("ARRIVAL_DELAY").isNotNull().cast("int")})


def weekday_finalize(tables, merged, top, order):
    means = mean_from_parts(merged, "delay_sum", "delay_count", "average_delay")
    return top_n(means, ["average_delay"], top, order, tie_break=["DAY_OF_WEEK"])


FLIGHTS_BY_DAY_OF_WEEK = MetricSpec(
    name="FlightsByDayOfWeek", source="flights",
    required={"flights": ("DAY_OF_WEEK", "ARRIVAL_DELAY") + DATE_PARTS},
    keys=("DAY_OF_WEEK",), sums=("delay_sum", "delay_count"),
    reduction=ARRIVAL_DELAYS, finalize=weekday_finalize,
    description="mean arrival delay per day of week (nulls skipped)",
)


# ---- M5 ------------------------------------------------------------------------------

def first_reason():
    return first_positive({r: r for r in REASONS})


FIRST_REASONS = Reduction(keys=lambda: {"Reason": first_reason()}, sums=lambda: {"count": one()},
                          where=lambda: first_reason().isNotNull())


def reasons_finalize(tables, merged, top, order):
    return top_n(merged.select("Reason", "count"), ["count"], top, order, tie_break=["Reason"])


DELAY_REASONS = MetricSpec(
    name="DelayReasons", source="flights",
    required={"flights": REASONS + DATE_PARTS},
    keys=("Reason",), sums=("count",), reduction=FIRST_REASONS, finalize=reasons_finalize,
    import_saved=lambda tables, saved: saved.select("Reason", saved_count("count")),
    description="flights per first positive delay reason",
)


# ---- M6 ------------------------------------------------------------------------------

DELAY_TOTALS = Reduction(keys=dict, sums=lambda: {r: F.col(r) for r in REASONS})


def percent_finalize(tables, merged, top, order):
    shares = share_of_total(merged, {r: r for r in REASONS}, "Reason", "Percent")
    return top_n(shares, ["Percent"], top, order, tie_break=["Reason"])


DELAY_PERCENT = MetricSpec(
    name="DelayPercent", source="flights",
    required={"flights": REASONS + DATE_PARTS},
    keys=(), sums=REASONS, reduction=DELAY_TOTALS, finalize=percent_finalize,
    description="percent of all delay minutes per reason",
)


FLIGHT_METRICS = (
    TOP_AIRPORTS_BY_FLIGHTS, ON_TIME_AIRLINES, ON_TIME_FLIGHTS, FLIGHTS_BY_DAY_OF_WEEK,
    DELAY_REASONS, DELAY_PERCENT,
)


# ---- the job ---------------------------------------------------------------------------

SCHEMAS = {"flights": FLIGHTS, "airports": AIRPORTS, "airlines": AIRLINES}


def read_table(spark: SparkSession, path: str, schema, sep: str = ",") -> DataFrame:
    """Typed scan of a CSV file/directory (``*.csv``) or of a Parquet dataset (anything else).

    Columns the file lacks are left out; a metric that needs one reports it.
    A Parquet flights table partitioned by ``YEAR``/``MONTH`` gets partition pruning
    from the increment predicate.
    """
    if path.rstrip("/").lower().endswith((".csv", ".csv.gz")):
        return read_csv(spark, path, schema, sep=sep, complete=False)
    df = spark.read.parquet(path)
    have = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields
                       if f.name in have])


def load_tables(spark: SparkSession, catalog_path: str, sep: str = ",") -> dict[str, DataFrame]:
    """Resolve the three inputs in a ``(name, path)`` CSV catalogue and scan them typed."""
    catalog = read_csv(spark, catalog_path, CATALOG)
    return {name: read_table(spark, path_for(catalog, name), schema, sep=sep)
            for name, schema in SCHEMAS.items()}


def run_flight_job(spark: SparkSession, catalog_path: str, store_root: str,
                   seed_csv: str | None = None, cut: dt.date | None = None,
                   start_afresh: Collection[str] = (),
                   tables: Mapping[str, DataFrame] | None = None,
                   write: bool = True) -> dict[str, MetricResult]:
    """The batch job: one increment of all six metrics, merged with earlier runs.

    ``seed_csv`` seeds the state table from a CSV file the first time a store is used, with the
    results it names (``seed_from_saved``); later runs continue from the newest committed
    version.  ``start_afresh`` names the metrics whose seeded dates are dropped.
    """
    tables = dict(tables) if tables is not None else load_tables(spark, catalog_path)
    store = StateStore(spark, store_root)
    if seed_csv:
        seed_from_saved(tables, FLIGHT_METRICS, store, seed_csv, start_afresh)
    return run_job(spark, tables, FLIGHT_METRICS, store,
                   cut={"flights": cut} if cut else None, write=write)
