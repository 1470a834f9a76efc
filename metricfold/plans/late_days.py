"""Late and changed rows of days already counted, and an audit of a store against its facts.

**Recount.**  A batch run takes the days after the last stored one, so rows that arrive for an earlier day would
never be counted.  A run with ``ledger=True`` notes for every day of its window the number of rows and order-free
checksums of the columns that its metrics read.  ``recount`` compares these with the facts as they are
now (one scan, one row per day), and the windows that hold a day with other rows are computed anew from the
facts and replace the old ones, each with one new state version.  Days without rows now, days without rows
then and rows without a day are compared as well.

**Audit.**  ``audit`` compares a store's merged partials with a full recomputation without bringing either to
the driver: order-free checksums by ranges of the key's hash, then of the halves of the ranges that differ, until
they are small enough to list the differing keys themselves.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.operators.reductions import reduced
from metricfold.plans.facts import FACT_TABLES, FactTable, span
from metricfold.plans.metrics import MetricSpec
from metricfold.plans.runner import (
    BATCH,
    Noted,
    commit_increments,
    current_states,
    day_ledger,
    require_mode,
    stored_form,
    window_key,
)
from metricfold.plans.state import StateStore
from metricfold.sinks.files import save

CHECKS = ("rows", "check_high", "check_low")


def stored_ledger(spark: SparkSession, store: StateStore, spec: MetricSpec) -> DataFrame:
    """The days of all live windows of a metric: ``window, day, rows, check_high, check_low, after, until, columns``."""
    windows = store.committed_windows(spec.name)
    missing = [w for w in windows if not store.exists(store.ledger_path(spec.source, w))]
    if missing:
        raise ValueError(f"metric {spec.name!r}: windows {missing} have no ledger (run with ledger=True from the start)")
    parts = [spark.read.parquet(store.ledger_path(spec.source, w)).withColumn("window", F.lit(w)) for w in windows]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def changed_windows(spark: SparkSession, tables: Mapping[str, DataFrame], spec: MetricSpec, store: StateStore,
                    facts: Mapping[str, FactTable] = FACT_TABLES
                    ) -> tuple[dict[str, tuple[dt.date | None, dt.date]], list[str]]:
    """Live windows of a metric whose days hold other rows now, window -> (after, until), and the columns compared."""
    ledger = stored_ledger(spark, store, spec)
    windows = {r["window"]: (r["after"], r["until"], r["columns"]) for r in ledger.groupBy("window").agg(
        F.min(F.struct(F.col("after").isNotNull(), "after"))["after"].alias("after"),
        F.max("until").alias("until"), F.max("columns").alias("columns")).collect()}
    if len({columns for _, _, columns in windows.values()}) > 1:
        raise ValueError(f"metric {spec.name!r}: its windows' ledgers are about different columns")
    until, columns = max(w[1] for w in windows.values()), next(iter(windows.values()))[2]
    fact = facts[spec.source]
    now = reduced(fact.as_of(tables[spec.source], until), day_ledger(fact, columns.split(",")))
    # One signed sum per day: zero where the facts are what the ledger says.
    signed = ledger.select("day", *CHECKS).unionByName(now.select("day", *[(-F.col(c)).alias(c) for c in CHECKS]))
    changed = signed.groupBy("day").agg(*[F.sum(c).alias(c) for c in CHECKS]).where(" OR ".join(f"{c} <> 0" for c in CHECKS))
    days = [r["day"] for r in changed.select("day").collect()]       # days, not rows

    def holds(after: dt.date | None, until: dt.date, day: dt.date | None) -> bool:
        return after is None if day is None else (after is None or after < day) and day <= until

    return ({w: (after, until) for w, (after, until, _) in windows.items() if any(holds(after, until, d) for d in days)},
            columns.split(","))


def recount(spark: SparkSession, tables: Mapping[str, DataFrame], specs: Sequence[MetricSpec], store: StateStore,
            facts: Mapping[str, FactTable] = FACT_TABLES) -> dict[str, list[tuple[dt.date | None, dt.date]]]:
    """Count the windows with changed days again; returns the days (after, until) counted anew, by metric.

    Metrics that share a window are recounted together, from one scan of its days.
    """
    require_mode(store, specs, BATCH)
    fed = [spec for spec in specs if store.committed_windows(spec.name)]
    done: dict[str, list[tuple[dt.date | None, dt.date]]] = {spec.name: [] for spec in specs}
    together: dict[tuple, list[MetricSpec]] = {}
    found: dict[tuple, tuple] = {}
    for spec in fed:
        # Metrics with the same windows share their ledgers, so the facts are looked at once for them.
        key = (spec.source, tuple(store.committed_windows(spec.name)))
        if key not in found:
            found[key] = changed_windows(spark, tables, spec, store, facts)
        windows, columns = found[key]
        for window, days in windows.items():
            together.setdefault((spec.source, window, days, tuple(columns)), []).append(spec)
    for (source, window, (after, until), columns), group in together.items():
        fact = facts[source]
        rows = fact.as_of(fact.after(tables[source], after), until)
        new = window_key(after, uuid.uuid4().hex[:8])
        states = current_states(store, group)
        seen = span(fact, rows)
        commit_increments(tables, group, store, states, {s.name: rows for s in group}, {s.name: new for s in group},
                          {s.name: seen for s in group}, noted=Noted(facts, {s.name: (after, until) for s in group}, columns),
                          replacing={s.name: window for s in group})
        for spec in group:
            done[spec.name].append((after, until))
    return done


# ---- audit ----------------------------------------------------------------------------------

PLACE_BITS = 48         # bits of the key's hash
RANGE_BITS = 8          # a range is cut into 2^8
LISTED = 1_000          # ranges followed, and rows from which on the keys themselves are listed


def audit(spark: SparkSession, tables: Mapping[str, DataFrame], spec: MetricSpec, store: StateStore) -> DataFrame:
    """``metric, side, <keys>, <sums>``: the rows in which a store's merged partials ("stored") and a full
    recomputation ("facts") differ; no rows where they agree.  [R4]

    Both sides become one table of signed rows.  Each round sums counts and hash bits by
    ranges of the key's hash and goes on with the ranges that do not cancel out, 2^8 times finer, so only
    range numbers reach the driver; at last the rows of the differing ranges alone are compared.
    """
    spec = stored_form(store, spec)
    keys, sums = list(spec.keys), list(spec.sums)
    stored = store.merged(spec.name, spec.keys, spec.sums)
    fresh = spec.partial(tables, tables[spec.source])
    if stored is None:
        stored = fresh.limit(0)
    both = save(stored.select(F.lit("stored").alias("side"), *keys, *sums).unionByName(
        fresh.select(F.lit("facts").alias("side"), *keys, *sums)), "audit")
    sign = F.when(F.col("side") == "stored", F.lit(1)).otherwise(F.lit(-1))
    row = F.xxhash64(*keys, *sums)
    place = F.shiftrightunsigned(F.xxhash64(*keys) if keys else F.lit(0).cast("bigint"), 64 - PLACE_BITS)
    left, bits = both, PLACE_BITS
    while bits > 0:
        bits = max(0, bits - RANGE_BITS)
        here = F.shiftright(place, bits)
        checked = left.groupBy(here.alias("range")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(sign).alias("rows"), F.sum(sign * F.shiftrightunsigned(row, 40)).alias("high"),
            F.sum(sign * row.bitwiseAND(F.lit(0xFFFFFF))).alias("low"))
        differing = checked.where("rows <> 0 OR high <> 0 OR low <> 0").select("range", "n").limit(LISTED + 1).collect()
        if not differing:
            left = both.limit(0)
        if not differing or len(differing) > LISTED:    # the sides agree, or differ in too many places to narrow down
            break
        left = both.where(here.isin([r["range"] for r in differing]))
        if sum(r["n"] for r in differing) <= LISTED:
            break
    sides = left.groupBy(*keys, *sums).agg(F.sum(sign).alias("__sign"), F.max("side").alias("side")).where("__sign <> 0")
    return sides.select(F.lit(spec.name).alias("metric"), "side", *keys, *sums)
