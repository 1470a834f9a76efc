"""Running metrics: one increment per call, merged with everything committed before.

``run_metrics`` is the job: it finds the bounds of the rows newer than the
watermark (once per fact table and watermark), freezes the increment to them, writes
each metric's partial, and commits a new state version.
``results`` reads the merged results.  ``full_recompute`` is the one-shot form:
the same spec over every row, with no state.

The partial of a metric goes to a window named by the metric's *old* watermark
and the run's attempt id, both known before anything runs, so the partial writes
of all metrics are independent: they are submitted together and Spark schedules
them side by side.  The state version is written after all of them succeeded.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.operators.aggregates import merge_sums
from metricfold.operators.ranking import check_direction
from metricfold.operators.reductions import TAG, Reduction, reduced_together, unpacked
from metricfold.operators.validate import require_tables
from metricfold.plans.facts import FACT_TABLES, FactTable, Span, span
from metricfold.plans.heads import top_rows
from metricfold.plans.metrics import MetricSpec
from metricfold.plans.state import MetricState, StateStore, window_key
from metricfold.sources.csv import read_csv
from metricfold.sinks.files import write_csv_dir, write_parquet, write_single_csv

SEED_WINDOW = "seed"
# Concurrent Spark jobs submitted by one run (one partial write per metric).
MAX_CONCURRENT_JOBS = 8


class MetricResult:
    """A metric's merged result; plans are built on first access.

    The top of a ranked metric is read from its windows' heads: its first access runs a small job that finds the bound.
    """

    def __init__(self, tables: Mapping[str, DataFrame], spec: MetricSpec, merged: DataFrame,
                 state: MetricState, store: StateStore | None = None):
        self._tables, self._spec, self._merged = tables, spec, merged
        self.state, self._store = state, store
        self.bounded_top = spec.bounded_top

    @cached_property
    def full(self) -> DataFrame:
        """Every key."""
        return self._spec.finalize(self._tables, self._merged, None, self._spec.order)

    @cached_property
    def top(self) -> DataFrame:
        """What the user reads (top-N, ranks <= k, ...)."""
        return self._spec.finalize(self._tables, self._leading(), self.state.top, self.state.order)

    def _leading(self) -> DataFrame:
        """Merged rows among which the top result is: those of the leading keys, or all."""
        spec, rows = self._spec, None
        if spec.ranked and self._store and self.state.top is not None and check_direction(self.state.order) == "desc":
            known = (lambda heads: spec.known(self._tables, heads)) if spec.known else (lambda heads: heads)
            rows = top_rows(self._store, spec.name, spec.keys, spec.ranked, self.state.top, known)
        return self._merged if rows is None else merge_sums(rows, list(spec.keys), list(spec.sums))


def seed_rows(specs: Sequence[MetricSpec], root: str) -> list[MetricState]:
    return [
        MetricState(metricName=s.name, top=s.top, order=s.order,
                    path=f"{root}/results/{s.name}/top", pathAll=f"{root}/results/{s.name}/all")
        for s in specs
    ]


def seed_from_saved(tables: Mapping[str, DataFrame], specs: Sequence[MetricSpec], store: StateStore,
                    path: str, start_afresh: Collection[str] = ()) -> None:
    """Seed an empty store from a CSV state file and the saved full results it names.  [S5, S7]

    A seeded date claims the days up to it, so the metric's result at ``pathAll`` becomes its
    first committed window.  ValueError where that cannot be done (no saved result, or one
    that does not add up, such as means and ranks), unless ``start_afresh`` names the metric:
    its dates are dropped then and every row is counted again.  Files that exist are never
    written over: such a metric's results go below the store.
    """
    if store.latest_version() is not None:
        return
    known = {spec.name: spec for spec in specs}
    default = {row.metricName: row for row in seed_rows(specs, store.root)}
    window = f"{SEED_WINDOW}.{uuid.uuid4().hex[:8]}"
    rows = []
    for row in store.read_seed(path):
        spec = known.get(row.metricName)
        if spec is None:
            rows.append(row)
            continue
        if row.metricName in start_afresh:
            row = replace(row, dateFrom=None, dateTo=None)
        elif row.dateTo is not None:
            if spec.import_saved is None or not row.pathAll or not store.exists(row.pathAll):
                raise ValueError(f"metric {spec.name!r} has a date but no saved result that can be added "
                                 f"to (pathAll={row.pathAll!r}): name it in start_afresh to count it anew")
            saved = spec.import_saved(tables, read_csv(store.spark, row.pathAll))
            store.write_partial(spec.name, window, check_partial(spec, saved), spec.ranked)
            row = row.committing(window, mode=BATCH)
        for target in ("path", "pathAll"):
            named = getattr(row, target)
            if named and store.exists(named):
                row = replace(row, **{target: getattr(default[spec.name], target)})
        rows.append(row)
    store.seed(rows)


def increment_of(tables: Mapping[str, DataFrame], fact: FactTable, watermark: dt.date | None,
                 cut: dt.date | None = None) -> DataFrame:
    """Rows of ``fact`` after ``watermark`` (and, to replay history, on or before ``cut``)."""
    return fact.after(fact.as_of(tables[fact.name], cut), watermark)


def current_states(store: StateStore, specs: Sequence[MetricSpec]) -> dict[str, MetricState]:
    """Latest committed state rows; metrics never run before get their seed row."""
    states = store.latest()
    for row in seed_rows([s for s in specs if s.name not in states], store.root):
        states[row.metricName] = row
    return states


def check_partial(spec: MetricSpec, partial: DataFrame) -> DataFrame:
    """The partial must hold exactly the spec's keys and additive sums (schema only)."""
    expected = set(spec.keys) | set(spec.sums)
    if set(partial.columns) != expected or len(partial.columns) != len(expected):
        raise ValueError(f"metric {spec.name!r}: partial has columns {partial.columns}, "
                         f"expected keys {list(spec.keys)} and sums {list(spec.sums)}")
    return partial.select(*spec.keys, *spec.sums)


BATCH, STREAM, KEYED = "batch", "stream", "keyed"


def require_mode(store: StateStore, specs: Sequence[MetricSpec], mode: str) -> None:
    """ValueError if the store holds one of the metrics as fed the other way.

    A batch run takes the days after the last stored one, a stream takes whatever arrives: a
    stream's last day may be there only in part, so a store takes one or the other.
    """
    fed = {BATCH: "batch runs", STREAM: "a stream", KEYED: "a stream with keyed state"}
    for spec in specs:
        state = store.latest().get(spec.name)
        if state is not None and state.liveWindows and (state.mode or mode) != mode:
            raise ValueError(f"the store holds metric {spec.name!r} as fed by {fed[state.mode]}")


def stored_form(store: StateStore, spec: MetricSpec) -> MetricSpec:
    """The form of ``spec`` whose partials the store holds: its streamed form, or itself."""
    schema = store.partial_schema(spec.name)
    if spec.streamed is not None and schema is not None:
        if set(schema.names) == {*spec.streamed.keys, *spec.streamed.sums}:
            return spec.streamed
    return spec


def run_metrics(spark: SparkSession, tables: Mapping[str, DataFrame], specs: Sequence[MetricSpec],
                store: StateStore, cut: Mapping[str, dt.date] | None = None,
                now: dt.datetime | None = None,
                facts: Mapping[str, FactTable] = FACT_TABLES, ledger: bool = False) -> dict[str, MetricState]:
    """One run of the job over the given metrics; returns the new state rows.  [R1, R2]

    With ``ledger`` each window's days are noted with their row counts and checksums, so that
    ``late_days.recount`` can find rows that arrive later for days already counted.

    ``cut`` (fact table -> day) replays history: that table is seen as it stood at
    the end of the day.  A metric whose increment holds no dated row keeps its state and
    writes nothing.  Rows that arrive after the bounds were found and are later than them
    wait for the next run.
    """
    cut = dict(cut or {})
    for spec in specs:
        require_tables(tables, spec.required)
    require_mode(store, specs, BATCH)
    states = current_states(store, specs)
    wanted = {spec.name: (spec.source, states[spec.name].dateTo) for spec in specs}

    def measured(source: str, watermark: dt.date | None) -> tuple[DataFrame, Span]:
        rows = increment_of(tables, facts[source], watermark, cut.get(source))
        return rows, span(facts[source], rows)

    with ThreadPoolExecutor(max_workers=MAX_CONCURRENT_JOBS) as pool:
        jobs = {key: pool.submit(measured, *key) for key in set(wanted.values())}
        found = {key: job.result() for key, job in jobs.items()}
    due = [spec for spec in specs if found[wanted[spec.name]][1].last is not None]
    frozen = {key: facts[key[0]].as_of(rows, seen.last) for key, (rows, seen) in found.items()}
    increments, spans, windows, ranges = {}, {}, {}, {}
    attempt = uuid.uuid4().hex[:8]
    for spec in due:
        increments[spec.name] = frozen[wanted[spec.name]]
        spans[spec.name] = found[wanted[spec.name]][1]
        windows[spec.name] = window_key(states[spec.name].dateTo, attempt)
        ranges[spec.name] = (states[spec.name].dateTo, found[wanted[spec.name]][1].last)
    committed = commit_increments(tables, due, store, states, increments, windows, spans, now,
                                  noted=Noted(facts, ranges) if ledger else None)
    return {spec.name: committed.get(spec.name, replace(states[spec.name], committedWindow=None))
            for spec in specs}


LEDGER = "ledger of days"


def ledger_columns(specs: Sequence[MetricSpec]) -> list[str]:
    """The fact columns that any of the metrics reads."""
    return sorted({c for spec in specs for c in spec.required[spec.source]})


def day_ledger(fact: FactTable, columns: Sequence[str]) -> Reduction:
    """Rows and two order-free checksums (sums of 24 bits of each row's hash) for each day."""
    def bits() -> dict[str, Column]:
        row_hash = F.xxhash64(*columns)
        return {"rows": F.lit(1), "check_high": F.shiftrightunsigned(row_hash, 40),
                "check_low": row_hash.bitwiseAND(F.lit(0xFFFFFF))}
    return Reduction(keys=lambda: {"day": fact.day()}, sums=bits)


@dataclass(frozen=True)
class Noted:
    """What an increment's ledger needs: the fact tables, and each metric's days (after, until)."""
    facts: Mapping[str, FactTable]
    ranges: Mapping[str, tuple[dt.date | None, dt.date]]
    columns: Sequence[str] | None = None        # hashed columns, if other than those the metrics read

    def hashed(self, specs: Sequence[MetricSpec]) -> list[str]:
        return list(self.columns or ledger_columns(specs))

    def reduction(self, specs: Sequence[MetricSpec]) -> Reduction:
        return day_ledger(self.facts[specs[0].source], self.hashed(specs))

    def write(self, store: StateStore, specs: Sequence[MetricSpec], windows: Mapping[str, str], days: DataFrame) -> None:
        """One ledger for the metrics of an increment: they share its window's name."""
        after, until = self.ranges[specs[0].name]
        days.select("day", "rows", "check_high", "check_low", F.lit(after).cast("date").alias("after"),
                    F.lit(until).cast("date").alias("until"), F.lit(",".join(self.hashed(specs))).alias("columns")
                    ).coalesce(1).write.parquet(store.ledger_path(specs[0].source, windows[specs[0].name]))


def by_increment(specs: Sequence[MetricSpec], increments: Mapping[str, DataFrame]
                 ) -> list[tuple[DataFrame, list[MetricSpec]]]:
    """The distinct increments, each with the metrics that read it."""
    groups: dict[int, tuple[DataFrame, list[MetricSpec]]] = {}
    for spec in specs:
        rows = increments[spec.name]
        groups.setdefault(id(rows), (rows, []))[1].append(spec)
    return list(groups.values())


def shared_reductions(rows: DataFrame, specs: Sequence[MetricSpec], path: str, noted: Noted | None = None
                      ) -> dict[str, DataFrame]:
    """Reduced rows of every metric of one increment, from one scan; none where nothing is shared.  [R1]

    The tagged aggregate is written once, a folder for each metric, so that finishing one
    metric neither scans the facts again nor reads the others' rows.  The increment's ledger is one more
    reduction of the same scan.
    """
    reductions = {spec.name: spec.reduction for spec in specs if spec.reduction is not None}
    if noted:
        reductions[LEDGER] = noted.reduction(specs)
    elif len(reductions) < 2:
        return {}
    together = reduced_together(rows, reductions)
    together.write.partitionBy(TAG).parquet(path)
    written = rows.sparkSession.read.schema(together.schema).parquet(path)
    return {name: unpacked(written, reductions, name) for name in reductions}


def commit_increments(tables: Mapping[str, DataFrame], specs: Sequence[MetricSpec],
                      store: StateStore, states: Mapping[str, MetricState],
                      increments: Mapping[str, DataFrame], windows: Mapping[str, str],
                      spans: Mapping[str, Span], now: dt.datetime | None = None,
                      batch: tuple[str, int] | None = None, noted: Noted | None = None,
                      replacing: Mapping[str, str] | None = None, mode: str | None = None) -> dict[str, MetricState]:
    """Write each metric's partial of its increment under its window, then commit.

    Metrics with the same increment share one scan of it (``shared_reductions``).  Partial writes of
    different metrics run concurrently; the new state version is written only after all of them succeeded.  Only committed windows are ever read, and
    no window name is used by two attempts, so a retry never counts a row twice.
    ``batch`` (streaming query id, batch id) is noted in the state with a micro-batch.  ``noted`` asks for
    ledgers, ``replacing`` (metric -> live window) names windows that the new ones stand in for.  ``mode`` is
    noted as what feeds the metrics (without it: a stream where there is a batch, else batch runs).
    """
    if not specs:
        return {}
    now = now or dt.datetime.now().replace(microsecond=0)

    def write_partial(spec: MetricSpec, shared: Mapping[str, DataFrame]) -> None:
        rows = increments[spec.name]
        made = spec.finished(tables, shared[spec.name]) if spec.name in shared else spec.partial(tables, rows)
        store.write_partial(spec.name, windows[spec.name], check_partial(spec, made), spec.ranked)

    with ThreadPoolExecutor(max_workers=MAX_CONCURRENT_JOBS) as pool, store.scratch() as folder:
        groups = [(of_rows, pool.submit(shared_reductions, rows, of_rows, f"{folder}/reduced-{i}", noted))
                  for i, (rows, of_rows) in enumerate(by_increment(specs, increments))]
        shared = {name: rows for _, job in groups for name, rows in job.result().items()}
        if noted:
            for of_rows, job in groups:
                noted.write(store, of_rows, windows, job.result()[LEDGER])
        for job in [pool.submit(write_partial, spec, shared) for spec in specs]:
            job.result()

    new_rows: dict[str, MetricState] = {}
    for spec in specs:
        old, seen = states[spec.name], spans[spec.name]
        batches = {**old.lastBatches, batch[0]: batch[1]} if batch else old.lastBatches
        if replacing:
            old = replace(old, liveWindows=tuple(w for w in old.liveWindows if w != replacing[spec.name]))
        new_rows[spec.name] = old.committing(
            windows[spec.name], date=now, lastBatches=batches, mode=mode or (STREAM if batch else BATCH),
            dateFrom=min((d for d in (old.dateFrom, seen.first) if d is not None), default=None),
            dateTo=max((d for d in (old.dateTo, seen.last) if d is not None), default=None))
    others = [replace(r, committedWindow=None) for n, r in states.items() if n not in new_rows]
    store.commit(list(new_rows.values()) + others)
    return new_rows


def results(tables: Mapping[str, DataFrame], specs: Sequence[MetricSpec],
            store: StateStore) -> dict[str, MetricResult]:
    """Merged results of every committed increment (empty when there is none yet)."""
    states = current_states(store, specs)
    return {spec.name: read_result(tables, spec, store, states[spec.name]) for spec in specs}


def read_result(tables: Mapping[str, DataFrame], spec: MetricSpec, store: StateStore,
                state: MetricState) -> MetricResult:
    spec = stored_form(store, spec)
    merged = store.merged(spec.name, spec.keys, spec.sums)
    if merged is None:
        merged = empty_partial(tables, spec)
    return MetricResult(tables, spec, merged, state, store)


def write_results(res: Mapping[str, MetricResult]) -> None:
    """Full result as Parquet at ``pathAll``, top result as CSV at ``path``.

    The top is one file where it is a top-N, and a file per task where it is not bounded
    (a rank depth per group).  Both are derived data: they are rebuilt from the partials on every run and
    never read back for merging.
    """
    with ThreadPoolExecutor(max_workers=MAX_CONCURRENT_JOBS) as pool:
        jobs = []
        for r in res.values():
            if r.state.pathAll:
                jobs.append(pool.submit(write_parquet, r.full, r.state.pathAll))
            if r.state.path:
                write = write_single_csv if r.bounded_top else write_csv_dir
                jobs.append(pool.submit(write, r.top, r.state.path))
        for job in jobs:
            job.result()


def compact(store: StateStore, specs: Sequence[MetricSpec], min_windows: int = 2) -> dict[str, str]:
    """Fold the windows of every metric that has a tier of at least ``min_windows``."""
    due = {spec.name: (spec.keys, spec.sums, spec.ranked) for spec in (stored_form(store, s) for s in specs)}
    return store.compact(due, min_windows, ledgers={s.name: s.source for s in specs})


# ``run_job`` and the stream fold a metric's windows of one tier when there are this many.
COMPACT_AFTER_WINDOWS = 10


def run_job(spark: SparkSession, tables: Mapping[str, DataFrame], specs: Sequence[MetricSpec],
            store: StateStore, cut: Mapping[str, dt.date] | None = None,
            write: bool = True, facts: Mapping[str, FactTable] = FACT_TABLES,
            compact_after: int | None = COMPACT_AFTER_WINDOWS, ledger: bool = False,
            ) -> dict[str, MetricResult]:
    """Run, compact long window lists, then read (and write out) every metric's result.  [R3]"""
    run_metrics(spark, tables, specs, store, cut=cut, facts=facts, ledger=ledger)
    if compact_after:
        compact(store, specs, compact_after)
    res = results(tables, specs, store)
    if write:
        write_results(res)
    return res


def empty_partial(tables: Mapping[str, DataFrame], spec: MetricSpec) -> DataFrame:
    """The partial of an empty increment (right schema, no rows)."""
    inc = tables[spec.source].limit(0)
    return spec.partial(tables, inc)


def full_recompute(tables: Mapping[str, DataFrame], spec: MetricSpec,
                   top: int | None = None) -> DataFrame:
    """One pass over all rows, no state: partial of everything, then finalize.  [R4]"""
    require_tables(tables, spec.required)
    partial = spec.partial(tables, tables[spec.source])
    return spec.finalize(tables, partial, spec.top if top is None else top, spec.order)
