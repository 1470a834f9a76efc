"""Versioned metric state and the partial-result store.

Layout under a store root (any Hadoop-compatible filesystem)::

    state/version=N/part-*.parquet         one row per metric (STATE schema)
    partials/<metric>/window_start=W/      the partial aggregate of one increment
    heads/<metric>/window_start=W/         the partial's rows of largest sums, of a ranked metric
    ledger/<fact table>/window=W/          days, row counts and checksums that an increment held
    staging/<attempt>/                     a version being written, not yet claimed

Protocol (one writer per store; a second writer racing for the same version fails at the commit):

1. read the newest state version; a metric's watermark is its ``dateTo``;
2. write the increment's partial to ``partials/<metric>/window_start=<old dateTo
   or 'none'>.<attempt id>``: every attempt writes its own folder;
3. write the new rows to a staging folder of this attempt and rename that folder to
   ``state/version=N+1``.  The rename is the commit: the file system lets only one
   attempt have the name, rows included;
4. readers merge only the windows that the newest version lists as live, so the
   partial of a crashed or losing attempt stays invisible.

Every version is a whole snapshot, so a reader needs the newest one alone, however long the
history is.  Versions are numbered without gaps and must not be deleted (the newest is found by
probing names).  Nothing is ever overwritten while it is being read, so an executor lost in the
middle of a run costs a task retry or, at worst, a rerun of the whole job.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricfold.operators.aggregates import merge_sums
from metricfold.schemas import STATE
from metricfold.sources.csv import read_csv

NO_WINDOW = "none"
COMPACTED_PREFIX = "compact-"
HEAD_ROWS = 1_000       # rows of a window's head


@dataclass(frozen=True)
class MetricState:
    metricName: str
    top: int
    order: str
    date: dt.datetime | None = None
    dateFrom: dt.date | None = None
    dateTo: dt.date | None = None
    path: str | None = None
    pathAll: str | None = None
    committedWindow: str | None = None
    liveWindows: tuple[str, ...] = ()
    lastBatches: Mapping[str, int] = field(default_factory=dict)
    mode: str | None = None             # what feeds the metric: "batch", "stream" or "keyed"

    def as_tuple(self):
        return (self.metricName, self.top, self.order, self.date, self.dateFrom, self.dateTo,
                self.path, self.pathAll, self.committedWindow, list(self.liveWindows),
                dict(self.lastBatches), self.mode)

    def committing(self, window: str, **changes) -> MetricState:
        """This state with ``window`` committed on top of the live ones."""
        return replace(self, committedWindow=window, liveWindows=(*self.liveWindows, window), **changes)


def _day(value) -> dt.date | None:
    if value is None or isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value
    return value.date()


def _state(row) -> MetricState:
    values = row.asDict()
    return MetricState(**{**values, "liveWindows": tuple(values["liveWindows"] or ()),
                          "lastBatches": dict(values["lastBatches"] or {})})


class StateStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.state_dir = f"{self.root}/state"
        self.partial_dir = f"{self.root}/partials"
        self._newest: tuple[int | None, dict[str, MetricState]] | None = None
        self._schemas: dict[str, T.StructType] = {}

    # ---- files ----------------------------------------------------------------------

    def _file(self, path: str):
        """Hadoop file system and path object of ``path``."""
        handle = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return handle.getFileSystem(self.spark._jsc.hadoopConfiguration()), handle

    @contextmanager
    def scratch(self) -> Iterator[str]:
        """Name of a folder of this store for one attempt's intermediate tables; deleted at the end."""
        path = f"{self.root}/staging/{uuid.uuid4().hex}"
        try:
            yield path
        finally:
            files, handle = self._file(path)
            files.delete(handle, True)

    def exists(self, path: str) -> bool:
        files, handle = self._file(path)
        return files.exists(handle)

    def _claim(self, staged: str, target: str) -> None:
        """Rename ``staged`` to ``target``; FileExistsError when another writer has that name.

        A local rename onto a folder that holds files fails in the kernel, and HDFS checks and
        renames under one lock.
        """
        files, source = self._file(staged)
        _, goal = self._file(target)
        files.mkdirs(goal.getParent())
        taken = FileExistsError(f"{target} already exists: another writer committed it")
        if files.getUri().getScheme() == "file":
            try:
                os.rename(source.toUri().getPath(), goal.toUri().getPath())
            except OSError as refused:
                if os.path.isdir(goal.toUri().getPath()):
                    raise taken from refused
                raise
            return
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration())
        keep = self.spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(source), files.makeQualified(goal), keep)
        except Py4JJavaError as refused:
            if "AlreadyExists" in refused.java_exception.getClass().getName():
                raise taken from refused
            raise

    # ---- state table --------------------------------------------------------------

    def table(self) -> DataFrame:
        """The state table as a DataFrame: every version's rows, with their ``version``.

        For inspection and SQL (``store.table().createOrReplaceTempView(...)``); the
        ``version`` partition column prunes a filter on it to one folder.
        """
        schema = T.StructType(STATE.fields + [T.StructField("version", T.IntegerType(), True)])
        return self.spark.read.schema(schema).parquet(self.state_dir)

    def _version_dir(self, version: int) -> str:
        return f"{self.state_dir}/version={version}"

    def _find_newest(self) -> int | None:
        """Newest version by doubling steps and halving: a few name checks, no listing."""
        low, step = -1, 1
        while self.exists(self._version_dir(low + step)):
            low, step = low + step, step * 2
        high = low + step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.exists(self._version_dir(middle)) else (low, middle)
        return None if low < 0 else low

    def _snapshot(self) -> tuple[int | None, dict[str, MetricState]]:
        """Number and rows (one per metric) of the newest version.

        Read once per store object, then kept in step with this object's commits: a run works on
        one version from start to commit, and the commit fails if another writer was faster.
        """
        if self._newest is None:
            version, states = self._find_newest(), {}
            if version is not None:
                for row in self.spark.read.schema(STATE).parquet(self._version_dir(version)).collect():
                    if row["metricName"] in states:
                        raise ValueError(f"state version {version} holds metric {row['metricName']!r} twice")
                    states[row["metricName"]] = _state(row)
            self._newest = version, states
        return self._newest

    def latest_version(self) -> int | None:
        return self._snapshot()[0]

    def latest(self) -> dict[str, MetricState]:
        """Rows of the newest version, by metric."""
        return dict(self._snapshot()[1])

    def state_of(self, metric: str) -> MetricState:
        """The newest state row of one metric (error if it has none).  [S6]"""
        states = self.latest()
        if metric not in states:
            raise KeyError(f"no state row for metric {metric!r}")
        return states[metric]

    def commit(self, rows: list[MetricState]) -> int:
        """Write the next version; returns its number.  [K5]

        FileExistsError when another writer committed that version first: nothing of this attempt
        is visible then, and the next call reads the state anew.
        """
        current = self.latest_version()
        version = 0 if current is None else current + 1
        staged = f"{self.root}/staging/{uuid.uuid4().hex}"
        df = self.spark.createDataFrame([r.as_tuple() for r in rows], STATE)
        df.coalesce(1).write.mode("errorifexists").parquet(staged)
        self._newest = None
        self._claim(staged, self._version_dir(version))
        self._newest = version, {r.metricName: r for r in rows}
        return version

    def seed(self, rows: list[MetricState]) -> None:
        """Create version 0 when the store is empty."""
        if self.latest_version() is None:
            self.commit(rows)

    def read_seed(self, path: str) -> list[MetricState]:
        """Rows of a CSV state file, one per metric; columns are bound by name, in any order.  [S5]"""
        df = read_csv(self.spark, path, schema=None, infer=False)
        cols = set(df.columns)
        typed = df.select(*[
            (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STATE.fields
        ])
        rows = [_state(r) for r in typed.collect()]
        return [replace(r, dateFrom=_day(r.dateFrom), dateTo=_day(r.dateTo)) for r in rows]

    def seed_from_csv(self, path: str) -> None:
        """Seed an empty store with a CSV state file's rows as they stand.

        ``runner.seed_from_saved`` takes the results along that the rows' dates claim.
        """
        self.seed(self.read_seed(path))

    def committed_windows(self, metric: str) -> list[str]:
        """Windows whose partials make up the metric's current result."""
        state = self._snapshot()[1].get(metric)
        return [] if state is None else sorted(state.liveWindows)

    def compact(self, metrics: Mapping[str, tuple], fan: int = 2, ledgers: Mapping[str, str] | None = None) -> dict[str, str]:
        """Fold windows of like size, tier by tier; one commit for all metrics.

        ``metrics`` maps metric name -> ``(keys, sums)``, and the sum it is ranked by, if it keeps heads.  An increment's window is of tier 0.  A tier
        that holds ``fan`` windows or more is folded into one window of the next tier (which may fill that one:
        then both are folded at once), so a large window is read and written again only together with
        ``fan`` others of its size: n runs write a partial O(log n) times each, and a result is spread over fewer than
        ``fan`` windows a tier.  The folded partials are written under a fresh window name and committed by the
        next version, so a crash in between leaves them invisible.  ``ledgers`` (metric -> fact table) names the
        metrics whose windows' ledgers are folded along.  Returns metric -> new window.
        """
        due = {m: folding(self.committed_windows(m), fan) for m in metrics}
        due = {m: windows for m, windows in due.items() if windows}
        if not due:
            return {}
        # Metrics that fold the same windows share the new one's name, as they share the increments'.
        sets = sorted({tuple(windows) for windows in due.values()})
        stamp = f"{self.latest_version() + 1:09d}.{uuid.uuid4().hex[:8]}"
        named = {m: f"{COMPACTED_PREFIX}{1 + max(map(tier, windows))}-{stamp}{sets.index(tuple(windows))}"
                 for m, windows in due.items()}

        def fold(metric: str) -> None:
            keys, sums, *ranked = metrics[metric]
            merged = merge_sums(self.read_partials(metric, due[metric]), list(keys), list(sums))
            self.write_partial(metric, named[metric], merged, *ranked)

        def fold_ledger(source: str, new: str, windows: tuple[str, ...]) -> None:
            paths = [self.ledger_path(source, w) for w in windows]
            if all(self.exists(path) for path in paths):
                self.spark.read.parquet(*paths).coalesce(1).write.parquet(self.ledger_path(source, new))

        shared = {(source, named[m], tuple(due[m])) for m, source in (ledgers or {}).items() if m in due}
        with ThreadPoolExecutor(max_workers=8) as pool:
            for job in [*[pool.submit(fold, m) for m in due], *[pool.submit(fold_ledger, *each) for each in shared]]:
                job.result()
        rows = [replace(r, committedWindow=named[name],
                        liveWindows=(named[name], *(w for w in r.liveWindows if w not in due[name]))) if name in due
                else replace(r, committedWindow=None) for name, r in self.latest().items()]
        self.commit(rows)
        return named

    def retired_windows(self, metric: str) -> list[str]:
        """Windows committed at some time but superseded by a compaction.

        Their partial folders are no longer read and may be deleted.
        """
        if self.latest_version() is None:
            return []
        rows = (self.table().filter((F.col("metricName") == metric) & F.col("committedWindow").isNotNull())
                .select("committedWindow").distinct().collect())
        return sorted({r["committedWindow"] for r in rows} - set(self.committed_windows(metric)))

    def unreferenced_windows(self, metric: str) -> list[str]:
        """Partial folders that no current result reads: retired by a compaction, or
        written by an attempt that never committed.  Safe to delete.

        Found from the partial dataset's file listing (``inputFiles``); no data is read.
        """
        if not self.exists(f"{self.partial_dir}/{metric}"):
            return []
        files = self.spark.read.parquet(f"{self.partial_dir}/{metric}").inputFiles()
        present = {seg.split("=", 1)[1] for f in files for seg in f.split("/")
                   if seg.startswith("window_start=")}
        return sorted(present - set(self.committed_windows(metric)))

    # ---- ledgers ------------------------------------------------------------------

    def ledger_path(self, source: str, window: str) -> str:
        return f"{self.root}/ledger/{source}/window={window}"

    # ---- partials -----------------------------------------------------------------

    def partial_path(self, metric: str, window: str) -> str:
        return f"{self.partial_dir}/{metric}/window_start={window}"

    def head_path(self, metric: str, window: str) -> str:
        return f"{self.root}/heads/{metric}/window_start={window}"

    def write_partial(self, metric: str, window: str, df: DataFrame, ranked: str | None = None) -> None:
        """Write a window's partial, and the head of its rows by ``ranked``, if given."""
        path = self.partial_path(metric, window)
        (df.sortWithinPartitions(F.desc(ranked)) if ranked else df).write.mode("overwrite").parquet(path)
        self._schemas[metric] = df.schema
        if ranked:
            head = self.spark.read.schema(df.schema).parquet(path).orderBy(F.desc(ranked)).limit(HEAD_ROWS)
            head.write.mode("overwrite").parquet(self.head_path(metric, window))

    def partial_schema(self, metric: str) -> T.StructType | None:
        """Columns of the committed partials (a footer, or the write in this process), else None."""
        windows = self.committed_windows(metric)
        if windows and metric not in self._schemas:
            self._schemas[metric] = self.spark.read.parquet(self.partial_path(metric, windows[0])).schema
        return self._schemas[metric] if windows else None

    def read_partials(self, metric: str, windows: Sequence[str] | None = None) -> DataFrame | None:
        """Committed partials of ``metric`` (of all live ``windows``), or None when there is no prior result.  [S7]

        Only the folders of these windows are listed and read.
        """
        schema = self.partial_schema(metric)
        if schema is None:
            return None
        chosen = self.committed_windows(metric) if windows is None else windows
        paths = [self.partial_path(metric, window) for window in chosen]
        return self.spark.read.schema(schema).parquet(*paths)

    def read_heads(self, metric: str) -> DataFrame | None:
        """Heads of all live windows; None unless each of them has one."""
        paths = [self.head_path(metric, window) for window in self.committed_windows(metric)]
        if not paths or not all(self.exists(path) for path in paths):
            return None
        return self.spark.read.schema(self.partial_schema(metric)).parquet(*paths)

    def merged(self, metric: str, keys, sums) -> DataFrame | None:
        parts = self.read_partials(metric)
        if parts is None:
            return None
        return merge_sums(parts, list(keys), list(sums))


def tier(window: str) -> int:
    """0 for an increment's window, else how often its oldest rows were folded."""
    if not window.startswith(COMPACTED_PREFIX):
        return 0
    number = window.removeprefix(COMPACTED_PREFIX).split("-")
    return int(number[0]) if len(number) > 1 else 1     # windows of earlier versions name no tier


def folding(windows: Sequence[str], fan: int) -> list[str]:
    """The windows to fold into one: those of the lowest full tier, and of the next ones that this fills."""
    by_tier: dict[int, list[str]] = {}
    for window in windows:
        by_tier.setdefault(tier(window), []).append(window)
    fan = max(fan, 2)
    full = [t for t, held in by_tier.items() if len(held) >= fan]
    if not full:
        return []
    at, chosen = min(full), list(by_tier[min(full)])
    while len(by_tier.get(at + 1, ())) + 1 >= fan:
        at += 1
        chosen += by_tier[at]
    return chosen


def window_key(watermark: dt.date | None, attempt: str | None = None) -> str:
    """Window name: the old watermark it starts after, plus the writing attempt's id.

    The attempt id keeps two runs from ever writing the same folder: a crashed or
    losing attempt leaves a folder that no version names, never a modified one.
    """
    base = NO_WINDOW if watermark is None else watermark.isoformat()
    return base if attempt is None else f"{base}.{attempt}"
