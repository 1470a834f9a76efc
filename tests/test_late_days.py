"""Late and changed days, the audit, tiered compaction and the quarantine scan."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from metricfold.plans import metrics as M
from metricfold.plans.late_days import audit, recount
from metricfold.plans.runner import compact, full_recompute, results, run_metrics
from metricfold.plans.state import StateStore, folding, tier
from metricfold.schemas import struct
from metricfold.sources.csv import read_csv_checked
from metricfold.sources.tables import Tables
from tests.conftest import SF_SMALL

FIRST, SECOND = {"lineitem": dt.date(1996, 6, 30), "events": dt.date(2024, 1, 10)}, {
    "lineitem": dt.date(1999, 6, 30), "events": dt.date(2024, 1, 20)}


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def changed(tables):
    """Rows of one early day are missing, one row of a late day has another value, a row has no day yet."""
    lines, events = tables["lineitem"], tables["events"]
    lines = lines.filter("NOT (to_date(l_shipdate) = date'1998-03-03') AND l_linenumber < 7")
    events = events.withColumn("value", F.when(F.col("event_id") == 40, 123.0).otherwise(F.col("value"))).filter("event_id <> 7")
    return tables.replace("lineitem", lines).replace("events", events)


@pytest.mark.parametrize("compacted", [False, True])
def test_recount_finds_late_and_changed_days(spark, workdir, compacted):
    tables = Tables(spark, SF_SMALL)
    specs, store = list(M.ALL_METRICS), StateStore(spark, workdir)
    before = changed(tables)
    for cut in (FIRST, SECOND, None):
        run_metrics(spark, before, specs, store, cut=cut, ledger=True)
    if compacted:
        compact(store, specs, 3)
        assert all(len(store.committed_windows(s.name)) == 1 for s in specs)
    done = recount(spark, tables, specs, store)
    assert all(done[s.name] for s in specs)
    merged = results(tables, specs, store)
    for spec in specs:
        assert bag(merged[spec.name].top) == bag(full_recompute(tables, spec)), spec.name
    version = store.latest_version()
    assert not any(recount(spark, tables, specs, store).values()) and store.latest_version() == version


def test_only_windows_with_changed_days_are_recounted(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    for cut in (FIRST, SECOND, None):
        run_metrics(spark, tables, [M.TOP_ORIGINS], store, cut=cut, ledger=True)
    before = store.committed_windows("top_origins")
    lines = tables["lineitem"]
    more = lines.unionByName(lines.filter("to_date(l_shipdate) BETWEEN date'1997-01-01' AND date'1997-01-31'"))
    tables = tables.replace("lineitem", more)
    assert recount(spark, tables, [M.TOP_ORIGINS], store) == {"top_origins": [(FIRST["lineitem"], SECOND["lineitem"])]}
    assert len(set(before) & set(store.committed_windows("top_origins"))) == 2
    assert bag(results(tables, [M.TOP_ORIGINS], store)["top_origins"].full) == bag(full_recompute(tables, M.TOP_ORIGINS, 10_000))


def test_recount_needs_ledgers(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    run_metrics(spark, tables, [M.SHARE_BY_REASON], store)
    with pytest.raises(ValueError, match="have no ledger"):
        recount(spark, tables, [M.SHARE_BY_REASON], store)


def test_audit(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    specs = list(M.ALL_METRICS)
    run_metrics(spark, tables, specs, store)
    for spec in specs:
        assert audit(spark, tables, spec, store).count() == 0, spec.name
    one = tables["lineitem"].filter("l_discount = 0").orderBy("l_orderkey", "l_linenumber").limit(1)
    more = tables.replace("lineitem", tables["lineitem"].unionByName(one))
    got = {r["side"]: (r["supplier"], r["on_time"]) for r in audit(spark, more, M.ON_TIME_SUPPLIERS, store).collect()}
    assert got["facts"] == (one.first()["l_suppkey"], got["stored"][1] + 1) and got["stored"][0] == got["facts"][0]


# ---- compaction -----------------------------------------------------------------------------------

def test_tiers_write_each_row_a_logarithmic_number_of_times():
    """Every run writes one row; a fold writes the rows of its windows."""
    for fan in (2, 3, 10):
        live, rows, written, most = [], {}, 0, 0
        for n in range(300):
            live.append(f"w{n}")
            rows[f"w{n}"] = 1
            due = folding(live, fan)
            if due:
                new = f"compact-{1 + max(map(tier, due))}-{n:09d}.x"
                rows[new] = sum(rows[w] for w in due)
                written += rows[new]
                live = [new, *(w for w in live if w not in due)]
            most = max(most, len(live))
        tiers = math.ceil(math.log(300, fan)) + 1
        assert sum(rows[w] for w in live) == 300
        assert written <= 300 * tiers and most <= fan * tiers, fan


def test_compacted_store_keeps_its_result(spark, workdir):
    tables = Tables(spark, SF_SMALL)
    store = StateStore(spark, workdir)
    specs = [M.SHARE_BY_REASON, M.FIRST_REASON_COUNTS]
    for day in (3, 6, 9, 12, 15, 18, None):
        run_metrics(spark, tables, specs, store, cut={"events": dt.date(2024, 1, day)} if day else None)
        compact(store, specs, 3)
    assert sorted(map(tier, store.committed_windows("share_by_reason"))) == [0, 1, 1]
    merged = results(tables, specs, StateStore(spark, workdir))
    for spec in specs:
        assert bag(merged[spec.name].top) == bag(full_recompute(tables, spec))


# ---- quarantine -------------------------------------------------------------------------------------

def test_quarantine(spark, workdir, tmp_path):
    schema = struct("id bigint, name string, day date")
    files = {
        "a.csv": "id,name,day\n1,x,2024-01-01\n2,\"y, z\",2024-01-02\nthree,w,2024-01-03\n4,v\n5,,\n",
        "b.csv": "note,day,id,name\nn,2024-02-30,6,u\nn,2024-02-03,7,t\n",
        "c.csv": "8,s,2024-01-08\n9,r,2024-01-09\n",
        "empty.csv": "",
        "headeronly.csv": "name,id,day\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    scan = read_csv_checked(spark, str(tmp_path), schema)
    assert [(r.id, r.name, str(r.day)) for r in sorted(scan.rows.collect())] == [
        (1, "x", "2024-01-01"), (2, "y, z", "2024-01-02"), (5, None, "None"), (7, "t", "2024-02-03")]
    bad = sorted((r.file.rsplit("/", 1)[1], r.reason, r.record) for r in scan.quarantine.collect())
    assert bad == [("a.csv", "malformed", "4,v"), ("a.csv", "malformed", "three,w,2024-01-03"),
                   ("b.csv", "malformed", "n,2024-02-30,6,u"), ("c.csv", "no header", "8,s,2024-01-08"), ("c.csv", "no header", "9,r,2024-01-09")]
    assert sorted((r.file.rsplit("/", 1)[1], r.n) for r in scan.counts().collect()) == [("a.csv", 2), ("b.csv", 1), ("c.csv", 2)]
    assert (scan.rows.count(), scan.quarantine.count()) == (4, 5)
    only_bad = tmp_path / "only"
    only_bad.mkdir()
    (only_bad / "x.csv").write_text("1,2,3\n")
    scan = read_csv_checked(spark, str(only_bad), schema)
    assert scan.rows.count() == 0 and scan.quarantine.count() == 1
