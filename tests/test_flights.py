"""The six flight metrics and the CSV job, on hand-made fixtures with hand-computed results."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from metricfold.plans import flights as FL
from metricfold.plans.runner import full_recompute, results, run_metrics
from metricfold.plans.state import MetricState, StateStore
from metricfold.schemas import AIRLINES, AIRPORTS, FLIGHTS
from metricfold.sources.csv import read_csv

COLS = [f.name for f in FLIGHTS.fields]

# (day, airline, origin, destination, departure delay, arrival delay, five reason columns)
FLIGHT_ROWS = [
    (1, "XX", "AAA", "BBB", 0, 0, None),
    (1, "YY", "AAA", "BBB", 5, 10, (0, 0, 10, 0, 0)),
    (2, "XX", "BBB", "AAA", 0, 0, None),
    (2, "XX", "AAA", "BBB", 0, -3, None),
    (3, "YY", "BBB", "AAA", 20, 25, (5, 0, 0, 20, 0)),
    (3, "XX", "AAA", "BBB", None, None, None),          # cancelled: no delays at all
]
AIRPORT_ROWS = [("AAA", "Alpha, Intl", "A City", "AS", "US", 1.0, 2.0),
                ('BBB', 'Bravo "Field"', "B City", "BS", "US", None, None)]
AIRLINE_ROWS = [("XX", "X Air"), ("YY", "Y Air")]


def flight_record(day, airline, origin, dest, dep, arr, reasons, year=2015, month=1):
    rec = dict.fromkeys(COLS)
    weekday = dt.date(year, month, day).isoweekday()
    rec.update(YEAR=year, MONTH=month, DAY=day, DAY_OF_WEEK=weekday, AIRLINE=airline,
               FLIGHT_NUMBER=1, ORIGIN_AIRPORT=origin, DESTINATION_AIRPORT=dest,
               SCHEDULED_DEPARTURE="0005", DEPARTURE_DELAY=dep, ARRIVAL_DELAY=arr)
    if reasons:
        rec.update(zip(FL.REASONS, reasons))
    return tuple(rec[c] for c in COLS)


def flights_df(spark, rows=FLIGHT_ROWS):
    return spark.createDataFrame([flight_record(*r) for r in rows], FLIGHTS)


@pytest.fixture()
def tables(spark):
    return {
        "flights": flights_df(spark),
        "airports": spark.createDataFrame(AIRPORT_ROWS, AIRPORTS),
        "airlines": spark.createDataFrame(AIRLINE_ROWS, AIRLINES),
    }


def collect(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_six_metrics_by_hand(spark, tables):
    top = {m.name: full_recompute(tables, m) for m in FL.FLIGHT_METRICS}
    assert collect(top["TopAirportsByFlights"], "ORIGIN_AIRPORT", "AIRPORT", "count") == [
        ("AAA", "Alpha, Intl", 4), ("BBB", 'Bravo "Field"', 2)]
    assert collect(top["OnTimeAirlines"], "AIRLINE_CODE", "AIRLINE", "count") == [("XX", "X Air", 2)]
    pairs = sorted(collect(top["OnTimeFlights"], "ORIGIN_AIRPORT", "position", "AIRLINE",
                           "carrier_total", "carrier_rank", "DESTINATION_AIRPORT",
                           "destination_total", "destination_rank"))
    assert pairs == [("AAA", 1, "XX", 2, 1, "BBB", 2, 1), ("BBB", 1, "XX", 1, 1, "AAA", 1, 1)]
    assert collect(top["FlightsByDayOfWeek"], "DAY_OF_WEEK", "average_delay") == [
        (6, 25.0), (4, 5.0), (5, -1.5)]
    assert sorted(collect(top["DelayReasons"], "Reason", "count")) == [
        ("AIRLINE_DELAY", 1), ("AIR_SYSTEM_DELAY", 1)]
    shares = dict(collect(top["DelayPercent"], "Reason", "Percent"))
    assert shares == pytest.approx({"AIR_SYSTEM_DELAY": 500 / 35, "SECURITY_DELAY": 0.0,
                                    "AIRLINE_DELAY": 1000 / 35, "LATE_AIRCRAFT_DELAY": 2000 / 35,
                                    "WEATHER_DELAY": 0.0})


def test_top_n_cut_off_with_ties(spark, tables):
    # AAA 4 and BBB 2 flights; with top=1 only AAA, and ties break on the name.
    res = full_recompute(tables, FL.TOP_AIRPORTS_BY_FLIGHTS, top=1)
    assert collect(res, "ORIGIN_AIRPORT") == [("AAA",)]
    tied = dict(tables, flights=flights_df(spark, FLIGHT_ROWS[:2] + FLIGHT_ROWS[2:3] + FLIGHT_ROWS[4:5]))
    res = full_recompute(tied, FL.TOP_AIRPORTS_BY_FLIGHTS, top=1)
    assert collect(res, "ORIGIN_AIRPORT") == [("AAA",)]          # 2 vs 2: "Alpha, Intl" first


def test_unknown_airport_is_dropped_by_inner_join(spark, tables):
    rows = FLIGHT_ROWS + [(2, "XX", "ZZZ", "AAA", 1, 1, None)]
    res = full_recompute(dict(tables, flights=flights_df(spark, rows)), FL.TOP_AIRPORTS_BY_FLIGHTS)
    assert sorted(collect(res, "ORIGIN_AIRPORT")) == [("AAA",), ("BBB",)]


def test_all_zero_minutes_give_null_percent(spark, tables):
    rows = [(1, "XX", "AAA", "BBB", 0, 0, (0, 0, 0, 0, 0))]
    res = full_recompute(dict(tables, flights=flights_df(spark, rows)), FL.DELAY_PERCENT)
    assert {r.Percent for r in res.collect()} == {None}


def test_increments_merge_like_one_run_and_rerun_is_noop(spark, tables, workdir):
    store = StateStore(spark, workdir)
    states = run_metrics(spark, tables, FL.FLIGHT_METRICS, store, cut={"flights": dt.date(2015, 1, 2)})
    assert {s.dateTo for s in states.values()} == {dt.date(2015, 1, 2)}
    assert {s.committedWindow.split(".")[0] for s in states.values()} == {"none"}
    run_metrics(spark, tables, FL.FLIGHT_METRICS, store)
    version = store.latest_version()
    merged = results(tables, FL.FLIGHT_METRICS, store)
    for spec in FL.FLIGHT_METRICS:
        expected = full_recompute(tables, spec)
        assert sorted(map(tuple, merged[spec.name].top.collect())) == sorted(
            map(tuple, expected.collect())), spec.name
    # Nothing new: no new version, same results.
    states = run_metrics(spark, tables, FL.FLIGHT_METRICS, store)
    assert store.latest_version() == version
    assert all(s.committedWindow is None for s in states.values())
    again = results(tables, FL.FLIGHT_METRICS, store)
    assert sorted(map(tuple, again["TopAirportsByFlights"].top.collect())) == [
        ("AAA", "Alpha, Intl", 4), ("BBB", 'Bravo "Field"', 2)]
    latest = store.latest()["TopAirportsByFlights"]
    assert (latest.dateFrom, latest.dateTo, latest.top) == (dt.date(2015, 1, 1), dt.date(2015, 1, 3), 10)


def test_crashed_partial_stays_invisible(spark, tables, workdir):
    store = StateStore(spark, workdir)
    run_metrics(spark, tables, [FL.TOP_AIRPORTS_BY_FLIGHTS], store, cut={"flights": dt.date(2015, 1, 1)})
    # A run that wrote its partial but died before committing:
    store.write_partial("TopAirportsByFlights", "2015-01-01",
                        spark.createDataFrame([("AAA", 1000)], "ORIGIN_AIRPORT string, count bigint"))
    res = results(tables, [FL.TOP_AIRPORTS_BY_FLIGHTS], store)["TopAirportsByFlights"].top
    assert collect(res, "ORIGIN_AIRPORT", "count") == [("AAA", 2)]
    # The retry writes its own window and commits that one.
    run_metrics(spark, tables, [FL.TOP_AIRPORTS_BY_FLIGHTS], store)
    assert store.unreferenced_windows("TopAirportsByFlights") == ["2015-01-01"]
    res = results(tables, [FL.TOP_AIRPORTS_BY_FLIGHTS], store)["TopAirportsByFlights"].top
    assert collect(res, "ORIGIN_AIRPORT", "count") == [("AAA", 4), ("BBB", 2)]


def test_merge_keeps_keys_outside_top_n(spark, tables, workdir):
    # top = 1: BBB is not in the top result, but its count must survive merges.
    store = StateStore(spark, workdir)
    spec = FL.TOP_AIRPORTS_BY_FLIGHTS
    from dataclasses import replace

    one = replace(spec, top=1)
    run_metrics(spark, tables, [one], store, cut={"flights": dt.date(2015, 1, 2)})
    run_metrics(spark, tables, [one], store)
    res = results(tables, [one], store)["TopAirportsByFlights"]
    assert collect(res.top, "ORIGIN_AIRPORT", "count") == [("AAA", 4)]
    assert sorted(collect(res.full, "ORIGIN_AIRPORT", "count")) == [("AAA", 4), ("BBB", 2)]


def _write_csv(path, header, rows):
    import csv

    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def test_csv_job_end_to_end(spark, workdir):
    os.makedirs(workdir, exist_ok=True)
    paths = {n: os.path.join(workdir, f"{n}.csv") for n in ("flights", "airports", "airlines")}
    _write_csv(paths["flights"], COLS, [flight_record(*r) for r in FLIGHT_ROWS])
    _write_csv(paths["airports"], [f.name for f in AIRPORTS.fields], AIRPORT_ROWS)
    _write_csv(paths["airlines"], [f.name for f in AIRLINES.fields], AIRLINE_ROWS)
    catalog = os.path.join(workdir, "file_path.csv")
    _write_csv(catalog, ["name", "path"], sorted(paths.items()))
    seed = os.path.join(workdir, "metrics_store.csv")
    header = ["metricName", "top", "order", "date", "dateFrom", "dateTo", "path", "pathAll"]
    _write_csv(seed, header, [
        (m.name, 10, "desc", "2023-01-01", "2010-01-01", "2011-12-31",
         os.path.join(workdir, "out", m.name), os.path.join(workdir, "out", m.name + "All"))
        for m in FL.FLIGHT_METRICS
    ])

    loaded = FL.load_tables(spark, catalog)
    assert collect(loaded["flights"].limit(1), "SCHEDULED_DEPARTURE") == [("0005",)]

    store_root = os.path.join(workdir, "store")
    # The seed claims days whose results are not there: refused, unless they are counted anew.
    with pytest.raises(ValueError, match="start_afresh"):
        FL.run_flight_job(spark, catalog, store_root, seed_csv=seed)
    res = FL.run_flight_job(spark, catalog, store_root, seed_csv=seed,
                            start_afresh=[m.name for m in FL.FLIGHT_METRICS])
    state = res["TopAirportsByFlights"].state
    assert (state.dateFrom, state.dateTo) == (dt.date(2015, 1, 1), dt.date(2015, 1, 3))

    # The single-file CSV export keeps names with comma and quote intact.
    top_dir = os.path.join(workdir, "out", "TopAirportsByFlights")
    files = [f for f in os.listdir(top_dir) if f.endswith(".csv")]
    assert len(files) == 1
    back = read_csv(spark, top_dir, None)
    assert sorted(collect(back, "AIRPORT")) == [("Alpha, Intl",), ('Bravo "Field"',)]
    full = spark.read.parquet(os.path.join(workdir, "out", "TopAirportsByFlightsAll"))
    assert full.count() == 2

    # Second run with no new flights: unchanged.
    before = store.latest_version() if (store := StateStore(spark, store_root)) else None
    FL.run_flight_job(spark, catalog, store_root, seed_csv=seed)
    assert StateStore(spark, store_root).latest_version() == before


def test_missing_column_is_reported(spark, tables):
    from metricfold.operators import MissingColumnsError

    broken = dict(tables, flights=tables["flights"].drop("ARRIVAL_DELAY"))
    with pytest.raises(MissingColumnsError, match=r"The \[ARRIVAL_DELAY\] columns are not in the DF"):
        full_recompute(broken, FL.ON_TIME_AIRLINES)


def test_command_line_job(spark, workdir, capsys):
    from metricfold.__main__ import main

    os.makedirs(workdir, exist_ok=True)
    paths = {n: os.path.join(workdir, f"{n}.csv") for n in ("flights", "airports", "airlines")}
    _write_csv(paths["flights"], COLS, [flight_record(*r) for r in FLIGHT_ROWS])
    _write_csv(paths["airports"], [f.name for f in AIRPORTS.fields], AIRPORT_ROWS)
    _write_csv(paths["airlines"], [f.name for f in AIRLINES.fields], AIRLINE_ROWS)
    catalog = os.path.join(workdir, "file_path.csv")
    _write_csv(catalog, ["name", "path"], sorted(paths.items()))
    store = os.path.join(workdir, "store")
    assert main(["--catalog", catalog, "--store", store, "--as-of", "2015-01-02"]) == 0
    assert "TopAirportsByFlights: dateFrom=2015-01-01 dateTo=2015-01-02 window=none" in capsys.readouterr().out
    assert main(["--catalog", catalog, "--store", store]) == 0
    assert "dateTo=2015-01-03 window=2015-01-02" in capsys.readouterr().out
    assert StateStore(spark, store).state_of("DelayReasons").dateTo == dt.date(2015, 1, 3)


def test_compaction_keeps_results_and_bounds_windows(spark, tables, workdir):
    from metricfold.plans.runner import compact

    store = StateStore(spark, workdir)
    for day in (1, 2, None):
        run_metrics(spark, tables, FL.FLIGHT_METRICS, store,
                    cut={"flights": dt.date(2015, 1, day)} if day else None)
    assert len(store.committed_windows("DelayReasons")) == 3
    before = {m.name: sorted(map(tuple, r.top.collect()))
              for m, r in zip(FL.FLIGHT_METRICS, results(tables, FL.FLIGHT_METRICS, store).values())}
    done = compact(store, FL.FLIGHT_METRICS)
    assert set(done) == {m.name for m in FL.FLIGHT_METRICS}
    for m in FL.FLIGHT_METRICS:
        assert store.committed_windows(m.name) == [done[m.name]]
        assert len(store.retired_windows(m.name)) == 3
        assert store.unreferenced_windows(m.name) == store.retired_windows(m.name)
    after = results(tables, FL.FLIGHT_METRICS, store)
    for m in FL.FLIGHT_METRICS:
        assert sorted(map(tuple, after[m.name].top.collect())) == before[m.name], m.name
    # A new day after compaction is added on top of the compacted window.
    more = dict(tables, flights=flights_df(spark, FLIGHT_ROWS + [(4, "YY", "BBB", "AAA", 1, 1, None)]))
    run_metrics(spark, more, FL.FLIGHT_METRICS, store)
    assert len(store.committed_windows("TopAirportsByFlights")) == 2
    res = results(more, [FL.TOP_AIRPORTS_BY_FLIGHTS], store)["TopAirportsByFlights"].top
    assert collect(res, "ORIGIN_AIRPORT", "count") == [("AAA", 4), ("BBB", 3)]


def test_parquet_flights_partitioned_by_month_are_pruned(spark, workdir):
    from metricfold.plans.facts import FACT_TABLES

    rows = FLIGHT_ROWS + [(1, "XX", "AAA", "BBB", 0, 0, None, 2015, 2)]
    path = os.path.join(workdir, "flights_pq")
    flights_df(spark, [r[:7] for r in rows[:-1]]).unionByName(
        spark.createDataFrame([flight_record(*rows[-1][:7], year=2015, month=2)], FLIGHTS)
    ).write.partitionBy("YEAR", "MONTH").parquet(path)
    df = FL.read_table(spark, path, FLIGHTS)
    assert [f.name for f in df.schema.fields] == COLS
    inc = FACT_TABLES["flights"].after(df, dt.date(2015, 1, 31))
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "MONTH" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert inc.count() == 1


def test_seed_from_saved_state_layout(spark, workdir):
    # The saved layout: columns in another order, timestamps with fractions of a second.
    os.makedirs(workdir, exist_ok=True)
    seed = os.path.join(workdir, "saved_state.csv")
    header = ["pathAll", "dateTo", "path", "metricName", "date", "order", "dateFrom", "top"]
    _write_csv(seed, header, [
        ("/x/all", "2015-12-31 00:00:00.0", "/x/top", "DelayReasons", "2023-06-20 00:07:12.188433",
         "desc", "2015-01-01 00:00:00.0", 10),
    ])
    store = StateStore(spark, os.path.join(workdir, "store"))
    store.seed_from_csv(seed)
    row = store.state_of("DelayReasons")
    assert (row.dateFrom, row.dateTo, row.top, row.order, row.path) == (
        dt.date(2015, 1, 1), dt.date(2015, 12, 31), 10, "desc", "/x/top")
    assert row.date == dt.datetime(2023, 6, 20, 0, 7, 12, 188433)


def test_rows_without_a_day_are_counted_once(spark, tables, workdir):
    undated = flight_record(1, "XX", "AAA", "BBB", 0, 0, None)
    undated = tuple(None if c == "DAY" else v for c, v in zip(COLS, undated))
    flights = flights_df(spark).unionByName(spark.createDataFrame([undated], FLIGHTS))
    data = dict(tables, flights=flights)
    store = StateStore(spark, workdir)
    run_metrics(spark, data, [FL.TOP_AIRPORTS_BY_FLIGHTS], store, cut={"flights": dt.date(2015, 1, 2)})
    run_metrics(spark, data, [FL.TOP_AIRPORTS_BY_FLIGHTS], store)
    res = results(data, [FL.TOP_AIRPORTS_BY_FLIGHTS], store)["TopAirportsByFlights"].top
    assert collect(res, "ORIGIN_AIRPORT", "count") == [("AAA", 5), ("BBB", 2)]
    assert sorted(map(tuple, res.collect())) == sorted(
        map(tuple, full_recompute(data, FL.TOP_AIRPORTS_BY_FLIGHTS).collect()))


def test_partial_must_match_declared_keys_and_sums(spark, tables, workdir):
    from dataclasses import replace

    wrong = replace(FL.TOP_AIRPORTS_BY_FLIGHTS, sums=("flights",))
    with pytest.raises(ValueError, match="expected keys"):
        run_metrics(spark, tables, [wrong], StateStore(spark, workdir))


def test_second_writer_racing_for_a_version_fails(spark, tables, workdir):
    a, b = StateStore(spark, workdir), StateStore(spark, workdir)
    run_metrics(spark, tables, [FL.DELAY_REASONS], a, cut={"flights": dt.date(2015, 1, 1)})
    assert b.latest_version() == 0          # b has now read version 0 and cached it
    run_metrics(spark, tables, [FL.DELAY_REASONS], a, cut={"flights": dt.date(2015, 1, 2)})
    with pytest.raises(Exception, match="(?i)already exists"):
        run_metrics(spark, tables, [FL.DELAY_REASONS], b)
    assert StateStore(spark, workdir).latest_version() == 1


def test_racing_commits_have_one_winner(spark, workdir):
    for trial in range(5):
        root = f"{workdir}/{trial}"
        stores = [StateStore(spark, root) for _ in range(2)]
        assert [s.latest_version() for s in stores] == [None, None]

        def attempt(number):
            try:
                return stores[number].commit([MetricState(f"metric{number}", 10, "desc")])
            except FileExistsError:
                return None

        with ThreadPoolExecutor(2) as pool:
            done = list(pool.map(attempt, range(2)))
        assert sorted(d is None for d in done) == [False, True]
        winner = next(number for number, version in enumerate(done) if version == 0)
        assert list(StateStore(spark, root).latest()) == [f"metric{winner}"]
        assert stores[1 - winner].commit([MetricState("late", 10, "desc")]) == 1     # reads anew


def test_long_history_is_found_by_name(spark, workdir):
    store = StateStore(spark, workdir)
    for number in range(13):
        store.commit([MetricState("m", number, "desc")])
    fresh = StateStore(spark, workdir)
    assert fresh.latest_version() == 12 and fresh.state_of("m").top == 12


def test_empty_run_leaves_no_folder(spark, tables, workdir):
    store = StateStore(spark, workdir)
    run_metrics(spark, tables, [FL.DELAY_REASONS], store)
    run_metrics(spark, tables, [FL.DELAY_REASONS], store)
    assert store.unreferenced_windows("DelayReasons") == []
    assert store.latest_version() == 0


@pytest.mark.parametrize("month, day", [(2, 30), (13, 1), (0, 5), (4, 31)])
def test_impossible_dates_are_counted_once(spark, tables, workdir, month, day):
    def record(m, d):
        made = flight_record(1, "XX", "AAA", "BBB", 0, 0, None)
        return tuple({"MONTH": m, "DAY": d}.get(c, v) for c, v in zip(COLS, made))

    spec = FL.TOP_AIRPORTS_BY_FLIGHTS
    first = spark.createDataFrame([record(2, 26), record(2, 27), record(month, day)], FLIGHTS)
    store = StateStore(spark, workdir)
    run_metrics(spark, dict(tables, flights=first), [spec], store)
    assert store.state_of(spec.name).dateTo == dt.date(2015, 2, 27)
    later = dict(tables, flights=first.unionByName(spark.createDataFrame([record(2, 28)], FLIGHTS)))
    run_metrics(spark, later, [spec], store)
    res = results(later, [spec], store)[spec.name].top
    assert collect(res, "ORIGIN_AIRPORT", "count") == [("AAA", 4)]
    assert collect(full_recompute(later, spec), "count") == [(4,)]


def _saved_job(workdir, airports=AIRPORT_ROWS, flights_header=COLS, flights_rows=None):
    os.makedirs(workdir, exist_ok=True)
    paths = {n: os.path.join(workdir, f"{n}.csv") for n in ("flights", "airports", "airlines")}
    rows = [dict(zip(COLS, flight_record(*r))) for r in flights_rows or FLIGHT_ROWS]
    _write_csv(paths["flights"], flights_header, [[r[c] for c in flights_header] for r in rows])
    _write_csv(paths["airports"], [f.name for f in AIRPORTS.fields], airports)
    _write_csv(paths["airlines"], [f.name for f in AIRLINES.fields], AIRLINE_ROWS)
    catalog = os.path.join(workdir, "file_path.csv")
    _write_csv(catalog, ["name", "path"], sorted(paths.items()))
    saved = os.path.join(workdir, "saved.csv")
    _write_csv(saved, ["AIRPORT", "count"], [("Alpha, Intl", "1000.0"), ('Bravo "Field"', "900.0")])
    seed = os.path.join(workdir, "seed.csv")
    header = ["metricName", "top", "order", "date", "dateFrom", "dateTo", "path", "pathAll"]
    _write_csv(seed, header, [("TopAirportsByFlights", 10, "desc", "2023-01-01", "2014-01-01",
                               "2015-01-02", os.path.join(workdir, "top.csv"), saved)])
    return catalog, seed, saved


def test_saved_results_are_taken_along_and_kept(spark, workdir):
    catalog, seed, saved = _saved_job(workdir)
    before = open(saved).read()
    res = FL.run_flight_job(spark, catalog, os.path.join(workdir, "store"), seed_csv=seed)
    got = res["TopAirportsByFlights"]
    assert collect(got.top, "ORIGIN_AIRPORT", "count") == [("AAA", 1001), ("BBB", 901)]
    assert (got.state.dateFrom, got.state.dateTo) == (dt.date(2014, 1, 1), dt.date(2015, 1, 3))
    assert open(saved).read() == before and os.path.isfile(saved)


def test_saved_name_with_two_codes_is_refused(spark, workdir):
    catalog, seed, _ = _saved_job(workdir, AIRPORT_ROWS + [("CCC", "Alpha, Intl") + (None,) * 5])
    with pytest.raises(ValueError, match="Alpha, Intl"):
        FL.run_flight_job(spark, catalog, os.path.join(workdir, "store"), seed_csv=seed)


def test_csv_columns_are_found_by_name(spark, workdir):
    shuffled = list(reversed(COLS))
    catalog, _, _ = _saved_job(workdir, flights_header=shuffled)
    loaded = FL.load_tables(spark, catalog)
    assert loaded["flights"].columns == COLS and loaded["flights"].count() == len(FLIGHT_ROWS)
    res = full_recompute(loaded, FL.TOP_AIRPORTS_BY_FLIGHTS)
    assert collect(res, "ORIGIN_AIRPORT", "count") == [("AAA", 4), ("BBB", 2)]
    assert sorted(collect(full_recompute(loaded, FL.DELAY_REASONS), "Reason", "count")) == [
        ("AIRLINE_DELAY", 1), ("AIR_SYSTEM_DELAY", 1)]


def test_csv_file_without_a_column_is_reported(spark, workdir):
    from metricfold.operators import MissingColumnsError

    catalog, _, _ = _saved_job(workdir, flights_header=[c for c in COLS if c != "ARRIVAL_DELAY"])
    loaded = FL.load_tables(spark, catalog)
    assert full_recompute(loaded, FL.TOP_AIRPORTS_BY_FLIGHTS).count() == 2      # does not need it
    with pytest.raises(MissingColumnsError, match=r"The \[ARRIVAL_DELAY\] columns are not in the DF"):
        FL.run_flight_job(spark, catalog, os.path.join(workdir, "store"))


def test_unknown_codes_leave_the_rankings(spark, tables):
    rows = FLIGHT_ROWS + [(2, "XX", "ZZZ", "AAA", 0, 1, None), (2, "QQ", "AAA", "ZZZ", 0, 1, None)]
    res = full_recompute(dict(tables, flights=flights_df(spark, rows)), FL.ON_TIME_FLIGHTS)
    got = sorted(collect(res, "ORIGIN_AIRPORT", "AIRLINE", "DESTINATION_AIRPORT"))
    assert got == [("AAA", "XX", "BBB"), ("BBB", "XX", "AAA")]


def test_rank_order_is_honoured(spark, tables):
    from dataclasses import replace

    rows = [(1, "XX", "AAA", "BBB", 0, 0, None)] * 3 + [(1, "YY", "AAA", "BBB", 0, 0, None)]
    data = dict(tables, flights=flights_df(spark, rows))
    best, last = (full_recompute(data, replace(FL.ON_TIME_FLIGHTS, order=o), top=1) for o in ("asc", "desc"))
    assert collect(best, "AIRLINE", "carrier_rank") == [("XX", 1)]
    assert collect(last, "AIRLINE", "carrier_rank") == [("YY", 2)]
    with pytest.raises(ValueError):
        full_recompute(data, replace(FL.ON_TIME_FLIGHTS, order="up"))
