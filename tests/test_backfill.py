"""Backfill by change detection: only ship days whose rows changed are written."""

import datetime as dt
import random

import pytest
from pickbay.plans import ingest
from pickbay.scenario import Scenario
from pickbay.session import scratch_path
from pickbay.sinks import publish
from test_sinks import RAW_SCHEMA

RUN = dt.date(2001, 1, 1)
SCN = Scenario(run_date=RUN, pid="p", ts="t")


def raw_rows(rng, n, first, last):
    out = []
    for i in range(n):
        ship = first + dt.timedelta(days=rng.randint(0, (last - first).days))
        out.append((f"s{i}", "1", dt.datetime.combine(ship, dt.time(9)), "c", f"o{i}", 1.0, "0", "0", 1, "1", ship))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA).repartition(3)


def files(spark, path):
    """day -> names of its files."""
    out = {}
    for rel, full in publish.leaves(spark, path, 1).items():
        fs, folder = publish.fs_and_path(spark, full)
        out[rel.split("=")[1]] = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part"))
    return out


def content(df):
    return sorted(map(str, df.drop("dt").collect()))


@pytest.mark.parametrize("fmt", ["tsv", "parquet"])
def test_only_days_with_late_rows_are_written_again(spark, fmt):
    rng = random.Random(1)
    rows = raw_rows(rng, 300, RUN - dt.timedelta(days=31), RUN - dt.timedelta(days=1))
    path = scratch_path(spark, "test-days")
    ingest.backfill(spark, frame(spark, rows), path, SCN, fmt)
    run = f"{path}/dt={RUN}"
    before = files(spark, run)
    late = [("late", "1", dt.datetime(2000, 12, 10, 8), "c", "ox", 2.0, "0", "0", 1, "1", RUN), rows[7]]      # new row, repeated row
    rng.shuffle(rows)                                                                                      # order doesn't matter
    ingest.backfill(spark, frame(spark, rows + late), path, SCN, fmt)
    after = files(spark, run)
    touched = {"2000-12-10", rows_day(late[1])}
    assert {d for d in after if after[d] != before.get(d)} == touched and set(after) == set(before)
    full = scratch_path(spark, "test-days-full")
    ingest.backfill(spark, frame(spark, rows + late), full, SCN, fmt)
    assert content(ingest.read_order_lines(spark, path, fmt)) == content(ingest.read_order_lines(spark, full, fmt))


def rows_day(row):
    return row[2].date().isoformat()


def test_a_rolling_table_over_successive_runs(spark):
    """Ten runs, late rows among them: equal to a full rewrite each time, old days leave, quiet days keep their files."""
    rng, path = random.Random(2), scratch_path(spark, "test-rolling")
    rows = raw_rows(rng, 400, RUN - dt.timedelta(days=33), RUN + dt.timedelta(days=10))
    kept = 0
    for k in range(10):
        scn = Scenario(run_date=RUN + dt.timedelta(days=k), pid="p", ts="t")
        if k in (3, 6):
            rows.append((f"late{k}", "1", dt.datetime(2000, 12, 20 + k, 7), "c", f"ol{k}", 1.0, "0", "0", 1, "1", scn.yesterday))
        raw = frame(spark, [r for r in rows if r[10] <= scn.yesterday])
        done = ingest.roll_days(spark, raw, path, scn, "parquet")
        assert content(ingest.read_rolled_days(spark, path, scn, "parquet")) == content(ingest.ingest_order_lines(raw, scn))
        if k:
            assert len(done["written"]) <= 2 and all(d < scn.history_start.isoformat() for d in done["removed"])
            assert k not in (3, 6) or f"2000-12-{20 + k}" in done["written"]
        kept += len(done["kept"])
    assert kept > 9 * 27


def test_fingerprints_see_repeated_and_moved_rows(spark):
    a, b = raw_rows(random.Random(3), 2, RUN - dt.timedelta(days=5), RUN - dt.timedelta(days=5))
    day = [tuple(r) for r in ingest.day_fingerprints(ingest.ingest_order_lines(frame(spark, [a, b]), SCN)).collect()]
    for rows, same in (([b, a], True), ([a, a], False), ([a, b, b], False), ([a], False)):
        got = [tuple(r) for r in ingest.day_fingerprints(ingest.ingest_order_lines(frame(spark, rows), SCN)).collect()]
        assert (got == day) == same
    nulls = [(*a[:3], None, *a[4:]), (*b[:3], None, *b[4:])]
    assert len(ingest.day_fingerprints(ingest.ingest_order_lines(frame(spark, nulls), SCN)).collect()) == 1


def test_an_interrupted_run_is_finished(spark, monkeypatch):
    path = scratch_path(spark, "test-days-killed")
    rows = raw_rows(random.Random(4), 60, RUN - dt.timedelta(days=9), RUN - dt.timedelta(days=1))
    ingest.roll_days(spark, frame(spark, rows), path, SCN)
    more = rows[20:] + raw_rows(random.Random(5), 20, RUN - dt.timedelta(days=9), RUN - dt.timedelta(days=1))

    class Killed(BaseException):
        pass
    for step in (2, 5, 9):
        real, count = publish.rename, [0]

        def rename(*args):
            count[0] += 1
            if count[0] == step:
                raise Killed
            real(*args)
        with monkeypatch.context() as m:
            m.setattr(publish, "rename", rename)
            with pytest.raises(Killed):
                ingest.roll_days(spark, frame(spark, more[step:]), path, SCN)
        ingest.roll_days(spark, frame(spark, more[step:]), path, SCN)
        assert content(ingest.read_rolled_days(spark, path, SCN)) == content(ingest.ingest_order_lines(frame(spark, more[step:]), SCN))


def test_a_table_without_fingerprints_is_replaced(spark):
    path = scratch_path(spark, "test-days-old")
    rows = raw_rows(random.Random(6), 40, RUN - dt.timedelta(days=6), RUN - dt.timedelta(days=1))
    stale = ingest.ingest_order_lines(frame(spark, raw_rows(random.Random(7), 40, RUN - dt.timedelta(days=20), RUN - dt.timedelta(days=1))), SCN)
    stale.drop("dt").write.partitionBy("sub_dt").parquet(path)
    ingest.roll_days(spark, frame(spark, rows), path, SCN, "parquet")
    assert content(ingest.read_rolled_days(spark, path, SCN, "parquet")) == content(ingest.ingest_order_lines(frame(spark, rows), SCN))
