"""The run log and the surgery window by instants."""

import datetime as dt

import pytest
from dosewise.context import RunContext
from dosewise.operators import events as ev
from dosewise.plans import runs
from dosewise.plans.runlog import RunLog

from .conftest import SMOKE


def states(spark, log, *ids):
    return {r["run_id"]: r["state"] for r in log.states(spark.createDataFrame([(i,) for i in ids], "run_id long")).collect()}


def test_failed_and_repeated_runs_show_their_state(spark, tmp_path, monkeypatch):
    log, ctx = RunLog(spark, f"{tmp_path}/log"), RunContext(run_id=7, report_type="UPL")
    assert log.read().count() == 0 and states(spark, log, 7) == {7: "unknown"}
    small = spark.createDataFrame([(1,)], "h_id long")

    def broken(t, ctx):
        raise RuntimeError("no lines")

    monkeypatch.setitem(runs.REPORTS, "UPL", broken)
    with pytest.raises(RuntimeError):
        runs.run_report(spark, SMOKE, f"{tmp_path}/out", "UPL", ctx, log=log)
    row = log.latest().collect()
    assert [(r["process"], r["attempt"], r["flag"], r["message"]) for r in row] == [("BUILD UPL", 1, "ERROR", "no lines")]
    assert states(spark, log, 7, 8) == {7: "ok", 8: "unknown"}  # it may run again
    seen = {}

    def watched(t, ctx):
        seen.update(states(spark, log, 7))
        return {"upl_report": small}

    monkeypatch.setitem(runs.REPORTS, "UPL", watched)
    runs.run_report(spark, SMOKE, f"{tmp_path}/out", "UPL", ctx, log=log)
    assert seen == {7: "in_progress"} and states(spark, log, 7) == {7: "already_run"}
    assert [(r["attempt"], r["flag"]) for r in log.latest().collect()] == [(2, "SUCCESS")]
    rows = log.read().count()
    log.write(ctx, "BUILD UPL", "SUCCESS", attempt=2)  # a driver that tries the same row again
    assert log.read().count() == rows == 6
    log.write(ctx, "BUILD UPL", "STARTED", attempt=3)  # a driver that died: the next try is the same attempt
    assert log.next_attempt(ctx, "BUILD UPL") == 3 and log.latest().first()["flag"] == "STARTED"
    with pytest.raises(ValueError):
        log.write(ctx, "BUILD UPL", "DONE")


def test_the_surgery_window_is_by_instants(spark):
    at = dt.datetime
    surgeries = [(1, at(2001, 6, 10, 12, 0)), (1, at(2001, 6, 10, 9, 0)), (2, None), (3, at(2001, 6, 10, 0, 0))]
    sales = [(1, 1, at(2001, 6, 15, 12, 0)), (2, 1, at(2001, 6, 15, 12, 1)), (3, 1, at(2001, 6, 5, 9, 0)), (4, 1, at(2001, 6, 5, 8, 59)),
             (5, 1, at(2001, 6, 14, 23, 59)), (6, 1, at(2001, 6, 6, 0, 0)), (7, 2, at(2001, 6, 10, 0, 0)), (8, 1, None),
             (9, 3, at(2001, 6, 15, 0, 0)), (10, 3, at(2001, 6, 5, 0, 0)), (11, 3, at(2001, 6, 4, 23, 59)), (12, 1, at(2001, 6, 10, 10, 0))]
    s = spark.createDataFrame(sales, "id long, patient_id long, ts timestamp_ntz")
    e = spark.createDataFrame(surgeries, "patient_id long, surgery_ts timestamp_ntz")
    kept = sorted(r["id"] for r in ev.exclude_near_instant(s, e, ["patient_id"], "ts", "surgery_ts", 5).collect())
    near = {i for i, p, t in sales for q, u in surgeries if p == q and t and u and abs(t - u) <= dt.timedelta(days=5)}
    assert kept == [2, 4, 7, 8, 11] == sorted({r[0] for r in sales} - near)
    assert ev.exclude_near_instant(s, e, ["patient_id"], "ts", "surgery_ts", 5, when=s["id"] > 5).count() == 8
