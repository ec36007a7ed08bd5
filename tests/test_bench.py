"""Timed runs, their comparison, and the metrics read back from the event log."""

import json

import pytest

import matrixq as mq
from matrixq.bench.eventlog import group_metrics, read_event_log
from matrixq.bench.runs import (
    append_runs,
    compare_files,
    compare_runs,
    job_group,
    run_strategies,
)
from matrixq.bench.workloads import ALL, Workload, run_workloads
from matrixq.sources.cells import generate
from matrixq.sources.text import write_cells


def test_workload_shapes(spark):
    assert len({w.name for w in ALL}) == len(ALL) == 15
    a, b = Workload("x", 30, 20, 10, 0.1).matrices(spark)
    assert a.shape == (30, 20) and b.shape == (20, 10)
    assert a.cells.count() == 60 and b.cells.count() == 20


def test_runs_agree_and_are_kept(spark, folder):
    a, b = Workload("small", 50, 40, 30, 0.2).matrices(spark)
    runs = run_strategies(a, b, ("join", "broadcast", "block"), "small").persist()
    append_runs(runs, f"{folder}/runs")
    append_runs(runs, f"{folder}/runs")
    assert spark.read.parquet(f"{folder}/runs").count() == 6
    rows = {r["strategy"]: r for r in compare_runs(runs, "join").collect()}
    assert set(rows) == {"join", "broadcast", "block"}
    assert all(r["agrees"] and r["seconds"] > 0 for r in rows.values())
    assert rows["join"]["saved_percent"] == 0 and rows["join"]["times_as_fast"] == 1


def test_comparison_arithmetic(spark):
    rows = [("w", "join", 1, 1, 1, 5.0, 8.0, 7.0), ("w", "block", 1, 1, 1, 6.0, 2.0, 7.0),
            ("w", "moved", 1, 1, 1, 5.0, 8.0, 9.0), ("w", "fuller", 1, 1, 2, 5.0, 8.0, 7.0),
            ("w", "same", 1, 1, 1, 5.0, 8.0, 7.0)]
    names = ("workload string, strategy string, n_rows long, n_cols long, nnz long, total double, "
             "seconds double, fingerprint double")
    agreed = {r["strategy"] for r in compare_runs(spark.createDataFrame(rows, names), "join").where("agrees").collect()}
    assert agreed == {"join", "same"}
    found = compare_runs(spark.createDataFrame(rows, names), "join").where("strategy = 'block'").first()
    assert (found["saved_percent"], found["times_as_fast"], found["agrees"]) == (75.0, 4.0, False)


def test_compare_files(spark, folder):
    write_cells(generate(spark, 20, 15, 0.3, 1), f"{folder}/a")
    write_cells(generate(spark, 15, 10, 0.3, 2), f"{folder}/b")
    rows = compare_files(spark, f"{folder}/a", f"{folder}/b").collect()
    assert [r["agrees"] for r in rows] == [True, True]
    total = mq.sum_of_product(generate(spark, 20, 15, 0.3, 1), generate(spark, 15, 10, 0.3, 2))
    assert rows[0]["total"] == total.first()["total"]


def test_event_log_metrics(spark, event_log_dir):
    with job_group(spark, "measured"):
        generate(spark, 200, 200, 0.5).cells.groupBy("i").count().collect()
    log = read_event_log(spark, event_log_dir)
    row = group_metrics(log, cores=4).where("job_group = 'measured'").first()
    assert row["app"].startswith("local-")
    assert row["jobs"] >= 1 and row["tasks"] >= 2 and row["seconds"] > 0
    assert row["shuffle_write"] > 0 and row["shuffle_read"] == row["shuffle_write"]
    assert row["cpu_use"] == pytest.approx(row["cpu_seconds"] / (4 * row["seconds"]))


def test_run_workloads(spark, folder):
    small = [Workload("p", 20, 10, 20, 0.2), Workload("q", 10, 20, 5, 0.2)]
    run_workloads(spark, small, ("join", "auto"), f"{folder}/kept")
    kept = spark.read.parquet(f"{folder}/kept")
    assert {(r["workload"], r["strategy"]) for r in kept.collect()} == {
        (w, s) for w in "pq" for s in ("join", "auto")
    }
    assert compare_runs(kept, "join").where("not agrees").isEmpty()


def test_groups_without_end_or_tasks_are_kept(spark):
    def event(name, **fields):
        return json.dumps({"Event": f"SparkListener{name}", **fields}, separators=(",", ":"))

    properties = {"spark.jobGroup.id": "open"}
    log = [
        event("JobStart", **{"Job ID": 1, "Submission Time": 5, "Properties": properties}),
        event("StageSubmitted", **{"Stage Info": {"Stage ID": 2, "Stage Attempt ID": 0}, "Properties": properties}),
        event("TaskEnd", **{"Stage ID": 2, "Stage Attempt ID": 0, "Task Metrics": {"Executor Run Time": 9}}),
        event("JobStart", **{"Job ID": 3, "Submission Time": 7, "Properties": {"spark.jobGroup.id": "idle"}}),
    ]
    rows = group_metrics(spark.createDataFrame([("a", x) for x in log], "app string, value string"), 4)
    found = {r["job_group"]: (r["jobs"], r["seconds"], r["tasks"]) for r in rows.collect()}
    assert found == {"open": (1, None, 1), "idle": (1, None, None)}
