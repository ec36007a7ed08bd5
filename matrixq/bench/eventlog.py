"""Run metrics from Spark's own event log: duration, task time, CPU use, shuffle volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.functions.parsing import once

# The events that are read and their fields, by their names in the log.
EVENTS = {
    "SparkListenerJobStart": """
        `Job ID` bigint, `Submission Time` bigint, `Properties` map<string,string>""",
    "SparkListenerJobEnd": "`Job ID` bigint, `Completion Time` bigint",
    "SparkListenerStageSubmitted": """
        `Stage Info` struct<`Stage ID`: bigint, `Stage Attempt ID`: bigint>,
        `Properties` map<string,string>""",
    "SparkListenerTaskEnd": """
        `Stage ID` bigint, `Stage Attempt ID` bigint,
        `Task Metrics` struct<
            `Executor Run Time`: bigint, `Executor CPU Time`: bigint,
            `Shuffle Read Metrics`: struct<
                `Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
            `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>>""",
}
GROUP_PROPERTY = "spark.jobGroup.id"


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(app, value)``, one per logged event, from one log or a folder of logs.

    The logs must not be compressed (``spark.eventLog.compress=false``).
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return lines.select(F.regexp_replace(name, r"^events_\d+_", "").alias("app"), "value")


def group_metrics(log: DataFrame, cores: int) -> DataFrame:
    """One row per ``(app, job_group)``.

    ``seconds`` from the first submission to the last completion of its jobs, ``task_seconds``
    and ``cpu_seconds`` summed over its tasks, ``cpu_use`` as the share of ``cores`` that was
    busy meanwhile, ``shuffle_read`` and ``shuffle_write`` in bytes. Tasks are summed per stage
    before they meet the name of the stage's group. A group of jobs that have not ended, or have no
    tasks, has nulls in the columns that are not known.
    """
    job, stage, attempt = (F.col(f"e.`{name} ID`") for name in ("Job", "Stage", "Stage Attempt"))
    group = F.coalesce(F.element_at("e.Properties", F.lit(GROUP_PROPERTY)), F.lit(""))
    starts = _events(log, "SparkListenerJobStart").select(
        "app", job.alias("job"), group.alias("job_group"),
        F.col("e.`Submission Time`").alias("submitted"),
    )
    ends = _events(log, "SparkListenerJobEnd").select(
        "app", job.alias("job"), F.col("e.`Completion Time`").alias("completed")
    )
    spans = starts.join(ends, ["app", "job"], "left").groupBy("app", "job_group").agg(
        F.count("*").alias("jobs"),
        ((F.max("completed") - F.min("submitted")) / 1000).alias("seconds"),
    )

    stages = _events(log, "SparkListenerStageSubmitted").select(
        "app", F.col("e.`Stage Info`.`Stage ID`").alias("stage"),
        F.col("e.`Stage Info`.`Stage Attempt ID`").alias("attempt"), group.alias("job_group"),
    )
    metrics = "e.`Task Metrics`"
    read = f"{metrics}.`Shuffle Read Metrics`"
    written = f"{metrics}.`Shuffle Write Metrics`.`Shuffle Bytes Written`"
    tasks = _events(log, "SparkListenerTaskEnd").groupBy(
        "app", stage.alias("stage"), attempt.alias("attempt")
    ).agg(
        F.count("*").alias("tasks"),
        F.sum(F.col(f"{metrics}.`Executor Run Time`")).alias("run_ms"),
        F.sum(F.col(f"{metrics}.`Executor CPU Time`")).alias("cpu_ns"),
        F.sum(
            F.coalesce(F.col(f"{read}.`Remote Bytes Read`"), F.lit(0))
            + F.coalesce(F.col(f"{read}.`Local Bytes Read`"), F.lit(0))
        ).alias("read_bytes"),
        F.sum(F.coalesce(F.col(written), F.lit(0))).alias("written_bytes"),
    )
    work = stages.join(tasks, ["app", "stage", "attempt"]).groupBy("app", "job_group").agg(
        F.sum("tasks").alias("tasks"),
        (F.sum("run_ms") / 1000).alias("task_seconds"),
        (F.sum("cpu_ns") / 1_000_000_000).alias("cpu_seconds"),
        F.sum("read_bytes").alias("shuffle_read"),
        F.sum("written_bytes").alias("shuffle_write"),
    )
    cpu_use = F.try_divide(F.col("cpu_seconds"), F.col("seconds") * cores)
    return spans.join(work, ["app", "job_group"], "left").withColumn("cpu_use", cpu_use)


def _events(log: DataFrame, name: str) -> DataFrame:
    """Rows ``(app, e)`` of one kind of event; lines of other kinds are not parsed."""
    own = log.where(F.col("value").startswith('{"Event":"' + name + '"'))
    return once(own, app=F.col("app"), e=F.from_json("value", EVENTS[name]))
