"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores.
Every query runs once to warm up and then ``BENCH_RUNS`` times; its figure is
the median.  Results go to Spark's ``noop`` sink, so nothing is pulled to the
driver and no column is dropped.  Beside the headline queries: the machine job with
the time of each of its sinks and its rate from the stream's own progress, alarms of
an input of which a third comes from one machine, and per-lot work on one core.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from kilnstream.plans import inputs, message_queries, stored_queries  # noqa: E402
from kilnstream.sinks.tables import BatchTables  # noqa: E402
from kilnstream.sources import streams  # noqa: E402
from kilnstream.sources.shared import shared_folder  # noqa: E402
from kilnstream.streaming import jobs  # noqa: E402

HEADLINE = [
    "parse_typed", "value_types", "modelled_filter", "typed_cells", "wide_rows",
    "wide_rows_pivot", "alarm_levels", "alarm_history", "latest_status", "status_update",
    "group_by_lot", "lot_apply", "lot_chart_series", "document_routing", "sql_range_filter",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


SINK_SECONDS: dict[str, float] = {}


class TimedTables(BatchTables):
    def write(self, rows, table, batch_id, partition_by=()):
        SINK_SECONDS[table] = round(timed(
            lambda: BatchTables.write(self, rows, table, batch_id, partition_by)
        ), 3)


def machine_job(spark: SparkSession, sf_dir: str) -> tuple[float, float]:
    """Seconds of the machine job over all messages at once, and its rows per second."""
    folder = shared_folder(spark)
    inputs.machine_messages(spark, sf_dir).write.parquet(folder)
    tables = TimedTables(shared_folder(spark))
    query = jobs.machine_job(
        streams.file_stream(spark, folder), lambda session: inputs.masters(session, sf_dir),
        tables, f"{tables.root}/checkpoint", available_now=True,
    )
    seconds = timed(query.awaitTermination)
    [progress] = [p for p in query.recentProgress if p["numInputRows"]]
    return seconds, 1000 * progress["numInputRows"] / progress["durationMs"]["triggerExecution"]


def skewed(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the events, every third of them moved to one user."""
    folder = shared_folder(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    moved = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    events.withColumn("user_id", moved.cast(events.schema["user_id"].dataType)) \
        .write.parquet(f"{folder}/events.parquet")
    return folder


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def median_seconds(query, spark: SparkSession, sf_dir: str, runs: int) -> float:
    drain(query(spark, sf_dir))
    return round(statistics.median(
        timed(lambda: drain(query(spark, sf_dir))) for _ in range(runs)
    ), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = session(cpus)
    registered = {**message_queries.QUERIES, **stored_queries.QUERIES}
    seconds = {name: median_seconds(registered[name], spark, sf_dir, runs) for name in HEADLINE}
    seconds["alarm_history_skewed"] = median_seconds(
        message_queries.alarm_history, spark, skewed(spark, sf_dir), runs
    )
    machine_job(spark, sf_dir)
    job_seconds, rate = machine_job(spark, sf_dir)
    seconds["machine_job"] = round(job_seconds, 3)
    spark.stop()
    single = session("1")
    seconds["lot_apply_1_core"] = median_seconds(message_queries.lot_apply, single, sf_dir, 1)
    print(json.dumps({
        "metric": "total seconds, headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "machine_job_sinks": SINK_SECONDS,
        "machine_job_rows_per_sec": round(rate),
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }))
    single.stop()


if __name__ == "__main__":
    main()
