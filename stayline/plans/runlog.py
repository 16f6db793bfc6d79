"""Audit of pipeline steps, kept apart from the data they write.

Each step appends one event when it starts and one when it ends, so a failed step leaves both. While it runs it holds a
lease, which it renews by further events. A step whose process died renews nothing, so once its lease has run out it shows
as abandoned.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.rules import round2
from stayline.operators.sides import literal
from stayline.sources.schemas import RUN_EVENTS

RUNNING, OK, ERROR, ABANDONED = "RUNNING", "OK", "ERROR", "ABANDONED"
#: How long a step counts as running after it was last heard of; it is heard of three times as often.
LEASE = dt.timedelta(minutes=30)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class Step:
    """What a running step reports about itself."""

    rows: int | None = None
    message: str | None = None


class RunLog:
    def __init__(self, spark: SparkSession, path: str, lease: dt.timedelta = LEASE):
        self.spark, self.path, self.lease = spark, path, lease

    @contextmanager
    def step(self, process: str, action: str, message: str | None = None):
        run_id = uuid.uuid4().int >> 65
        started, clock = _now(), time.monotonic()
        step, over = Step(message=message), threading.Event()

        def alive() -> None:
            self._append(run_id, process, action, None, RUNNING, message, None, started, None, False, _now() + self.lease)

        def renew() -> None:
            while not over.wait(self.lease.total_seconds() / 3):
                alive()

        def finish(status: str, text: str | None) -> None:
            over.set()
            renewal.join()
            seconds = Decimal(f"{time.monotonic() - clock:.2f}")
            self._append(run_id, process, action, step.rows, status, text, seconds, started, _now(), True, None)

        alive()
        renewal = threading.Thread(target=renew, daemon=True)
        renewal.start()
        try:
            yield step
        except BaseException as failure:
            finish(ERROR, str(failure))
            raise
        finish(OK, step.message)

    def _append(self, *values) -> None:
        literal(self.spark, [values], RUN_EVENTS).write.mode("append").parquet(self.path)

    def runs(self, as_of: dt.datetime | None = None) -> DataFrame:
        return current_runs(self.spark.read.schema(RUN_EVENTS).parquet(self.path), as_of)


def current_runs(events: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """The state of each run at a moment, now by default: its end where there is one, else its start; abandoned where its
    last lease has run out. Events without a lease never run out."""
    columns = [name for name in events.columns if name not in ("run_id", "is_end")]
    latest = F.struct("is_end", "lease_until")
    last = events.groupBy("run_id").agg(F.max_by(F.struct(*columns, "is_end"), latest).alias("last"))
    lost = ~F.col("last.is_end") & (F.col("last.lease_until") < F.lit(as_of or _now()).cast("timestamp_ntz"))
    status = F.when(lost, ABANDONED).otherwise(F.col("last.status")).alias("status")
    shown = [name for name in columns if name != "lease_until"]
    return last.select("run_id", *[status if name == "status" else F.col(f"last.{name}").alias(name) for name in shown])


def recent_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    """The latest runs, newest first."""
    newest = runs.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id").desc()).limit(limit)
    return newest.select(
        "run_id", "process", "action", "rows", "status", "seconds",
        F.date_format("started_at", "dd/MM/yyyy HH:mm:ss").alias("started"), "message",
    )


def run_stats(runs: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Runs, outcomes and durations per process over the last days."""
    since = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")
    seconds = F.sum("seconds").cast("double") / F.nullif(F.count("seconds"), F.lit(0))
    return (
        runs.where(F.col("started_at") >= since)
        .groupBy("process")
        .agg(
            F.count("*").alias("runs"),
            F.count_if(F.col("status") == OK).alias("succeeded"),
            F.count_if(F.col("status") == ERROR).alias("failed"),
            round2(seconds).alias("avg_seconds"),
            F.max("seconds").alias("max_seconds"),
            F.max("started_at").alias("last_start"),
        )
    )
