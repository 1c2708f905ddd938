"""Session set-up, the shared folder for cut points, and decisions on counted rows."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1024 * 1024

# Rows that one task ranks or cumulates in order; tables with more are cut into that many more ranges.
ROWS_PER_TASK = 1_000_000

# A table is only hinted as broadcast when its counted values take no more than this.
BROADCAST_BYTES = 64 * MIB


def make_session(app: str = "tidewatch", master: str | None = None,
                 shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC times; on a cluster leave `master` unset."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by `spark.checkpoint.dir`.

    Where it is unset, a machine-local folder stands in only when Spark itself runs on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tidewatch-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Tables written by `materialize` and their rows, once counted. (An `Observation` on the writing job would spare the
#: count, but a session that has used one can no longer serialise Spark ML's models: SparkSession holds its manager.)
_ROWS: weakref.WeakKeyDictionary[DataFrame, int | None] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: the lineage ends there, and
    lost executors cost no recomputation."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    _ROWS[written] = None
    return written


def rows_of(written: DataFrame) -> int:
    """Rows of a table just written, counted once from the file footers."""
    known = _ROWS.get(written)
    if known is None:
        known = _ROWS[written] = written.count()
    return known


def written_columns(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """The columns of `df` as a written table: those of a table that `materialize` gave are read from it again."""
    wanted = df.select(*columns)
    if df not in _ROWS:
        return materialize(wanted, label)
    _ROWS[wanted] = rows_of(df)
    return wanted


def tasks_for(written: DataFrame, rows_per_task: int | None = None) -> int:
    """Tasks for the rows of a table just written."""
    return max(1, -(-rows_of(written) // (rows_per_task or ROWS_PER_TASK)))


def broadcast_counted(written: DataFrame, values: Column | None = None) -> DataFrame:
    """Hint a broadcast of a table just written when its values, counted, are few enough; `values` is their
    number in a row (one per column if not given). Beyond that the join stays with AQE, which shuffles and
    splits skewed partitions."""
    held = rows_of(written) * len(written.columns) if values is None else (
        written.agg(F.sum(values.cast("bigint"))).first()[0] or 0)
    return F.broadcast(written) if 8 * held <= BROADCAST_BYTES else written


def side_by_side(spark: SparkSession, calls: Sequence[Callable[[], Any]], threads: int, label: str) -> list:
    """The results of several pieces of Spark work in the order of `calls`, at most `threads` of them at a time.

    Each runs its jobs under one job group and in a scheduler pool of its own, so that under
    `spark.scheduler.mode=FAIR` a long one does not hold back the others. When one raises, the jobs of all others are
    cancelled, what has not begun is left out, and the error is raised.
    """
    context, group = spark.sparkContext, f"{label}-{uuid.uuid4().hex}"

    def work(place: int, call: Callable[[], Any]) -> Any:
        context.setJobGroup(group, f"{label} {place}", interruptOnCancel=False)
        context.setLocalProperty("spark.scheduler.pool", f"{label}-{place % threads}")
        return call()

    with ThreadPoolExecutor(max(1, threads)) as pool:
        # Every call gets a copy of the caller's local properties; what `work` sets stays with its own thread.
        futures = [pool.submit(inheritable_thread_target(spark)(work), place, call) for place, call in enumerate(calls)]
        done, waiting = wait(futures, return_when=FIRST_EXCEPTION)
        if waiting:
            for future in waiting:
                future.cancel()
            context.cancelJobGroup(group)
            raise next(f.exception() for f in done if f.exception())
    return [future.result() for future in futures]
