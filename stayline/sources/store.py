"""Where jobs put intermediate and versioned data: always the folder the cluster shares."""

from __future__ import annotations

import atexit
import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_POINTER = "_published"
#: Versions that `retire` leaves in place: the one readers use and the one before it, which they may still be reading.
KEPT_VERSIONS = 2
#: Folders of the innermost job that is running in this thread; each thread has its own jobs.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)
_applications: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster shares, named by `spark.checkpoint.dir`; the context's checkpoint folder where a
    program has set that itself."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate data. It goes when the `scratch` around it ends, at the latest with the process."""
    home = f"{shared_root(spark)}/stayline/{spark.sparkContext.applicationId}"
    if home not in _applications:
        _applications.add(home)
        atexit.register(_drop_quietly, spark, home)
    path = f"{home}/{name}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


def _drop_quietly(spark: SparkSession, path: str) -> None:
    """At the end of the process the session may be gone, and its folder is then the cluster's to clear."""
    with contextlib.suppress(Exception):
        drop_folder(spark, path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are dropped at the end, so nothing that is read later may hang on them."""
    outer = _scope.set([])
    try:
        yield
    finally:
        made = _scope.get()
        _scope.reset(outer)
        for path in made or []:
            drop_folder(spark, path)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write once to the shared folder and go on from there, so that every later reader sees the same rows and a lost
    executor costs no more than re-reading its files. `path` is a `work_path` made before, where the table is to outlive
    the `scratch` around this call."""
    path = path or work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The same rows, and how many of them were written, to be asked for after the frame's one write. They are counted as
    they pass, in the tasks that write; a task that is run again counts once."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: int(seen.get["rows"])


def new_version() -> str:
    """Names sort by time, so the newest publication is the greatest one."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def version_path(root: str, version: str, table: str) -> str:
    return f"{root}/{version}/{table}"


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Point readers at a complete version; until this append commits they keep reading the former one."""
    row = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/{_POINTER}")


def retire(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Drop all but the newest published versions below `root`, and versions older than those that never were."""
    published = sorted(row[0] for row in spark.read.parquet(f"{root}/{_POINTER}").select("version").distinct().collect())
    kept = published[-keep:]
    old = [name for name in child_folders(spark, root) if name != _POINTER and name < kept[0]]
    for name in old:
        drop_folder(spark, f"{root}/{name}")
    return old


def published_version(spark: SparkSession, root: str) -> str:
    return spark.read.parquet(f"{root}/{_POINTER}").agg(F.max("version")).head()[0]


def has_published(spark: SparkSession, root: str) -> bool:
    return _POINTER in child_folders(spark, root)


def read_published(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    return spark.read.parquet(version_path(root, version or published_version(spark, root), table))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
