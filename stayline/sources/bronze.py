"""Raw room-night exports, kept as they came and replaceable by window of stay dates.

Bronze is a set of folders, one per month of stay and batch, and a manifest that lists those that count. A change writes
new folders beside the old ones and then publishes a new manifest, so readers see the table before the change or after
it, and a job that breaks off leaves the table as it was. Clearing a window takes the months inside it off the list and
rewrites at most the two months it covers in part; every other month stays untouched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.dates import month_bounds, month_of, parse_day
from stayline.operators.conform import with_parsed
from stayline.operators.sides import literal
from stayline.sources import schemas
from stayline.sources.store import child_folders, counted, drop_folder, new_version, publish, published_version

_PARTITIONS = ["stay_month", "batch_id"]
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_DATA, _MANIFEST = "data", "manifest"


class Reload(NamedTuple):
    deleted: int
    landed: int


class Part(NamedTuple):
    """A folder of bronze: what wrote it, the month of stay (None where there is no readable night), and the batch."""

    version: str
    month: int | None
    batch: str

    def path(self, root: str) -> str:
        month = _NO_MONTH if self.month is None else self.month
        return f"{root}/{_DATA}/version={self.version}/stay_month={month}/batch_id={self.batch}"


def read_export(
    spark: SparkSession, path: str, kind: str = "csv", renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Read an export in its declared shape. CSV columns count by position, so odd source headers do not matter;
    Parquet columns are found by name, after `renames` (source name -> our name)."""
    place = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_block")]
    if kind == "csv":
        read = spark.read.schema(schemas.RAW_STAYS).csv(path, header=True, mode="FAILFAST", quote='"', escape='"')
        return read.select("*", *place)
    named = {ours: source for source, ours in (renames or {}).items()}
    frame = spark.read.format(kind).load(path)
    columns = [F.col(f"`{named.get(name, name)}`").cast(kind_).alias(name) for name, kind_ in schemas.RAW_FIELDS]
    return frame.select(*columns, *place)


def stamp(batch: DataFrame, batch_id: str) -> DataFrame:
    """Add place of arrival, parsed dates and the partition columns to the 23 source columns, which stay unchanged.

    Lines of an export arrive in the order of files, then of blocks in a file, then of lines in a block; that is one
    order, however many tasks read the files and wherever they cut them. Rows that come from elsewhere have no file, and
    if they come out of a shuffle no order either until they are written, so store them first where equal lines must be
    told apart.
    """
    place = {"source_file": F.lit(""), "source_block": F.lit(0).cast("bigint")}
    known = [F.col(name) if name in batch.columns else value.alias(name) for name, value in place.items()]
    arrived = batch.select(*schemas.RAW_COLUMNS, *known, F.monotonically_increasing_id().alias("ingest_seq"))
    return with_parsed(arrived).withColumns(
        {"stay_month": month_of(F.col("stay_day")), "batch_id": F.lit(batch_id)}
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The published table; empty where nothing was landed yet."""
    return _read(spark, path, parts(spark, path))


def _read(spark: SparkSession, path: str, listed: Sequence[Part]) -> DataFrame:
    if not listed:
        return spark.createDataFrame([], schemas.BRONZE)
    read = spark.read.schema(schemas.BRONZE).option("basePath", f"{path}/{_DATA}")
    return read.parquet(*[part.path(path) for part in listed]).select(*schemas.BRONZE_COLUMNS)


def parts(spark: SparkSession, path: str) -> list[Part]:
    """Folders of the published table: at most a calendar of months for each batch."""
    if not child_folders(spark, path):
        return []
    listed = spark.read.schema(_PART).parquet(f"{path}/{_MANIFEST}/{published_version(spark, path)}")
    return [Part(*row) for row in listed.collect()]


_PART = "version string, stay_month int, batch_id string"


def _publish(spark: SparkSession, path: str, version: str, listed: Sequence[Part]) -> None:
    """One append moves all readers from the former list of folders to this one."""
    literal(spark, [tuple(part) for part in listed], _PART).coalesce(1).write.parquet(f"{path}/{_MANIFEST}/{version}")
    publish(spark, path, version)


def land_raw(
    spark: SparkSession, source: str, path: str, batch_id: str, kind: str = "csv",
    renames: Mapping[str, str] | None = None,
) -> int:
    """Append an export to bronze; landing the same batch name again replaces that batch. Returns its row count."""
    return land_batch(read_export(spark, source, kind, renames), path, batch_id)


def land_batch(batch: DataFrame, path: str, batch_id: str) -> int:
    """Append rows that are already in the declared shape."""
    spark, version = batch.sparkSession, new_version()
    kept = [part for part in parts(spark, path) if part.batch != batch_id]
    fresh, landed = _write(stamp(batch, batch_id), path, version)
    _publish(spark, path, version, kept + fresh)
    return landed


def delete_window(spark: SparkSession, path: str, low: dt.date, high: dt.date) -> int:
    """Remove rows staying from `low` to `high`, both included; rows without a readable night stay."""
    version = new_version()
    rest, deleted = _without(spark, path, version, parts(spark, path), low, high)
    _publish(spark, path, version, rest)
    return deleted


def reload_window(
    spark: SparkSession, path: str, low: dt.date, high: dt.date, batch: DataFrame, batch_id: str
) -> Reload:
    """Replace the window by a batch. The new table is complete before it is published, and running it twice leaves the
    same table.

    Loads must not overlap: of two that start from the same table, the one published last undoes the other.
    """
    version = new_version()
    listed = parts(spark, path)
    rest, deleted = _without(spark, path, f"{version}-rest", [part for part in listed if part.batch != batch_id], low, high)
    # the former rows of this batch go whatever their night; those of the window count as deleted
    _, whole, partly = _split([part for part in listed if part.batch == batch_id], low, high)
    deleted += _rows(spark, path, whole)
    if partly:
        deleted += _read(spark, path, partly).where(_inside(low, high)).count()
    fresh, landed = _write(stamp(batch, batch_id), path, version)
    _publish(spark, path, version, rest + fresh)
    return Reload(deleted, landed)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Drop the folders that the newest `keep` manifests do not list, and older manifests. Returns their number.

    Folders of a change that is under way carry the newest version names and are left alone.
    """
    published = sorted(name for name in child_folders(spark, f"{path}/{_MANIFEST}"))
    kept = published[-keep:]
    live = set()
    for version in kept:
        listed = spark.read.schema(_PART).parquet(f"{path}/{_MANIFEST}/{version}").select("version").distinct().collect()
        live |= {row[0] for row in listed}
    dropped = [f"{path}/{_MANIFEST}/{name}" for name in published[:-keep]]
    for folder in child_folders(spark, f"{path}/{_DATA}"):
        version = folder.removeprefix("version=")
        if version not in live and kept and version < kept[-1]:
            dropped.append(f"{path}/{_DATA}/{folder}")
    for folder in dropped:
        drop_folder(spark, folder)
    return len(dropped)


def _inside(low: dt.date, high: dt.date) -> Column:
    """The window, with the months it touches spelled out so that only their partitions are read."""
    months = F.col("stay_month").between(_number(low), _number(high))
    return months & F.col("stay_day").between(low, high)


def _number(day: dt.date) -> int:
    return day.year * 100 + day.month


def _rows(spark: SparkSession, path: str, listed: Sequence[Part]) -> int:
    """Rows of some folders by the footers of their files; no column is read."""
    return _read(spark, path, listed).count() if listed else 0


def _write(rows: DataFrame, path: str, version: str) -> tuple[list[Part], int]:
    """Write rows as folders of a version; returns those that it wrote, which the calendar and the batches bound, and the
    number of rows in them."""
    # rebalance gathers a month's rows into few files and splits a month that holds too many
    rows, written = counted(rows.hint("rebalance", F.col("stay_month")))
    rows.write.partitionBy(*_PARTITIONS).mode("append").parquet(f"{path}/{_DATA}/version={version}")
    return _folders(rows.sparkSession, path, version), written()


def _folders(spark: SparkSession, path: str, version: str) -> list[Part]:
    found, root = [], f"{path}/{_DATA}/version={version}"
    for month in child_folders(spark, root):
        value = month.removeprefix("stay_month=")
        for batch in child_folders(spark, f"{root}/{month}"):
            found.append(Part(version, None if value == _NO_MONTH else int(value), batch.removeprefix("batch_id=")))
    return found


def _split(listed: Sequence[Part], low: dt.date, high: dt.date) -> tuple[list[Part], list[Part], list[Part]]:
    """The folders outside a window, inside it, and covered by it in part."""
    outside, whole, partly = [], [], []
    for part in listed:
        if part.month is None or not _number(low) <= part.month <= _number(high):
            outside.append(part)
            continue
        first, following = month_bounds(dt.date(part.month // 100, part.month % 100, 1))
        inside = low <= first and following - dt.timedelta(days=1) <= high
        (whole if inside else partly).append(part)
    return outside, whole, partly


def _without(
    spark: SparkSession, path: str, version: str, listed: Sequence[Part], low: dt.date, high: dt.date
) -> tuple[list[Part], int]:
    """The folders less the window, and the number of rows that this takes away; months that the window covers in part are
    rewritten under `version`, which is the only time that any row is read."""
    kept, whole, partly = _split(listed, low, high)
    taken = _rows(spark, path, whole + partly)
    if partly:
        rest = _read(spark, path, partly).where(~F.col("stay_day").between(low, high))
        rewritten, left = _write(rest, path, version)
        kept, taken = kept + rewritten, taken - left
    return kept, taken


def normalise_dates(df: DataFrame, columns: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Parse text columns into date columns (`text column -> date column`) and split off the rows in which some
    text is no date. Missing text is no error."""
    parsed = df.withColumns({day: parse_day(F.col(text)) for text, day in columns.items()})
    bad = F.lit(False)
    for text, day in columns.items():
        bad = bad | (F.col(text).isNotNull() & F.col(day).isNull())
    return parsed.where(~bad), parsed.where(bad)
