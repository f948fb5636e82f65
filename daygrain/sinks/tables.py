"""Table writers over plain Parquet folders.

A table that is replaced or merged keeps numbered versions: a write makes the next one, and the
newest with a success marker is the table. A failed or repeated job therefore never harms what
readers see, and a job may read the table it writes. A version of a replaced table is a folder of
rows; one of a merged table names a folder for each bucket of keys, most of them those of the version
before. Time-range tables are partitioned by day and only touch their interval.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.session import cut, temporary


#: Where time-range writes wait; readers pass over names that start like this.
PENDING = "_pending"
#: What the name of a time-range write ends with once days are being swapped.
SWAPPING = "_swapping"
#: Buckets of a merged table, the folder they are in, their partition column, and the file of a version that lists them.
BUCKETS, DEALT, BUCKET, LISTING = 16, "_dealt", "__bucket", "_buckets"


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def versions(spark: SparkSession, table: str) -> list[str]:
    """Finished version folders, oldest first."""
    return [f"{table}/{v}" for v in _children(spark, table) if v.startswith("v") and _exists(spark, f"{table}/{v}/_SUCCESS")]


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The newest finished version, or None before the first write."""
    finished = versions(spark, table)
    if not finished:
        return None
    buckets = _buckets(spark, finished[-1])
    return spark.read.parquet(finished[-1]) if buckets is None else spark.read.parquet(*[f"{table}/{path}" for path in buckets.values()])


def _buckets(spark: SparkSession, version: str) -> dict[int, str] | None:
    """Where a merged table's version has the rows of each bucket, below the table; None for a folder of rows."""
    fs, listing = _folder(spark, f"{version}/{LISTING}")
    if not fs.exists(listing):
        return None
    stream = fs.open(listing)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {int(number): path for number, path in (line.split("\t") for line in text.splitlines()[1:])}


def _bucket_count(spark: SparkSession, version: str) -> int:
    fs, listing = _folder(spark, f"{version}/{LISTING}")
    stream = fs.open(listing)
    try:
        return int(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()[0])
    finally:
        stream.close()


def _list_buckets(spark: SparkSession, version: str, count: int, buckets: dict[int, str]) -> None:
    """Finish a version of a merged table: the number of buckets, then the place of each; last the marker."""
    lines = [str(count), *[f"{number}\t{path}" for number, path in sorted(buckets.items())]]
    for name, text in ((LISTING, "\n".join(lines) + "\n"), ("_SUCCESS", "")):
        fs, path = _folder(spark, f"{version}/{name}")
        stream = fs.create(path, True)
        stream.write(bytearray(text.encode()))
        stream.close()


def _next_version(spark: SparkSession, table: str) -> str:
    taken = [int(v[1:]) for v in _children(spark, table) if v.startswith("v") and v[1:].isdigit()]
    return f"{table}/v{max(taken, default=0) + 1:08d}"


def drop_old_versions(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Remove finished versions that no reader needs any more, and the buckets that only they name."""
    finished = versions(spark, table)
    needed = [_buckets(spark, path) or {} for path in finished[-keep:]]
    inside = {path for buckets in needed for path in buckets.values()}
    old = {path for version in finished[:-keep] for path in (_buckets(spark, version) or {}).values()}
    for path in [*finished[:-keep], *[f"{table}/{path}" for path in sorted(old - inside)]]:
        fs, folder = _folder(spark, path)
        fs.delete(folder, True)


def write_full(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> str:
    """Replace the whole table; returns the folder written."""
    target = _next_version(df.sparkSession, table)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(target)
    return target


def upsert(df: DataFrame, table: str, key: str, order: Column | None = None, buckets: int = BUCKETS) -> str:
    """Merge by key: rows of ``df`` win over stored rows with the same key; returns the version's folder.

    A key repeated inside ``df`` is stored once, the row greatest by ``order`` (or by
    its values). NULL keys match nothing stored.

    Keys are dealt over ``buckets`` by their hash; a table keeps the number it began with. Only the
    buckets that get a row are read and written, the others stay where they are. A table that was
    written as a whole is dealt out by its first merge.
    """
    spark = df.sparkSession
    row = F.struct(*df.columns)
    unique = df.groupBy(F.col(key).alias("__key")).agg(F.max_by(row, order if order is not None else row).alias("__row"))
    finished = versions(spark, table)
    held = _buckets(spark, finished[-1]) if finished else {}
    if held:
        buckets = _bucket_count(spark, finished[-1])
    bucket = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.xxhash64(*df.columns).cast("string"))), F.lit(buckets)).cast("int").alias(BUCKET)
    with temporary(spark):
        new = cut(unique.select("__row.*").select("*", bucket))
        touched = {r[BUCKET] for r in new.select(BUCKET).distinct().collect()}
        if held is None:  # a whole version: all of its rows are dealt out
            old = spark.read.parquet(finished[-1]).select("*", bucket)
            held = {}
        else:
            paths = {n: f"{table}/{held[n]}" for n in sorted(touched & set(held))}
            old = spark.read.parquet(*paths.values()).select("*", bucket) if paths else None
        rows = new
        if old is not None:
            kept = old.join(new.select(F.col(key).alias("__key")), F.col(key) == F.col("__key"), "left_anti")
            rows = kept.unionByName(new)
        version = _next_version(spark, table)
        if not touched and not held and old is None:
            return write_full(df, table)
        home = f"{DEALT}/{version.rsplit('/', 1)[1]}-{uuid.uuid4().hex}"
        rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{table}/{home}")
        written = {int(name.removeprefix(f"{BUCKET}=")): f"{home}/{name}" for name in _children(spark, f"{table}/{home}") if name.startswith(f"{BUCKET}=")}
        _list_buckets(spark, version, buckets, held | written)
        return version


def write_time_range(df: DataFrame, table: str, time_column: str, start: dt.date, end: dt.date) -> None:
    """Replace the days of [start, end) by the rows of ``df`` that fall into them.

    The rows are written once, beside the table, a folder for each day. Then days of the interval that
    got no row are dropped, and the new folders take the place of the old ones by renaming. All other
    days stay untouched. A job that dies on the way leaves the waiting days, from which the next write,
    or ``finish_pending``, completes the swap: rows taken from a replaced day are never lost. A row
    without a time belongs to no day and raises. One writer at a time; a reader that looks during the
    swap may miss a day.
    """
    spark = df.sparkSession
    days = F.col(time_column).cast("date")
    undated = F.raise_error(F.lit(f"a row has no {time_column}")).cast("boolean")
    inside = df.where(F.when(days.isNull(), undated).otherwise((days >= F.lit(start)) & (days < F.lit(end)))).withColumn("day", days)

    finish_pending(spark, table)
    staged = f"{table}/{PENDING}/{start.isoformat()}_{end.isoformat()}_{uuid.uuid4().hex}"
    inside.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(staged)
    _swap_in(spark, table, staged)


def finish_pending(spark: SparkSession, table: str) -> None:
    """Bring a time-range write that was interrupted to its end, or undo it if its rows were not all stored."""
    for name in _children(spark, f"{table}/{PENDING}"):
        staged = f"{table}/{PENDING}/{name}"
        if _exists(spark, f"{staged}/_SUCCESS"):
            _swap_in(spark, table, staged)
        else:
            fs, folder = _folder(spark, staged)
            fs.delete(folder, True)


def _swap_in(spark: SparkSession, table: str, staged: str) -> None:
    """Put the days of a staged write, named after its interval, in place. It may be repeated from wherever it stopped."""
    fs, folder = _folder(spark, staged)
    if not staged.endswith(SWAPPING):
        # All new days still wait here, so a day that does not has become empty.
        start, end = map(dt.date.fromisoformat, staged.rsplit("/", 1)[1].split("_")[:2])
        waiting = set(_children(spark, staged))
        for path in _day_folders(spark, table, start, end):
            if path.rsplit("/", 1)[1] not in waiting:
                fs.delete(_folder(spark, path)[1], True)
        staged += SWAPPING
        _rename(fs, folder, _folder(spark, staged)[1])
    for name in _children(spark, staged):
        if name.startswith("day="):
            target = _folder(spark, f"{table}/{name}")[1]
            fs.delete(target, True)
            _rename(fs, _folder(spark, f"{staged}/{name}")[1], target)
    fs.delete(_folder(spark, staged)[1], True)


def _rename(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"{old.toString()} can't be renamed to {new.toString()}")


def read_time_range(spark: SparkSession, table: str, schema, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Read a time-range table; the interval prunes day folders."""
    rows = spark.read.schema(f"{schema}, day date").parquet(table)
    if start is not None:
        rows = rows.where(F.col("day") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("day") < F.lit(end))
    return rows.drop("day")


def read_day(spark: SparkSession, table: str, day: dt.date) -> DataFrame | None:
    """One stored day of a time-range table, or None."""
    folder = f"{table}/day={day.isoformat()}"
    return spark.read.parquet(folder) if _exists(spark, folder) else None


def _day_folders(spark: SparkSession, table: str, start: dt.date, end: dt.date) -> list[str]:
    found = []
    for name in _children(spark, table):
        stamp = name.removeprefix("day=")
        if stamp != name and stamp != "__HIVE_DEFAULT_PARTITION__" and start <= dt.date.fromisoformat(stamp) < end:
            found.append(f"{table}/{name}")
    return found


def write_yearly(df: DataFrame, base: str, time_column: str = "reportTime") -> None:
    """Observations as one Parquet set per city and year; only sets present in ``df`` are replaced.

    Rebalancing gathers a set into few files but splits one that is large.
    """
    (
        df.withColumn("year", F.year(time_column))
        .hint("rebalance", F.col("city"), F.col("year"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("city", "year")
        .parquet(base)
    )
