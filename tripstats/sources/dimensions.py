"""Dimension tables: loading, reading, looking up."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripstats.operators.lookup import with_current_names
from tripstats.schemas import HOTEL_DIM

ROWS_PER_CHUNK = 10_000  # rows a JDBC insert sends at once (fixed value)


def read_hotels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOTEL_DIM).parquet(path)


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """Flights under their current column names, whichever names the files use."""
    return with_current_names(spark.read.parquet(path))


def write_dimension(
    frame: DataFrame, path: str, rows_per_file: int = 5_000_000, key: str | None = None
) -> None:
    """Bulk load as parquet, in files of bounded size; in the order of `key` if one is named.

    Ranges of the key then lie in files and row groups of their own, which lookups skip.
    """
    if key:
        frame = frame.repartitionByRange(key).sortWithinPartitions(key)
    frame.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def _bucket_folders(spark: SparkSession, path: str) -> list:
    """File system of `path` and its folders `buckets=<n>`."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(folder) if files.exists(folder) else []
    return [files, [f.getPath() for f in found if f.getPath().getName().startswith("buckets=")]]


def _table(folder: str) -> str:
    return f"tripstats_{hashlib.sha256(folder.encode()).hexdigest()[:32]}"


def write_bucketed(frame: DataFrame, path: str, key: str, buckets: int) -> None:
    """A dimension in `buckets` files by the hash of its key, under `path`/buckets=<n>.

    For dimensions beyond the broadcast budget that many batches join: the shuffle is paid once,
    here. Choose `buckets` so that one fits in a task's memory, and at least
    spark.sql.shuffle.partitions, as Spark shuffles a side with fewer; the key needs the type of the
    events' ids, as a cast loses the buckets. What was there before goes after the new files are
    written.
    """
    spark, folder = frame.sparkSession, f"{path}/buckets={buckets}"
    table = _table(folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        frame.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        .mode("overwrite").option("path", folder).saveAsTable(table)
    )
    spark.sql(f"DROP TABLE {table}")  # its files stay
    files, folders = _bucket_folders(spark, path)
    for old in folders:
        if old.getName() != f"buckets={buckets}":
            files.delete(old, True)


def read_bucketed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A dimension written by `write_bucketed`, which joins on `key` don't shuffle.

    Spark learns of buckets from a table only, so one is declared over the files; any session
    can, as nothing but the folder has to be known.
    """
    _, folders = _bucket_folders(spark, path)
    if len(folders) != 1:
        raise ValueError(f"{len(folders)} bucketed tables in {path}, one expected: write it again")
    folder = f"{path}/{folders[0].getName()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema)
    table, buckets = _table(folder), int(folders[0].getName().partition("=")[2])
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(table)


def _has_rows(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).limit(1).isEmpty()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def load_dimensions(
    spark: SparkSession, frames: Mapping[str, DataFrame], paths: Mapping[str, str],
    keys: Mapping[str, str] | None = None,
) -> bool:
    """Load all dimensions unless each is already there with rows; tells whether it loaded.

    Those with a key in `keys` are written in its order.
    """
    if all(_has_rows(spark, paths[name]) for name in frames):
        return False
    for name, frame in frames.items():
        write_dimension(frame, paths[name], key=(keys or {}).get(name))
    return True


def read_jdbc_dimension(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    key_range: tuple[int, int],
    partitions: int,
    properties: Mapping[str, str],
) -> DataFrame:
    """Dimension from a database, read in parallel by key range (driver jar needed).

    Filters and the column list of later steps are pushed into the database's query.
    """
    return with_current_names(
        spark.read.jdbc(
            url,
            table,
            column=key,
            lowerBound=key_range[0],
            upperBound=key_range[1],
            numPartitions=partitions,
            properties=dict(properties),
        )
    )


def write_jdbc_dimension(
    frame: DataFrame, url: str, table: str, properties: Mapping[str, str]
) -> None:
    """Bulk load into a database in chunks (driver jar needed)."""
    frame.write.option("batchsize", ROWS_PER_CHUNK).jdbc(
        url, table, mode="overwrite", properties=dict(properties)
    )
