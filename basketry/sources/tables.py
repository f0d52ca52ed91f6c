"""CSV to Parquet conversion, pruned reads, output gates and versioned publication."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schemas import require_schema


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Headered CSV under a fixed schema; a row that does not fit it fails the job."""
    paths = path if isinstance(path, str) else list(path)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(paths)
    )


def csv_to_parquet(
    spark: SparkSession,
    source: str | Sequence[str],
    target: str,
    schema: T.StructType,
    compression: str = "snappy",
) -> DataFrame:
    """Convert headered CSV to Parquet and return the written table.

    ``target`` must not exist yet: a re-run never mixes with an older conversion.
    """
    read_csv(spark, source, schema).write.option("compression", compression).parquet(target)
    return read_dataset(spark, target)


def read_dataset(
    spark: SparkSession,
    uri: str | Sequence[str],
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    predicate: Column | str | None = None,
) -> DataFrame:
    """Parquet from any Hadoop URI with a column subset and a row predicate.

    Both reach the scan: only the named columns are read, and row groups whose statistics
    rule the predicate out are skipped.
    """
    df = spark.read.parquet(*([uri] if isinstance(uri, str) else uri))
    if schema is not None:
        require_schema(df, schema)
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*columns) if columns else df


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack extracts of one table by column name; duplicates are kept."""
    return reduce(lambda left, right: left.unionByName(right), parts)


def row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per dataset with its row count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in datasets.items()
    ]
    return union_parts(counted)


def validate_outputs(datasets: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """Gate between stages: every dataset must hold at least ``min_rows`` rows.

    All counts run as one job (Parquet answers them from its footers).  Raises if one is
    too small, otherwise returns the counts: one row per dataset.
    """
    counts = row_counts(datasets)
    found = [(row["dataset"], row["rows"]) for row in counts.collect()]
    small = {name: rows for name, rows in found if rows < min_rows}
    if small:
        raise ValueError(f"datasets below {min_rows} rows: {small}")
    spark = counts.sparkSession
    return spark.createDataFrame(found, "dataset string, rows bigint")


def _versions(uri: str) -> str:
    return f"{uri.rstrip('/')}/versions"


def _log(uri: str) -> str:
    return f"{uri.rstrip('/')}/log"


KEPT_VERSIONS = 3  # readers of the last versions before the current one can finish


def publish_dataset(
    df: DataFrame,
    uri: str,
    min_rows: int = 1,
    drop_previous: bool = False,
    layout: Sequence[str] = (),
    keep: int = KEPT_VERSIONS,
) -> DataFrame:
    """Publish a stage output under a fixed name and return the published table.

    The rows go to a fresh version folder and are validated there.  Only then is an entry
    added to the commit log, so readers see the old version or the new one and never a part
    of it, also when an executor or the driver is lost half-way.  Of writers at the same time
    each gets an entry of its own, and the later one is current.  A version that
    fails is removed.  ``layout`` names columns by whose ranges the rows are dealt out and
    sorted: row groups then hold narrow ranges and filters on them skip files.
    ``drop_previous`` removes versions older than the last ``keep``.
    """
    spark = df.sparkSession
    path = new_version(spark, uri)
    if layout:
        df = df.repartitionByRange(*layout).sortWithinPartitions(*layout)
    try:
        df.write.parquet(path)
        written = spark.read.parquet(path)
        counts = validate_outputs({path: written}, min_rows)
    except Exception:
        _delete(spark, path)
        raise
    point_to(spark, uri, path, counts.first()["rows"])
    if drop_previous:
        drop_versions(spark, uri, keep)
    return written


def new_version(spark: SparkSession, uri: str) -> str:
    """Folder for a version; its place among others is that of its entry in the log."""
    number = max(_numbers(spark, uri), default=0) + 1
    return f"{_versions(uri)}/{number:012d}-{uuid.uuid4().hex[:8]}"


def point_to(spark: SparkSession, uri: str, path: str, rows: int) -> int:
    """Make a complete version the current one; the number of its entry in the commit log.

    The next number is taken only if nobody has it yet; else the log is read again and the
    number after is tried.  An entry appears whole or not at all.
    """
    entry = json.dumps({"version": path.rsplit("/", 1)[1], "rows": rows})
    while True:
        number = max(_numbers(spark, uri), default=0) + 1
        if _put_if_absent(spark, f"{_log(uri)}/{number:012d}", entry):
            return number


def drop_versions(spark: SparkSession, uri: str, keep: int = KEPT_VERSIONS) -> None:
    """Remove all published versions but the last ``keep``; unpublished ones stay."""
    if keep < 1:
        raise ValueError("the current version must be kept")
    for number in sorted(_numbers(spark, uri))[:-keep]:
        entry = f"{_log(uri)}/{number:012d}"
        version = _read_entry(spark, entry)["version"]
        _delete(spark, f"{_versions(uri)}/{version}")
        _delete(spark, entry)


def published_version(spark: SparkSession, uri: str) -> str | None:
    """Name of the version that was committed last; None before the first one."""
    numbers = _numbers(spark, uri)
    return _read_entry(spark, f"{_log(uri)}/{max(numbers):012d}")["version"] if numbers else None


def _numbers(spark: SparkSession, uri: str) -> list[int]:
    """Numbers of the entries of the commit log; ``drop_versions`` keeps it short."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_log(uri))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return [int(name) for name in names if name.isdigit()]


def _read_entry(spark: SparkSession, path: str) -> dict:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


_COMMITTING = threading.Lock()  # a local file system looks and renames in two steps


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name that must be free, by a rename that does not replace;
    False if somebody has the name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    draft = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = target.getFileSystem(conf).create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    plain = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        with _COMMITTING:
            hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, plain)
    except Py4JJavaError as error:
        _delete(spark, draft.toString())
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def published_path(spark: SparkSession, uri: str) -> str:
    """Folder of the current version."""
    version = published_version(spark, uri)
    if version is None:
        raise FileNotFoundError(f"nothing published under {uri}")
    return f"{_versions(uri)}/{version}"


def read_published(
    spark: SparkSession,
    uri: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    predicate: Column | str | None = None,
) -> DataFrame:
    """The version of a published table that is current now."""
    return read_dataset(spark, published_path(spark, uri), schema, columns, predicate)


def dataset_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of a dataset on storage; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("length").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
