"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Spark's setting that removes the shuffle files of a query at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(
    app_name: str = "askgraph",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators were planned for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the first
    comes from spark-submit, the second is coalesced by adaptive execution from
    whatever the cluster configures.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_folders: dict[str, tempfile.TemporaryDirectory] = {}
# Staged paths and tables per application, oldest first.
_paths: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is used, but only in local
    mode, and removed with the process: on a cluster a machine-local folder
    would lose tables with the machine, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        app = context.applicationId
        if app not in _local_folders:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            _local_folders[app] = tempfile.TemporaryDirectory(prefix="askgraph-")
        folder = _local_folders[app].name
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _staging_path(spark: SparkSession, name: str) -> str:
    path = new_path(spark, name)
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def removing_staged(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving what was staged inside, also after a failure.

    For work whose results are written by then: DataFrames that still read a
    staged table can't be used afterwards. What was staged before stays.
    """
    app = spark.sparkContext.applicationId
    paths, tables = _paths.setdefault(app, []), _tables.setdefault(app, [])
    old_paths, old_tables = len(paths), len(tables)
    try:
        yield
    finally:
        for table in tables[old_tables:]:
            spark.sql(f"drop table if exists {table}")
        for path in paths[old_paths:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del paths[old_paths:], tables[old_tables:]


@contextmanager
def leaving_no_shuffle(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and the
    disk holds those of all steps of a job. For writes that are not run again.
    """
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if old is None else spark.conf.set(CLEANUP, old)


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    For intermediate results that are read several times: the work is not
    repeated per reader, and a lost executor costs a read and not a recompute.
    """
    path = _staging_path(spark, name)
    with leaving_no_shuffle(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by_key(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    key: str,
    buckets: int | None = None,
    dealt: bool = False,
) -> DataFrame:
    """``staged``, with the rows of equal ``key`` in one of ``buckets`` files, in order.

    Two tables written with as many buckets join on the key as they lie: Spark
    knows the layout from its catalog and shuffles neither. The number defaults
    to that of shuffle partitions, which is the same for tables of one job. Rows
    that are ``dealt`` over partitions by the key already are not shuffled again.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = _staging_path(spark, name)
    table = f"askgraph_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    with leaving_no_shuffle(spark):
        (
            (df if dealt else df.repartition(buckets, key))
            .write.format("parquet")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", path)
            .saveAsTable(table)
        )
    return spark.table(table)
