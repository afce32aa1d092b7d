"""Session settings and durable intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans count on.  Cluster sizing (executors, memory,
# shuffle partitions) stays with the person submitting the job.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tailfold", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own, because there the
    driver and the executors are one process on one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder to run on a cluster")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tailfold-")
    return _local_root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Several passes over an expensive intermediate then cost a columnar scan each,
    and a lost executor re-reads files instead of replaying the lineage.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _paths[id(staged)] = (weakref.ref(staged, lambda _, key=id(staged): _paths.pop(key, None)), path)
    return staged


_paths: dict[int, tuple] = {}


def release(spark: SparkSession, *staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more.

    Spark drops the shuffle files of a finished query when the driver collects its garbage, which
    it may not do for a long time; so it is asked to.
    """
    jvm = spark.sparkContext._jvm
    for table in staged:
        _, path = _paths.pop(id(table), (None, None))
        if path:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    gc.collect()
    jvm.System.gc()
