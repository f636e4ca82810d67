"""Session construction and cluster-facing settings.

Library functions never create sessions; they take DataFrames. This module is
for tests, the bench and command-line use. On a cluster the session is
provided by the platform and only :func:`checkpoint_dir` is consulted.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splitting is the backstop for hot keys the
# operators do not salt themselves.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when the cluster
    names none (local tests) is a private scratch folder created and set.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return spark.sparkContext.getCheckpointDir() or conf_dir
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def cut_lineage(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder (or at ``path``) and read it
    back: lineage is cut, the result survives executor loss, and later readers
    get columnar scans (cheaper than an RDD checkpoint of serialized rows)."""
    import uuid

    if path is None:
        base = checkpoint_dir(df.sparkSession).rstrip("/")
        path = f"{base}/tessera-tables/{name}-{uuid.uuid4().hex}"
        for held in _SCOPES:
            held.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_SCOPES: list[list[str]] = []


class stored_copies:
    """``with stored_copies() as paths`` lists the tables that :func:`cut_lineage` and :func:`cut_by_key` write meanwhile, so
    that a caller can give them to :func:`delete_paths` once nothing reads them any more."""

    def __enter__(self) -> list[str]:
        _SCOPES.append([])
        return _SCOPES[-1]

    def __exit__(self, *_) -> None:
        _SCOPES.pop()


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders on whatever file system they are; those that are gone already are passed over."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def cut_by_key(df: DataFrame, key: str, name: str = "table", path: str | None = None) -> DataFrame:
    """:func:`cut_lineage` for a table that is grouped by ``key`` afterwards: it is stored in buckets of ``key``, so
    such groupings need no shuffle. ``df`` should come from ``repartition(key_buckets(spark), key)``, which makes one
    file a bucket; a task that meets one bucket only writes it as it comes, without a sort of all its rows by bucket.
    Buckets are read through a catalogue entry, which is dropped once the plan holds the files."""
    import uuid

    spark = df.sparkSession
    table = f"tessera_{name}_{uuid.uuid4().hex}"
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/tessera-tables/{table}"
        for held in _SCOPES:
            held.append(path)
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, 1)
    try:
        df.write.format("parquet").bucketBy(key_buckets(spark), key).option("path", path).saveAsTable(table)
    finally:
        spark.conf.set(writers, before)
    return _forget_entry(spark, table)


def open_by_key(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table that :func:`cut_by_key` wrote to ``path`` in ``buckets`` buckets."""
    import uuid

    table = f"tessera_open_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    return _forget_entry(spark, table)


def _forget_entry(spark: SparkSession, table: str) -> DataFrame:
    stored = spark.table(table)
    stored.schema  # resolved before the entry goes; the files of an external table stay
    spark.sql(f"DROP TABLE {table}")
    return stored


def key_buckets(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fits(df: DataFrame, max_rows: int, max_bytes: int = 128 << 20) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of at most ``max_bytes`` in all; reads at most max_rows+1. Texts count
    by their bytes, other values as 8."""
    from pyspark.sql import functions as F

    wide = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    row = sum(wide, F.lit(8 * len(df.columns)))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the Python workers of this context.

    Arrow UDFs and ``mapInPandas`` bodies live in this package; workers import
    them by module name. The package is zipped once per SparkContext and sent
    with ``addPyFile`` (Spark's file server distributes it to every executor).
    """
    import shutil

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="tessera-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "tessera"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(key)
