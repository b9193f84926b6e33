"""Spark session construction and the shared-storage settings every job reads.

Nothing here is specific to one table: the session carries adaptive execution,
the layer base URI and the checkpoint folder.  On a cluster the operator of the
cluster sets ``spark.checkpoint.dir`` (a shared folder); we only fill it in when
it is unset, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Spark conf key naming the root folder/URI of the layered tables.
BASE_URI_CONF = "tierline.base.uri"

DEFAULT_CONF: dict[str, str] = {
    # Re-plan at runtime from real shuffle sizes: coalesce small partitions,
    # split skewed join partitions, turn a join into a broadcast when the
    # measured build side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the rows must be shuffled again for what follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast only what is proven small.  Static estimates are guesses (a
    # join's estimate is the product of its inputs, so the *fact* side can look
    # smaller than the dimension), so estimate-based broadcast is off; a join
    # is broadcast either after a bounded row count of the dimension
    # (``operators.joins``) or by adaptive execution from measured shuffle
    # sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Layer files: zstd wrote and read back faster than snappy here and
    # compresses better, which is what object-store IO pays for.
    "spark.sql.parquet.compression.codec": "zstd",
    # Dates are composed from parts and compared as DATE; keep the session
    # clock fixed so nothing depends on the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "tierline",
    base_uri: str | None = None,
    conf: dict[str, str] | None = None,
    master: str | None = None,
    catalog: str | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``base_uri`` is any Hadoop filesystem URI (``s3a://bucket/lake``,
    ``hdfs://...``, ``file:/...``) under which the layers live.  ``catalog`` is Spark's
    catalog implementation: ``hive`` keeps registered tables in the configured metastore,
    the default ``in-memory`` keeps them for the life of the process.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if catalog:
        builder = builder.config("spark.sql.catalogImplementation", catalog)
    if base_uri:
        builder = builder.config(BASE_URI_CONF, base_uri)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, choosing one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we never
    override it.  When it is unset, the layer base URI's ``_checkpoints``
    folder is used (shared storage); only a ``local`` master (tests) may fall
    back to a fresh machine-local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        base = spark.conf.get(BASE_URI_CONF, None)
        if base:
            current = base.rstrip("/") + "/_checkpoints"
        elif spark.sparkContext.master.startswith("local"):
            current = tempfile.mkdtemp(prefix="tierline-ckpt-")
        else:
            raise ValueError(
                "spark.checkpoint.dir is unset: name a folder on shared storage "
                f"(or set {BASE_URI_CONF})"
            )
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def durable_catalog(spark: SparkSession) -> bool:
    """True when registered tables outlive this process."""
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "in-memory"


def base_uri(spark: SparkSession, default: str | None = None) -> str:
    value = spark.conf.get(BASE_URI_CONF, None) or default
    if not value:
        raise ValueError(f"no layer base URI: set {BASE_URI_CONF} or pass one")
    return value


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and split sizes for a cluster reading ``input_bytes``.

    Starts shuffles with about one partition per ``partition_bytes`` of input
    (at least two per core) and lets adaptive execution coalesce them to the
    same advisory size, so partitions stay spill-friendly at any scale.  File
    splits use the same size.  Pass the result as ``build_session(conf=...)``.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    size = f"{partition_bytes // (1 << 20)}m"
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        # Coalesce to the advisory size, not to the default parallelism:
        # fewer, fuller reduce tasks and output files on a large cluster.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": size,
    }


def local_session(cores: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local benchmark (``local[N]``)."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(
        "tierline-local",
        master=f"local[{n}]",
        conf={
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "8g",
        },
    )
