"""Session defaults and the shared folder for intermediate data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that suit both a laptop and a large cluster.  Sizes of shuffle
#: partitions are left to adaptive execution, which merges small ones and splits
#: the partitions of a hot key.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_local_folders: dict[str, str] = {}


def build_session(
    app_name: str = "quern",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's defaults, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs over an input of this size on this many cores.

    A shuffle may be as large as the input.  Its partitions start at about 128 MB,
    which fits next to others in an executor's memory; adaptive execution merges
    those that turn out small.  Large inputs are read in larger splits, so that
    the number of tasks stays in the range a driver handles well.
    """
    partition = 128 * 1024**2
    partitions = max(2 * cores, -(-input_bytes // partition))
    split = partition if partitions <= 100_000 else 4 * partition
    return {
        "spark.sql.shuffle.partitions": str(min(partitions, 100_000)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def _shared_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: intermediate tables need a folder "
            "that every executor can reach"
        )
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="quern-")
    return _local_folders[app]


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or the context's checkpoint
    directory).  Only a local session without either gets a temporary folder.
    """
    app = spark.sparkContext.applicationId
    return f"{_shared_root(spark)}/quern/{app}/{label}-{uuid.uuid4().hex}"


def clear_shared(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder."""
    path = f"{_shared_root(spark)}/quern/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage on storage that outlives executors, and fixes values
    (row positions, say) that must not differ when a stage runs again.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
