"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs rely on. They only ask Spark to re-plan from
# measured sizes: coalesce small partitions, split skewed ones (also where the
# split costs one more shuffle), and broadcast a side only once it is known to
# be below the threshold.
_RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Tasks of the retail jobs. A task sorts and hashes what it reads, in which a shuffled
# megabyte becomes some 30 in memory, so the sizes are far below Spark's defaults; and
# there have to be enough partitions for the sizes to matter, which Spark coalesces to
# them where there is less.
_TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PARTITIONS = 600


def build_session(app: str = "martlet", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in {**_RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def small_tasks(spark: SparkSession) -> SparkSession:
    """Bound what one task of a retail job sorts and hashes, however large the tables
    are. A session that has smaller sizes or more partitions keeps them."""
    for key, value in _TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > _bytes(value):
            spark.conf.set(key, value)
    now = spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if int(now) < _PARTITIONS:
        spark.conf.set(_INITIAL, str(_PARTITIONS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; a cluster without it is an
    error, since a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="martlet-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Cuts lineage and freezes whatever depends on task layout; survives the loss
    of any executor because later stages read the files, not cached blocks.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)  # read once or twice, so size counts
    return spark.read.schema(df.schema).parquet(path)
