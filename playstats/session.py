"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall-clock for timestamp_ntz parity, ANSI
# arithmetic (division by zero must be guarded, as in the reference's SQL), AQE
# for runtime coalescing and skew splitting, no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Runtime SQL settings applied to whatever session runs the queries (also one
# created by someone else). Constraint propagation re-derives every alias and
# IS NOT NULL constraint through the 21-feature projections of the feature views,
# which made optimisation of the similarity plans take close to a minute; the
# explicit predicates those plans need are written out, so nothing is lost.
# Arrow batches end at these bytes, not only at 10,000 rows, so a Python worker's memory does not
# grow with the length of the texts.
RUNTIME_CONF = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.constraintPropagation.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def _local_heap() -> str:
    """Half of the machine's memory, 1 to 16 GB."""
    gb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") >> 30
    return f"{max(1, min(16, gb // 2))}g"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "playstats", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the project settings.

    On a cluster ``master`` stays None and the submit command decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf.update(RUNTIME_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", _local_heap())
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset and the
    master is local (tests) a scratch folder is created and registered. On a cluster
    an unset folder is an error rather than a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            # a machine-local folder would not be visible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                               "for iterative and materialising jobs")
        configured = tempfile.mkdtemp(prefix="playstats-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Used where a frame is read more than once or a loop needs its last state: lost
    executors re-read files instead of recomputing, and later reads prune columns.
    """
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/playstats-stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
