"""Session construction and cluster-aware settings.

On a cluster the session comes from the platform; ``build_session`` is for
local runs and tests.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from
the session and only falls back to a fresh local folder when the setting is
absent (local mode / tests), never on a cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that hold at any scale: AQE re-plans shuffles at runtime, coalesces
# small partitions, splits skewed join partitions; UTC everywhere.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # texts can be long: keep Arrow batches to the Python workers bounded
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def _driver_memory() -> str:
    """Half the machine's memory, at most 16 GB (local mode: the driver is
    the executor)."""
    if os.environ.get("QUARRY_DRIVER_MEMORY"):
        return os.environ["QUARRY_DRIVER_MEMORY"]
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total / 2**30 / 2)))}g"


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", _driver_memory())
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only when ``spark.checkpoint.dir`` is unset (local runs, tests) is a fresh
    scratch folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
    return sc.getCheckpointDir()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings every query relies on: UTC dates, small Arrow batches
    (a batch of long texts is held by the JVM and by its Python worker),
    checkpoint folder."""
    for key in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        if spark.conf.get(key) != SCALE_CONF[key]:
            spark.conf.set(key, SCALE_CONF[key])
    ensure_checkpoint_dir(spark)
    return spark
