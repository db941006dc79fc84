"""Session settings and the shared folder for tables that outlive one plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where the plan above it then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on; cluster sizing is left as it is."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int = 8, app: str = "thalweg", memory: str = "12g") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Recording the Python line of every column costs more than building the plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def workspace(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is used, and only in local mode: on a cluster
    a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            _local_roots[app] = tempfile.mkdtemp(prefix="thalweg-")
        root = _local_roots[app]
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the workspace that nothing has written to."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str, by=()):
    """Write ``df`` to the workspace, in one folder per value of ``by``, and read it back.

    Cuts the lineage, so an input used several times is computed once and a lost executor costs
    a re-read and not a re-run.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
