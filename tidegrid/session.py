"""Session settings, and the one place that decides where durable intermediate data goes."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Settings the operators count on; all of them may be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method above 8000 bytes of bytecode. Long rule lists produce such
    # methods in whole-stage code; below this limit Spark splits them per operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def get_spark(app: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above.

    Shuffle partition counts are left to the cluster's own settings unless given in ``conf``
    (keys use ``_`` for ``.``); adaptive execution merges small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    # Files of checkpoints nobody refers to any more go away; only a new session can be told so.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


#: One process; ``local-cluster`` has executors of its own.
LOCAL_MASTER = re.compile(r"local($|\[)")
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there one machine is all
    there is.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not LOCAL_MASTER.match(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def with_checkpoints(spark: SparkSession) -> None:
    """Make sure that checkpoints have a folder; iterative learners use it on their own."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and cut its lineage there.

    Needed where a plan is non-deterministic when run again (sampled range bounds) or grows with
    every loop turn. Survives the loss of executors, unlike cached blocks.
    """
    with_checkpoints(df.sparkSession)
    return df.checkpoint()
