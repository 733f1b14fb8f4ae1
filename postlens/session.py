"""Session helpers: a tuned builder for local runs and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins by runtime size
# (broadcast only what actually turned out small) and splits skewed
# partitions; the session time zone is pinned so timestamps read the same on
# every executor.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on sizes measured at run time: the planner's file-size
    # estimates are switched off, AQE converts a join to a broadcast once a
    # side's shuffle output is known to be below the bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = "local[*]", app: str = "postlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  state_store: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB per shuffle partition;
    left as the cluster has it unless given), AQE coalesces the small ones.  ``state_store="rocksdb"`` keeps streaming
    state off the heap (set before the first streaming query starts).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if state_store == "rocksdb":
        # stream state kept on local disk (RocksDB) instead of the JVM heap:
        # the choice for large join / dedupe / window state
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_STATE_STORE
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (executors and a restarted driver must
    see the same files).  Only a local-mode session without the setting gets
    a fresh folder of its own, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect has no SparkContext)
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if root:
        return root
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not str(master).startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="postlens-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
    try:
        spark.conf.set("spark.checkpoint.dir", root)
    except Exception:  # noqa: BLE001  (core settings may be read-only at runtime)
        pass
    return root


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique (not yet created) sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    sub = f"{purpose}-{uuid.uuid4().hex[:12]}"
    if "://" in root and not root.startswith("file:"):
        return root.rstrip("/") + "/" + sub
    return os.path.join(root.replace("file:", "", 1) if root.startswith("file:") else root, sub)


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a sub-folder that :func:`work_dir` named, through Hadoop's file system (any store Spark knows)."""
    jvm = getattr(spark, "_jvm", None)               # Spark Connect has none: the folder stays
    if jvm is not None:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings for what is started inside; those of before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Shuffle files go when their job is over, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
