"""Session helpers: a configured SparkSession and a shared scratch location.

On a cluster the scratch location is whatever the session names in
``spark.checkpoint.dir`` (a shared file system); a cluster session without it
is refused.  Only for a local master (runs and tests) with the setting absent do
we create a private directory and record it in the session.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_scratch: list[str] = []  # paths handed out and not yet deleted, oldest first
_hadoop_conf: list = []  # of the newest session: still serves when the session is stopped


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemill") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    master = master or os.environ.get("TIDEMILL_MASTER")
    parts = shuffle_partitions or os.environ.get("TIDEMILL_SHUFFLE_PARTITIONS")
    builder = SparkSession.builder.appName(app_name)
    # master and shuffle width are the cluster's own unless the caller names them
    if master:
        builder = builder.master(master)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMILL_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, if it is there."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get(_CKPT_KEY, None)
    if not current:
        try:
            current = spark.conf.get(_CKPT_KEY, None)
        except Exception:  # noqa: BLE001 - core confs may be hidden from the SQL conf
            current = None
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        # a machine-local folder is not visible to other executors and dies with the node
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemill-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables.

    Queries read such a table lazily, so it stays until ``drop_scratch`` or the program's end."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    _hadoop_conf[:] = [spark._jsc.hadoopConfiguration()]
    if not _scratch:
        atexit.unregister(drop_scratch)
        atexit.register(drop_scratch, spark)
    _scratch.append(path)
    return path


def scratch_mark() -> int:
    """Where the list of scratch tables ends now; ``drop_scratch(since=...)`` starts there."""
    return len(_scratch)


def drop_scratch(spark: SparkSession, since: int = 0, keep_last: int = 0) -> None:
    """Delete the tables written to ``scratch_path``s from ``since`` on but the ``keep_last`` newest.

    The file system is reached through the JVM, which outlives a stopped session."""
    gone = _scratch[since:len(_scratch) - keep_last]
    del _scratch[since:len(_scratch) - keep_last]
    for path in gone:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(_hadoop_conf[0]).delete(target, True)
        except Exception:  # noqa: BLE001 - the JVM is gone, nothing can be deleted through it
            return
