"""Session construction and the shared scratch folder.

Intermediate tables (stream checkpoints, round-trip files, written snapshots)
live under the folder the cluster names in ``spark.checkpoint.dir``, which must
be shared storage reachable by every executor. Only when the session has no
such setting (local tests) do we create one under the system temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide receipt projections compile to methods above HotSpot's 8000-byte
    # JIT limit; without this flag they would run interpreted. Only takes
    # effect for JVMs this builder launches.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


#: Bytes of a method beyond which HotSpot leaves it interpreted.
HUGE_METHOD = "8000"


def compiled_methods(spark: SparkSession) -> None:
    """Let Spark split a wide projection whose one generated method would be too
    long for HotSpot to compile. Sessions are often launched without the flag
    above, and the setting counts when the query runs, so it stays set; a value
    that the session was given is left alone."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, "65535") == "65535":
        spark.conf.set(key, HUGE_METHOD)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerly", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(CHECKPOINT_KEY, None)
    if not value:
        value = spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, creating a local one only
    when none is configured (tests and single-machine runs)."""
    d = _configured_dir(spark)
    if d is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ledgerly-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder, made
    through the folder's own file system."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{label}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return path
