"""Spark session defaults and the checkpoint directory rule."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints are removed once no DataFrame refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "stratum",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or return) a session with AQE and skew-join handling on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
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
    """Use the cluster's ``spark.checkpoint.dir``; only a local session
    without one gets a scratch directory (tests, benches).  A Spark Connect
    session has no SparkContext here: the server's setting applies."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="stratum-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when this application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark.sparkContext, path))
    return path


_SCRATCH: list = []


def _remove_scratch() -> None:
    """Remove the staged tables of sessions that still run; the driver that has
    made them is the only one that reads them."""
    for sc, path in _SCRATCH:
        if sc._jsc is not None and not sc._jsc.sc().isStopped():
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    _SCRATCH.clear()


def materialize(df):
    """Cut lineage at a stage boundary: the rows written once as Parquet in the
    session's ``spark.checkpoint.dir`` and read back (survives executor loss;
    never a machine-local checkpoint).  Used where one result feeds several
    later joins: it is computed once (a ``checkpoint`` computes its last stage a
    second time to write it), later reads take the columns they need, and the
    later plans stay small."""
    path = scratch(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
