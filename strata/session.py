"""Spark session construction and lineage-cut helpers.

Everything here is plain Spark configuration.  The engine never picks a
machine-local scratch folder on a cluster: reliable checkpoints and
intermediate tables go under the folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session with no such setting
(unit tests) gets a private folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session tuned for the engine's plans.

    * AQE on, with partition coalescing and skew-join splitting: hub entities
      and hot tiers show up as skewed join keys, AQE splits those partitions
      at run time.
    * ``autoBroadcastJoinThreshold`` stays at Spark's size-checked default;
      explicit ``broadcast()`` hints are only placed on tables whose row count
      is bounded by construction (tiers, type lists, clearance pairs).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    cpus = os.cpu_count() or 8
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.optimizer.windowGroupLimitThreshold": "20000",
        "spark.sql.adaptive.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or max(8, cpus)),
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "local").startswith("local")


def _context(spark: SparkSession):
    """The SparkContext, or None on a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - connect sessions expose no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    *and* the session is local (tests) a private temp folder is used.
    """
    sc = _context(spark)
    if sc is None:      # remote session: the server's configured checkpoint dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root for written tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/strata-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss, unlike localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back.  For
    loops: a checkpointed plan keeps its constraints, which grow from round to round."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
