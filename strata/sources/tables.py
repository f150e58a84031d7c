"""Parquet table scans with declared schemas (pushdown + pruning by Catalyst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.schemas import INPUT_TABLES


def spread_small(df: DataFrame) -> DataFrame:
    """Applied before CPU-heavy per-row text work (tokenising, extraction,
    HTML, embedding): a table stored in fewer files than there are cores
    (e.g. one file with one row group) would be processed by a single task,
    so it is spread round-robin.  Inputs with at least one file per core
    keep their file splits (no shuffle of the raw corpus at scale)."""
    if df.isStreaming:          # micro-batches are bounded by maxFilesPerTrigger
        return df
    from strata.session import _context
    sc = _context(df.sparkSession)
    par = sc.defaultParallelism if sc is not None else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if len(df.inputFiles()) < par:
        return df.repartition(par)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(INPUT_TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_optional(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a stage table; an absent optional table is a typed empty frame."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as exc:  # AnalysisException: PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


class Tables:
    """Lazy accessor: ``Tables(spark, d).documents``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in INPUT_TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
