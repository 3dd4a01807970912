"""Session helpers shared by all operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints that every executor can reach.

    ``spark.checkpoint.dir`` of the session wins. Only where it is unset and all
    tasks run in this process (tests) a temporary folder of this machine is taken
    and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not configured and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = configured or tempfile.mkdtemp(prefix="spark-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
