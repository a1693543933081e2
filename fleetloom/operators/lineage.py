"""Cutting a plan's lineage, so that what follows reads it instead of computing it again."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint, in the folder that the cluster shares (spark.checkpoint.dir); local runs without one use a temporary folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir is unset: this cluster names no folder that its executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="fleetloom-"))
    return df.checkpoint()
