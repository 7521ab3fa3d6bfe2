"""Session settings the engine relies on, and the folder its intermediate tables go to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the results and the two-table writer depend on (all can change at run time)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated JSON key takes its last value instead of making the text invalid.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # Rule sets make long expressions. Beyond this size the JVM would interpret the fused method, so Spark is told
    # to generate smaller ones instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Two routes per task: keep both files open instead of sorting the rows by route.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: what ``spark.checkpoint.dir`` names, or else the context's checkpoint folder.

    Where neither is set, a folder inside the warehouse serves a local session. On a cluster that would be a guess, so
    it is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nothing has written to yet, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
