"""Shared scratch storage: where intermediate tables are written so that lineage can be cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder, shared by all executors.

    Where the setting is absent on one machine (tests) a temporary folder is registered instead; a
    cluster without the setting is refused, since its executors share no local folder.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="coinloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def staged(df: DataFrame) -> DataFrame:
    """Write `df` once as Parquet in the shared scratch folder and read it back.

    Cuts the lineage, fixes the result of non-deterministic expressions, and survives the
    loss of any executor, since nothing of it lives on an executor's own disk.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """Write `df` once as a bucketed table in the shared scratch folder and read it back.

    A join or an aggregate on all of `keys` shuffles only what meets the table, however often it is read.
    """
    spark = df.sparkSession
    name = f"coinloom_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(parts, *keys).write.bucketBy(parts, *keys)
    writer.format("parquet").option("compression", "zstd").option("path", f"{scratch_root(spark)}/{name}").saveAsTable(name)
    return spark.read.table(name)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
