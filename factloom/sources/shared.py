"""Tables between steps, in the folder that all executors share, and joins to them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir); only a local master may do without one."""
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not given:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        given = tempfile.mkdtemp(prefix="factloom-")
        sc.setCheckpointDir(given)
    return given.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, wherever Spark can read."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the application ends (Hadoop's deleteOnExit)."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hpath)
    files.deleteOnExit(hpath)
    return path


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession, f'scratch-{name}')}/rows"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def beside(rows: DataFrame, facts: DataFrame, key: list[str], total: int) -> DataFrame:
    """Inner join of rows with the facts of their keys, of which column n counts a key's rows.

    total is at least the number of rows (of each band, where rows have bands). Facts of keys with over a
    thousandth of them, fewer than 1000 keys whatever the total, are broadcast, so that these rows stay where
    they are instead of meeting in one task.
    """
    least = total // 1000 + 1
    hot = F.broadcast(facts.filter(F.col("n") > least))
    rest = rows.join(F.broadcast(facts.filter(F.col("n") > least).select(*key)), key, "left_anti").join(facts.filter(F.col("n") <= least), key)
    return rows.join(hot, key).union(rest)
