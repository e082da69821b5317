"""Where intermediate tables go.

Iterative jobs cut their lineage by writing a table and reading it back. The
folder comes from ``spark.checkpoint.dir`` so that every executor can reach it
and a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as configured for the session.

    Only a single-machine session (``local[...]``) may go without the setting; it
    uses a folder below its warehouse. The session's settings are never changed.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def run_folder(spark: SparkSession) -> str:
    """The one folder that holds all intermediate tables of this application."""
    return f"{scratch_root(spark).rstrip('/')}/pairwright-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new, unused path below the application's scratch folder."""
    return f"{run_folder(spark)}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Later stages read it as often as they like without recomputing ``df``, and
    the planner sees its real size, so joins are chosen from facts.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a superseded intermediate table written by this package."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.delete(hadoop_path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediate tables, once its results are consumed."""
    discard(spark, run_folder(spark))
