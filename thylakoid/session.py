"""Session and input helpers shared by queries, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the operators are tested under: UTC, AQE, Arrow."""
    builder = (
        SparkSession.builder.master(master)
        .appName("thylakoid")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's checkpoint folder (a temporary one if none is set, in local mode
    only), deleted when the driver's JVM ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = tempfile.mkdtemp(prefix="spark-thylakoid-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/thylakoid-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame, computed once and written to the shared scratch folder: for results that several later
    steps read, and that survive lost executors."""
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_scratch(df: DataFrame) -> None:
    """Deletes what ``cut_lineage`` wrote for a frame that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of finished steps: it does so once the driver has collected what refers to them, for the last step
    after another one ran."""
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
