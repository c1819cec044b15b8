"""Session settings and the shared folder used for materialised intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "allelespan", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="allelespan-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing uses yet, in a folder of this application that goes when its driver ends."""
    context = spark.sparkContext
    folder = f"{shared_dir(spark)}/allelespan-{context.applicationId}"
    if getattr(context, "_allelespan_folder", None) != folder:
        files, target = _file(spark, folder)
        files.mkdirs(target)
        files.deleteOnExit(target)
        context._allelespan_folder = folder
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._allelespan_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of ``materialise`` results that nothing reads any more; other frames have none."""
    for df in frames:
        if path := getattr(df, "_allelespan_path", None):
            files, target = _file(df.sparkSession, path)
            files.delete(target, True)
