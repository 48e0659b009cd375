"""Session settings and shared staging space."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Riders and drivers are skewed keys: pay the extra exchange when a join partition is skewed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sessions of one busy rider are merged on the map side before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "ridelake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the recommended settings; ``conf`` keys may use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: under ``spark.checkpoint.dir``, or else under the warehouse.

    Both are shared by the driver and all executors; a machine's own temporary folder is not.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/ridelake/{app}"


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared staging once and read it back.

    Cuts the lineage for frames that a plan reads several times.  Parquet keeps
    column pruning and size statistics, and survives the loss of executors.
    """
    path = staging_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Size of the files and frames that ``df`` reads; those of unknown size are not counted."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    return sum(size for size in sizes if size < unknown)


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` handles for table maintenance on any supported storage."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it is missing."""
    fs, target = hadoop_path(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(target)) if fs.exists(target) else []


def path_size(spark: SparkSession, path: str) -> int:
    fs, target = hadoop_path(spark, path)
    return fs.getContentSummary(target).getLength()


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename; ``target`` must not exist."""
    fs, old = hadoop_path(spark, source)
    new = hadoop_path(spark, target)[1]
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file; readers see the old text or the new one."""
    fs, target = hadoop_path(spark, path)
    fresh = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fresh, target, options)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = hadoop_path(spark, path)
    stream = fs.open(target)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def release_staging(spark: SparkSession) -> None:
    """Drop every table this application staged (call when its results are consumed)."""
    delete_path(spark, staging_root(spark))
