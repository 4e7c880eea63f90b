"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}


def build_session(app: str = "candlewick", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, AQE and Arrow on. On a cluster the master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _fallback.setdefault(context.applicationId, tempfile.mkdtemp(prefix="candlewick-"))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read from there: computed once, whatever executors are lost."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete kept (staged) tables whose rows have gone into others. Nothing reads them again, whatever is lost."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer referenced: the cleaner acts on collected
    references only, and a driver that does little else may not collect any for half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
