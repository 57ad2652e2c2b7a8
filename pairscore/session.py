"""Session helpers: one place for the runtime settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans assume. AQE re-plans joins from runtime sizes (broadcast
# only when the measured side is below the threshold) and splits skewed join
# partitions where both join inputs are plain shuffles; the product joins,
# whose product side is aggregated, split hot products themselves
# (operators.skew).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "pairscore", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. On a cluster, pass master=None and let
    spark-submit decide; ``shuffle_partitions`` then comes from the job."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or else the folder set with
    ``SparkContext.setCheckpointDir``. With neither, a local master gets a scratch folder; on a cluster executors
    would each write to their own disk, so that is an error."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="pairscore-ckpt-")
    # RDD checkpoints (forest node ids) go to the same folder; set it once,
    # since every setCheckpointDir call creates a new sub-folder
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back. This cuts lineage (a lost executor costs a re-read, not a
    recompute of joins, tokenising and embeddings), and unlike an RDD
    checkpoint the re-reads are columnar, so each later pass (one Word2Vec
    fit per column, every tree level of a forest) reads only its columns.
    ``remove_stages`` deletes the tables when their readers are done."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_root(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pairscore/{spark.sparkContext.applicationId}"


def remove_stages(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables, once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
