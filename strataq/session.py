"""Session, table access and lineage cutting."""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "strataq", cpus: str | int = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most stored bytes that are moved to spread a source over the cores.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as there are cores, where its source has fewer splits (one small file is one split) and no more than SPREAD_BYTES: for work that costs far more than moving its rows. Other sources stay as they are split."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    small = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SPREAD_BYTES
    return df.repartition(cores) if small and df.rdd.getNumPartitions() < cores else df


def _shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a local one only where it is unset and the master is local."""
    said = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if said:
        return said
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    d = os.path.join(tempfile.gettempdir(), f"strataq-{spark.sparkContext.applicationId}")
    os.makedirs(d, exist_ok=True)
    return "file://" + d


def kept_path(spark: SparkSession, source: str, name: str) -> str:
    """A folder in the shared one for what is derived from a stored table: another one for another state of the table (its files' sizes and times) and for another application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    status = fs.getFileStatus(path)
    files = fs.listStatus(path) if status.isDirectory() else [status]
    state = "|".join(sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files))
    digest = hashlib.sha256(f"{spark.sparkContext.applicationId}|{state}".encode()).hexdigest()[:24]
    return f"{_shared_dir(spark)}/{name}-{digest}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that a lost executor costs no recomputation from the source."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(_shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
