"""Session settings, table reading and the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "statloom", master: str = "local[8]", **extra: str) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    conf = SETTINGS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    } | extra
    return SparkSession.builder.master(master).appName(app).config(map=conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of whole texts that JVM and Python workers hand to each other at once.
BATCH_ROWS = "2000"


def lean_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than the default, where nobody has chosen a size: rows here hold whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir.

    Where nobody has set it, a local session gets a temporary folder; a cluster
    has no folder that all its machines share unless it names one.
    """
    lean_batches(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext.getCheckpointDir()
        if held:
            base = held.rsplit("/", 1)[0]
        elif spark.sparkContext.master.split("[")[0] == "local":
            base = tempfile.mkdtemp(prefix="statloom-")
        else:
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base}/statloom-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each write inside gives its shuffle files back when it is done, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Scratch:
    """The intermediate files and staged tables of one run, in the shared place until ``drop``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.tables = spark, shared_dir(spark), []

    def written(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows, written here and read again."""
        with shuffles_dropped(self.spark):
            rows.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}")

    def kept(self, rows: DataFrame, name: str, drop: bool = True) -> DataFrame:
        """The rows, written to a folder that outlives this run; all else goes if asked."""
        with shuffles_dropped(self.spark):
            rows.write.option("compression", "zstd").parquet(path := f"{shared_dir(self.spark)}/{name}")
        if drop:
            self.drop()
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.clear()
        delete(self.spark, self.path)
