"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the session comes from the caller."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("offerloom")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where it is unset (local runs only)."""
    context = spark.sparkContext
    there = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if there:
        return there.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="offerloom-"))
    return context.getCheckpointDir()


class Scratch:
    """Intermediate tables written to the shared folder, so that a lost executor costs no lineage.

    keep() writes a DataFrame and returns it read again; drop() deletes one that is no longer read.
    What is left is deleted when Python exits; a killed driver leaves one folder named after the label.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.at = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}", {}
        atexit.register(self._delete, self.root)

    def _delete(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone; the folder stays
            pass

    def keep(self, df: DataFrame, name: str | None = None) -> DataFrame:
        path = f"{self.root}/{name or uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.at[id(back)] = path
        return back

    def measured(self, df: DataFrame, **aggregates: Column) -> tuple[DataFrame, dict]:
        """keep(), and aggregates of the rows taken while they are written, without another job."""
        seen = Observation()
        back = self.keep(df.observe(seen, *[c.alias(k) for k, c in aggregates.items()]))
        return back, seen.get

    def drop(self, df: DataFrame) -> None:
        if path := self.at.pop(id(df), None):
            self._delete(path)
