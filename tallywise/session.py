"""The shared folder for checkpoints and intermediate tables, and settings that suit the plans."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Broadcast and hash joins only on sizes measured at run time: Catalyst cannot know how many words a
# text explodes into, so its estimates before the run are no ground for a broadcast.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where the setting is absent and Spark runs on this machine alone (tests), a temporary folder
    is set. On a cluster a missing setting is an error: a local folder would not be shared.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallywise-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{shared_folder(spark).rstrip('/')}/tallywise-{uuid.uuid4().hex}/{name}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executors and gives every later read the same values."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run in a folder of their own under the shared folder.

    A table goes when it is dropped, or with all others on :meth:`release`. What a returned frame
    still reads must stay until the caller has read it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = scratch_path(spark, "run")
        self._next = 0
        self._tables: dict[str, str] = {}

    def path(self, name: str) -> str:
        """A path in the folder that no other call returns."""
        self._next += 1
        return f"{self.folder}/{self._next:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the table read back."""
        path = self.path(name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def bucketed(
        self, df: DataFrame, name: str, buckets: int, keys: Sequence[str], dealt: bool = False, order: Sequence[str] = ()
    ) -> DataFrame:
        """Write ``df`` as a table of ``buckets`` files, a hash of ``keys`` choosing the file, sorted by them or by
        ``order``, and return it read back. A join or aggregate on ``keys`` reads it without a shuffle where
        ``spark.sql.shuffle.partitions`` is the same number. ``dealt`` says that ``df`` already has that
        partitioning. The table is in the session's catalogue until it is dropped."""
        path, table = self.path(name), f"tallywise_{uuid.uuid4().hex}"
        rows = df if dealt else df.repartition(buckets, *keys)
        writer = rows.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*(order or keys))
        writer.saveAsTable(table)
        self._tables[path] = table
        back = self.spark.table(table)
        back._scratch_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that :meth:`write` or :meth:`bucketed` returned."""
        for table in tables:
            self._forget(table._scratch_path)
            delete(self.spark, table._scratch_path)

    def release(self) -> None:
        """Delete the whole folder."""
        for path in list(self._tables):
            self._forget(path)
        delete(self.spark, self.folder)

    def _forget(self, path: str) -> None:
        if path in self._tables:
            self.spark.sql(f"drop table if exists {self._tables.pop(path)}")


def clean_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage, upon which Spark deletes the shuffle files of frames that are gone.
    Otherwise those of a finished step stay on disk beside the next one's until the driver's memory is short."""
    gc.collect()
    spark._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that this library made, in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

