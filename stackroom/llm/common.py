"""What several operators share: tables kept between jobs, normal forms, sizing."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and the six controls from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def scratch_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the warehouse: both are
    shared by the driver and the executors."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is deleted when the application ends."""
    path = f"{scratch_folder(spark)}/stackroom-llm/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    The table is columnar, so later jobs read the columns they need, and it outlives
    any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Kept tables that are needed no longer than a result that is a table itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete some of the tables, all if none is named."""
        for name in names or [*self.paths]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def one_space(text: Column) -> Column:
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Maximal runs of anything but the contracts' white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def process_cache() -> dict:
    """A dict that lives as long as the Python worker, over all its tasks."""
    return sys.modules.setdefault("_stackroom_llm_cache", types.ModuleType("_stackroom_llm_cache")).__dict__


class Remembered(dict):
    """A memory of bounded size in two generations.

    When the young one is full it becomes the old one, and what is asked for again moves
    back; so what is frequent stays, however much is seen once.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most // 2, {}

    def make_room(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def known_of(self, wanted: set) -> set:
        """Make what is remembered of ``wanted`` ready to be read, and return the rest."""
        self.make_room()
        # Sets would walk through the whole memory: they look up in a plain dict or a set alone.
        missing = {w for w in wanted if w not in self}
        again = {w for w in missing if w in self.old}
        self.update(zip(again, map(self.old.__getitem__, again)))
        return missing - again

    def forget(self) -> None:
        self.clear()
        self.old = {}
