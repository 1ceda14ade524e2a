"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder serves in local mode (tests); on a
    cluster that would lose rows, so it is an error there.
    """
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="lectern-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/lectern-{label}-{uuid.uuid4().hex}"
        self._n = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        # read only after this returns: no marker file needed
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def together(self, tables: list[DataFrame]) -> DataFrame:
        """The rows of tables of :meth:`keep` that have the same columns, read by one scan."""
        return self.spark.read.schema(tables[0].schema).parquet(*(t.scratch_path for t in tables))

    def drop(self, df: DataFrame) -> None:
        """Deletes a table of :meth:`keep` that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner", salts: int = 16) -> DataFrame:
    """``rows`` with the columns of their group; the rows of a hot group are dealt to ``salts`` tasks.

    ``groups`` has one row per group, which is repeated for each salt.
    """
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    dealt = groups.withColumn("__salt", F.explode(F.array(*map(F.lit, range(salts)))))
    return rows.withColumn("__salt", salt).join(dealt, [*keys, "__salt"], how).drop("__salt")


class WordCache(dict):
    """word -> value, filled by ``make(word)`` on a miss and emptied at ``limit`` words."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.make(word)
        return value
