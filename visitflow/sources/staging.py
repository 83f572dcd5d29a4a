"""Staged results: a DataFrame evaluated once, for several actions, with a lifetime.

``staged(df)`` writes Parquet in the shared folder and hands out the table read
back.  Every later action sees the same rows, random ids included, also after a
lost executor.  ``release()`` (or the end of a ``with`` block) removes the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitflow.spark import shared_dir


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder within one file system; the parent of ``new`` is made."""
    fs, at = _file_system(spark, old)
    to = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"could not move {old} to {new}")


class Staged:
    """A table in the shared folder; ``df`` reads it until ``release``."""

    def __init__(self, df: DataFrame, name: str):
        self._spark = df.sparkSession
        self.path = shared_dir(self._spark, name)
        try:
            df.write.parquet(self.path)
        except BaseException:
            self.release()
            raise
        self.df = self._spark.read.schema(df.schema).parquet(self.path)

    def release(self) -> None:
        remove(self._spark, self.path)

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *error) -> None:
        self.release()


def staged(df: DataFrame, name: str = "staged") -> Staged:
    return Staged(df, name)
