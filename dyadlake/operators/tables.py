"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: With it, Spark deletes the shuffle files of a write as soon as the write is over.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.  Only a session of one machine may leave it unset; it then gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="dyadlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


@contextlib.contextmanager
def _short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: lineage is cut, every executor reads the same files, and the write's shuffles are gone."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/dyadlake/{label}-{uuid.uuid4().hex}"
    with _short_lived_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Stored tables that go together: ``with Scratch() as s: ... s.keep(s.store(result, "x"))``."""

    def __init__(self) -> None:
        self._tables: list[DataFrame] = []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        self._tables.append(stored(df, label))
        return self._tables[-1]

    def own(self, df: DataFrame) -> DataFrame:
        """Take over a table that something else has stored."""
        self._tables.append(df)
        return df

    def keep(self, df: DataFrame) -> DataFrame:
        """The table outlives the scope."""
        self._tables = [t for t in self._tables if t is not df]
        return df

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        discard(*self._tables)
        self._tables = []
