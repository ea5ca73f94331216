"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Fixed value: what the query contracts call a word, as a Java/RE2/Python regex.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_own_folders: dict[str, str] = {}  # of local sessions, by application


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder
    of its own. On a cluster a missing setting is an error, because a folder
    of one machine is invisible to the others.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_folders:
            _own_folders[app] = "file://" + tempfile.mkdtemp(prefix="keelson-")
        folder = _own_folders[app]
    # a path without a scheme lies where Hadoop's default file system says, for Spark and for ``filesystem`` alike
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one use, inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here delete their shuffle files when they end: nothing reads them afterwards."""
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    This cuts the lineage: what reads the result does not depend on any
    executor's local files. The schema is passed on, so reading back starts
    no job.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with cleaning(spark):
        df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._keelson_path = path
    return back


class Scratch:
    """The stored tables of one computation; what is left of them is deleted at its end, also when it fails."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*self.tables)

    def own(self, table: DataFrame) -> DataFrame:
        """Take over a stored table."""
        self.tables.append(table)
        return table

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return self.own(stored(df, name))

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        dropped(*tables)
        self.tables = [t for t in self.tables if not any(t is x for x in tables)]


def dropped(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_keelson_path", None)
        if path:
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, as ``shared_folder`` gives it."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri.removeprefix("file:")


def make_folder(uri: str) -> None:
    fs, path = filesystem(uri)
    fs.create_dir(path, recursive=True)


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name no other task attempt uses.

    Retried or speculative attempts write their own files; only files listed
    by the attempt that Spark commits are read later.
    """
    return f"{prefix}-{os.getpid()}-{uuid.uuid4().hex}{suffix}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this library importable in Python workers, once per application.

    The same as passing it with ``--py-files``: workers may run in another folder or on
    another machine than the driver.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="keelson-"), "keelson_library.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "keelson")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
