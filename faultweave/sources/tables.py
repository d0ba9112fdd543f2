"""Reading the input tables and finding the folder that all executors share."""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Event producers whose logs are materialized (fixed values).
PRODUCERS = ("data_acquisition", "hhm_rpp_ge", "hhm_rpp_philips")

#: The name under which this engine logs its own runs; its rows are never read back.
SELF_APP = "faultweave"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once for each application; they need not have it installed.

    The archive is read by the driver alone, which serves it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = spark.conf.get("spark.checkpoint.dir", None) or ""
    folder = root.removeprefix("file://") if root.startswith(("file:/", "/")) and os.path.isdir(root.removeprefix("file://")) else tempfile.mkdtemp(prefix="faultweave-")
    path = os.path.join(folder, f"faultweave-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(at, n), os.path.join("faultweave", os.path.relpath(os.path.join(at, n), package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of ``sf_dir``; only the columns that a plan uses are read (Parquet)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A session setting for what is planned or run in here; afterwards it is what it was."""
    usual = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def stamp(spark: SparkSession, path: str) -> str:
    """What tells whether a table has changed: its files' names, lengths and times."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return "|".join(sorted(f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(p)))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over all cores before costly work on each row, if its scan alone would leave most of them idle.

    A scan of more than two partitions a core, and one of at least a file for each core, stays as it is: a large table is never
    shuffled for this. ``keys`` are hashed, so a lost task is repeated with the same rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() > 2 * cores or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores, *keys)


def shared_root(spark: SparkSession) -> str:
    """The folder shared by driver and executors: ``spark.checkpoint.dir``. Where that is unset, an own one if all executors are
    on this machine; on a cluster it has to be set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='faultweave-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


class Scratch:
    """A folder for what operators write, with the few file-system calls that they need: a given one, which stays, or a private
    one under the shared root, which goes with the application."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        ship(spark)
        self.spark = spark
        self.path = path or f"{shared_root(spark)}/fw-{uuid.uuid4().hex}"
        self._hp = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hp(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        if path is None:  # lazy results read it until the application ends
            self._fs.deleteOnExit(self._hp(self.path))

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._hp(self.at(name)))

    def drop(self, name: str) -> None:
        self._fs.delete(self._hp(self.at(name)), True)

    def touch(self, name: str, ms: int) -> None:
        """Give a file a modification time, in milliseconds since 1970."""
        self._fs.setTimes(self._hp(self.at(name)), ms, -1)

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """Write ``df`` as a table (this cuts the lineage and survives lost executors) and read it back."""
        w = df.write.mode("overwrite").option("compression", "zstd")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(self.at(name))
        return self.spark.read.schema(df.schema).parquet(self.at(name))

    def create(self, name: str, text: str) -> bool:
        """Write a small file that must not exist: whole or not at all. False: it exists already."""
        tmp, final = f"{name}.{uuid.uuid4().hex}.tmp", self.at(name)
        out = self._fs.create(self._hp(self.at(tmp)), True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getScheme() == "file":  # a link fails where the name is taken; rename would replace it
                try:
                    os.link(self._local(tmp), self._local(name))
                    return True
                except FileExistsError:
                    return False
            return not self.exists(name) and self._fs.rename(self._hp(self.at(tmp)), self._hp(final))  # refuses an existing target
        finally:
            self.drop(tmp)

    def _local(self, name: str) -> str:
        return self._hp(self.at(name)).toUri().getPath()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._hp(self.at(name)))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def list(self, name: str = "") -> list[str]:
        p = self._hp(self.at(name)) if name else self._hp(self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []


class ConcurrentWriterError(RuntimeError):
    """Another writer has published since this one read."""


class Versions:
    """The small state of a store (what belongs to it, its cursors) in numbered files.

    A version is written whole under another name and then moved to its own, which must not exist. Whenever a writer dies, readers
    find the old version or the new one; of two writers that start from the same version one is refused. The last two versions stay.
    """

    def __init__(self, files: Scratch, name: str, start: dict):
        self.files, self.name = files, name
        self.number = max(self._numbers(), default=0)
        self.value: dict = json.loads(files.read(self._file(self.number))) if self.number else start

    def _file(self, number: int) -> str:
        return f"{self.name}-{number:012d}.json"

    def _numbers(self) -> list[int]:
        return [int(m.group(1)) for n in self.files.list() if (m := re.fullmatch(rf"{re.escape(self.name)}-(\d{{12}})\.json", n))]

    def check(self) -> None:
        """Refuse to go on if another writer was faster; called before costly work, too."""
        if max(self._numbers(), default=0) != self.number:
            raise ConcurrentWriterError(f"{self.files.at(self.name)} has moved on from version {self.number}")

    def publish(self, value: dict) -> None:
        self.check()
        if not self.files.create(self._file(self.number + 1), json.dumps(value)):
            raise ConcurrentWriterError(f"version {self.number + 1} of {self.files.at(self.name)} was published by another writer")
        self.number, self.value = self.number + 1, value
        for old in self._numbers():
            if old < self.number - 1:
                self.files.drop(self._file(old))
