"""Intermediate tables that several results share."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path is."""
    folder, system = _file_system(spark, path)
    return system.exists(folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if it is not there."""
    folder, system = _file_system(spark, path)
    system.delete(folder, True)


def _is_local(spark: SparkSession) -> bool:
    """Do all processes share this machine's disk? Those of ``local-cluster`` do too."""
    return spark.sparkContext.master.startswith("local")


def _comes_together(spark: SparkSession, path: str) -> bool:
    """Do files that the executors write to this folder of a cluster all arrive here?

    One small file per core is written, as any table is, and those that the driver sees are
    counted: what an executor puts on a disk of its own is missing.
    """
    probe, tasks = f"{path}/probe-{uuid.uuid4().hex}", spark.sparkContext.defaultParallelism
    folder, system = _file_system(spark, probe)
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(probe)
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sum(name.startswith("part-") for name in names) == tasks
    finally:
        remove_path(spark, probe)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder, which goes when
    the JVM ends. ``local-cluster`` may not, as its executors may have temporary folders of their
    own. A setting without a scheme means the default file system: on a cluster whose default is
    the local disk, it may be a folder that all machines mount or one that each has of its own.
    So files are written there from all executors, and if one does not arrive, the folder is
    refused; so is one that is not there. Executors that join later are taken to be like those
    that were asked. A folder with an explicit ``file:`` is taken without a trial.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        configured = configured.rstrip("/")
        folder, system = _file_system(spark, configured)
        scheme = system.getUri().getScheme()
        if scheme == "file" and not folder.toUri().getScheme() and not _is_local(spark):
            if not (system.exists(folder) and _comes_together(spark, configured)):
                raise RuntimeError(
                    f"spark.checkpoint.dir {configured!r} is on each machine's own disk; "
                    "name a shared file system"
                )
        return configured
    if _is_local(spark) and not spark.sparkContext.master.startswith("local-cluster"):
        made = tempfile.mkdtemp(prefix="cohortspark-")
        folder, system = _file_system(spark, f"file:{made}")
        system.deleteOnExit(folder)
        return made
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


class Scratch:
    """A folder of its own for intermediate Parquet tables.

    A saved table outlives the executors that wrote it, is read column by column and starts
    a new lineage. The folder is removed when a ``with`` block ends. Without one, as for a lazy
    result that reads from it, it is removed when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
        self._names: Counter[str] = Counter()
        self._tables: list[str] = []
        folder, system = _file_system(spark, self.path)
        system.mkdirs(folder)
        system.deleteOnExit(folder)

    def save(self, name: str, rows: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Run the plan once and return the stored table. Names may come again.

        A partitioned table is rebalanced ahead of writing, so that its number of files follows
        its size and not partitions times values.
        """
        self._names[name] += 1
        again = self._names[name]
        path = f"{self.path}/{name}" + (f"-again-{again}" if again > 1 else "")
        if partition_by:
            rows.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
        else:
            rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def save_bucketed(self, name: str, rows: DataFrame, key: str, buckets: int) -> DataFrame:
        """As ``save``, in buckets by ``key``: joins and groupings on it shuffle no stored row.

        Rows that already lie in ``buckets`` partitions by ``key`` become one file a bucket.
        Buckets are known to Spark's catalog only, so the table is entered there, in the session
        catalog under a name of its own, until the folder is dropped.
        """
        self._names[name] += 1
        table = f"spark_catalog.default.scratch_{uuid.uuid4().hex}"
        path = f"{self.path}/{name}-buckets-{self._names[name]}"
        self._tables.append(table)
        rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
        return self.spark.table(table)

    def drop(self) -> None:
        """Remove the folder with all its tables."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")
        remove_path(self.spark, self.path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()
