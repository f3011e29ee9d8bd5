"""Tables that are replaced in one step: written aside, looked at, then pointed to.

Every write makes a version folder of its own. One small file beside them names the version that
readers see; it is replaced by a rename, which HDFS and local file systems do in one step (an object
store puts the one file anew). A write or a data test that fails leaves the file, and with it the old
table, as it was. There must be one writer at a time.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillstream.operators import quality

POINTER = "CURRENT"


class Published:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def stage(self, rows: DataFrame, partition_by: str | None = None) -> str:
        """Writes a version that nobody sees yet, and returns its name; names sort by time."""
        version = f"{time.time_ns():020d}-{os.urandom(4).hex()}"
        writer = rows.write.mode("errorifexists")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(self.folder(version))
        return version

    def folder(self, version: str) -> str:
        return f"{self.path}/versions/{version}"

    def rows(self, version: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder(version))

    def publish(self, version: str) -> None:
        """Makes a version the table, in one step."""
        files, path = self._files()
        fresh = path(f"{POINTER}-{version}")
        with_bytes = files.create(fresh, True)
        try:
            with_bytes.write(bytearray(version.encode()))
        finally:
            with_bytes.close()
        jvm = self.spark._jvm
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            path(".").toUri(), self._settings()).rename(fresh, path(POINTER), options)

    def version(self) -> str | None:
        files, path = self._files()
        if not files.exists(path(POINTER)):
            return None
        stream = files.open(path(POINTER))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def current(self) -> DataFrame:
        """The published rows; none before the first publication."""
        version = self.version()
        return self.rows(version) if version else self.spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, checks: list | None = None,
                partition_by: str | None = None, keep: int = 2) -> DataFrame | None:
        """Writes, tests and publishes; returns the test report. Failed tests raise instead.

        `keep` versions stay for readers that began before; versions that never were published and
        are older go as well.
        """
        version, report = self.stage(rows, partition_by), None
        if checks:
            report = quality.report(self.rows(version), checks)
            quality.enforce(report)
        self.publish(version)
        self.vacuum(keep)
        return report

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all versions before the last `keep` ones up to the published one."""
        files, path = self._files()
        current = self.version()
        if current is None:
            return
        names = sorted(status.getPath().getName() for status in files.listStatus(path("versions")))
        for name in [n for n in names if n <= current][:-keep]:
            files.delete(path(f"versions/{name}"), True)

    def _settings(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _files(self):
        """The table's file system, and a function from names to its paths."""
        new_path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = new_path(self.path).getFileSystem(self._settings())
        files.mkdirs(new_path(self.path))
        # Qualified, so that a path without scheme means the same to all of Hadoop's classes.
        root = files.makeQualified(new_path(self.path))
        return files, lambda name: new_path(root, name) if name != "." else root
