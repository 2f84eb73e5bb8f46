"""Run reports that survive a crash (M5).

A report's folder holds numbered versions. A new one is written under a hidden name, closed,
and renamed to the next number, which publishes it; only then are older ones deleted. So
at every moment a reader finds a whole version: the one before, until the rename, and the
new one after it. The newest number is the pointer. A report is one small JSON document,
which the driver writes through the file system that the path names.
"""
from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_NAME = "report-%09d.json"


class ReportFolder:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.spark, self.path = spark, path.rstrip("/")
        self._path = jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(self.path)
        self._fs = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        if not self._fs.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._folder)]
        return sorted(int(n[7:-5]) for n in names if n.startswith("report-") and n.endswith(".json"))

    def file(self, version: int) -> str:
        return f"{self.path}/{_NAME % version}"

    def _write(self, report: dict) -> str:
        """Write a version that no reader sees yet."""
        hidden = f"{self.path}/_unpublished-{uuid.uuid4().hex}"
        out = self._fs.create(self._path(hidden), False)
        try:
            out.write(bytearray(json.dumps(report, sort_keys=True, default=str).encode() + b"\n"))
        finally:
            out.close()
        return hidden

    def _publish(self, hidden: str) -> int:
        """Give a written version the next number; a number that another writer took is passed over."""
        version = (self.versions() or [0])[-1] + 1
        while self._fs.exists(self._path(self.file(version))) or not self._fs.rename(self._path(hidden), self._path(self.file(version))):
            if not self._fs.exists(self._path(hidden)):
                raise FileNotFoundError(hidden)
            version += 1
        return version

    def save(self, report: dict) -> int:
        version = self._publish(self._write(report))
        for older in self.versions():
            if older < version:
                self._fs.delete(self._path(self.file(older)), False)
        return version

    def claim(self, report: dict) -> None:
        """Write the first version, or fail if the folder is taken; of several writers one succeeds."""
        parent = self._folder.getParent()
        self._fs.mkdirs(parent)
        # creating the marker without overwriting is the one step that only one writer can take
        marker = self._path(f"{self.path}/_claimed")
        if self.versions():
            raise FileExistsError(f"{self.path} holds a report")
        try:
            self._fs.create(marker, False).close()
        except Exception as error:
            if self._fs.exists(marker):
                raise FileExistsError(f"{self.path} is claimed") from error
            raise
        self.save(report)

    def frame(self) -> DataFrame:
        """The newest version as one row of text, column ``value``."""
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"{self.path} holds no report")
        return self.spark.read.option("wholetext", True).text(self.file(found[-1]))

    def load(self) -> dict:
        """The newest whole version: on a store whose renames can be torn, the one before a torn one."""
        for version in reversed(self.versions()):
            try:
                return json.loads(self.spark.read.option("wholetext", True).text(self.file(version)).first()[0])
            except (json.JSONDecodeError, TypeError, AnalysisException):
                continue
        raise FileNotFoundError(f"{self.path} holds no report")


def save_report(spark: SparkSession, report: dict, path: str) -> None:
    """M5: publish the report as the newest version in the folder ``path``."""
    ReportFolder(spark, path).save(report)


def load_report(spark: SparkSession, path: str) -> dict:
    return ReportFolder(spark, path).load()


def report_frame(spark: SparkSession, path: str) -> DataFrame:
    return ReportFolder(spark, path).frame()
