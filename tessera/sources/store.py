"""Small files of builds (manifests, reports, pointers) on any file system: plain paths are
the driver's own, paths with a scheme (hdfs://, s3a://, file://) go through Hadoop's."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession


class StorePath:
    """What is used of pathlib.Path, for a path with a scheme."""

    def __init__(self, path: str) -> None:
        self._path = path.rstrip("/")

    def __str__(self) -> str:
        return self._path

    def __repr__(self) -> str:
        return f"StorePath({self._path!r})"

    def __eq__(self, other: object) -> bool:
        return isinstance(other, StorePath) and other._path == self._path

    def __hash__(self) -> int:
        return hash(self._path)

    def __truediv__(self, name: str) -> StorePath:
        return StorePath(f"{self._path}/{name}")

    @property
    def name(self) -> str:
        return self._path.rpartition("/")[2]

    @property
    def parent(self) -> StorePath:
        return StorePath(self._path.rpartition("/")[0])

    def _system(self) -> tuple[Any, Any]:
        """Hadoop's file system of the path, and the path as it takes it."""
        spark = SparkSession.builder.getOrCreate()
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path)
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at

    def exists(self) -> bool:
        system, at = self._system()
        return system.exists(at)

    def read_text(self) -> str:
        system, at = self._system()
        if not system.exists(at):
            raise FileNotFoundError(self._path)
        stream = system.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        """Written aside and put in place in one step."""
        system, at = self._system()
        aside = self.parent / f".{self.name}.{uuid.uuid4().hex}"
        jvm, gateway = SparkSession.builder.getOrCreate().sparkContext._jvm, SparkSession.builder.getOrCreate().sparkContext._gateway
        fs = jvm.org.apache.hadoop.fs
        stream = system.create(fs.Path(str(aside)), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        how = getattr(fs, "Options$Rename")
        options = gateway.new_array(how, 1)
        options[0] = how.OVERWRITE
        fs.FileContext.getFileContext(at.toUri(), system.getConf()).rename(fs.Path(str(aside)), at, options)

    def mkdir(self, **_: Any) -> None:
        system, at = self._system()
        system.mkdirs(at)

    def glob(self, pattern: str) -> Iterator[StorePath]:
        system, _ = self._system()
        jvm = SparkSession.builder.getOrCreate().sparkContext._jvm
        for found in system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self._path}/{pattern}")) or []:
            # As the path was written: Hadoop may spell its root in another way.
            steps = pattern.count("/") + 1
            yield StorePath("/".join([self._path, *found.getPath().toString().split("/")[-steps:]]))

    def changed(self) -> float:
        system, at = self._system()
        return system.getFileStatus(at).getModificationTime() / 1000


def at(path: str | Path | StorePath) -> Path | StorePath:
    if isinstance(path, str) and "://" in path:
        return StorePath(path)
    return path if isinstance(path, StorePath) else Path(path)


def changed(path: Path | StorePath) -> float:
    """When the file was last written, in seconds."""
    return path.changed() if isinstance(path, StorePath) else path.stat().st_mtime
