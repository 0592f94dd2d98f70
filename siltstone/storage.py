"""Small-file access for manifests: local files directly, all else through Hadoop."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def is_local(uri: str) -> bool:
    return urlparse(uri).scheme in ("", "file")


def local_path(uri: str) -> str:
    return urlparse(uri).path if uri.startswith("file:") else uri


class Store:
    """Files below one table's root; names are relative to it."""

    def __init__(self, uri: str, spark: SparkSession | None = None, options: dict[str, str] | None = None):
        self.local = is_local(uri)
        self.root = os.path.abspath(local_path(uri)) if self.local else uri.rstrip("/")
        self.spark, self.options = spark, dict(options or {})

    def path(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def _hadoop(self, name: str):
        spark = self.spark or SparkSession.active()
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        for k, v in self.options.items():
            conf.set(k, str(v))
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(conf), p

    def exists(self, name: str) -> bool:
        if self.local:
            return os.path.exists(self.path(name))
        fs, p = self._hadoop(name)
        return fs.exists(p)

    def list(self, name: str) -> list[tuple[str, int]]:
        """Names and sizes of the files in a folder; none if it doesn't exist."""
        if self.local:
            if not os.path.isdir(self.path(name)):
                return []
            return sorted((e.name, e.stat().st_size) for e in os.scandir(self.path(name)) if e.is_file())
        fs, p = self._hadoop(name)
        if not fs.exists(p):
            return []
        return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(p) if s.isFile())

    def read(self, name: str) -> str:
        if self.local:
            with open(self.path(name), encoding="utf-8") as f:
                return f.read()
        fs, p = self._hadoop(name)
        stream = fs.open(p)
        try:
            return (self.spark or SparkSession.active())._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a new file in one step; False if the name is taken."""
        if self.local:
            path = self.path(name)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            temp = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
            with open(temp, "w", encoding="utf-8") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(temp, path)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(temp)
        fs, p = self._hadoop(name)
        if fs.exists(p):
            return False
        # rename doesn't replace on HDFS; object stores need a committer that has conditional puts
        _, temp = self._hadoop(f"{os.path.dirname(name)}/.{uuid.uuid4().hex}")
        stream = fs.create(temp, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if fs.rename(temp, p):
            return True
        fs.delete(temp, False)
        return False

    def remove(self, name: str) -> None:
        if self.local:
            path = self.path(name)
            shutil.rmtree(path, ignore_errors=True) if os.path.isdir(path) else os.path.exists(path) and os.unlink(path)
        else:
            fs, p = self._hadoop(name)
            fs.delete(p, True)


def reliable(df: DataFrame) -> DataFrame:
    """The rows as they are now, in the session's checkpoint folder, so a lost executor doesn't change them."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="siltstone-checkpoint-"))
    return df.checkpoint()
