"""Tables that only grow by commits: rows are written aside and published by one rename."""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from latentspark.schemas import require_columns


class TableLog:
    """A table at ``path``: folders of Parquet, and numbered commit files that name those that count.

    A commit appears by a rename that fails if its number is taken; the writer then takes the next number. So a
    write that is killed leaves the table as it was, and readers see a commit whole or not at all. A commit has a
    key: doing it again adds nothing. Folders no commit names are never read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def append(self, df: DataFrame, key: str) -> bool:
        """Add rows; False if the key is committed already."""
        return self._commit(df, key, replace=False)

    def replace(self, df: DataFrame, key: str) -> bool:
        """Make these the table's only rows; False if the key is committed already."""
        return self._commit(df, key, replace=True)

    def read(self) -> DataFrame:
        """Rows of the last replacement and all commits after it."""
        found = self.commits()
        first = max((i for i, c in enumerate(found) if c["replace"]), default=0)
        folders = [f"{self.path}/data/{c['folder']}" for c in found[first:]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def commits(self) -> list[dict]:
        """Commits in order of their numbers."""
        store, folder = self._store(), self._path(f"{self.path}/commits")
        if not store.exists(folder):
            return []
        names = sorted(s.getPath().getName() for s in store.listStatus(folder))
        return [json.loads(self._text(store, f"{self.path}/commits/{n}")) for n in names if n.endswith(".json") and not n.startswith(".")]

    def _commit(self, df: DataFrame, key: str, replace: bool) -> bool:
        require_columns(df, self.schema)
        if any(c["key"] == key for c in self.commits()):
            return False
        folder = f"{hashlib.sha256(key.encode()).hexdigest()[:16]}-{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.parquet(f"{self.path}/data/{folder}")
        return self._publish({"key": key, "folder": folder, "replace": replace})

    def _publish(self, commit: dict) -> bool:
        store = self._store()
        store.mkdirs(self._path(f"{self.path}/commits"))
        aside = f"{self.path}/commits/.{uuid.uuid4().hex}"
        stream = store.create(self._path(aside), False)
        stream.write(bytearray(json.dumps(commit).encode()))
        stream.close()
        while True:
            found = self.commits()
            if any(c["key"] == commit["key"] for c in found):
                store.delete(self._path(aside), False)
                return False
            if self._rename(aside, f"{self.path}/commits/{len(found):012d}.json"):
                return True

    def _rename(self, source: str, target: str) -> bool:
        """Whether the rename was done; it is not if the target exists."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        files = jvm.org.apache.hadoop.fs
        context = files.FileContext.getFileContext(self._store().makeQualified(self._path(source)).toUri(), self._conf())
        options = gateway.new_array(getattr(files, "Options$Rename"), 1)
        options[0] = getattr(files, "Options$Rename").NONE
        try:
            context.rename(self._store().makeQualified(self._path(source)), self._store().makeQualified(self._path(target)), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _store(self):
        return self._path(self.path).getFileSystem(self._conf())

    def _text(self, store, path: str) -> str:
        stream = store.open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
