"""Tables kept as versions: folders are written first, then a numbered entry of a log names them.

A reader sees the old or the new version; a job that dies between leaves a
folder that nothing names.  A version is a set of parts, each a folder, so a
write of some parts leaves the others where they are.  The file system has to
create a file exclusively, as local ones and HDFS do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession

WHOLE = ""


class SnapshotTable:
    """keep: versions whose folders stay readable."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 10) -> None:
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._p = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._seen: int | None = None

    def versions(self) -> list[str]:
        """Numbers of the versions in the log, oldest first."""
        if not self._fs.exists(self._p(f"{self.path}/_log")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._p(f"{self.path}/_log"))]
        return sorted(n for n in names if n.isdigit())

    def _entry(self, version: str) -> dict[str, str]:
        """Folder by part.  An entry that is still empty belongs to a writer that is just committing, or that died so; it counts as taken."""
        stream = self._fs.open(self._p(f"{self.path}/_log/{version}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if not text:
            raise RuntimeError(f"version {version} is being committed; if its writer is dead, delete its entry in the log")
        return json.loads(text)

    def _current(self) -> tuple[int, dict[str, str]]:
        found = self.versions()
        return (int(found[-1]) + 1, self._entry(found[-1])) if found else (0, {})

    def read(self, parts: Iterable[str] | None = None) -> DataFrame | None:
        """The newest version, or these parts of it; None if there is nothing.  A write that follows replaces this version and no other."""
        self._seen, folders = self._current()
        wanted = [f for p, f in sorted(folders.items()) if parts is None or p in set(parts)]
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in wanted]) if wanted else None

    def write(self, df: DataFrame, part: Column | None = None) -> None:
        """A new version; if another one came since this table was last read, this raises and changes nothing.

        With part, a string column of few values, only the parts that df has
        rows of are replaced, else the whole table is.
        """
        number, before = self._current()
        if self._seen is not None and number != self._seen:
            raise RuntimeError("the table changed since it was read")
        name = f"v={uuid.uuid4().hex}"
        if part is None:
            df.write.parquet(f"{self.path}/{name}")
            after = {WHOLE: name}
        else:
            df.withColumn("part_", part).write.partitionBy("part_").parquet(f"{self.path}/{name}")
            made = [s.getPath().getName() for s in self._fs.listStatus(self._p(f"{self.path}/{name}")) if s.isDirectory()]
            after = before | {m.removeprefix("part_="): f"{name}/{m}" for m in made if m.startswith("part_=")}
        self._fs.mkdirs(self._p(f"{self.path}/_log"))
        try:
            entry = self._fs.create(self._p(f"{self.path}/_log/{number:012d}"), False)  # fails if it is there
        except Exception as taken:
            raise RuntimeError("the table changed while a version was written") from taken
        entry.write(bytearray(json.dumps(after), "utf-8"))
        entry.close()
        self._seen = number + 1
        self._retire(after)

    def _retire(self, after: dict[str, str]) -> None:
        """Deletes the folders that only versions older than the last keep name, and their entries."""
        found = self.versions()
        old, kept = found[: -self.keep], found[-self.keep :]
        held = {f for v in kept for f in self._entry(v).values()} | set(after.values())
        for version in old:
            for folder in set(self._entry(version).values()) - held:
                self._fs.delete(self._p(f"{self.path}/{folder}"), True)
            self._fs.delete(self._p(f"{self.path}/_log/{version}"), False)


def write_month(df: DataFrame, path: str, month: str) -> None:
    """A month's snapshot, replacing only that month."""
    df.write.mode("overwrite").parquet(f"{path}/month={month}")


def month_before(spark: SparkSession, path: str, month: str) -> DataFrame | None:
    """The newest snapshot strictly before a month."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
    months = sorted(n[6:] for n in names if n.startswith("month=") and n[6:] < month)
    return spark.read.parquet(f"{path}/month={months[-1]}") if months else None
