"""Resource tables kept in a folder of files and written file by file.

A merge rewrites only the files that hold a row which the source names; all others stay as they are. New files are
written to a hidden folder first. A journal then names the files that come and go, so that a commit which died midway
is finished, and a write that died before it is forgotten, the next time the folder is opened.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import PlantError
from ..operators.merge import merge
from .schemas import WRITE_RULES

_JOURNAL, _NEW = "_journal", "_new-"


@dataclass(frozen=True)
class Rewrite:
    """What a merge did: files written anew and kept, rows in the new files, rows created and updated among them."""

    rewritten: int
    kept: int
    rows: int
    created: int
    updated: int


class _Folder:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.jvm, self.name = jvm, path.rstrip("/")
        self.path = jvm.org.apache.hadoop.fs.Path(self.name)
        self.files = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return reduce(self.jvm.org.apache.hadoop.fs.Path, names, self.path)

    def names(self, *below: str) -> list[str]:
        return [f.getPath().getName() for f in self.files.listStatus(self.at(*below))]

    def data(self, *below: str) -> list[str]:
        return [n for n in self.names(*below) if not n.startswith(("_", "."))]

    def commit(self, new: str, gone: list[str]) -> None:
        """Make the files of ``new`` the table's in place of those ``gone``; from the journal on there is no way back."""
        text = "\n".join([new, *gone]).encode()
        draft = self.at(f"{_JOURNAL}-{uuid.uuid4().hex}")
        out = self.files.create(draft, True)
        try:
            out.write(text)
        finally:
            out.close()
        if not self.files.rename(draft, self.at(_JOURNAL)):
            raise PlantError(f"another write to {self.name} is being committed")
        self.finish()

    def finish(self) -> None:
        """Carry out the journal; every step may have been done before."""
        stream = self.files.open(self.at(_JOURNAL))
        try:
            new, *gone = bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode().split("\n")
        finally:
            stream.close()
        if self.files.exists(self.at(new)):
            for name in self.data(new):
                if not self.files.rename(self.at(new, name), self.at(name)):
                    raise PlantError(f"can not move {name} in {self.name}")
        for name in gone:
            self.files.delete(self.at(name), False)
        self.files.delete(self.at(new), True)
        self.files.delete(self.at(_JOURNAL), False)

    def recover(self) -> None:
        names = self.names()
        if _JOURNAL in names:
            self.finish()
        for name in names:
            if name.startswith((_NEW, f"{_JOURNAL}-")):
                self.files.delete(self.at(name), True)


def _key(resource: str) -> str:
    if resource not in WRITE_RULES:
        raise PlantError(f"Resource {resource} can not be written with merge")
    return "id" if WRITE_RULES[resource].has_id else "externalId"


def create_store(df: DataFrame, path: str, resource: str, files: int | None = None) -> None:
    """Write a resource table to a new folder, in the order of its key, so that a source meets few files."""
    key = _key(resource)
    parted = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    parted.sortWithinPartitions(key).write.mode("errorifexists").parquet(path)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The stored table, after a write that died was finished or forgotten. One writer at a time."""
    _Folder(spark, path).recover()
    return spark.read.parquet(path)


def _file() -> Column:
    return F.col("_metadata.file_name").alias("_file")


def _touched(stored: DataFrame, source: DataFrame) -> list[str]:
    """Names of the files that hold a row with an id or externalId of the source; only those columns are read."""
    hits = [
        stored.select(c, _file()).join(source.select(F.col(c).cast(stored.schema[c].dataType).alias(c)).filter(F.col(c).isNotNull()).distinct(), c, "left_semi").select("_file")
        for c in ("id", "externalId")
        if c in source.columns and c in stored.columns
    ]
    if not hits:
        raise PlantError("id or externalId is required")
    # As many names as the table has files at most, which the driver lists to read it.
    return sorted(r["_file"] for r in reduce(DataFrame.unionByName, hits).distinct().collect())


def merge_at(spark: SparkSession, path: str, source: DataFrame, resource: str, mode: str = "abort", *, now: datetime | None = None, **options) -> Rewrite:
    """``merge`` into a stored table: files without a row that ``source`` names are carried over as they are.

    A refused row raises before anything changes. A source that is run again after a failure gives the same table.
    Counts are observed while the files are written.
    """
    key, stored, folder = _key(resource), open_store(spark, path), _Folder(spark, path)
    now = now or datetime.now(timezone.utc)
    gone, all_files = _touched(stored, source), folder.data()
    target = spark.read.schema(stored.schema).parquet(*[f"{folder.name}/{name}" for name in gone]) if gone else stored.limit(0)
    highest = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] if key == "id" else None
    result = merge(target, source, resource, mode, now=now, highest_id=highest, **options).raise_for_errors()

    def stamped(column: str) -> Column:
        hit = F.col(column) == F.lit(now) if column in stored.columns and mode != "delete" else F.lit(False)
        return F.coalesce(F.sum(hit.cast("long")), F.lit(0)).alias(column)

    seen, new = Observation(), f"{_NEW}{uuid.uuid4().hex}"
    table = result.table.repartitionByRange(key).sortWithinPartitions(key)  # finding the ranges reads the table too
    table = table.observe(seen, F.count(F.lit(1)).alias("rows"), stamped("createdTime"), stamped("lastUpdatedTime"))
    table.write.parquet(f"{folder.name}/{new}")
    counts = seen.get
    folder.commit(new, gone)
    created = counts["createdTime"]
    return Rewrite(len(gone), len(all_files) - len(gone), counts["rows"], created, counts["lastUpdatedTime"] - created)
