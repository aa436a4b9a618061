"""Merges into stored tables: which files change, counts, refusals, and writes that die midway."""

import hashlib
import os
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantframe import PlantError
from plantframe.sources import store
from plantframe.sources.schemas import read_schema
from plantframe.sources.store import create_store, merge_at, open_store

NOW = datetime(2031, 5, 1, tzinfo=timezone.utc)


def events(spark, n):
    ids = spark.range(1, n + 1)
    given = {"id": F.col("id"), "externalId": F.concat(F.lit("e"), F.col("id").cast("string")), "description": F.lit("old")}
    return ids.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in read_schema("events").fields])


def files(path):
    return {f.name: hashlib.md5(f.read_bytes()).hexdigest() for f in Path(path).glob("part-*")}


@pytest.fixture()
def path(spark, tmp_path):
    create_store(events(spark, 800), str(tmp_path / "events"), "events", 8)
    return str(tmp_path / "events")


def test_only_touched_files_change(spark, path):
    before = files(path)
    source = spark.createDataFrame([(5, None, "by id"), (None, "e7", "by name"), (None, "new", "created")], "id long, externalId string, description string")
    done = merge_at(spark, path, source, "events", "upsert", now=NOW)
    after = files(path)
    assert (done.rewritten, done.kept, done.created, done.updated) == (1, 7, 1, 2) and done.rows == 101
    assert len(before.items() & after.items()) == 7
    rows = {r.externalId: r for r in open_store(spark, path).collect()}
    assert len(rows) == 801 and rows["e5"].description == "by id" and rows["e7"].description == "by name" and rows["e8"].description == "old"
    assert rows["new"].id == 801  # above the highest id of the whole table
    again = merge_at(spark, path, source, "events", "upsert", now=NOW)
    assert again.kept >= 7 and {r.externalId for r in open_store(spark, path).collect()} == rows.keys()


def test_files_without_hits_and_deletes(spark, path):
    before = files(path)
    new = spark.createDataFrame([("fresh",)], "externalId string")
    assert merge_at(spark, path, new, "events", "upsert").rewritten == 0
    assert before.items() <= files(path).items()
    gone = merge_at(spark, path, spark.createDataFrame([(790,), (9999,)], "id long"), "events", "delete")
    assert gone.rewritten == 1 and gone.created == gone.updated == 0
    assert open_store(spark, path).filter("id = 790").count() == 0 and open_store(spark, path).count() == 800


def test_refusals_change_nothing(spark, path):
    before = files(path)
    taken = spark.createDataFrame([("e9",), ("e700",)], "externalId string")
    with pytest.raises(PlantError, match="already exists"):
        merge_at(spark, path, taken, "events", "abort")
    with pytest.raises(PlantError, match="required"):
        merge_at(spark, path, spark.createDataFrame([("x",)], "description string"), "events", "upsert")
    with pytest.raises(PlantError, match="can not be written"):
        merge_at(spark, path, taken, "nothing", "upsert")
    assert files(path) == before


@pytest.mark.parametrize("dies", ["before the journal", "rename", "delete"])
def test_a_write_that_died(spark, path, dies, monkeypatch):
    source = spark.createDataFrame([(5, "changed"), (250, "changed")], "id long, description string")

    def die(*_):
        raise RuntimeError("died")

    if dies == "before the journal":
        monkeypatch.setattr(store._Folder, "commit", die)
    else:
        monkeypatch.setattr(store._Folder, "finish", die)
    with pytest.raises(RuntimeError):
        merge_at(spark, path, source, "events", "update", now=NOW)
    monkeypatch.undo()
    if dies == "delete":  # the new files are in place already
        folder = next(Path(path).glob("_new-*"))
        for part in [*folder.glob("part-*")]:
            os.replace(part, Path(path) / part.name)
    changed = open_store(spark, path).filter("description = 'changed'").count()
    assert changed == (0 if dies == "before the journal" else 2) and open_store(spark, path).count() == 800
    assert not [*Path(path).glob("_new-*"), *Path(path).glob("_journal*")]
