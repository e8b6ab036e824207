"""Tables in versions: what a change rewrites, what a reader sees, what loads once."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from curate.operators import changes
from curate.plans import catalogue as cat
from curate.registry.derived import derived
from curate.sinks import discard, owned, stored
from curate.sinks.versions import VersionedTable

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def rows_of(table, version=None):
    return sorted(map(tuple, table.read(version).collect()), key=str)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "k", buckets=8)


def data_files(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("part-*")}


def test_upserts_replace_insert_and_add_keyless_rows(spark, table):
    assert rows_of(table) == []
    table.upsert(frame(spark, (1, "a"), (2, "b"), (None, "x")))
    table.upsert(frame(spark, (2, "c"), (3, "d"), (None, "x")))
    assert rows_of(table) == [(1, "a"), (2, "c"), (3, "d"), (None, "x"), (None, "x")]
    assert rows_of(table, 1) == [(1, "a"), (2, "b"), (None, "x")]
    with pytest.raises(ValueError):
        table.read(9)


def test_only_touched_buckets_are_written(spark, table, tmp_path):
    table.upsert(frame(spark, *((i, "a") for i in range(400))))
    before = data_files(tmp_path)
    folders = table.manifest()["folders"]
    assert len([f for f in folders if f]) == 8
    table.upsert(frame(spark, (5, "new")))
    after = data_files(tmp_path)
    changed = [a != b for a, b in zip(folders, table.manifest()["folders"], strict=True)]
    assert sum(changed) == 1 and all(after[p] == t for p, t in before.items())
    assert len(after) - len(before) == 1
    assert len(rows_of(table)) == 400 and (5, "new") in rows_of(table)


def test_a_run_that_stops_before_the_swap_leaves_the_old_table(spark, table, tmp_path, monkeypatch):
    table.upsert(frame(spark, (1, "a")))

    def stop(self, row):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_commit", stop)
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, (1, "b"), (2, "c")))
    assert len(data_files(tmp_path)) > 1
    assert rows_of(VersionedTable(spark, table.path)) == [(1, "a")]
    table.upsert(frame(spark, (1, "b"), (2, "c")))
    assert rows_of(table) == [(1, "b"), (2, "c")]


def test_a_batch_counts_once(spark, table):
    assert table.upsert(frame(spark, (None, "x")), "one")
    assert not table.upsert(frame(spark, (None, "x")), "one")
    assert rows_of(table) == [(None, "x")]


def test_two_writers_of_one_version_are_found(spark, table):
    now = table.manifest()
    table.upsert(frame(spark, (1, "a")))
    table._commit((1, now["schema"], "k", now["folders"], [], [], None))
    with pytest.raises(RuntimeError, match="two writers"):
        table.read()


@pytest.mark.parametrize("most", [1, 10_000])
def test_files_load_once(spark, table, tmp_path, most):
    landed = str(tmp_path / "landed")
    frame(spark, (1, "a"), (None, "x")).coalesce(1).write.mode("append").parquet(landed)
    assert table.load_files(landed, SCHEMA, max_files=most) == 1
    assert table.load_files(landed, SCHEMA, max_files=most) == 0
    frame(spark, (1, "b"), (None, "x")).repartition(2).write.mode("append").parquet(landed)
    assert table.load_files(landed, SCHEMA, max_files=most) >= 1
    assert rows_of(table) == [(1, "b"), (None, "x"), (None, "x")]
    assert table.load_files(landed, SCHEMA, max_files=most) == 0


def test_vacuum_keeps_what_the_newest_version_reads(spark, table, tmp_path):
    for value in "abc":
        table.upsert(frame(spark, (1, value), (None, value)))
    before = len(data_files(tmp_path))
    assert table.vacuum() == 2
    assert len(data_files(tmp_path)) < before
    assert rows_of(table) == [(1, "c"), (None, "a"), (None, "b"), (None, "c")]


def test_an_unknown_key_and_a_second_create(spark, table):
    with pytest.raises(ValueError):
        VersionedTable.create(spark, table.path + "2", SCHEMA, "nokey")
    table.upsert(frame(spark, (1, "a")))
    again = VersionedTable.create(spark, table.path, SCHEMA, "k", buckets=3)
    assert rows_of(again) == [(1, "a")] and len(again.manifest()["folders"]) == 8


def test_the_catalogue_is_refreshed_from_new_raw_files_only(spark, tmp_path, monkeypatch):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "curated")
    whole = derived(spark, "/root/testdata/sf0.001", "catalogue")
    first, second = whole.randomSplit([0.5, 0.5], seed=1)
    seen = []
    monkeypatch.setattr("curate.sinks.versions.upsert", lambda a, b, k: seen.append(a.count()) or changes.upsert(a, b, k))
    first.write.parquet(raw)
    assert cat.refresh(spark, raw, path) > 0
    second.write.mode("append").parquet(raw)
    assert cat.refresh(spark, raw, path) > 0
    assert cat.refresh(spark, raw, path) == 0
    keys = {r[0] for r in cat.records(whole).select(cat.KEY).collect()} - {None}
    held = [r[0] for r in VersionedTable(spark, path).read().select(cat.KEY).collect()]
    assert {k for k in held if k is not None} == keys
    assert len([k for k in held if k is not None]) == len(keys) and len(seen) == 2


def test_stored_tables_are_deleted_by_their_owner(spark):
    with owned() as folders:
        one = stored(spark.range(3), "one")
        two = stored(one, "two")
    three = stored(two, "three")
    assert folders == [one.stored_in, two.stored_in]
    discard(one)
    assert two.count() == three.count() == 3
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(f"{one.stored_in}/one").count()
    with pytest.raises(AnalysisException):
        VersionedTable(spark, one.stored_in).read()
