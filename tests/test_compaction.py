"""Batch folders rewritten into segments under readers and writers."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from shopvitals.streaming import sinks
from shopvitals.streaming.sinks import compact, create_table, last_number_of, read_table, write_batch

SCHEMA = "k bigint, v string"


def put(path, number, rows):
    """A batch folder written without Spark."""
    folder = path / f"batch_id={number}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"k": [k for k, _ in rows], "v": [v for _, v in rows]}), folder / "part-0.parquet")


def held(spark, path, schema):
    return sorted(map(tuple, read_table(spark, str(path), schema).collect()))


@pytest.fixture
def schema(rows):
    return rows([], SCHEMA).schema


def test_five_hundred_batches_are_few_files(spark, schema, tmp_path):
    path, want = tmp_path / "t", []
    create_table(spark, str(path), schema)
    for start in range(0, 500, 100):
        for number in range(start, start + 100):
            put(path, number, [(number, f"v{number}"), (-number, None)])
            want += [(number, f"v{number}"), (-number, None)]
        assert compact(spark, str(path), schema) in (99, 100)
        assert sorted(map(tuple, read_table(spark, str(path), schema).collect()), key=str) == sorted(want, key=str)
    assert compact(spark, str(path), schema) == 0  # nothing new; but what was replaced goes
    table = read_table(spark, str(path), schema)
    assert len(table.inputFiles()) < 20 and table.count() == 1000
    assert len(list(path.glob("batch_id=*"))) == 2  # the empty one and the last
    assert last_number_of(spark, str(path)) == 499
    assert read_table(spark, str(path), schema, before_batch=250).count() == 500


def test_a_retry_during_compaction_loses_nothing(spark, schema, rows, tmp_path, monkeypatch):
    path = tmp_path / "t"
    create_table(spark, str(path), schema)
    for number in range(4):
        put(path, number, [(number, "first")])
    sums = sinks.content_sums

    def meanwhile(frame):  # the last batch is written again, and one more, while the segment is being made
        write_batch(rows([(3, "again")], SCHEMA), str(path), 3)
        write_batch(rows([(4, "new")], SCHEMA), str(path), 4)
        return sums(frame)

    monkeypatch.setattr(sinks, "content_sums", meanwhile)
    assert compact(spark, str(path), schema) == 3
    assert held(spark, path, schema) == [(0, "first"), (1, "first"), (2, "first"), (3, "again"), (4, "new")]


def test_readers_of_the_version_before_are_undisturbed(spark, schema, tmp_path):
    path = tmp_path / "t"
    create_table(spark, str(path), schema)
    for number in range(6):
        put(path, number, [(number, "x")])
    before = read_table(spark, str(path), schema)
    compact(spark, str(path), schema)
    assert before.count() == 6
    between = read_table(spark, str(path), schema)
    put(path, 6, [(6, "x")])
    compact(spark, str(path), schema)
    assert between.count() == 6 and read_table(spark, str(path), schema).count() == 7


def test_a_compaction_that_broke_changes_nothing(spark, schema, tmp_path, monkeypatch):
    path = tmp_path / "t"
    create_table(spark, str(path), schema)
    for number in range(5):
        put(path, number, [(number, "x")])

    def broken(spark, folder):
        raise OSError("disk")

    monkeypatch.setattr(sinks, "_bytes", broken)
    with pytest.raises(OSError):
        compact(spark, str(path), schema)
    monkeypatch.undo()
    assert len(held(spark, path, schema)) == 5
    assert compact(spark, str(path), schema) == 4 and len(held(spark, path, schema)) == 5


def test_segments_stay_few(spark, schema, tmp_path):
    path = tmp_path / "t"
    create_table(spark, str(path), schema)
    for number in range(16):
        put(path, number, [(number, "x")])
        compact(spark, str(path), schema)
        version, segments = sinks._manifest(spark, str(path))
        assert len(segments) <= 5
    assert held(spark, path, schema) == [(n, "x") for n in range(16)]


def test_a_batch_of_the_query_reads_its_own_rows(spark, monkeypatch):
    from registry import queries

    read = []

    def put_batch(frame, path, number):
        read.append("PartitionFilters: [isnotnull(part" in frame._jdf.queryExecution().toString())
        write_batch(frame, path, number)

    monkeypatch.setattr(queries, "write_batch", put_batch)
    queries.QUERIES["compacted_batches"](spark, "/root/testdata/sf0.001")
    assert read == [True] * 9
