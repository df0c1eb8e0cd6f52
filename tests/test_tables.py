from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lawloom.sinks import snapshots
from lawloom import operators as op
from lawloom import schemas, sinks
from lawloom.operators import ContractError

KV = "id int, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_update_replaces_adds_and_keeps(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep")], KV)
    source = spark.createDataFrame([(1, "new"), (3, "add")], KV)
    once = op.merge_tables(target, source, ["id"])
    assert rows(once) == [(1, "new"), (2, "keep"), (3, "add")]
    assert rows(op.merge_tables(once, source, ["id"])) == rows(once)
    assert rows(op.merge_tables(target, source.limit(0), ["id"])) == rows(target)
    assert rows(op.merge_tables(target.limit(0), source, ["id"])) == rows(source)


def test_ignore_keeps_existing_and_first_of_duplicates(spark):
    target = spark.createDataFrame([(1, "old")], KV)
    source = spark.createDataFrame([(1, "new"), (3, "add"), (3, "add")], KV)
    once = op.merge_tables(target, source, ["id"], "ignore")
    assert rows(once) == [(1, "old"), (3, "add")]
    assert rows(op.merge_tables(once, source, ["id"], "ignore")) == rows(once)
    assert rows(op.new_rows(target, source, ["id"])) == [(3, "add")]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        op.merge_tables(spark.range(1), spark.range(1), ["id"], "replace")


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_merge_like_a_dict(spark, partitions):
    rng = random.Random(partitions)
    old = {(rng.randint(0, 40), rng.choice("abc")): "old" for _ in range(80)}
    new = {(rng.randint(0, 40), rng.choice("abc")): "new" for _ in range(80)}

    def frame(d):
        return spark.createDataFrame([(i, w, v) for (i, w), v in d.items()], "id int, w string, v string").repartition(partitions)

    merged = op.merge_tables(frame(old), frame(new), ["id", "w"])
    assert {(r.id, r.w): r.v for r in merged.collect()} == {**old, **new} and merged.count() == len({**old, **new})
    ignored = op.merge_tables(frame(old), frame(new), ["id", "w"], "ignore")
    assert {(r.id, r.w): r.v for r in ignored.collect()} == {**new, **old}


def test_contract_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, None), (None, "x")], KV)
    got = {(r.check, r.column_name): r.n for r in op.contract_violations(df, ["id", "v"], ["id"]).collect()}
    assert got == {("rows", ""): 5, ("duplicate_key", "id"): 2, ("null", "id"): 1, ("null", "v"): 2}
    empty = {r.check: r.n for r in op.contract_violations(df.limit(0), ["v"], ["id"]).collect()}
    assert empty == {"rows": 0, "duplicate_key": 0, "null": 0}


def test_check_contract_raises(spark):
    table = schemas.TOPICS
    assert op.check_contract(spark.createDataFrame([(1, "a")], "id long, topic string"), table) == 1
    for bad in ([(1, None)], [(None, "a")], [(1, "a"), (1, "b")]):
        with pytest.raises(ContractError):
            op.check_contract(spark.createDataFrame(bad, "id long, topic string"), table)


def test_tables_match_their_contracts():
    assert {t.name: t.keys for t in schemas.TABLES.values()} == {
        "propositions": ("id",),
        "authors": ("id",),
        "proposition_word_cloud": ("id", "word"),
        "proposition_summary": ("id",),
        "proposition_ner": ("id", "entity_type", "entity"),
        "proposition_topics": ("id",),
    }
    assert all(not f.nullable for t in schemas.TABLES.values() for f in t.schema)


def test_upsert_round_trip(spark, tmp_path):
    root, table = str(tmp_path / "db"), schemas.AUTHORS
    sinks.create_tables(spark, root)
    sinks.create_tables(spark, root)
    assert sinks.latest_version(spark, root, table) == 0 and sinks.read_table(spark, root, table).count() == 0

    def people(data):
        return spark.createDataFrame(data, "uf string, id long, full_name string, poli_party string")

    assert sinks.upsert(spark, root, table, people([("SP", 1, "A", "P"), ("RJ", 2, "B", "Q")])) == 2
    assert sinks.upsert(spark, root, table, people([("MG", 2, "B2", "Q"), ("BA", 3, "C", "R")])) == 2
    expected = [(1, "A", "P", "SP"), (2, "B2", "Q", "MG"), (3, "C", "R", "BA")]
    assert rows(sinks.read_table(spark, root, table)) == expected

    version = sinks.latest_version(spark, root, table)
    assert sinks.upsert(spark, root, table, people([("MG", 2, "B", "Q")]).limit(0)) == 0
    for bad in ([("SP", 4, None, "P")], [("SP", 4, "x", "P"), ("SP", 4, "y", "P")], [("SP", 1 << 40, "x", "P")]):
        with pytest.raises(ContractError):
            sinks.upsert(spark, root, table, people(bad))
    assert sinks.latest_version(spark, root, table) == version
    assert rows(sinks.read_table(spark, root, table)) == expected
    assert not list((tmp_path / "db" / "authors" / "_staging").glob("*"))


def test_upsert_without_create_and_ignore_mode(spark, tmp_path):
    root, table = str(tmp_path / "db"), schemas.ENTITIES
    source = spark.createDataFrame([(1, "t", "a"), (1, "t", "a"), (1, "t", "b")], table.schema)
    assert sinks.read_table(spark, root, table).count() == 0
    assert sinks.upsert(spark, root, table, source, "ignore") == 3
    assert sinks.upsert(spark, root, table, source, "ignore") == 3
    assert rows(sinks.read_table(spark, root, table)) == [(1, "t", "a"), (1, "t", "b")]


def test_array_and_timestamp_columns_survive(spark, tmp_path):
    root, table = str(tmp_path / "db"), schemas.PROPOSITIONS
    row = (1, "u", "t", dt.datetime(2025, 3, 1, 10), [3, 1])
    assert sinks.upsert(spark, root, table, spark.createDataFrame([row], table.schema)) == 1
    assert [tuple(r) for r in sinks.read_table(spark, root, table).collect()] == [row]


def _people(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}", "P", "SP") for i in ids], schemas.AUTHORS.schema)


def test_upsert_after_a_failed_write(spark, tmp_path):
    """Neither a leftover folder nor an entry that a writer left empty stops the next call."""
    root, table = str(tmp_path / "db"), schemas.AUTHORS
    sinks.create_tables(spark, root, [table])
    (tmp_path / "db" / "authors" / "data-00000001-x").mkdir()
    (tmp_path / "db" / "authors" / "_versions" / "00000001").touch()
    assert sinks.upsert(spark, root, table, _people(spark, 1)) == 1
    assert sinks.latest_version(spark, root, table) == 2

    failing = _people(spark, 2).withColumn("uf", F.expr("raise_error('half-way')").cast("string"))
    with pytest.raises(Exception, match="half-way"):
        sinks.upsert(spark, root, table, failing)
    assert [r.id for r in sinks.read_table(spark, root, table).collect()] == [1]
    assert sinks.upsert(spark, root, table, _people(spark, 3)) == 1
    assert sorted(r.id for r in sinks.read_table(spark, root, table).collect()) == [1, 3]


def test_the_slower_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path / "db"), schemas.AUTHORS
    sinks.create_tables(spark, root, [table])
    publish = snapshots._publish

    def overtaken(spark, root, table, version, name):
        monkeypatch.setattr(snapshots, "_publish", publish)
        sinks.upsert(spark, root, table, _people(spark, 1))
        publish(spark, root, table, version, name)

    monkeypatch.setattr(snapshots, "_publish", overtaken)
    with pytest.raises(sinks.LostRaceError):
        sinks.upsert(spark, root, table, _people(spark, 2))
    assert [r.id for r in sinks.read_table(spark, root, table).collect()] == [1]
    assert sinks.upsert(spark, root, table, _people(spark, 2)) == 1
    assert sinks.read_table(spark, root, table).count() == 2


def test_vacuum_keeps_the_last_versions(spark, tmp_path):
    root, table = str(tmp_path / "db"), schemas.AUTHORS
    for i in range(4):
        sinks.upsert(spark, root, table, _people(spark, i))
    (tmp_path / "db" / "authors" / "data-00000009-lost").mkdir()
    assert sinks.vacuum(spark, root, table, keep=2) == 3
    assert sinks.read_table(spark, root, table).count() == 4
    assert len(list((tmp_path / "db" / "authors").glob("data-*"))) == 2
    sinks.upsert(spark, root, table, _people(spark, 9))
    assert sinks.read_table(spark, root, table).count() == 5


class Session:
    """Just the two things that are asked of a session."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = settings


def test_shared_dir_follows_the_session():
    assert sinks.shared_dir(Session("yarn", {"spark.checkpoint.dir": "hdfs://x/shared/"})) == "hdfs://x/shared"
    assert sinks.shared_dir(Session("local[4]", {})) == sinks.shared_dir(Session("local[4]", {}))
    with pytest.raises(RuntimeError):
        sinks.shared_dir(Session("yarn", {}))
