"""Tables in hash buckets: what an upsert reads and writes, and what two writers may do."""

from __future__ import annotations

import random
import threading

import pytest
from pyspark.sql import functions as F

from lawloom import schemas, sinks
from lawloom.operators import ContractError
from lawloom.sinks import snapshots

TABLE = schemas.AUTHORS


def people(spark, ids, name="n"):
    return spark.createDataFrame([(i, f"{name}{i}", "P", "SP") for i in ids], TABLE.schema)


def names(spark, root, **kw):
    return {r["id"]: r["full_name"] for r in sinks.read_table(spark, root, TABLE, **kw).collect()}


def all_paths(folders):
    return {name for parts in folders.values() for name in parts}


def read_paths(monkeypatch):
    """Record the folders that merges read."""
    seen, plain = [], snapshots._read

    def read(spark, root, table, folders):
        folders = list(folders)
        seen.extend(folders)
        return plain(spark, root, table, folders)

    monkeypatch.setattr(snapshots, "_read", read)
    return seen


def test_an_update_reads_and_writes_only_the_buckets_of_its_keys(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "db")
    sinks.create_tables(spark, root, [TABLE], buckets=64)
    sinks.upsert(spark, root, TABLE, people(spark, range(500)))
    before = sinks.bucket_folders(spark, root, TABLE)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "db" / "authors").rglob("*.parquet")}

    changed = [3, 77, 123, 311, 1000]  # one per cent of the keys, one of them new
    seen = read_paths(monkeypatch)
    assert sinks.upsert(spark, root, TABLE, people(spark, changed, "new")) == 5
    monkeypatch.undo()
    after = sinks.bucket_folders(spark, root, TABLE)
    touched = {b for b in after if after[b] != before.get(b)}
    bucket = F.pmod(F.xxhash64("id"), F.lit(64))
    assert touched == {r[0] for r in people(spark, changed).select(bucket).collect()} and len(touched) <= 5
    assert set(seen) == {name for b in touched for name in before[b]}
    written = [f for f in (tmp_path / "db" / "authors").rglob("*.parquet") if f not in files]
    assert {f.parent.name for f in written} == {f"_bucket={b}" for b in touched}
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    assert names(spark, root) == {i: f"n{i}" for i in range(500)} | {i: f"new{i}" for i in changed}
    assert names(spark, root, version=1) == {i: f"n{i}" for i in range(500)}


def test_an_ignoring_insert_adds_files_and_rewrites_none(spark, tmp_path):
    root, table = str(tmp_path / "db"), schemas.ENTITIES
    sinks.create_tables(spark, root, [table], buckets=4)
    rows = [(i, "t", f"e{i % 7}") for i in range(60)]
    sinks.upsert(spark, root, table, spark.createDataFrame(rows + rows, table.schema), "ignore")
    before = sinks.bucket_folders(spark, root, table)
    more = rows + [(i, "t", "other") for i in range(3)]
    assert sinks.upsert(spark, root, table, spark.createDataFrame(more, table.schema), "ignore") == 63
    after = sinks.bucket_folders(spark, root, table)
    assert all(after[b][: len(before[b])] == before[b] for b in before)
    got = sorted(tuple(r) for r in sinks.read_table(spark, root, table).collect())
    assert got == sorted({*map(tuple, more)})
    (plan,) = {line for line in _plan(spark, root, table).splitlines() if "ReadSchema" in line}
    assert "entity_type" in plan

    assert sinks.compact(spark, root, table) == sum(len(parts) > 1 for parts in after.values())
    assert all(len(parts) == 1 for parts in sinks.bucket_folders(spark, root, table).values())
    assert sorted(tuple(r) for r in sinks.read_table(spark, root, table).collect()) == got
    assert sinks.compact(spark, root, table) == 0


def _plan(spark, root, table):
    return sinks.read_table(spark, root, table)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("buckets", "by"), [(1, ()), (3, ()), (16, ("id",))])
def test_any_number_of_buckets_is_like_a_dict(spark, tmp_path, buckets, by):
    rng, root, table = random.Random(buckets), str(tmp_path / "db"), schemas.WORD_CLOUD
    sinks.create_tables(spark, root, [table], buckets, by)
    want = {}
    for step in range(4):
        mode = rng.choice(["update", "ignore"])
        batch = {(rng.randint(0, 9), rng.choice("abcd")): step for _ in range(12)}
        want = {**want, **batch} if mode == "update" else {**batch, **want}
        source = spark.createDataFrame([(i, w, n) for (i, w), n in batch.items()], table.schema)
        sinks.upsert(spark, root, table, source, mode)
        if step == 2:
            sinks.compact(spark, root, table, buckets=5)
    assert {(r["id"], r["word"]): r["frequency"] for r in sinks.read_table(spark, root, table).collect()} == want


def test_buckets_are_named_by_key_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.create_tables(spark, str(tmp_path), [TABLE], 4, ("uf",))
    with pytest.raises(ValueError):
        sinks.create_tables(spark, str(tmp_path), [TABLE], 0)
    assert sinks.compact(spark, str(tmp_path), TABLE) == 0


def test_vacuum_drops_buckets_that_no_kept_version_has(spark, tmp_path):
    root = str(tmp_path / "db")
    sinks.create_tables(spark, root, [TABLE], buckets=8)
    sinks.upsert(spark, root, TABLE, people(spark, range(40)))
    for step in range(3):
        sinks.upsert(spark, root, TABLE, people(spark, [5], f"s{step}-"))
    (tmp_path / "db" / "authors" / "data-00000099-lost").mkdir()
    assert sinks.vacuum(spark, root, TABLE, keep=1) == 4  # one bucket of the first write, two updates, the lost one
    assert names(spark, root) == {i: f"n{i}" for i in range(40)} | {5: "s2-5"}
    folders = {str(f.parent.relative_to(tmp_path / "db" / "authors")) for f in (tmp_path / "db").rglob("*.parquet")}
    assert folders == all_paths(sinks.bucket_folders(spark, root, TABLE))


def test_a_version_from_before_buckets_is_read_and_updated(spark, tmp_path):
    root = str(tmp_path / "db")
    people(spark, [1, 2]).write.parquet(f"{root}/authors/data-00000000-old")
    (tmp_path / "db" / "authors" / "_versions").mkdir()
    (tmp_path / "db" / "authors" / "_versions" / "00000000").write_text("data-00000000-old")
    assert names(spark, root) == {1: "n1", 2: "n2"}
    sinks.upsert(spark, root, TABLE, people(spark, [2, 3], "x"))
    assert names(spark, root) == {1: "n1", 2: "x2", 3: "x3"}
    assert sinks.compact(spark, root, TABLE, buckets=4) > 0
    assert names(spark, root) == {1: "n1", 2: "x2", 3: "x3"}


# --- two writers ------------------------------------------------------------------------


@pytest.mark.parametrize("way", ["_link", "_rename"])
def test_an_entry_appears_whole_or_not_at_all(spark, tmp_path, monkeypatch, way):
    monkeypatch.setattr(sinks.CommitLog, "_link", getattr(sinks.CommitLog, way))
    log = sinks.CommitLog(spark, str(tmp_path / "log"))
    assert log.state() == type(log.state())(None, 0)
    log.publish(0, {"a": "é"})
    with pytest.raises(sinks.LostRaceError):
        log.publish(0, {"a": "other"})
    assert log.read(0) == '{"a": "\\u00e9"}' and log.versions() == [0]
    left = [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")]
    assert left == ["00000000"]  # nothing of the loser


def test_a_writer_that_is_about_to_publish_loses_no_row(spark, tmp_path, monkeypatch):
    """A has merged and opened its entry; B merges and publishes; A finishes."""
    root = str(tmp_path / "db")
    sinks.create_tables(spark, root, [TABLE])
    sinks.upsert(spark, root, TABLE, people(spark, [1]))
    appear = sinks.CommitLog._appear

    def late(self, fs, waiting, entry):
        monkeypatch.setattr(sinks.CommitLog, "_appear", appear)
        sinks.upsert(spark, root, TABLE, people(spark, [3]))
        appear(self, fs, waiting, entry)

    monkeypatch.setattr(sinks.CommitLog, "_appear", late)
    with pytest.raises(sinks.LostRaceError):
        sinks.upsert(spark, root, TABLE, people(spark, [2]))
    assert sorted(names(spark, root)) == [1, 3]

    monkeypatch.setattr(sinks.CommitLog, "_appear", late)
    assert sinks.upsert(spark, root, TABLE, people(spark, [2]), attempts=2) == 1
    assert sorted(names(spark, root)) == [1, 2, 3]


@pytest.mark.parametrize("buckets", [1, 4])
def test_writers_at_the_same_time(spark, tmp_path, buckets):
    root = str(tmp_path / "db")
    sinks.create_tables(spark, root, [TABLE], buckets)
    failed = []

    def write(k):
        try:
            sinks.upsert(spark, root, TABLE, people(spark, range(10 * k, 10 * k + 10)), attempts=20)
        except Exception as exc:
            failed.append(exc)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and sorted(names(spark, root)) == list(range(50))
    assert sinks.latest_version(spark, root, TABLE) == 5


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "db")
    sinks.create_tables(spark, root, [TABLE], 2)
    assert sinks.upsert(spark, root, TABLE, people(spark, [1]), batch=("feed", 0)) == 1
    assert sinks.upsert(spark, root, TABLE, people(spark, [1], "late"), batch=("feed", 0)) == 0
    assert sinks.upsert(spark, root, TABLE, people(spark, [2]), batch=("other", 0)) == 1
    assert sinks.upsert(spark, root, TABLE, people(spark, [3]), batch=("feed", 1)) == 1
    sinks.compact(spark, root, TABLE, buckets=3)
    assert sinks.upsert(spark, root, TABLE, people(spark, [9]), batch=("feed", 1)) == 0
    assert names(spark, root) == {1: "n1", 2: "n2", 3: "n3"}


# --- what is moved ----------------------------------------------------------------------


def test_a_first_update_is_written_once(spark, tmp_path, monkeypatch):
    """The rows that were checked are the table's: nothing merges or copies them."""
    root, table = str(tmp_path / "db"), schemas.WORD_CLOUD
    sinks.create_tables(spark, root, [table], buckets=4)
    monkeypatch.setattr(snapshots, "_merge_once", None)
    rows = [(i, w, i) for i in range(50) for w in "abc"]
    assert sinks.upsert(spark, root, table, spark.createDataFrame(rows, table.schema), parts=3) == 150
    assert sorted(map(tuple, sinks.read_table(spark, root, table).collect())) == rows
    assert sinks.upsert(spark, root, schemas.AUTHORS, people(spark, range(9)), attempts=2) == 9
    assert not list((tmp_path / "db").rglob("_staging/*"))


def test_rows_that_no_update_can_meet_are_not_shuffled(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path / "db"), schemas.WORD_CLOUD
    sinks.create_tables(spark, root, [table], buckets=4)
    want = {(i, w): i for i in range(200) for w in "abc"}
    sinks.upsert(spark, root, table, spark.createDataFrame([(*k, n) for k, n in want.items()], table.schema))
    moved, plain = [], snapshots._write

    def write(spark, root, table, version, manifest, rows, in_place=None):
        moved.append((in_place.count(), in_place._jdf.queryExecution().executedPlan().toString()))
        return plain(spark, root, table, version, manifest, rows, in_place)

    monkeypatch.setattr(snapshots, "_write", write)
    new = {(i, w): -1 for i in range(0, 210, 10) for w in "bd"}
    sinks.upsert(spark, root, table, spark.createDataFrame([(*k, n) for k, n in new.items()], table.schema))
    ((kept, plan),) = moved
    assert kept == 540 and "Exchange hashpartitioning" not in plan.replace("\n", " ").split("BroadcastExchange")[0]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    read = lambda: {(r["id"], r["word"]): r["frequency"] for r in sinks.read_table(spark, root, table).collect()}
    assert read() == want | new

    monkeypatch.undo()  # with more values than are sent to all tasks, both sides meet by key
    monkeypatch.setattr(snapshots, "_FEW", 1)
    newer = {(i, "c"): -2 for i in (1, 2, 600)}
    sinks.upsert(spark, root, table, spark.createDataFrame([(*k, n) for k, n in newer.items()], table.schema))
    assert read() == want | new | newer


@pytest.mark.parametrize("buckets", [1, 4])
def test_the_pass_that_writes_finds_broken_rows(spark, tmp_path, buckets):
    root, table = str(tmp_path / "db"), schemas.WORD_CLOUD
    sinks.create_tables(spark, root, [table], buckets)
    rows = [(i % 90, f"w{i % 90}", i) for i in range(100)] + [(None, "x", 1), (None, "x", 2), (5, "y", None)]
    broken = spark.createDataFrame(rows, "id int, word string, frequency int").repartition(7)
    with pytest.raises(ContractError, match="duplicate_key id,word: 11; null id: 2; null frequency: 1$"):
        sinks.upsert(spark, root, table, broken)
    assert sinks.bucket_folders(spark, root, table) == {} and not list((tmp_path / "db").rglob("*.parquet"))
    assert sinks.upsert(spark, root, table, broken.filter("id >= 10 AND frequency IS NOT NULL")) == 80
    assert sinks.upsert(spark, root, table, broken.limit(0)) == 0
