"""Result tables as versions of hash buckets in Parquet.

A table's rows are dealt to buckets by a hash of key columns. A version is an entry of
the log in `_versions`: it lists the data folders of every bucket. An upsert reads and
writes the buckets of its keys only, into a folder of its own, and publishes an entry
that names this folder for those buckets and the folders of the version before for all
others. A writer that fails, or loses the race for the next version, leaves a data
folder that nobody reads; `vacuum` removes those.

How many buckets: so that one of them holds about a gigabyte. An update then costs the
buckets it touches, and an ignoring insert the keys of these buckets and its new rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any, Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.operators.contracts import conform, watch_contract, watched_contract
from lawloom.operators.merge import merge_tables, new_rows
from lawloom.schemas import TABLES, Table
from lawloom.sinks.commits import CommitLog, LostRaceError, hadoop_path

__all__ = [
    "LostRaceError",
    "bucket_folders",
    "compact",
    "create_tables",
    "latest_version",
    "read_table",
    "upsert",
    "vacuum",
]

_BUCKET, _SLICE = "_bucket", "_slice"
#: Slices of a bucket if nobody says in how many parts the rows come.
_SLICES = 16
#: So many values of the leading key column are sent to all tasks at most.
_FEW = 1 << 18
#: Files that a task may hold open; with more buckets it sorts.
_OPEN_FILES = 64


@dataclass(frozen=True)
class Manifest:
    """A version: the folders of each bucket, relative to the table's, and the last batch of each named writer."""

    buckets: int = 1
    bucket_by: tuple[str, ...] = ()
    folders: dict[int, tuple[str, ...]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str) -> Manifest:
        if not text.startswith("{"):  # a version of one bucket, written before there were several
            return cls(folders={0: (text,)})
        read = json.loads(text)
        folders = {int(b): tuple(parts) for b, parts in read["folders"].items()}
        return cls(read["buckets"], tuple(read["bucket_by"]), folders, read["batches"])

    def content(self) -> dict[str, Any]:
        return {"buckets": self.buckets, "bucket_by": self.bucket_by, "folders": self.folders, "batches": self.batches}

    def bucket(self, table: Table) -> Column:
        return F.pmod(F.xxhash64(*(self.bucket_by or table.keys)), F.lit(self.buckets)).cast("int")


def _log(spark: SparkSession, root: str, table: Table) -> CommitLog:
    return CommitLog(spark, f"{root}/{table.name}/_versions")


def _manifest(log: CommitLog, version: int | None) -> Manifest | None:
    return None if version is None else Manifest.parse(log.read(version))


def _publish(spark: SparkSession, root: str, table: Table, version: int, manifest: Manifest) -> None:
    _log(spark, root, table).publish(version, manifest.content())


def latest_version(spark: SparkSession, root: str, table: Table) -> int | None:
    return _log(spark, root, table).state().latest


def bucket_folders(spark: SparkSession, root: str, table: Table, version: int | None = None) -> dict[int, tuple[str, ...]]:
    """The folders, relative to the table's, that hold each bucket in a version (the latest, if none is given)."""
    log = _log(spark, root, table)
    manifest = _manifest(log, log.state().latest if version is None else version)
    return manifest.folders if manifest else {}


def _read(spark: SparkSession, root: str, table: Table, folders: Iterable[str]) -> DataFrame:
    paths = [f"{root}/{table.name}/{name}" for name in folders]
    if not paths:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(*paths)


def read_table(spark: SparkSession, root: str, table: Table, version: int | None = None) -> DataFrame:
    """Rows of a table, of the latest version if none is given; no rows when it was never written."""
    folders = bucket_folders(spark, root, table, version)
    return _read(spark, root, table, [name for parts in folders.values() for name in parts])


def create_tables(
    spark: SparkSession,
    root: str,
    tables: Iterable[Table] = tuple(TABLES.values()),
    buckets: int = 1,
    bucket_by: Sequence[str] = (),
) -> None:
    """Publish an empty first version of every table that does not exist.

    `bucket_by` are the key columns that name the bucket, all of the key if none are
    given: with the leading one, rows that come together lie together, but a value with
    very many rows makes a large bucket.
    """
    if buckets < 1:
        raise ValueError("a table has one bucket at least")
    for table in tables:
        if not set(bucket_by) <= set(table.keys):
            raise ValueError(f"{table.name}: buckets are named by key columns")
        log = _log(spark, root, table)
        state = log.state()
        if state.latest is None:
            _publish(spark, root, table, state.following, Manifest(buckets, tuple(bucket_by)))


def _data_folder(version: int) -> str:
    return f"data-{version:08d}-{uuid.uuid4().hex}"


def _write(
    spark: SparkSession, root: str, table: Table, version: int, manifest: Manifest, rows: DataFrame, in_place: DataFrame | None = None
) -> dict[int, str]:
    """Write rows into a data folder of their own; the folder of each bucket that has rows.

    in_place: rows that come from the files of their buckets and are not shuffled.
    """
    name = _data_folder(version)
    path = f"{root}/{table.name}/{name}"
    if manifest.buckets == 1:
        (rows if in_place is None else rows.unionByName(in_place)).write.parquet(path)
        return {0: name}
    # Rebalanced, a small bucket is one file and a large one is split into several.
    dealt = rows.withColumn(_BUCKET, manifest.bucket(table)).hint("rebalance", F.col(_BUCKET))
    if in_place is None:
        dealt.write.partitionBy(_BUCKET).parquet(path)
    else:
        dealt = dealt.unionByName(in_place.withColumn(_BUCKET, manifest.bucket(table)))
        _write_unsorted(dealt, path)
    return _written(spark, root, table, name)


def _write_unsorted(rows: DataFrame, path: str) -> None:
    """Write rows by bucket with several files of a task open, so that it need not sort what it reads."""
    conf, name = rows.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    ours = conf.get(name) == "0"
    if ours:
        conf.set(name, _OPEN_FILES)
    try:
        rows.write.partitionBy(_BUCKET).parquet(path)
    finally:
        if ours:
            conf.set(name, 0)


def _written(spark: SparkSession, root: str, table: Table, name: str) -> dict[int, str]:
    fs, folder = hadoop_path(spark, f"{root}/{table.name}/{name}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return {int(n.split("=")[1]): f"{name}/{n}" for n in names if n.startswith(f"{_BUCKET}=")}


def _write_checked(
    spark: SparkSession, root: str, table: Table, manifest: Manifest, source: DataFrame, name: str, unique_keys: bool, parts: int | None
) -> tuple[int, dict[int, str]]:
    """Write the source and check its contract in the same pass; its rows, and the folders that were written, by bucket.

    Where keys are unique, a bucket's rows are dealt out by slices of their keys' hashes, so
    equal keys meet and a file has one bucket. `parts` are for four slices each.
    """
    path = f"{root}/{table.name}/{name}"
    if not unique_keys:
        watched, watch = watch_contract(conform(source, table), table, (), False)
        watched.write.parquet(path)
        return watched_contract(watch, table), {0: name}
    slices = (_SLICES if manifest.buckets > 1 else 64 * _SLICES) if parts is None else -(-4 * parts // manifest.buckets)
    again = F.pmod(F.xxhash64(F.lit("slice"), *table.keys), F.lit(slices)).cast("int")
    dealt = conform(source, table).withColumn(_BUCKET, manifest.bucket(table)).withColumn(_SLICE, again)
    dealt = dealt.repartition(*([] if parts is None else [parts]), _BUCKET, _SLICE)
    watched, watch = watch_contract(dealt, table, (_BUCKET, _SLICE))
    if manifest.buckets == 1:
        watched.drop(_BUCKET, _SLICE).write.parquet(path)
        return watched_contract(watch, table), {0: name}
    watched.drop(_SLICE).write.partitionBy(_BUCKET).parquet(path)
    return watched_contract(watch, table), _written(spark, root, table, name)


def _merge_once(
    spark: SparkSession, root: str, table: Table, staged: DataFrame, mode: str, batch: tuple[str, int] | None
) -> bool:
    """Merge staged rows into the version that is the latest now; False if the batch is in it already."""
    log = _log(spark, root, table)
    state = log.state()
    manifest = _manifest(log, state.latest) or Manifest()
    if batch and manifest.batches.get(batch[0], -1) >= batch[1]:
        return False
    touched = {0}
    if manifest.buckets > 1:
        found = staged.select(manifest.bucket(table).alias("b")).distinct()
        touched = {r["b"] for r in found.collect()}  # no more rows than buckets
    old = [name for b in sorted(touched) for name in manifest.folders.get(b, ())]
    target = _read(spark, root, table, old)
    adds = mode == "ignore" and manifest.buckets > 1
    in_place = None
    if adds:
        rows = new_rows(target, staged, table.keys)
    else:
        if old and mode == "update" and len(table.keys) > 1:
            target, in_place = _met(target, staged, table.keys[0])
        rows = merge_tables(target, staged, table.keys, mode)
    written = _write(spark, root, table, state.following, manifest, rows, in_place)
    kept = {b: manifest.folders.get(b, ()) if adds else () for b in written}
    folders = manifest.folders | {b: (*kept[b], name) for b, name in written.items()}
    batches = manifest.batches | ({batch[0]: batch[1]} if batch else {})
    _publish(spark, root, table, state.following, Manifest(manifest.buckets, manifest.bucket_by, folders, batches))
    return True


def _met(target: DataFrame, staged: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the target with a leading key value of the staged rows, and the others, if such values are few.

    The others are in no merge and stay in their buckets, so they are not shuffled.
    """
    values = staged.select(key).distinct()
    if values.limit(_FEW + 1).count() > _FEW:
        return target, None
    values = F.broadcast(values)
    return (target.join(values, key, how).select(*target.columns) for how in ("left_semi", "left_anti"))


def upsert(
    spark: SparkSession,
    root: str,
    table: Table,
    source: DataFrame,
    mode: Literal["update", "ignore"] = "update",
    attempts: int = 1,
    batch: tuple[str, int] | None = None,
    parts: int | None = None,
) -> int:
    """Merge `source` into the table, all or nothing; returns the number of source rows.

    The source is computed once, dealt to buckets and checked on the way, into a staging
    folder that the merge reads; an update of an empty table is the table's first data
    folder at once. `parts`: to how many parts a very large source is dealt. No source
    rows: nothing is written. If another
    writer was faster, the merge is done again on its version, up to `attempts` times in
    all; then LostRaceError is raised and the call can be repeated. `batch` is a writer's
    name and the number of its batch: a number up to the last one merged under that name
    changes nothing, and 0 is returned.
    """
    log = _log(spark, root, table)
    state = log.state()
    manifest = _manifest(log, state.latest) or Manifest()
    first = mode == "update" and not manifest.folders and not manifest.batches
    name = _data_folder(state.following) if first else f"_staging/{uuid.uuid4().hex}"
    fs, path = hadoop_path(spark, f"{root}/{table.name}/{name}")
    published = False
    try:
        rows, written = _write_checked(spark, root, table, manifest, source, name, mode == "update", parts)
        if not rows:
            return 0
        staged = spark.read.schema(table.schema).parquet(*[f"{root}/{table.name}/{folder}" for folder in written.values()])
        for attempt in range(attempts):
            try:
                if first and attempt == 0:
                    folders = {b: (folder,) for b, folder in written.items()}
                    batches = {batch[0]: batch[1]} if batch else {}
                    _publish(spark, root, table, state.following, Manifest(manifest.buckets, manifest.bucket_by, folders, batches))
                    published = True
                    return rows
                return rows if _merge_once(spark, root, table, staged, mode, batch) else 0
            except LostRaceError:
                if attempt + 1 == attempts:
                    raise
        return rows
    finally:
        if not published:
            fs.delete(path, True)


def compact(spark: SparkSession, root: str, table: Table, buckets: int | None = None) -> int:
    """Write every bucket of several folders as one; with `buckets`, deal all rows to that many buckets.

    Returns the number of buckets written; the rows stay as they are.
    """
    log = _log(spark, root, table)
    state = log.state()
    manifest = _manifest(log, state.latest)
    if manifest is None:
        return 0
    if buckets in (None, manifest.buckets):
        changed = {b: parts for b, parts in manifest.folders.items() if len(parts) > 1}
        after = manifest
    else:
        changed, after = manifest.folders, Manifest(buckets, manifest.bucket_by, {}, manifest.batches)
    if not changed and after is manifest:
        return 0
    rows = _read(spark, root, table, [name for parts in changed.values() for name in parts])
    written = _write(spark, root, table, state.following, after, rows)
    folders = after.folders | {b: (name,) for b, name in written.items()}
    _publish(spark, root, table, state.following, Manifest(after.buckets, after.bucket_by, folders, after.batches))
    return len(written)


def vacuum(spark: SparkSession, root: str, table: Table, keep: int = 2) -> int:
    """Delete the data that is in none of the last `keep` versions, and of failed attempts; returns the number of folders.

    Run it while nobody writes the table or reads an older version of it.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    log = _log(spark, root, table)
    last = log.versions()[-keep:]
    kept = {name for v in last for parts in Manifest.parse(log.read(v)).folders.values() for name in parts}
    log.forget(set(log.entries()) - set(last))
    fs, base = hadoop_path(spark, f"{root}/{table.name}")
    gone = []
    for status in fs.listStatus(base) if fs.exists(base) else []:
        name = status.getPath().getName()
        if not name.startswith("data-") or name in kept:
            continue
        inner = [s.getPath() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith(f"{_BUCKET}=")]
        unused = [p for p in inner if f"{name}/{p.getName()}" not in kept]
        gone += unused if len(unused) < len(inner) else [status.getPath()]
    for path in gone:
        fs.delete(path, True)
    return len(gone)
