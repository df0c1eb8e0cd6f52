"""Large JSON files with one array under a root key, read by many tasks.

Spark cuts a text file into blocks by byte range, and a block into pieces that end with
a closing brace. The first pass finds, for every block, how deep it leads and whether it
ends inside a string, for both states it may start in; one row for each block is enough
to know the state at every block's start. The second pass then takes the objects of the
root array out of each block. Objects that lie across blocks come as fragments, at most
two for each block, and are put together by a grouping.

What the driver holds is a few short rows for each block (`spark.sql.files.maxPartitionBytes`).
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.sinks.files import shared_dir

_TOKEN = re.compile(r'"([^"\\]*(?:\\.[^"\\]*)*)("?)|[{\[\],]', re.DOTALL)
_REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*("?)', re.DOTALL)
_ROWS = 2000
_WHOLE, _OPEN, _MIDDLE, _CLOSE, _ARRAY, _STATE = "whole", "open", "middle", "close", "array", "state"


def _tokens(piece: str, in_string: bool) -> Iterator[tuple[str, int]]:
    """Brackets, commas and strings of a piece and where they start; 'open' if it ends inside a string."""
    at = 0
    if in_string:
        rest = _REST_OF_STRING.match(piece)
        if not rest[1]:
            yield "open", 0
            return
        at = rest.end()
    for m in _TOKEN.finditer(piece, at):
        if m[0][0] != '"':
            yield m[0], m.start()
        elif m[2]:
            yield m[0], m.start()
        else:
            yield "open", m.start()


def _after(piece: str, in_string: bool, depth: int) -> tuple[bool, int]:
    """State after a piece and the brace that follows it."""
    for token, _ in _tokens(piece, in_string):
        if token == "open":
            return True, depth
        if token in "{[":
            depth += 1
        elif token == "]":
            depth -= 1
    return False, depth - 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    """((file, block start), piece) in the order of the file."""
    for batch in batches:
        yield from zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2).to_pylist())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: for a start outside and one inside a string, the state at the end, with depths from 0."""
    ends: dict[tuple[str, int], list[tuple[bool, int]]] = {}
    for block, piece in _blocks(batches):
        states = ends.setdefault(block, [(False, 0), (True, 0)])
        ends[block] = [_after(piece, *state) for state in states]
    columns = [[b[0] for b in ends], [b[1] for b in ends]]
    columns += [[states[k][part] for states in ends.values()] for k in (0, 1) for part in (0, 1)]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
    names = ["src_file", "block", "out_in_string", "out_depth", "in_in_string", "in_depth"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_SUMMARY = "src_file string, block long, out_in_string boolean, out_depth long, in_in_string boolean, in_depth long"


def _start_states(rows: Sequence) -> dict[tuple[str, int], tuple[bool, int]]:
    """State at the start of every block; an error for a file that does not end where its root object does."""
    starts, state, file = {}, (False, 0), None

    def close() -> None:
        # the last piece is taken to have a brace after it, also where the file ends with white space
        if file is not None and (state[0] or state[1] not in (0, -1)):
            raise ValueError(f"malformed JSON: {file}")

    for row in sorted(rows, key=lambda r: (r["src_file"], r["block"])):
        if row["src_file"] != file:
            close()
            file, state = row["src_file"], (False, 0)
        starts[row["src_file"], row["block"]] = state
        ended, deeper = (row["in_in_string"], row["in_depth"]) if state[0] else (row["out_in_string"], row["out_depth"])
        state = (ended, state[1] + deeper)
    close()
    return starts


@dataclass
class _Reader:
    """Takes objects out of one block. Depth 1 is in the root object, 2 in an array or object under a key of it."""

    in_string: bool
    depth: int
    rows: list[tuple[str, str | None, int, str | None]] = field(default_factory=list)  # kind, key, pos, text
    key: str | None = None  # of the array that is open; None: it was opened in an earlier block
    known: bool = False  # a value under a key of the root object began or ended in this block
    is_array: bool = True
    pos: int = 0
    text: list[str] | None = None  # of the object that is open
    last_string: str = ""

    def __post_init__(self) -> None:
        self.carried = self.depth >= 3  # the block starts inside an element of an earlier block
        if self.carried:
            self.text = []

    def read(self, piece: str) -> None:
        begin = 0  # of the open object's text in this piece
        ended_in_string = False
        for token, at in _tokens(piece, self.in_string):
            if token == "open":
                ended_in_string = True
            elif token in ("{", "["):
                if self.depth == 1:
                    self.known, self.is_array, self.key, self.pos = True, token == "[", self.last_string, 0
                    if self.is_array:
                        self.rows.append((_ARRAY, self.key, 0, None))
                elif self.depth == 2 and token == "{" and self.is_array:
                    self.text, begin = [], at
                self.depth += 1
            elif token == "]":
                self.depth -= 1
                self._closed(piece[begin : at + 1])
            elif token == ",":
                if self.depth == 2:
                    self.pos += 1
            elif self.depth == 1:
                self.last_string = token[1:-1]
        self.in_string = ended_in_string
        if self.text is not None:
            self.text.append(piece[begin:] + "}")
        if not ended_in_string:
            self.depth -= 1
            self._closed("")

    def _closed(self, rest: str) -> None:
        if self.depth == 2 and self.text is not None:
            if self.carried:  # an element that is an array may end before the piece does
                self.rows.append((_CLOSE, None, 0, "".join(self.text) + rest))
            else:
                self.rows.append((_WHOLE, self.key if self.known else None, self.pos, "".join(self.text)))
            self.text, self.carried = None, False
        elif self.depth <= 1:
            self.known, self.is_array = True, False

    def end(self) -> list[tuple[str, str | None, int, str | None]]:
        if self.text is not None:
            kind = _MIDDLE if self.carried else _OPEN
            self.rows.append((kind, self.key if self.known else None, self.pos, "".join(self.text)))
        state = None if not self.known else self.key if self.is_array and self.depth >= 2 else ""
        self.rows.append((_STATE, state, self.pos, "known" if self.known else None))
        return self.rows


_FOUND = "src_file string, block long, kind string, key string, pos long, text string"


def _find(starts: dict[tuple[str, int], tuple[bool, int]]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(block, rows):
            columns = [[block[0]] * len(rows), [block[1]] * len(rows), *map(list, zip(*rows))]
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            names = ["src_file", "block", "kind", "key", "pos", "text"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        current, reader = None, None
        for block, piece in _blocks(batches):
            if block != current:
                if reader:
                    yield batch(current, reader.end())
                current, reader = block, _Reader(*starts[block])
                if not block[1]:
                    piece = piece.removeprefix("\ufeff")
            reader.read(piece)
            if len(reader.rows) >= _ROWS:
                yield batch(current, reader.rows)
                reader.rows = []
        if reader:
            yield batch(current, reader.end())

    return find


def _carried(rows: Sequence) -> tuple[list[tuple], dict[str, set[str]]]:
    """(file, block, key carried into it, elements before it, block where its first fragment's element began); root arrays by file."""
    arrays: dict[str, set[str]] = defaultdict(set)
    by_block: dict[tuple[str, int], dict[str, object]] = defaultdict(dict)
    for r in rows:
        if r["kind"] == _ARRAY:
            arrays[r["src_file"]].add(r["key"])
        else:
            by_block[r["src_file"], r["block"]][r["kind"]] = r
    out, file, key, base, began = [], None, "", 0, None
    for (name, block), kinds in sorted(by_block.items()):
        if name != file:
            file, key, base, began = name, "", 0, None
        out.append((name, block, key, base, began))
        if _OPEN in kinds:
            began = block
        state = kinds[_STATE]
        if state["text"]:
            key, base = state["key"], state["pos"]
        else:
            base += state["pos"]
    return out, arrays


def read_split_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    roots: Sequence[str] = ("dados",),
    require_root: bool = False,
) -> DataFrame:
    """Rows of `read_root_json`, of files of any size: the tasks share the blocks of a file.

    The objects found are written to the shared folder; the caller may delete the folder
    named by `lawloom_folder` of the result when its rows are not needed any more. A
    malformed file is an error, except that the last brace may be missing. Of several
    arrays under one root key, all are read.
    """
    pieces = spark.read.option("lineSep", "}").text(path)
    pieces = pieces.select(F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("block"), "value")
    starts = _start_states(pieces.mapInArrow(_summaries, _SUMMARY).collect())
    folder = f"{shared_dir(spark)}/objects-{uuid.uuid4().hex}"
    pieces.mapInArrow(_find(starts), _FOUND).write.partitionBy("kind").parquet(folder)
    found = spark.read.schema(_FOUND).parquet(folder)

    about_blocks = found.filter(F.col("kind").isin(_STATE, _ARRAY, _OPEN)).select(
        "src_file", "block", "kind", "key", "pos", F.when(F.col("kind") == _STATE, F.col("text")).alias("text")
    )
    carried, arrays = _carried(about_blocks.collect())
    if require_root and any(not set(roots) & arrays[name] for name in {block[0] for block in starts}):
        raise ValueError("JSON document has none of the expected root keys")
    wanted = [(name, root) for name, keys in arrays.items() for root in roots if root in keys and not set(roots[: roots.index(root)]) & keys]

    # Not more rows than blocks, and files
    blocks = F.broadcast(spark.createDataFrame(carried, "src_file string, block long, carried_key string, base long, began long"))
    chosen = F.broadcast(spark.createDataFrame(wanted, "src_file string, found_key string"))
    placed = found.join(blocks, ["src_file", "block"]).select(
        "src_file", "block", "kind", "began", "text",
        F.coalesce("key", "carried_key").alias("found_key"),
        (F.col("pos") + F.when(F.col("key").isNull(), F.col("base")).otherwise(0)).alias("src_pos"),
    )
    whole = placed.filter(F.col("kind") == _WHOLE).select("src_file", "found_key", "src_pos", "text")
    parts = placed.filter(F.col("kind").isin(_OPEN, _MIDDLE, _CLOSE)).withColumn(
        "first", F.when(F.col("kind") == _OPEN, F.col("block")).otherwise(F.col("began"))
    )
    joined = (
        parts.filter("first IS NOT NULL")
        .groupBy("src_file", "first")
        .agg(
            F.first(F.when(F.col("kind") == _OPEN, F.struct("found_key", "src_pos")), ignorenulls=True).alias("element"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "").alias("text"),
        )
        .select("src_file", "element.found_key", "element.src_pos", "text")
    )
    elements = whole.unionByName(joined).join(chosen, ["src_file", "found_key"], "left_semi")
    row = F.from_json(F.to_json(F.parse_json("text")), schema)
    out = elements.select("src_file", F.col("src_pos").cast("int").alias("src_pos"), row.alias("_row")).select("src_file", "src_pos", "_row.*")
    out.lawloom_folder = folder
    return out
