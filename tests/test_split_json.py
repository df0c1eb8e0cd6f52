"""Files cut into many blocks read like whole ones."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import types as T

from lawloom import plans, schemas, sources
from lawloom.schemas import RAW_AUTHOR

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("nome", T.StringType()),
        T.StructField("lista", T.ArrayType(T.LongType())),
        T.StructField("outro", T.StringType()),
    ]
)


@pytest.fixture
def blocks(spark):
    """Cut files into blocks of about so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield cut
    for n, v in before.items():
        spark.conf.set(n, v)


def texts(rng):
    return "".join(rng.choice(['a', "é", "}", "{", "[", "]", ",", '"', "\\", "\\\\", "\n", ":", "}}", "中", '\\"', " "]) for _ in range(rng.randint(0, 12)))


def element(rng):
    kind = rng.randrange(12)
    if kind == 0:
        return rng.choice([5, None, "s", '{"id": 7}', "}", [1, {"id": 2}], [[{"id": 1}], []], True, 1.5, []])
    out = {"id": rng.randrange(1000), "nome": texts(rng)}
    if kind < 4:
        out["outro"] = {"a": [{"b": texts(rng)}, {}], texts(rng): {"c": []}}
    if kind % 3 == 0:
        out["lista"] = [rng.randrange(9) for _ in range(rng.randrange(4))]
    return out


def document(rng):
    values = {"dados": [element(rng) for _ in range(rng.choice([0, 1, 3, 40]))]}
    others = [("links", [{"id": 1}, {"id": 2}]), ("meta", {"a": {"id": 3}, "b": [{"id": 4}], "c": {"dados": [{"id": 5}]}}), ("n", 1), ("proposicoes", [{"id": 6}])]
    chosen = rng.sample(others, rng.randint(0, len(others)))
    items = chosen + [("dados", values["dados"])] if rng.random() < 0.9 else chosen
    rng.shuffle(items)
    return dict(items)


def rows(df):
    return sorted((tuple(map(repr, r)) for r in df.collect()))


@pytest.mark.parametrize(("size", "files"), [(60, 2), (400, 6), (1 << 20, 12)])
def test_like_the_whole_file_reader(spark, tmp_path, blocks, size, files):
    rng = random.Random(size)
    for i in range(files):
        indent, ascii_only = rng.choice([None, 1]), rng.random() < 0.5
        text = json.dumps(document(rng), indent=indent, ensure_ascii=ascii_only) + rng.choice(["", "\n", " \n\n"])
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    blocks(size)
    for roots in (("dados",), ("proposicoes", "dados"))[-1 if size < 1000 else 0 :]:
        want = rows(sources.read_root_json(spark, str(tmp_path), SCHEMA, roots))
        got = sources.read_split_json(spark, str(tmp_path), SCHEMA, roots)
        assert got.columns == ["src_file", "src_pos", *SCHEMA.names] and rows(got) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path, blocks):
    people = [{"idProposicao": i, "nomeAutor": "x" * (i % 50)} for i in range(4_000)]
    people[777]["nomeAutor"] = "y}" * 20_000  # longer than a block
    (tmp_path / "a.json").write_text(json.dumps({"dados": people}))
    blocks(15_000)
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert pieces.rdd.getNumPartitions() > 10
    got = sources.read_split_json(spark, str(tmp_path), RAW_AUTHOR)
    assert rows(got) == rows(sources.read_root_json(spark, str(tmp_path), RAW_AUTHOR)) and got.count() == 4_000


@pytest.mark.parametrize("text", ['{"dados": [{"id": 1},', '{"dados": [{"id": 1}', '{"dados": [{"id": "1]}', '{"dados": [{"id": 1]}}}'])
def test_a_malformed_file_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        sources.read_split_json(spark, str(tmp_path), SCHEMA).collect()


def test_roots(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"other": [{"id": 1}]}')
    assert sources.read_split_json(spark, str(tmp_path), SCHEMA).count() == 0
    with pytest.raises(ValueError):
        sources.read_split_json(spark, str(tmp_path), SCHEMA, require_root=True)
    (tmp_path / "a.json").write_bytes(b'\xef\xbb\xbf{"dados": [{"id": 1}], "x": {}}')
    assert [r.id for r in sources.read_split_json(spark, str(tmp_path), SCHEMA, require_root=True).collect()] == [1]


def test_prepare_files_by_blocks(spark, tmp_path, blocks):
    bills = [{"id": i, "siglaTipo": ("PL", "REQ")[i % 2], "dataApresentacao": "2025-03-01", "urlInteiroTeor": "}" * (i % 9)} for i in range(60)]
    people = [{"idProposicao": i % 60, "idDeputadoAutor": i, "nomeAutor": f"n{i}"} for i in range(1, 150)]
    (tmp_path / "b.json").write_text(json.dumps({"dados": bills}))
    (tmp_path / "a.json").write_text(json.dumps({"dados": people}))
    blocks(1500)
    got = {}
    for split in (False, True):
        out = str(tmp_path / f"out{split}")
        paths = str(tmp_path / "b.json"), str(tmp_path / "a.json"), out
        counts = plans.prepare_files(spark, *paths, schemas.RAW_BILL, keep_order=True, split=split)
        got[split] = rows(counts), sorted(r["value"] for r in spark.read.text(out).collect())
    assert got[True] == got[False] and len(got[True][1]) == 30
    with pytest.raises(ValueError):
        plans.prepare_files(spark, *paths[:2], str(tmp_path / "none"), split=True)


@pytest.mark.parametrize("text", ['{"dados": []}', '{"other": [1]}', '{"dados": [5, null]}'])
@pytest.mark.parametrize(("schema", "split"), [(None, False), (schemas.RAW_BILL, False), (schemas.RAW_BILL, True)])
def test_prepare_files_without_bills(spark, tmp_path, text, schema, split):
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(text)
    counts = plans.prepare_files(spark, str(tmp_path / "b.json"), str(tmp_path / "a.json"), str(tmp_path / "out"), schema, split=split)
    assert counts.collect() == [] and spark.read.schema(schemas.PREPARED_BILL).json(str(tmp_path / "out")).count() == 0
