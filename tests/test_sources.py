from __future__ import annotations

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from lawloom import operators as op
from lawloom import plans, schemas, sources
from lawloom.schemas import RAW_AUTHOR


FAILURE = (PySparkException, Py4JJavaError)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def authors(rows):
    return [{"idProposicao": i, "nomeAutor": n} for i, n in rows]


def test_reads_root_in_order(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps({"dados": authors([(1, "x"), (2, "é"), (1, "y")])}))
    rows = sources.read_root_json(spark, path, RAW_AUTHOR).orderBy("src_pos").collect()
    assert [(r.src_pos, r.idProposicao, r.nomeAutor) for r in rows] == [(0, 1, "x"), (1, 2, "é"), (2, 1, "y")]


def test_missing_root_is_empty_or_error(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"other": []}')
    assert sources.read_root_json(spark, path, RAW_AUTHOR).count() == 0
    with pytest.raises(FAILURE):
        sources.read_root_json(spark, path, RAW_AUTHOR, require_root=True).collect()


def test_legacy_root(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps({"proposicoes": [{"id": 7, "siglaTipo": "PL"}]}))
    bills = sources.read_bills(spark, path, schemas.RAW_BILL)
    assert [r.id for r in bills.collect()] == [7]


def test_malformed_or_missing_file_fails(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"dados": [{"idProposicao": 1},')
    with pytest.raises(FAILURE):
        sources.read_root_json(spark, path, RAW_AUTHOR).collect()
    with pytest.raises(FAILURE):
        sources.read_root_json(spark, str(tmp_path / "none.json"), RAW_AUTHOR).collect()


def test_elements_that_are_no_objects_are_skipped(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"dados": [{"idProposicao": 1}, 5, "s", null, [1], {"idProposicao": "bad"}]}')
    rows = sources.read_root_json(spark, path, RAW_AUTHOR).orderBy("src_pos").collect()
    assert [(r.src_pos, r.idProposicao) for r in rows] == [(0, 1), (5, None)]


def test_texts_to_classify(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, text_summary string")
    assert sorted(tuple(r) for r in sources.texts_to_classify(df).collect()) == [(1, "a"), (2, "")]
    assert sources.texts_to_classify(df, 1).count() == 1
    assert sources.texts_to_classify(df).schema["id"].dataType.simpleString() == "bigint"


def test_text_that_looks_like_an_object_is_no_object(spark, tmp_path):
    path = write(tmp_path / "a.json", r'{"dados": [{"idProposicao": 1}, "{\"idProposicao\": 77}", {"idProposicao": 2}]}')
    rows = sources.read_root_json(spark, path, RAW_AUTHOR).collect()
    assert sorted((r.src_pos, r.idProposicao) for r in rows) == [(0, 1), (2, 2)]


def test_prepare_files_keeps_other_fields_and_order(spark, tmp_path):
    bill = {"siglaTipo": "PL", "dataApresentacao": "2025-03-01", "ementa": "é", "numero": 7, "relator": {"id": 3, "tags": ["a"]}}
    bills = [{"id": 9, **bill}, {"id": 2, **bill}]
    people = [{"idProposicao": i, "idDeputadoAutor": 5, "nomeAutor": n} for i, n in ((9, "first"), (2, "second"))]
    b = write(tmp_path / "b.json", json.dumps({"dados": bills}))
    a = write(tmp_path / "a.json", json.dumps({"dados": people}))
    out = str(tmp_path / "out")
    plans.prepare_files(spark, b, a, out, keep_order=True)
    prepared = spark.read.json(out)
    row = prepared.filter("id = 9").first()
    assert row.ementa == "é" and row.numero == 7 and row.relator.id == 3 and list(row.relator.tags) == ["a"]
    # the first bill of the file counts, not the lowest id
    names = lambda order: [r.full_name for r in op.unique_authors(prepared, order).collect()]
    assert names(("src_file", "src_pos")) == ["first"] and names(("id",)) == ["second"]


def test_prepare_files(spark, tmp_path):
    bills = [
        {"id": 1, "siglaTipo": "PL", "descricaoTipo": "d", "dataApresentacao": "2025-03-01T10:00", "ultimoStatus": {"a": 1}},
        {"id": 2, "siglaTipo": "REQ", "dataApresentacao": "2025-03-01"},
        {"id": 3, "siglaTipo": "PEC", "dataApresentacao": ""},
        {"id": 4, "siglaTipo": "PLP", "dataApresentacao": "2025-08-01", "urlInteiroTeor": "u"},
        {"id": 5, "siglaTipo": "PLP", "dataApresentacao": "2025-07-17", "urlInteiroTeor": "ü"},
    ]
    people = [
        {"idProposicao": 1, "idDeputadoAutor": 9, "nomeAutor": "B", "extra": 1},
        {"idProposicao": 1, "idDeputadoAutor": 8, "nomeAutor": "A", "siglaPartidoAutor": "P", "siglaUFAutor": "SP"},
        {"idProposicao": 0, "idDeputadoAutor": 8},
    ]
    b = write(tmp_path / "b.json", json.dumps({"dados": bills}))
    a = write(tmp_path / "a.json", json.dumps({"dados": people}))
    out = str(tmp_path / "out")
    reasons = {r.reason: r.n for r in plans.prepare_files(spark, b, a, out).collect()}
    assert reasons == {"ok": 2, "tipo": 1, "vazia": 1, "data": 1}
    written = sorted(
        (json.loads(line) for p in (tmp_path / "out").glob("part-*.json") for line in p.read_text("utf-8").splitlines()),
        key=lambda r: r["id"],
    )
    assert [w["id"] for w in written] == [1, 5]
    assert set(written[0]) == {"id", "siglaTipo", "descricaoTipo", "dataApresentacao", "urlInteiroTeor", "autores"}
    assert [x["idDeputadoAutor"] for x in written[0]["autores"]] == [9, 8]
    assert written[0]["autores"][0]["siglaUFAutor"] is None
    assert written[1]["autores"] == [] and written[1]["urlInteiroTeor"] == "ü"
    assert "ü" in "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("part-*.json"))
    again = spark.read.schema(schemas.PREPARED_BILL).json(out)
    assert again.count() == 2
