"""What later runs read and do: pruned folders, changed texts, repeated batches."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lawloom import operators as op
from lawloom import plans, schemas, sinks
from tests.conftest import plan_of

BILL = "id long, siglaTipo string, descricaoTipo string, dataApresentacao string, urlInteiroTeor string"


@pytest.fixture
def laid_out(spark, tmp_path):
    rows = [
        (i, ("PL", "PEC", "REQ", None)[i % 4], "d", ("2025-03-01T10:00", "20250330", "2025-04-02 09:30", "bad", None)[i % 5], f"u{i}")
        for i in range(40)
    ]
    bills = spark.createDataFrame(rows, BILL)
    sinks.write_prepared(bills, str(tmp_path / "prepared"))
    return bills, str(tmp_path / "prepared")


def test_types_and_months_are_folders(spark, laid_out, tmp_path):
    bills, path = laid_out
    folders = {str(p.parent.relative_to(path)) for p in (tmp_path / "prepared").rglob("*.parquet")}
    assert "siglaTipo=PL/mes=2025-03" in folders and "siglaTipo=PEC/mes=2025-04" in folders
    assert "siglaTipo=REQ/mes=__HIVE_DEFAULT_PARTITION__" in folders
    rule = {"types": ["PL", "REQ"], "start": dt.date(2025, 3, 2), "end": dt.date(2025, 4, 30)}
    found = sinks.read_prepared(spark, path, bills.schema, **rule)
    assert found.schema == bills.schema
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, op.keep_valid(bills, **rule).collect()))
    plan = plan_of(found)
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "siglaTipo" in filters and "mes" in filters


def test_named_bills_prune_by_their_own_folders(spark, laid_out, tmp_path):
    bills, path = laid_out
    rule = {"types": ["PL", "PEC"], "start": dt.date(2025, 1, 1), "end": dt.date(2025, 12, 31)}
    among = bills.filter("id < 6")
    among.write.parquet(str(tmp_path / "among"))
    among = spark.read.parquet(str(tmp_path / "among")).filter("id < 6")
    found = sinks.read_prepared(spark, path, bills.schema, among=among, **rule)
    want = op.keep_valid(bills.filter("id < 6"), **rule)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert "dynamicpruning" in plan_of(found).lower()


# --- changed texts ----------------------------------------------------------------------


def words(spark, root):
    return {(r["id"], r["word"]): r["frequency"] for r in sinks.read_table(spark, root, schemas.WORD_CLOUD).collect()}


def test_only_changed_texts_are_counted_again(spark, tmp_path, monkeypatch):
    import importlib

    module = importlib.import_module("lawloom.plans.analyse")
    counted, plain = [], module.word_frequency

    def watch(docs, *args, **kw):
        counted.append(docs.count())
        return plain(docs, *args, **kw)

    monkeypatch.setattr(module, "word_frequency", watch)
    root = str(tmp_path / "db")
    texts = [(i, f"lei número {i} lei") for i in range(100)] + [(100, None)]
    docs = spark.createDataFrame(texts, "id long, text string")
    grown = docs.withColumn("text", F.when(F.col("id") == 7, "lei nova").otherwise(F.col("text")))
    assert plans.count_words(docs, root, ["de"], changed_only=True) == 300
    assert plans.count_words(docs, root, ["de"], changed_only=True) == 0
    assert plans.count_words(grown, root, ["de"], changed_only=True) == 2
    assert counted == [101, 0, 1]
    full = str(tmp_path / "full")
    for each in (docs, grown):
        plans.count_words(each, full, ["de"])
    assert words(spark, root) == words(spark, full) and words(spark, root)[7, "nova"] == 1
    assert plans.count_words(grown, root, ["lei"], changed_only=True) > 0  # other stop words
    assert counted[-1] == 101


def test_only_changed_texts_are_dealt(spark, tmp_path, monkeypatch):
    import importlib

    module = importlib.import_module("lawloom.plans.analyse")
    dealt, plain = [], module.deal_texts
    monkeypatch.setattr(module, "deal_texts", lambda docs, *rest: dealt.append(docs.count()) or plain(docs, *rest))
    docs = spark.range(50).selectExpr("id", "concat('a b', id) AS text")
    grown = docs.withColumn("text", F.expr("if(id % 10 = 3, concat(text, ' nova'), text)"))
    for texts in (docs, grown, grown):
        plans.count_words(texts, str(tmp_path / "db"), (), changed_only=True)
    assert dealt == [50, 5, 0]
    no_id = docs.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 'c' AS text"))
    before = words(spark, str(tmp_path / "db"))
    with pytest.raises(op.ContractError):
        plans.count_words(no_id, str(tmp_path / "db"), (), changed_only=True)
    assert words(spark, str(tmp_path / "db")) == before


def test_known_texts_are_left_out_before_tokenising(spark):
    docs = op.with_digest(spark.createDataFrame([(1, "a b")], "id long, text string"))
    known = spark.createDataFrame([(1, "x")], schemas.TEXT_DIGESTS.schema)
    plan = plan_of(op.word_frequency(op.changed(docs, known)))
    assert plan.index("Generate") < plan.index("LeftAnti")  # plans are printed from the last step to the first


def test_digests(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "a")], "id long, text string")
    got = {r["id"]: r["digest"] for r in op.with_digest(rows).collect()}
    assert got[1] == got[4] != got[2] == got[3]
    assert op.with_digest(rows, settings="s").first()["digest"] != got[1]
    assert op.settings_digest(["b", "a", "b"]) == op.settings_digest(["a", "b"]) != op.settings_digest(["a"])
    table = lambda *w: op.settings_digest(spark.createDataFrame([(x,) for x in w], "word string"))
    assert table("b", "a", "b") == table("a", "b") != table("a", "c")


def test_analyse_with_changed_only(spark, tmp_path):
    bills = spark.sql(
        "SELECT id, 'PL' descricaoTipo, '2025-03-01' dataApresentacao, 'u' urlInteiroTeor, 'lei nova lei' textoInteiroTeorLimpo,"
        " array(named_struct('idDeputadoAutor', 7L, 'nomeAutor', 'A', 'siglaPartidoAutor', 'P', 'siglaUFAutor', 'SP')) autores"
        " FROM VALUES (1L), (2L) t(id)"
    )
    runs = [
        plans.analyse(bills, str(tmp_path / "db"), lambda m: "{}", lambda m: "{}", buckets=2, changed_only=True)
        for _ in range(2)
    ]
    assert [r["proposition_word_cloud"] for r in runs] == [4, 0]
    assert words(spark, str(tmp_path / "db")) == {(i, w): n for i in (1, 2) for w, n in (("lei", 2), ("nova", 1))}


# --- streams ----------------------------------------------------------------------------


def test_a_stream_fills_a_table_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    root, table, source = str(tmp_path / "db"), schemas.AUTHORS, str(tmp_path / "in")
    sinks.create_tables(spark, root, [table], buckets=4)

    def arrive(*people):
        spark.createDataFrame([(i, n, "P", "SP") for i, n in people], table.schema).coalesce(1).write.mode("append").json(source)

    def run(checkpoint):
        stream = spark.readStream.schema(table.schema).json(source)
        writer = sinks.upsert_stream(stream, root, table, "feed", str(tmp_path / checkpoint))
        writer.trigger(availableNow=True).start().awaitTermination()

    def names():
        return {r["id"]: r["full_name"] for r in sinks.read_table(spark, root, table).collect()}

    arrive((1, "a"), (2, "b"))
    run("checkpoint")
    arrive((2, "c"), (3, "d"))
    run("checkpoint")
    assert names() == {1: "a", 2: "c", 3: "d"}
    version = sinks.latest_version(spark, root, table)
    assert version == 2

    # the last batch was merged, but its end is not in the checkpoint
    for note in (tmp_path / "checkpoint" / "commits").glob("*1*"):
        note.unlink()
    sinks.upsert(spark, root, table, spark.createDataFrame([(3, "by hand", "P", "SP")], table.schema))
    run("checkpoint")
    assert names() == {1: "a", 2: "c", 3: "by hand"}
    arrive((4, "e"))
    run("checkpoint")
    assert names() == {1: "a", 2: "c", 3: "by hand", 4: "e"}
