"""Shapes of physical plans: what is pushed down, what is shuffled, where Python runs."""

from __future__ import annotations

import datetime as dt
import importlib

import pytest
from pyspark.sql import functions as F

from lawloom import operators as op
from lawloom import plans, schemas
from lawloom.sources import json_root
from tests.conftest import plan_of
from workload import bill_queries, model_queries, text_queries

SF = "/root/testdata/sf0.001"
ENTRIES = {**text_queries.ENTRIES, **bill_queries.ENTRIES, **model_queries.ENTRIES}


@pytest.fixture(scope="module")
def plan_by_name(spark):
    return {name: plan_of(query(spark, SF)) for name, (query, _) in ENTRIES.items()}


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_python_runs_only_in_model_calls(plan_by_name):
    with_python = {name for name, plan in plan_by_name.items() if "InArrow" in plan or "Python" in plan}
    assert with_python == {"enrich_summary", "enrich_entities", "enrich_topic", "concurrent_topics"}


def test_no_cross_joins(plan_by_name):
    for name, plan in plan_by_name.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_bill_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bills")
    spark.createDataFrame([(1, "PL", "2025-03-01", "u", "x")], "id long, siglaTipo string, dataApresentacao string, urlInteiroTeor string, texto string").write.parquet(path)
    kept = op.keep_valid(spark.read.parquet(path), start=dt.date(2025, 2, 2), end=dt.date(2025, 7, 17)).select("id")
    plan = plan_of(kept)
    assert "In(siglaTipo, [PEC,PL,PLP])" in plan
    assert "GreaterThanOrEqual(dataApresentacao,2025)" in plan and "LessThan(dataApresentacao,2026)" in plan
    assert "texto" not in plan.split("ReadSchema")[1] and "urlInteiroTeor" not in plan.split("ReadSchema")[1]


def test_prepare_filters_before_the_join(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "bills")
    spark.createDataFrame([], schemas.RAW_BILL).write.parquet(path)
    authors = spark.createDataFrame([], schemas.RAW_AUTHOR).withColumn("pos", F.lit(1))
    plan = plan_of(plans.prepare(spark.read.parquet(path), authors, ["pos"]))
    assert plan.index("Join") < plan.index("PushedFilters: [") and "In(siglaTipo" in plan
    assert "ultimoStatus" not in plan


def test_word_frequency_shuffles_once_after_counting(spark):
    plan = plan_of(op.word_frequency(spark.read.parquet(f"{SF}/documents.parquet"), ["a"], "doc_id"))
    assert plan.count("Exchange") == 1
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(id")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_answers_are_parsed_once(plan_by_name):
    for name in ("parse_summary", "entities_exploded", "enrich_summary", "enrich_entities", "parse_topic"):
        assert plan_by_name[name].count("from_json") == 1, name


def test_plans_do_not_depend_on_size(spark, tmp_path):
    """The same operators over little and over much; Spark alone picks the kind of join."""
    shapes = set()
    for rows in (1, 200_000):
        path = str(tmp_path / str(rows))
        spark.range(rows).selectExpr("id AS doc_id", "repeat('a ', 20) AS text").write.parquet(path)
        plan = plan_of(op.word_frequency(spark.read.parquet(path), ["x"], "doc_id"))
        shapes.add(tuple(line.strip(" :+-*()0123456789").split(" ")[0].split("(")[0] for line in plan.splitlines()))
    assert len(shapes) == 1


def test_prepare_drops_authors_of_other_bills_first(spark, no_broadcast):
    bills = spark.createDataFrame([], schemas.RAW_BILL)
    authors = spark.createDataFrame([], schemas.RAW_AUTHOR).withColumn("pos", F.lit(1))
    plan = plan_of(plans.prepare(bills, authors, ["pos"]))
    assert plan.index("collect_list") < plan.index("LeftSemi")


def test_new_rows_read_each_side_once(spark, tmp_path):
    for name in ("target", "source"):
        spark.range(3).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    assert plan_of(op.merge_tables(target, source, ["id"], "ignore")).count("Scan parquet") == 3


def test_clean_text_moves_lines_by_key(spark, tmp_path, no_broadcast):
    """Repeated lines and annexes go by joins on their keys; no lists of lines, no windows."""
    lines, pages = str(tmp_path / "lines"), str(tmp_path / "pages")
    spark.createDataFrame([], schemas.LINES).write.parquet(lines)
    spark.createDataFrame([], schemas.PAGES).write.parquet(pages)
    plan = plan_of(op.clean_text(spark.read.parquet(lines), spark.read.parquet(pages), remove_annex=True))
    assert plan.count("LeftAnti") == 2 and "array_contains" not in plan and "collect_list" not in plan
    assert "Window" not in plan and "SinglePartition" not in plan and "RangePartitioning" not in plan


def test_contract_check_counts_before_the_shuffle(spark):
    df = spark.createDataFrame([], "id long, topic string")
    plan = plan_of(op.contract_violations(df, ["topic"], ["id"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_stage_counts_read_the_bills_once(spark):
    bills = op.count_steps(spark.read.parquet(f"{SF}/orders.parquet"), "bills", prepared=F.col("o_orderstatus") == "F")
    assert plan_of(bills).count("FileScan") == 1


@pytest.mark.parametrize("schema", [None, schemas.RAW_BILL])
def test_prepare_files_reads_the_raw_bills_once(spark, tmp_path, monkeypatch, schema):
    """One write reads the file: neither the join with authors nor the counts go back to it."""
    module = importlib.import_module("lawloom.plans.prepare")
    (tmp_path / "b.json").write_text('{"dados": [{"id": 1, "siglaTipo": "PL", "dataApresentacao": "2025-03-01"}, {"id": 2}]}')
    (tmp_path / "a.json").write_text('{"dados": [{"idProposicao": 1, "idDeputadoAutor": 5}]}')
    opened, written = [], []
    files, write = json_root._files, module.write_json
    monkeypatch.setattr(json_root, "_files", lambda spark, path, roots: opened.append(path) or files(spark, path, roots))
    monkeypatch.setattr(module, "write_json", lambda df, path: written.append(plan_of(df)) or write(df, path))
    b, a = str(tmp_path / "b.json"), str(tmp_path / "a.json")
    counts = plans.prepare_files(spark, b, a, str(tmp_path / "out"), schema)
    assert opened == [b, a]
    (plan,) = written
    assert "a.json" in plan and "b.json" not in plan and "b.json" not in plan_of(counts)
    assert sorted(map(tuple, counts.collect())) == [("ok", 1), ("tipo", 1)]


@pytest.mark.parametrize(
    "name", ["tokenize", "build_requests", "enrich_summary", "enrich_entities", "enrich_topic", "concurrent_topics"]
)
def test_row_by_row_queries_shuffle_nothing(plan_by_name, name):
    assert "Exchange" not in plan_by_name[name]
