"""Queries over bills and authors, and over keyed tables."""

from __future__ import annotations

import atexit
import contextlib
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom import functions as lf
from lawloom import operators as op
from lawloom import plans, schemas, sinks, sources
from workload import stand_ins as si
from workload.text_queries import TOKENS

WEEKS = (dt.date(1996, 3, 10), dt.date(1996, 5, 4))
RULE = {"types": si.TYPES, "start": si.START, "end": si.END}
SQL_TYPE_OK = "\"siglaTipo\" IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
SQL_DATE_OK = "day BETWEEN DATE '1996-02-02' AND DATE '1996-07-17'"


# --- filter and count -------------------------------------------------------------


def parse_iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("dataApresentacao")
    return si.irregular_bills(spark, sf_dir).select("id", date, lf.parse_iso_date(date).alias("day"))


def filter_type_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.keep_valid(si.irregular_bills(spark, sf_dir), **RULE)


def rejection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.count_rejections(si.irregular_bills(spark, sf_dir), **RULE)


REJECTION_SQL = f"""
WITH {si.IRREGULAR_BILLS}
SELECT CASE WHEN NOT coalesce({SQL_TYPE_OK}, false) THEN 'tipo' WHEN day IS NULL THEN 'vazia'
            WHEN NOT ({SQL_DATE_OK}) THEN 'data' ELSE 'ok' END AS reason, count(*) AS n
FROM dated GROUP BY 1"""


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = {
        "ultimoStatus": F.struct("siglaTipo", "descricaoTipo"),
        "uriOrgaoNumerador": F.col("urlInteiroTeor"),
        "uriPropAnterior": F.col("urlInteiroTeor"),
        "uriPropPrincipal": F.col("urlInteiroTeor"),
    }
    return op.drop_fields(si.bills(spark, sf_dir).withColumns(extra))


# --- authors ------------------------------------------------------------------------


def _author_text(a: Column) -> Column:
    return F.concat_ws(":", a["idDeputadoAutor"].cast("string"), a["nomeAutor"], a["siglaPartidoAutor"], a["siglaUFAutor"])


AUTHOR_TEXT = """concat_ws(':', "idDeputadoAutor", "nomeAutor", "siglaPartidoAutor", "siglaUFAutor")"""
GROUPED = f"""
grouped AS (
  SELECT "idProposicao", CAST(count(*) AS INTEGER) AS n_authors,
         string_agg({AUTHOR_TEXT}, '|' ORDER BY {si.AUTHOR_SORT}) AS autores
  FROM authors WHERE "idProposicao" <> 0 GROUP BY "idProposicao")"""


def authors_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = op.group_authors(si.authors(spark, sf_dir), si.AUTHOR_ORDER)
    return grouped.select(
        "idProposicao",
        F.size("autores").alias("n_authors"),
        F.array_join(F.transform("autores", _author_text), "|").alias("autores"),
    )


def merge_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.bills_with_authors(spark, sf_dir).select(
        "id",
        "siglaTipo",
        "dataApresentacao",
        F.size("autores").alias("n_authors"),
        F.array_join(F.transform("autores", _author_text), "|").alias("autores"),
    )


MERGE_AUTHORS_SQL = f"""
WITH {si.BILLS}, {si.AUTHORS}, {GROUPED}
SELECT id, "siglaTipo", "dataApresentacao", coalesce(n_authors, 0) AS n_authors, coalesce(autores, '') AS autores
FROM bills LEFT JOIN grouped ON "idProposicao" = id"""


def prepared_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = plans.prepare(si.irregular_bills(spark, sf_dir), si.authors(spark, sf_dir), si.AUTHOR_ORDER, **RULE)
    return prepared.withColumn("autores", F.array_join(F.transform("autores", _author_text), "|"))


def prepared_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid bills laid out by type and month, and those of one type and a few weeks read back."""
    folder = f"{sinks.shared_dir(spark)}/prepared-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, folder)
    kept = op.keep_valid(si.irregular_bills(spark, sf_dir), **RULE)
    sinks.write_prepared(kept, folder)
    return sinks.read_prepared(spark, folder, kept.schema, si.TYPES[:1], *WEEKS)


PREPARED_BY_MONTH_SQL = f"""
WITH {si.IRREGULAR_BILLS}
SELECT id, "siglaTipo", "descricaoTipo", "dataApresentacao", "urlInteiroTeor" FROM dated
WHERE {SQL_TYPE_OK} AND "siglaTipo" = '{si.TYPES[0]}' AND day BETWEEN DATE '{WEEKS[0]}' AND DATE '{WEEKS[1]}'"""


PREPARED_SQL = f"""
WITH {si.IRREGULAR_BILLS}, {si.AUTHORS}, {GROUPED}
SELECT id, "siglaTipo", "descricaoTipo", "dataApresentacao", "urlInteiroTeor", coalesce(autores, '') AS autores
FROM dated LEFT JOIN grouped ON "idProposicao" = id WHERE {SQL_TYPE_OK} AND {SQL_DATE_OK}"""


def unique_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unique_authors(si.bills_with_authors(spark, sf_dir))


UNIQUE_AUTHORS_SQL = f"""
WITH {si.AUTHORS}
SELECT CAST("idDeputadoAutor" AS INTEGER) AS id, "nomeAutor" AS full_name,
       "siglaPartidoAutor" AS poli_party, "siglaUFAutor" AS uf
FROM (SELECT *, row_number() OVER (PARTITION BY "idDeputadoAutor" ORDER BY "idProposicao", {si.AUTHOR_SORT}) AS rank
      FROM authors WHERE "idProposicao" <> 0 AND "idDeputadoAutor" <> 0) WHERE rank = 1"""


def propositions_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills with every kind of date text."""
    grouped = op.group_authors(si.authors(spark, sf_dir), si.AUTHOR_ORDER)
    rows = op.proposition_rows(op.merge_authors(si.irregular_bills(spark, sf_dir), grouped))
    return rows.withColumn("authors", F.array_join(F.col("authors").cast("array<string>"), ","))


_TIMESTAMP_FORM = (
    "([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})"
    "([T ]([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?)?"
)
PROPOSITIONS_SQL = f"""
WITH {si.IRREGULAR_BILLS}, {si.AUTHORS},
firsts AS (
  SELECT "idProposicao", "idDeputadoAutor", min(place) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY "idProposicao" ORDER BY {si.AUTHOR_SORT}) AS place
    FROM authors WHERE "idProposicao" <> 0) WHERE "idDeputadoAutor" <> 0 GROUP BY ALL),
ids AS (SELECT "idProposicao", string_agg("idDeputadoAutor", ',' ORDER BY place) AS authors FROM firsts GROUP BY ALL)
SELECT CAST(id AS INTEGER) AS id, "urlInteiroTeor" AS url_full_text, "descricaoTipo" AS proposition_type,
       CASE WHEN regexp_full_match("dataApresentacao", '{_TIMESTAMP_FORM}') THEN try_cast(
         regexp_replace("dataApresentacao", '^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})', '\\1-\\2-\\3') AS TIMESTAMP)
       END AS submission_date, coalesce(authors, '') AS authors
FROM irregular LEFT JOIN ids ON "idProposicao" = id"""


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills and those that pass the rules in one pass, and the other stages."""
    bills = op.count_steps(si.irregular_bills(spark, sf_dir), "bills", prepared=op.is_valid(**RULE))
    return bills.unionByName(
        op.count_stages(
            authors=si.authors(spark, sf_dir),
            unique_authors=op.unique_authors(si.bills_with_authors(spark, sf_dir)),
        )
    )


def watched_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reasons as counted by the pass that writes the bills that are kept."""
    folder = f"{sinks.shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, folder)
    watched, watch = op.watch_rejections(si.irregular_bills(spark, sf_dir), **RULE)
    op.keep_valid(watched, **RULE).write.parquet(folder)
    return op.watched_counts(spark, watch)


STAGE_COUNTS_SQL = f"""
WITH {si.IRREGULAR_BILLS}, {si.AUTHORS}
SELECT 'bills' AS stage, count(*) AS n FROM bills
UNION ALL SELECT 'authors', count(*) FROM authors
UNION ALL SELECT 'prepared', count(*) FROM dated WHERE {SQL_TYPE_OK} AND {SQL_DATE_OK}
UNION ALL SELECT 'unique_authors', count(DISTINCT "idDeputadoAutor") FROM authors
  WHERE "idProposicao" <> 0 AND "idDeputadoAutor" <> 0"""


# --- nested input ---------------------------------------------------------------------


def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = si.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("code"),
            F.struct(F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("weight")).alias("detail"),
        ).alias("status"),
        F.col("o_custkey").alias("owner"),
    )
    return lf.flatten(nested, "_")


EVENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("siglaTipo", T.StringType()),
        T.StructField("valor", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def json_root_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two objects per document among elements that are no objects; root key by event."""
    first = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("siglaTipo"), F.col("value").alias("valor"), "props"))
    second = F.to_json(F.struct((-F.col("event_id")).alias("id"), F.col("user_id").cast("string").alias("siglaTipo")))
    root = F.when(F.col("event_id") % 2 == 0, "dados").otherwise("proposicoes")
    odd = F.lit(r', 5, "{\"id\": 7}", null, ')
    text = F.concat(F.lit('{"'), root, F.lit('": ['), first, odd, second, F.lit("]}"))
    documents = si.table(spark, sf_dir, "events").hint("rebalance").select("event_id", text.alias("json"))
    return sources.explode_root_text(
        documents, "json", EVENT, roots=("dados", "proposicoes"), require_root=True, keep=("event_id",)
    )


def json_files_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents written as files to the shared folder and read from there."""
    first = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("siglaTipo"), F.col("value").alias("valor"), "props")
    folder = f"{sinks.shared_dir(spark)}/events-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, folder)
    events = si.table(spark, sf_dir, "events").withColumn("file", F.floor(F.col("event_id") / 1000))  # a bounded number of rows a file
    documents = events.groupBy("file").agg(F.to_json(F.struct(F.collect_list(first).alias("dados"))).alias("value"))
    documents.write.partitionBy("file").text(folder)  # one document per file
    rows = sources.read_root_json(spark, folder, EVENT)
    return rows.select("id", "siglaTipo", "valor", "props")


def split_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of 5,000 objects, read by blocks: objects among elements that are no objects, and arrays under other keys."""
    folder = f"{sinks.shared_dir(spark)}/events-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, folder)
    row = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("siglaTipo"), F.col("value").alias("valor"), "props")
    texts = si.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 5000).alias("file"), F.to_json(row).alias("text"))
    joined = texts.groupBy("file").agg(F.array_join(F.collect_list("text"), ', "}", [{"id": 1}], ').alias("text"))
    whole = F.concat(F.lit('{"outros": [{"id": 0}], "dados": ['), "text", F.lit(', null], "fim": {"id": [{}]}}'))
    joined.select("file", whole.alias("value")).write.partitionBy("file").text(folder)
    rows = sources.read_split_json(spark, folder, EVENT)
    atexit.register(_forget, spark, rows.lawloom_folder)
    return rows.select("id", "siglaTipo", "valor", "props")


def _forget(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        sinks.remove(spark, folder)


JSON_ROOT_SQL = """
SELECT event_id, 0 AS src_pos, event_id AS id, event_type AS "siglaTipo", value AS valor, props FROM events
UNION ALL SELECT event_id, 4, -event_id, CAST(user_id AS VARCHAR), NULL, NULL FROM events"""


# --- keyed tables -----------------------------------------------------------------------


def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers updated by their orders; doubled keys also bring new and leave old rows."""
    target = si.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("poli_party"),
        F.col("c_nationkey").cast("string").alias("uf"),
    )
    source = (
        si.table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") * 2).alias("id"))
        .agg(
            F.max("o_orderpriority").alias("full_name"),
            F.min("o_orderstatus").alias("poli_party"),
            F.count("*").cast("string").alias("uf"),
        )
    )
    return op.merge_tables(target, source, ["id"], "update")


MERGE_UPDATE_SQL = """
WITH source AS (
  SELECT o_custkey * 2 AS id, max(o_orderpriority) AS full_name, min(o_orderstatus) AS poli_party,
         CAST(count(*) AS VARCHAR) AS uf FROM orders GROUP BY 1)
SELECT * FROM source
UNION ALL SELECT c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR) FROM customer
  WHERE c_custkey NOT IN (SELECT id FROM source)"""


def merge_update_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word frequencies of the documents updated by those of the conversations."""
    target = op.word_frequency(op.deal_texts(si.texts(spark, sf_dir), "doc_id"), id_column="doc_id")
    source = op.word_frequency(si.table(spark, sf_dir, "conversations").hint("rebalance"), id_column="conv_id")
    return op.merge_tables(target, source, ["id", "word"], "update")


MERGE_COMPOSITE_SQL = f"""
WITH {TOKENS},
target AS (SELECT id, word, CAST(count(*) AS INTEGER) AS frequency FROM tokens GROUP BY ALL),
source AS (
  SELECT id, word, CAST(count(*) AS INTEGER) AS frequency FROM (
    SELECT conv_id AS id, unnest(regexp_split_to_array(
      regexp_replace(lower(coalesce(text, '')), '{si.SQL_NOT_WORD}', '', 'g'), '[{si.SQL_SPACE}]+')) AS word
    FROM conversations) WHERE word <> '' GROUP BY ALL)
SELECT * FROM source
UNION ALL SELECT t.* FROM target t ANTI JOIN source s ON s.id = t.id AND s.word = t.word"""


def merge_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, event type, props) triples; the source has the triples of the next user too."""
    triples = si.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("entity_type"), F.col("props").alias("entity")
    )
    source = triples.unionByName(triples.withColumn("id", F.col("id") + 1))
    return op.merge_tables(triples.distinct(), source, ["id", "entity_type", "entity"], "ignore")


MERGE_IGNORE_SQL = """
SELECT user_id AS id, event_type AS entity_type, props AS entity FROM events
UNION SELECT user_id + 1, event_type, props FROM events"""


def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as authors, written to a table, updated by suppliers, and read back."""
    root = f"{sinks.shared_dir(spark)}/tables-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, root)

    def people(table: str, key: str, factor: int) -> DataFrame:
        return si.table(spark, sf_dir, table).select(
            (F.col(f"{key}_{'custkey' if key == 'c' else 'suppkey'}") * factor).cast("int").alias("id"),
            F.col(f"{key}_name").alias("full_name"),
            F.lit(table).alias("poli_party"),
            F.col(f"{key}_nationkey").cast("string").alias("uf"),
        )

    sinks.create_tables(spark, root, [schemas.AUTHORS])
    sinks.upsert(spark, root, schemas.AUTHORS, people("customer", "c", 1))
    sinks.upsert(spark, root, schemas.AUTHORS, people("supplier", "s", 3))
    return sinks.read_table(spark, root, schemas.AUTHORS)


UPSERT_TWICE_SQL = """
WITH suppliers AS (
  SELECT CAST(s_suppkey * 3 AS INTEGER) AS id, s_name AS full_name, 'supplier' AS poli_party,
         CAST(s_nationkey AS VARCHAR) AS uf FROM supplier)
SELECT * FROM suppliers
UNION ALL SELECT CAST(c_custkey AS INTEGER), c_name, 'customer', CAST(c_nationkey AS VARCHAR) FROM customer
  WHERE c_custkey NOT IN (SELECT id FROM suppliers)"""


def incremental_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as authors in 16 buckets, one per cent updated by their orders, and suppliers added where ids are new."""
    root = f"{sinks.shared_dir(spark)}/tables-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, root)
    table = schemas.AUTHORS

    def people(name: str, key: str, full_name: str, uf: str) -> DataFrame:
        return si.table(spark, sf_dir, name).select(
            F.col(key).cast("int").alias("id"),
            F.col(full_name).alias("full_name"),
            F.lit(name).alias("poli_party"),
            F.col(uf).cast("string").alias("uf"),
        )

    customers = people("customer", "c_custkey", "c_name", "c_nationkey")
    ordered = people("orders", "o_custkey", "o_orderpriority", "o_orderstatus").filter("id % 100 = 7")
    changes = ordered.groupBy("id").agg(F.max("full_name").alias("full_name"), F.min("uf").alias("uf"))
    suppliers = people("supplier", "s_suppkey", "s_name", "s_nationkey").withColumn("id", F.col("id") * 50)
    sinks.create_tables(spark, root, [table], buckets=16)
    sinks.upsert(spark, root, table, customers)
    sinks.upsert(spark, root, table, changes.withColumn("poli_party", F.lit("orders")))
    sinks.upsert(spark, root, table, suppliers, mode="ignore")
    return sinks.read_table(spark, root, table)


INCREMENTAL_UPSERTS_SQL = """
WITH changes AS (
  SELECT CAST(o_custkey AS INTEGER) AS id, max(o_orderpriority) AS full_name, 'orders' AS poli_party,
         min(o_orderstatus) AS uf FROM orders WHERE o_custkey % 100 = 7 GROUP BY o_custkey),
updated AS (
  SELECT * FROM changes UNION ALL
  SELECT CAST(c_custkey AS INTEGER), c_name, 'customer', CAST(c_nationkey AS VARCHAR) FROM customer
  WHERE c_custkey NOT IN (SELECT id FROM changes))
SELECT * FROM updated UNION ALL
SELECT CAST(s_suppkey * 50 AS INTEGER), s_name, 'supplier', CAST(s_nationkey AS VARCHAR) FROM supplier
  WHERE s_suppkey * 50 NOT IN (SELECT id FROM updated)"""


def changed_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of all documents, then of those alone whose texts have grown since."""
    root = f"{sinks.shared_dir(spark)}/tables-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, root)
    docs = si.texts(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    grown = docs.withColumn("text", F.when(F.col("id") % 50 == 3, F.concat("text", F.lit(" nova nova palavra"))).otherwise(F.col("text")))
    sinks.create_tables(spark, root, [schemas.WORD_CLOUD, schemas.TEXT_DIGESTS], buckets=8)
    for texts in (docs, grown):
        plans.count_words(texts, root, (), changed_only=True)
    return sinks.read_table(spark, root, schemas.WORD_CLOUD)


CHANGED_WORD_COUNTS_SQL = f"""
WITH {TOKENS.replace("FROM documents", "FROM grown")}
SELECT CAST(id AS INTEGER) AS id, word, CAST(count(*) AS INTEGER) AS frequency FROM tokens GROUP BY ALL""".replace(
    "WITH ",
    "WITH grown AS (SELECT doc_id, text || CASE WHEN doc_id % 50 = 3 THEN ' nova nova palavra' ELSE '' END AS text FROM documents), ",
)


def streamed_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as a stream into a table of 16 buckets, and the same batches once more, which change nothing."""
    folder = f"{sinks.shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, folder)
    schema = si.table(spark, sf_dir, "customer").schema
    customers = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(sf_dir)
    rows = customers.select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("poli_party"),
        F.col("c_nationkey").cast("string").alias("uf"),
    )
    sinks.create_tables(spark, folder, [schemas.AUTHORS], buckets=16)
    for party, checkpoint in ((F.col("poli_party"), "first"), (F.lit("late"), "again")):
        stream = rows.withColumn("poli_party", party)
        writer = sinks.upsert_stream(stream, folder, schemas.AUTHORS, "customers", f"{folder}/{checkpoint}")
        writer.trigger(availableNow=True).start().awaitTermination()
    return sinks.read_table(spark, folder, schemas.AUTHORS)


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = si.table(spark, sf_dir, "lineitem").withColumn("l_shipmode", F.nullif("l_returnflag", F.lit("R")))
    return op.contract_violations(rows, ["l_orderkey", "l_quantity", "l_shipmode"], ["l_orderkey", "l_linenumber"])


CONTRACT_SQL = """
SELECT 'rows' AS "check", '' AS column_name, count(*) AS n FROM lineitem
UNION ALL SELECT 'duplicate_key', 'l_orderkey,l_linenumber', CAST(sum(m - 1) AS BIGINT) FROM (
  SELECT count(*) AS m FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'null', 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'null', 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem
UNION ALL SELECT 'null', 'l_shipmode', count(*) FILTER (l_returnflag = 'R') FROM lineitem"""


ENTRIES = {
    "parse_iso_date": (parse_iso_date, f'WITH {si.IRREGULAR_BILLS} SELECT id, "dataApresentacao", day FROM dated'),
    "filter_type_date": (
        filter_type_date,
        f'WITH {si.IRREGULAR_BILLS} SELECT id, "siglaTipo", "descricaoTipo", "dataApresentacao", "urlInteiroTeor"'
        f" FROM dated WHERE {SQL_TYPE_OK} AND {SQL_DATE_OK}",
    ),
    "rejection_counts": (rejection_counts, REJECTION_SQL),
    "watched_rejections": (watched_rejections, REJECTION_SQL),
    "drop_columns": (drop_columns, f"WITH {si.BILLS} SELECT * FROM bills"),
    "authors_grouped": (
        authors_grouped,
        f'WITH {si.AUTHORS}, {GROUPED} SELECT "idProposicao", n_authors, autores FROM grouped',
    ),
    "merge_authors": (merge_authors, MERGE_AUTHORS_SQL),
    "prepared_bills": (prepared_bills, PREPARED_SQL),
    "prepared_by_month": (prepared_by_month, PREPARED_BY_MONTH_SQL),
    "unique_authors": (unique_authors, UNIQUE_AUTHORS_SQL),
    "propositions_rows": (propositions_rows, PROPOSITIONS_SQL),
    "stage_counts": (stage_counts, STAGE_COUNTS_SQL),
    "flatten_struct": (
        flatten_struct,
        "SELECT o_orderkey AS id, o_orderstatus AS status_code, o_orderpriority AS status_detail_name,"
        " o_totalprice AS status_detail_weight, o_custkey AS owner FROM orders",
    ),
    "json_root_explode": (json_root_explode, JSON_ROOT_SQL),
    "json_files_explode": (
        json_files_explode,
        'SELECT event_id AS id, event_type AS "siglaTipo", value AS valor, props FROM events',
    ),
    "split_json_explode": (
        split_json_explode,
        'SELECT event_id AS id, event_type AS "siglaTipo", value AS valor, props FROM events',
    ),
    "upsert_twice": (upsert_twice, UPSERT_TWICE_SQL),
    "incremental_upserts": (incremental_upserts, INCREMENTAL_UPSERTS_SQL),
    "merge_update": (merge_update, MERGE_UPDATE_SQL),
    "merge_update_composite": (merge_update_composite, MERGE_COMPOSITE_SQL),
    "merge_ignore": (merge_ignore, MERGE_IGNORE_SQL),
    "changed_word_counts": (changed_word_counts, CHANGED_WORD_COUNTS_SQL),
    "streamed_upserts": (
        streamed_upserts,
        "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS full_name, c_mktsegment AS poli_party,"
        " CAST(c_nationkey AS VARCHAR) AS uf FROM customer",
    ),
    "contract_violations": (contract_violations, CONTRACT_SQL),
}
