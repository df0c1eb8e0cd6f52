"""The test tables mapped to bills, authors, page lines and model responses.

Each mapping exists twice: as a DataFrame and as SQL common table expressions.
Irregular values (odd dates, missing types, page furniture) are derived from the
keys of the rows, so they are there at every scale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom import functions as lf
from lawloom import rules
from lawloom.operators import explode_lines, group_authors, merge_authors

TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM")
START, END = dt.date(1996, 2, 2), dt.date(1996, 7, 17)
AUTHOR_ORDER = ("l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice")
LINES_PER_PAGE = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- bills and authors --------------------------------------------------------


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("siglaTipo"),
        F.col("o_orderstatus").alias("descricaoTipo"),
        F.replace(F.substring(F.col("o_orderdate").cast("string"), 1, 16), F.lit(" "), F.lit("T")).alias(
            "dataApresentacao"
        ),
        F.when(F.col("o_orderkey") % 5 != 3, F.concat(F.lit("u/"), "o_orderkey")).alias("urlInteiroTeor"),
    )


BILLS = """
bills AS (
  SELECT o_orderkey AS id, o_orderpriority AS "siglaTipo", o_orderstatus AS "descricaoTipo",
         strftime(o_orderdate, '%Y-%m-%dT%H:%M') AS "dataApresentacao",
         CASE WHEN o_orderkey % 5 <> 3 THEN 'u/' || o_orderkey END AS "urlInteiroTeor"
  FROM orders)"""


def irregular_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills with missing types and with every kind of date text."""
    regular = bills(spark, sf_dir)
    kind, date = F.col("id") % 16, F.col("dataApresentacao")
    day = F.substring(date, 1, 10)
    return regular.withColumn("siglaTipo", F.when(F.col("id") % 11 != 0, F.col("siglaTipo"))).withColumn(
        "dataApresentacao",
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 2, F.substring(date, 1, 7))
        .when(kind == 3, F.substring(date, 1, 4))
        .when(kind == 4, F.replace(day, F.lit("-"), F.lit("")))
        .when(kind == 5, F.concat(day, F.lit(" 10:30:59")))
        .when(kind == 6, F.concat(F.substring(date, 1, 4), F.lit("-13-01")))
        .when(kind == 7, F.concat(F.lit(" "), day))
        .when(kind == 8, F.concat(F.substring(date, 1, 8), F.lit("3")))
        .when(kind == 9, day)
        .when(kind == 10, F.concat(day, F.lit(" 25:00")))
        .when(kind == 11, F.lit("abc"))
        .otherwise(date),
    )


IRREGULAR_BILLS = (
    BILLS
    + """,
irregular AS (
  SELECT id, CASE WHEN id % 11 <> 0 THEN "siglaTipo" END AS "siglaTipo",
         "descricaoTipo", "urlInteiroTeor",
         CASE id % 16
           WHEN 0 THEN '' WHEN 1 THEN NULL
           WHEN 2 THEN substr("dataApresentacao", 1, 7) WHEN 3 THEN substr("dataApresentacao", 1, 4)
           WHEN 4 THEN replace(substr("dataApresentacao", 1, 10), '-', '')
           WHEN 5 THEN substr("dataApresentacao", 1, 10) || ' 10:30:59'
           WHEN 6 THEN substr("dataApresentacao", 1, 4) || '-13-01'
           WHEN 7 THEN ' ' || substr("dataApresentacao", 1, 10)
           WHEN 8 THEN substr("dataApresentacao", 1, 8) || '3'
           WHEN 9 THEN substr("dataApresentacao", 1, 10)
           WHEN 10 THEN substr("dataApresentacao", 1, 10) || ' 25:00'
           WHEN 11 THEN 'abc'
           ELSE "dataApresentacao" END AS "dataApresentacao"
  FROM bills),
dated AS (
  SELECT *, split_part("dataApresentacao", 'T', 1) AS part,
    CASE
      WHEN regexp_full_match(part, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_strptime(part, '%Y-%m-%d')
      WHEN regexp_full_match(part, '[0-9]{8}') THEN try_strptime(part, '%Y%m%d')
      WHEN regexp_full_match(part,
        '[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?')
        THEN try_strptime(substr(part, 1, 10), '%Y-%m-%d')
    END::DATE AS day
  FROM irregular)"""
)


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("idProposicao"),
        F.col("l_suppkey").alias("idDeputadoAutor"),
        F.col("s_name").alias("nomeAutor"),
        F.col("l_returnflag").alias("siglaPartidoAutor"),
        F.col("s_nationkey").cast("string").alias("siglaUFAutor"),
        *AUTHOR_ORDER,
    )


_ORDER = ", ".join(AUTHOR_ORDER)
AUTHOR_SORT = f'{_ORDER}, "idDeputadoAutor", "nomeAutor", "siglaPartidoAutor", "siglaUFAutor"'
AUTHORS = f"""
authors AS (
  SELECT l_orderkey AS "idProposicao", l_suppkey AS "idDeputadoAutor", s_name AS "nomeAutor",
         l_returnflag AS "siglaPartidoAutor", CAST(s_nationkey AS VARCHAR) AS "siglaUFAutor", {_ORDER}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


def bills_with_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_authors(bills(spark, sf_dir), group_authors(authors(spark, sf_dir), AUTHOR_ORDER))


# --- page lines -----------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts, dealt out evenly: a file of one row group is one task, and plans share the exchange."""
    return table(spark, sf_dir, "documents").hint("rebalance")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts as they are stored, for queries that work row by row and need no exchange."""
    return table(spark, sf_dir, "documents")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, i, n, line): the lines of each text; n is the page count."""
    pieces = documents(spark, sf_dir).select("doc_id", F.split("text", "\n").alias("pieces"))
    return pieces.select("doc_id", _page_total(F.col("pieces")).alias("n"), F.posexplode("pieces").alias("i", "line"))


def _page_total(pieces: Column) -> Column:
    return F.ceil(F.size(pieces) / F.lit(LINES_PER_PAGE)).cast("int")


DOCUMENT_LINES = """
document_lines AS (
  SELECT doc_id, CAST(ceil(len(pieces) / 5.0) AS INTEGER) AS n,
         CAST(unnest(range(len(pieces))) AS INTEGER) AS i, unnest(pieces) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS pieces FROM documents))"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = documents(spark, sf_dir).select("doc_id", _page_total(F.split("text", "\n")).alias("n"))
    return total.select(
        "doc_id", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("page_no"), F.lit(100.0).alias("page_height")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines placed in five slots per page, with page furniture around them."""
    text = explode_lines(documents(spark, sf_dir).select("doc_id", "text"), position="i").select(
        "doc_id",
        F.expr(f"CAST(i div {LINES_PER_PAGE} AS INT)").alias("page_no"),
        F.lit(100.0).alias("page_height"),
        (F.lit(10) + F.col("i") % LINES_PER_PAGE).alias("line_no"),
        ((F.col("i") % LINES_PER_PAGE) * 25.0).alias("y0"),
        "line",
    )
    doc, page, n = F.col("doc_id"), F.col("page_no"), F.col("n")

    def furniture(when: Column, line_no: int, y0: float, line: Column) -> Column:
        return F.when(when, F.struct(F.lit(line_no).alias("line_no"), F.lit(y0).alias("y0"), line.alias("line")))

    annex = ((doc % 5 == 0) & (page == 0)) | ((doc % 10 == 0) & (page == n - 1))
    planted = F.array(
        furniture(page % 3 != 2, 0, 5.0, F.concat(F.lit("RELATORIO "), doc % 7)),
        furniture(F.lit(True), 1, 5.0, (page + 1).cast("string")),
        furniture(annex, 2, 20.0, F.lit("ANEXO I")),
        furniture(doc % 6 == 0, 50, 50.0, lf.normalize_line(F.lit("Art. 1 ........ 3"))),
        furniture(F.lit(True), 90, 95.0, F.concat(F.lit("Página "), page + 1, F.lit(" de "), n)),
        furniture(doc % 4 == 0, 91, 95.0, F.concat(F.lit("Gabinete do Deputado "), doc)),
    )
    added = (
        pages(spark, sf_dir)
        .select("doc_id", "page_no", "page_height", F.explode(planted).alias("p"))
        .filter("p IS NOT NULL")
        .select("doc_id", "page_no", "page_height", "p.*")
    )
    return text.unionByName(added)


# Fixed values of the SQL side: the same classes as in lawloom.rules, in RE2 syntax.
SQL_SPACE = r"\t-\r\x1c-\x20\x{85}\p{Z}"
SQL_NOT_WORD = r"[^\p{L}\p{N}_" + SQL_SPACE + "]"
SQL_LEADERS = "[_''.·•●◦▪▫⋅∙…]{3,}"


def sql_normalized(line: str) -> str:
    return f"trim(regexp_replace(regexp_replace({line}, '{SQL_LEADERS}', ' ', 'g'), '[{SQL_SPACE}]+', ' ', 'g'))"


def sql_page_number(line: str) -> str:
    s = f"[{SQL_SPACE}]"
    d = r"\p{Nd}{1,4}"
    return f"regexp_full_match({line}, '(?i){s}*({d}|p[áa]gina{s}+{d}({s}+de{s}+{d})?|{d}{s}*/{s}*{d}){s}*')"


def sql_folded(line: str) -> str:
    return f"replace(replace(lower({line}), 'ß', 'ss'), 'ſ', 's')"


def sql_boilerplate(line: str) -> str:
    folded = sql_folded(line)
    s = f"[{SQL_SPACE}]"
    tests = [f"contains({folded}, '{term}')" for term in rules.BANNED_TERMS]
    tests.append(rf"regexp_matches({folded}, '(\*|^){s}*cd\p{{Nd}}{{6,}}{s}*(\*|$)')")
    tests.append(rf"regexp_full_match({folded}, 'pl{s}*n?[.ºo°]*{s}*\p{{Nd}}{{1,6}}[/-]\p{{Nd}}{{2,4}}')")
    return "(" + " OR ".join(tests) + ")"


def sql_annex_title(line: str) -> str:
    s = f"[{SQL_SPACE}]"
    trimmed = rf"regexp_replace({line}, '^{s}+|{s}+$', '', 'g')"
    return (
        rf"(regexp_full_match({trimmed}, 'ANEXO({s}+[IVXLCDM0-9]+)?({s}*[-–—:][^\n]*)?')"
        rf" AND NOT ends_with({trimmed}, '.')"
        rf" AND len(regexp_split_to_array({trimmed}, '{s}+')) <= 10"
        rf" AND 10 * length(regexp_replace({trimmed}, '[^\p{{Lu}}]', '', 'g'))"
        rf" >= 9 * length(regexp_replace({trimmed}, '[^\p{{L}}]', '', 'g'))"
        rf" AND {trimmed} = upper({trimmed}))"
    )


PAGES = (
    DOCUMENT_LINES
    + """,
pages AS (
  SELECT doc_id, n, CAST(unnest(range(n)) AS INTEGER) AS page_no, 100.0::DOUBLE AS page_height
  FROM (SELECT DISTINCT doc_id, n FROM document_lines))"""
)
LINES = (
    PAGES
    + f""",
raw_lines AS (
  SELECT doc_id, CAST(i // 5 AS INTEGER) AS page_no, CAST(10 + i % 5 AS INTEGER) AS line_no,
         (i % 5) * 25.0::DOUBLE AS y0, line FROM document_lines
  UNION ALL SELECT doc_id, page_no, 0, 5.0, 'RELATORIO ' || (doc_id % 7) FROM pages WHERE page_no % 3 <> 2
  UNION ALL SELECT doc_id, page_no, 1, 5.0, CAST(page_no + 1 AS VARCHAR) FROM pages
  UNION ALL SELECT doc_id, page_no, 2, 20.0, 'ANEXO I' FROM pages
    WHERE (doc_id % 5 = 0 AND page_no = 0) OR (doc_id % 10 = 0 AND page_no = n - 1)
  UNION ALL SELECT doc_id, page_no, 50, 50.0, 'Art. 1 ........ 3' FROM pages WHERE doc_id % 6 = 0
  UNION ALL SELECT doc_id, page_no, 90, 95.0, 'Página ' || (page_no + 1) || ' de ' || n FROM pages
  UNION ALL SELECT doc_id, page_no, 91, 95.0, 'Gabinete do Deputado ' || doc_id FROM pages WHERE doc_id % 4 = 0),
lines AS MATERIALIZED (
  SELECT doc_id, page_no, 100.0::DOUBLE AS page_height, line_no, y0, norm AS line
  FROM (SELECT *, {sql_normalized("line")} AS norm FROM raw_lines) WHERE norm <> ''),
regions AS MATERIALIZED (
  SELECT *, y0 <= page_height * 0.15::DOUBLE AS in_top, y0 >= page_height * 0.85::DOUBLE AS in_bottom,
         {sql_page_number("line")} AS is_number FROM lines),
totals AS (SELECT doc_id, count(*) AS n_pages FROM pages GROUP BY doc_id),
repeated AS MATERIALIZED (
  SELECT * FROM (
    SELECT doc_id, line,
           10 * count(DISTINCT CASE WHEN in_top AND NOT is_number THEN page_no END) >= 4 * any_value(n_pages) AS top_rep,
           10 * count(DISTINCT CASE WHEN in_bottom THEN page_no END) >= 4 * any_value(n_pages) AS bot_rep
    FROM regions JOIN totals USING (doc_id) WHERE in_top OR in_bottom GROUP BY doc_id, line)
  WHERE top_rep OR bot_rep),
starts AS (
  SELECT doc_id, annex_start FROM (
    SELECT doc_id, max(page_no) AS annex_start FROM lines
    WHERE y0 <= page_height * 0.30::DOUBLE AND {sql_annex_title("line")} GROUP BY doc_id)
  JOIN totals USING (doc_id) WHERE annex_start >= n_pages // 2),
kept AS MATERIALIZED (
  SELECT r.* FROM regions r LEFT JOIN repeated p ON p.doc_id = r.doc_id AND p.line = r.line
  WHERE NOT {sql_boilerplate("r.line")}
    AND NOT (r.in_top AND coalesce(p.top_rep, false)) AND NOT (r.in_bottom AND coalesce(p.bot_rep, false))
    AND NOT (r.is_number AND (r.in_top OR r.in_bottom))),
kept_before_annex AS (
  SELECT k.* FROM kept k LEFT JOIN starts s ON s.doc_id = k.doc_id
  WHERE s.annex_start IS NULL OR k.page_no < s.annex_start)"""
)


def sql_texts(kept: str) -> str:
    return f"""
page_texts AS (
  SELECT doc_id, page_no, trim(string_agg(line, ' ' ORDER BY line_no)) AS page_text FROM {kept} GROUP BY ALL),
texts AS (
  SELECT doc_id, nullif(page_join, '') AS clean_text FROM totals LEFT JOIN (
    SELECT doc_id, string_agg(page_text, chr(10) ORDER BY page_no) AS page_join
    FROM page_texts WHERE page_text <> '' GROUP BY doc_id) USING (doc_id))"""
