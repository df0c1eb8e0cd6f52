"""Queries over texts and page lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom import functions as lf
from lawloom import operators as op
from workload import stand_ins as si

STOP_WORDS = ("the", "of", "and", "in", "de", "la", "le", "les", "et", "que", "el", "en", "der", "die", "und", "o", "a", "e", "do", "da")

TOKENS = f"""
tokens AS (
  SELECT doc_id AS id, word FROM (
    SELECT doc_id, unnest(regexp_split_to_array(
      regexp_replace(lower(coalesce(text, '')), '{si.SQL_NOT_WORD}', '', 'g'), '[{si.SQL_SPACE}]+')) AS word
    FROM documents) WHERE word <> '')"""


def _cycle(key: Column, variants: list[Column]) -> Column:
    """Pick one variant per row by its key."""
    out = F.when(key % len(variants) == 0, variants[0])
    for i, variant in enumerate(variants[1:], start=1):
        out = out.when(key % len(variants) == i, variant)
    return out


def _sql_cycle(key: str, variants: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(variants))
    return f"CASE ({key}) % {len(variants)} {whens} END"


# --- words ----------------------------------------------------------------------


def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.word_frequency(op.deal_texts(si.texts(spark, sf_dir), "doc_id"), id_column="doc_id")


WORD_FREQUENCY_SQL = f"WITH {TOKENS} SELECT id, word, CAST(count(*) AS INTEGER) AS frequency FROM tokens GROUP BY ALL"


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.array_remove(lf.tokenize(F.col("text")), "")
    return si.texts(spark, sf_dir).select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


TOKENIZE_SQL = f"""
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM (
  SELECT doc_id, list_filter(regexp_split_to_array(
    regexp_replace(lower(coalesce(text, '')), '{si.SQL_NOT_WORD}', '', 'g'), '[{si.SQL_SPACE}]+'),
    lambda w: w <> '') AS tokens
  FROM documents)"""


def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.drop_stop_words(op.explode_words(si.documents(spark, sf_dir), "doc_id"), STOP_WORDS)


STOPWORD_FILTER_SQL = "WITH {} SELECT id, word FROM tokens WHERE word NOT IN ({})".format(
    TOKENS, ", ".join(f"'{w}'" for w in STOP_WORDS)
)


def stopword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop words are a table: all words of the benchmark."""
    stop_words = op.explode_words(si.table(spark, sf_dir, "benchmark"), "item_id").select("word").distinct()
    return op.drop_stop_words(op.explode_words(si.documents(spark, sf_dir), "doc_id"), stop_words)


STOPWORD_TABLE_SQL = f"""
WITH {TOKENS}, stop AS (
  SELECT DISTINCT unnest(regexp_split_to_array(
    regexp_replace(lower(text), '{si.SQL_NOT_WORD}', '', 'g'), '[{si.SQL_SPACE}]+')) AS word FROM benchmark)
SELECT id, word FROM tokens WHERE word NOT IN (SELECT word FROM stop)"""


# --- single lines ---------------------------------------------------------------

# Line ends put after each sentence, by document.
_ENDS = ("\r\n", "\x0b", "\x85", "\u2029", "\r", "\x1d")
_SQL_ENDS = ("chr(13) || chr(10)", "chr(11)", "chr(133)", "chr(8233)", "chr(13)", "chr(29)")


def explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _cycle(F.col("doc_id"), [F.replace("text", F.lit(". "), F.lit(". " + end)) for end in _ENDS])
    return op.explode_lines(si.documents(spark, sf_dir).select("doc_id", text.alias("text")), position="line_no")


EXPLODE_LINES_SQL = r"""
WITH varied AS (SELECT doc_id, {} AS text FROM documents),
pieces AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\x0B\f\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS parts FROM varied),
numbered AS (SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no, unnest(parts) AS raw FROM pieces)
SELECT doc_id, line_no, line FROM (SELECT doc_id, line_no, {} AS line FROM numbered) WHERE line <> ''""".format(
    _sql_cycle("doc_id", [f"replace(text, '. ', '. ' || {end})" for end in _SQL_ENDS]), si.sql_normalized("raw")
)


def normalize_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")

    def spaced(by: str) -> Column:
        return F.replace(line, F.lit(" "), F.lit(by))

    raw = _cycle(
        F.col("doc_id") + F.col("i"),
        [
            line,
            spaced("  "),
            spaced(" .... "),
            spaced("…•··"),
            F.concat(F.lit("___"), line, F.lit("'''")),
            spaced(" \t"),
            F.replace(line, F.lit("e"), F.lit("..")),
        ],
    )
    return si.document_lines(spark, sf_dir).select("doc_id", "i", lf.normalize_line(raw).alias("line"))


NORMALIZE_LINE_SQL = "WITH {}, varied AS (SELECT doc_id, i, {} AS raw FROM document_lines) SELECT doc_id, i, {} AS line FROM varied".format(
    si.DOCUMENT_LINES,
    _sql_cycle(
        "doc_id + i",
        [
            "line",
            "replace(line, ' ', '  ')",
            "replace(line, ' ', ' .... ')",
            "replace(line, ' ', '…•··')",
            "'___' || line || ''''''''",
            "replace(line, ' ', chr(160) || chr(9))",
            "replace(line, 'e', '..')",
        ],
    ),
    si.sql_normalized("raw"),
)


def _flags(spark: SparkSession, sf_dir: str, variants: list[Column], test) -> DataFrame:
    rows = si.document_lines(spark, sf_dir).select(
        "doc_id", "i", _cycle(F.col("doc_id") + F.col("i"), variants).alias("line")
    )
    return rows.select("doc_id", "i", "line", test(F.col("line")).alias("flag"))


def _flags_sql(variants: list[str], test: str) -> str:
    return (
        f"WITH {si.DOCUMENT_LINES}, varied AS (SELECT doc_id, i, {_sql_cycle('doc_id + i', variants)} AS line"
        f" FROM document_lines) SELECT doc_id, i, line, {test} AS flag FROM varied"
    )


def page_number_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, n = F.col("i"), F.col("n")
    variants = [
        F.col("line"),
        i.cast("string"),
        F.concat(F.lit("Página "), i),
        F.concat(F.lit("PÁGINA "), i, F.lit(" de "), i + 10),
        F.concat(i, F.lit("/"), n),
        F.concat(i, F.lit(" / "), n),
        F.concat(F.lit("p. "), i),
        F.concat(F.lit("1234"), i),
        F.concat(F.lit("pagina  "), i, F.lit(" DE "), n),
    ]
    return _flags(spark, sf_dir, variants, lf.is_page_number)


PAGE_NUMBER_SQL = _flags_sql(
    [
        "line",
        "CAST(i AS VARCHAR)",
        "'Página ' || i",
        "'PÁGINA ' || i || ' de ' || (i + 10)",
        "i || '/' || n",
        "i || ' / ' || n",
        "'p. ' || i",
        "'1234' || i",
        "'pagina  ' || i || ' DE ' || n",
    ],
    si.sql_page_number("line"),
)


def boilerplate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, line = F.col("i"), F.col("line")
    variants = [
        line,
        F.concat(F.lit("CÂMARA DOS DEPUTADOS "), line),
        F.concat(F.lit("*CD"), i + 340001000, F.lit("*")),
        F.concat(F.lit("CD123"), i % 100),
        F.concat(F.lit("xCD90210"), i),
        F.concat(line, F.lit(" mesada")),
        F.concat(F.lit("PL "), i, F.lit("/2025")),
        F.concat(F.lit("pl nº "), i, F.lit("-25")),
        F.concat(F.lit("Praça dos Três Poderes - "), line),
        F.concat(line, F.lit(" Aßinado eletronicamente")),
        F.concat(F.lit("PL "), i, F.lit("/2025 "), line),
    ]
    return _flags(spark, sf_dir, variants, lf.is_boilerplate)


BOILERPLATE_SQL = _flags_sql(
    [
        "line",
        "'CÂMARA DOS DEPUTADOS ' || line",
        "'*CD' || (i + 340001000) || '*'",
        "'CD123' || (i % 100)",
        "'xCD90210' || i",
        "line || ' mesada'",
        "'PL ' || i || '/2025'",
        "'pl nº ' || i || '-25'",
        "'Praça dos Três Poderes - ' || line",
        "line || ' Aßinado eletronicamente'",
        "'PL ' || i || '/2025 ' || line",
    ],
    si.sql_boilerplate("line"),
)


def annex_title_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, line = F.col("i"), F.col("line")
    plain = F.replace(line, F.lit("ß"), F.lit("ss"))  # the engines differ on upper('ß')
    variants = [
        line,
        F.concat(F.lit("ANEXO "), i),
        F.concat(F.lit("ANEXO II - TABELA "), i),
        F.concat(F.lit("ANEXO III - "), F.upper(plain)),
        F.concat(F.lit("ANEXO: "), line),
        F.concat(F.lit("ANEXO ÚNICO "), i),
        F.concat(F.lit("Anexo "), i),
        F.concat(F.lit("ANEXO IV – "), i, F.lit(".")),
        F.concat(F.lit("ANEXO V: "), F.upper(F.substring_index(plain, " ", 3))),
    ]
    return _flags(spark, sf_dir, variants, lf.is_annex_title)


ANNEX_TITLE_SQL = _flags_sql(
    [
        "line",
        "'ANEXO ' || i",
        "'ANEXO II - TABELA ' || i",
        "'ANEXO III - ' || upper(replace(line, 'ß', 'ss'))",
        "'ANEXO: ' || line",
        "'ANEXO ÚNICO ' || i",
        "'Anexo ' || i",
        "'ANEXO IV – ' || i || '.'",
        "'ANEXO V: ' || upper(array_to_string(string_split(replace(line, 'ß', 'ss'), ' ')[1:3], ' '))",
    ],
    si.sql_annex_title("line"),
)


# --- documents -------------------------------------------------------------------


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.repeated_lines(si.lines(spark, sf_dir), si.pages(spark, sf_dir))


def annex_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.annex_start(si.lines(spark, sf_dir), si.pages(spark, sf_dir))


def annex_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = si.lines(spark, sf_dir)
    return op.cut_annex(lines, op.annex_start(lines, si.pages(spark, sf_dir))).select("doc_id", "page_no", "line_no", "line")


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = op.clean_lines(si.lines(spark, sf_dir), si.pages(spark, sf_dir))
    return kept.select("doc_id", "page_no", "line_no", "line")


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_text(si.lines(spark, sf_dir), si.pages(spark, sf_dir))


def clean_text_without_annex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_text(si.lines(spark, sf_dir), si.pages(spark, sf_dir), remove_annex=True)


def attach_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = op.clean_text(si.lines(spark, sf_dir), si.pages(spark, sf_dir))
    return op.attach_clean_text(si.bills(spark, sf_dir), texts).select("id", "textoInteiroTeorLimpo")


ENTRIES = {
    "word_frequency": (word_frequency, WORD_FREQUENCY_SQL),
    "tokenize": (tokenize, TOKENIZE_SQL),
    "stopword_filter": (stopword_filter, STOPWORD_FILTER_SQL),
    "stopword_table": (stopword_table, STOPWORD_TABLE_SQL),
    "explode_lines": (explode_lines, EXPLODE_LINES_SQL),
    "normalize_line": (normalize_line, NORMALIZE_LINE_SQL),
    "page_number_flag": (page_number_flag, PAGE_NUMBER_SQL),
    "boilerplate_flag": (boilerplate_flag, BOILERPLATE_SQL),
    "annex_title_flag": (annex_title_flag, ANNEX_TITLE_SQL),
    "repeated_lines": (repeated_lines, f"WITH {si.LINES} SELECT doc_id, line, top_rep, bot_rep FROM repeated"),
    "annex_start": (annex_start, f"WITH {si.LINES} SELECT doc_id, annex_start FROM starts"),
    "annex_cut": (
        annex_cut,
        f"WITH {si.LINES} SELECT l.doc_id, l.page_no, l.line_no, l.line FROM lines l LEFT JOIN starts s"
        " ON s.doc_id = l.doc_id WHERE s.annex_start IS NULL OR l.page_no < s.annex_start",
    ),
    "clean_lines": (clean_lines, f"WITH {si.LINES} SELECT doc_id, page_no, line_no, line FROM kept"),
    "clean_text": (clean_text, f"WITH {si.LINES}, {si.sql_texts('kept')} SELECT doc_id, clean_text FROM texts"),
    "clean_text_without_annex": (
        clean_text_without_annex,
        f"WITH {si.LINES}, {si.sql_texts('kept_before_annex')} SELECT doc_id, clean_text FROM texts",
    ),
    "attach_clean_text": (
        attach_clean_text,
        f"WITH {si.BILLS}, {si.LINES}, {si.sql_texts('kept')} SELECT id, CASE WHEN \"urlInteiroTeor\" IS NOT NULL"
        ' THEN clean_text END AS "textoInteiroTeorLimpo" FROM bills LEFT JOIN texts ON doc_id = id',
    ),
}
