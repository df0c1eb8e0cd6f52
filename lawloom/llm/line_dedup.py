"""Line deduplication: lines found in many documents stay in one of them only.

Lines are exploded, normalised (white space stripped at both ends, A-Z lower-cased) and
hashed; distinct documents are counted per hash in two steps, (hash, document) before
hash, so that a line of a third of all documents is counted in parts; documents are put
together again by position. Only hashes and positions of long lines are shuffled for
that, then each text once.

Defined results: a null or empty text is one empty line; rows with a null id count as
one document, below all others; rows equal in id and text have equal results; all lines
of the document that keeps a line stay, repeats included; a document may end up empty;
an empty table gives an empty result; extra columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import WHITE, bind, fold_ascii, key_hashes, row_key, text_or_empty


def line_key(line: Column) -> Column:
    return fold_ascii(F.btrim(line, F.lit(WHITE)))


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row, pos, h1, h2) of the lines whose key is long enough."""
    # named before the explode: beside it, the name would be computed for every line
    named = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    lines = named.select(
        "doc_id", "row", F.posexplode(F.split(text_or_empty("text"), "\n")).alias("pos", "line")
    ).filter(F.length("line") >= min_chars)
    keyed = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    h1, h2 = key_hashes(F.col("key"))
    return keyed.filter(F.length("key") >= min_chars).select("doc_id", "row", "pos", h1.alias("h1"), h2.alias("h2"))


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(h1, h2, n_docs, keeper): keys found in at least `min_docs` documents, and the largest id."""
    return (
        _long_lines(docs, min_chars)
        .groupBy("h1", "h2", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
    )


def _without(lines: Column, dropped: Column) -> Column:
    """The lines less those at the sorted positions, as the stretches between them: linear."""

    def cut(parts: Column) -> Column:
        lines, dropped = parts["lines"], parts["dropped"]
        starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
        ends = F.concat(dropped, F.array(F.size(lines)))
        return F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 1, e - s)))

    return bind(F.struct(lines.alias("lines"), dropped.alias("dropped")), cut)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with `text` rewritten, plus `n_lines` and `n_dropped` (replaced if there)."""
    docs = docs.drop("n_lines", "n_dropped")
    base = docs.select("doc_id", "text")
    dropped = (
        _long_lines(base, min_chars)
        .join(repeated_lines(base, min_chars, min_docs), ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("row").alias("_line_row"))
        .agg(F.sort_array(F.collect_set("pos")).alias("_line_dropped"))
    )
    whole = docs.withColumn("_line_key", row_key(F.col("doc_id"), F.col("text")))
    joined = whole.join(dropped, F.col("_line_key") == F.col("_line_row"), "left")
    lines = F.split(text_or_empty("text"), "\n")
    kept = F.when(F.col("_line_dropped").isNull(), text_or_empty("text")).otherwise(
        F.array_join(_without(lines, F.col("_line_dropped")), "\n")
    )
    n_lines = (F.length(text_or_empty("text")) - F.length(F.translate(text_or_empty("text"), "\n", "")) + 1).cast("long")
    n_dropped = F.coalesce(F.size("_line_dropped"), F.lit(0)).cast("long")
    return joined.select(
        *[kept.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        n_lines.alias("n_lines"),
        n_dropped.alias("n_dropped"),
    )
