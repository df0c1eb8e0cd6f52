"""Page lines to clean text.

Input tables: `lines(doc_id, page_no, page_height, line_no, y0, line)` with one row
per text line, and `pages(doc_id, page_no, page_height)` with one row per page,
empty pages included. `page_no` counts from 0.

How the work is spread:

* Rules that look at one line run before any shuffle.
* Only lines in a page's top or bottom region are counted for repetition, first by
  (doc, line, page), then by (doc, line), so that neither a long document nor a
  header that is on every page piles up in one task.
* Repeated lines are taken out by a join on (doc, line): one row per key on their side,
  so the lines of a header that is on every page can be split over tasks. The work is
  linear in the lines of a page.
* Lines then move by (doc, page); a page is the largest group collected. The cleaned
  pages move by document to become its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import rules
from lawloom.functions.text import (
    drop_leaders,
    is_annex_title,
    is_boilerplate,
    is_page_number,
    null_if_blank,
    split_collapsed_lines,
)


def in_top(fraction: float = rules.TOP_FRACTION) -> Column:
    return F.col("y0") <= F.col("page_height") * F.lit(fraction)


def in_bottom(fraction: float = rules.BOTTOM_FRACTION) -> Column:
    return F.col("y0") >= F.col("page_height") * (F.lit(1) - F.lit(fraction))


def explode_lines(blocks: DataFrame, text_column: str = "text", position: str = "line_in_block") -> DataFrame:
    """Split the text of each block into normalised lines; empty lines are dropped.

    All other columns are kept, so a line has the coordinates of its block. The
    expensive patterns run on the whole text before the explode: what comes after it
    is a cheap trim, so filters pushed down onto `line` repeat no pattern.
    """
    others = [c for c in blocks.columns if c != text_column]
    spaced = blocks.select(*others, drop_leaders(F.col(text_column)).alias("_text"))
    split = spaced.select(*others, F.posexplode(split_collapsed_lines(F.col("_text"))).alias(position, "_line"))
    return split.select(*others, position, F.trim("_line").alias("line")).filter(F.col("line") != "")


def page_counts(pages: DataFrame) -> DataFrame:
    """(doc_id, n_pages)"""
    return pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"))


def repeated_lines(
    lines: DataFrame,
    pages: DataFrame,
    top_fraction: float = rules.TOP_FRACTION,
    bottom_fraction: float = rules.BOTTOM_FRACTION,
    ratio: tuple[int, int] = rules.REPEAT_RATIO,
    min_pages: int = 1,
) -> DataFrame:
    """(doc_id, line, top_rep, bot_rep): running headers and footers.

    A line repeats at the top (bottom) when the number of pages that have it there
    reaches `ratio` of all pages. Page numbers count at the bottom only. Documents
    with fewer than `min_pages` pages have no repeated lines.
    """
    part, whole = ratio
    top = in_top(top_fraction) & ~is_page_number(F.col("line"))
    bottom = in_bottom(bottom_fraction)
    region = lines.filter(in_top(top_fraction) | bottom).select(
        "doc_id", "line", "page_no", top.cast("int").alias("top"), bottom.cast("int").alias("bottom")
    )
    per_page = region.groupBy("doc_id", "line", "page_no").agg(
        F.max("top").alias("top"), F.max("bottom").alias("bottom")
    )
    per_line = per_page.groupBy("doc_id", "line").agg(
        F.sum("top").alias("top"), F.sum("bottom").alias("bottom"), F.max("page_no").alias("last_page")
    )
    # A document has at least last_page + 1 pages, so lines below this bound cannot
    # repeat. It drops nearly everything before the page total is joined.
    candidates = per_line.filter(F.greatest("top", "bottom") * whole >= (F.col("last_page") + 1) * part)
    counted = candidates.join(page_counts(pages).filter(F.col("n_pages") >= min_pages), "doc_id")
    needed = F.col("n_pages") * part
    return counted.select(
        "doc_id",
        "line",
        (F.col("top") * whole >= needed).alias("top_rep"),
        (F.col("bottom") * whole >= needed).alias("bot_rep"),
    ).filter("top_rep OR bot_rep")


def annex_start(
    lines: DataFrame,
    pages: DataFrame,
    top_fraction: float = rules.ANNEX_TOP_FRACTION,
) -> DataFrame:
    """(doc_id, annex_start): last page with an annex title near its top.

    Only documents where that page is in the second half have a row.
    """
    titled = lines.filter(in_top(top_fraction) & is_annex_title(F.col("line")))
    last = titled.groupBy("doc_id").agg(F.max("page_no").alias("annex_start"))
    kept = last.join(page_counts(pages), "doc_id").filter(F.expr("annex_start >= n_pages div 2"))
    return kept.select("doc_id", F.col("annex_start").cast("int").alias("annex_start"))


def cut_annex(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Drop the rows (lines or pages) at or after the annex start of their document."""
    begins = starts.select(F.col("doc_id").alias("_doc"), F.col("annex_start").alias("_start"))
    return rows.join(begins, (F.col("doc_id") == F.col("_doc")) & (F.col("page_no") >= F.col("_start")), "left_anti")


def clean_lines(
    lines: DataFrame,
    pages: DataFrame,
    remove_annex: bool = False,
    top_fraction: float = rules.TOP_FRACTION,
    bottom_fraction: float = rules.BOTTOM_FRACTION,
    annex_top_fraction: float = rules.ANNEX_TOP_FRACTION,
    ratio: tuple[int, int] = rules.REPEAT_RATIO,
    min_pages: int = 1,
    boilerplate: Column | None = None,
) -> DataFrame:
    """The lines that remain after all removal rules.

    A line goes when it is boilerplate, repeats in its region, is a page number in
    either region, or (with `remove_annex`) is on or after the annex start.
    `boilerplate` replaces the default test on column `line`.
    """
    line = F.col("line")
    if boilerplate is None:
        boilerplate = is_boilerplate(line)
    top, bottom = in_top(top_fraction), in_bottom(bottom_fraction)

    repeated = repeated_lines(lines, pages, top_fraction, bottom_fraction, ratio, min_pages)
    starts = annex_start(lines, pages, annex_top_fraction) if remove_annex else None

    own = lines.filter(~boilerplate & ~((top | bottom) & is_page_number(line)))
    again = repeated.select(F.col("doc_id").alias("_doc"), F.col("line").alias("_line"), "top_rep", "bot_rep")
    in_its_region = (top & F.col("top_rep")) | (bottom & F.col("bot_rep"))
    kept = own.join(again, (F.col("doc_id") == F.col("_doc")) & (line == F.col("_line")) & in_its_region, "left_anti")
    return kept if starts is None else cut_annex(kept, starts)


def assemble_text(kept: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, clean_text): lines joined by spaces, pages by newlines.

    Every document of `pages` has a row; the text is null when nothing is left.
    """
    by_page = kept.groupBy("doc_id", "page_no").agg(
        F.expr("trim(listagg(line, ' ') WITHIN GROUP (ORDER BY line_no))").alias("page_text")
    )
    by_doc = (
        by_page.filter(F.col("page_text") != "")
        .groupBy("doc_id")
        .agg(F.expr("listagg(page_text, '\\n') WITHIN GROUP (ORDER BY page_no)").alias("clean_text"))
    )
    documents = page_counts(pages).select("doc_id")
    return documents.join(by_doc.withColumn("clean_text", null_if_blank(F.col("clean_text"))), "doc_id", "left")


def clean_text(lines: DataFrame, pages: DataFrame, remove_annex: bool = False, **rule: object) -> DataFrame:
    """(doc_id, clean_text) of every document; takes the arguments of `clean_lines`."""
    return assemble_text(clean_lines(lines, pages, remove_annex, **rule), pages)


def attach_clean_text(bills: DataFrame, texts: DataFrame, column: str = "textoInteiroTeorLimpo") -> DataFrame:
    """Add the clean text to every bill; null without a document or without a URL."""
    texts = texts.select(F.col("doc_id").alias("id"), F.col("clean_text").alias("_text"))
    joined = bills.join(texts, "id", "left")
    has_url = null_if_blank(F.col("urlInteiroTeor")).isNotNull()
    return joined.withColumn(column, F.when(has_url, F.col("_text"))).drop("_text")
