"""Quality rules with cross-document line frequency per host.

Normalised lines are hashed and their distinct documents counted per host; lines found
in more than `max_docs` documents of the host are taken out, and a document of which
less than `min_share` of the words is left is depleted and rejected. Counting goes from
(host, line, document) to (host, line), so one host or one line with a third of all rows
is still counted in parts. Line hashes are computed once and staged; texts are never
shuffled.

Defined results: a null text has no words and fails the base rule; a null host is a host
of its own; rows equal in id, text and host are one document; an empty table gives an
empty result; only doc_id, text and the host column are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import (
    WHITE,
    WORD_PATTERN,
    bind,
    fold_ascii,
    key_hashes,
    row_key,
    staged,
    text_or_empty,
    word_count,
    words,
)

SYMBOLS = "#*$%&|<>"


def symbol_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def repeated_line_count(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    with_word = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    return bind(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_window_words(all_words: Column, window: int = 3) -> Column:
    """Words covered by windows of `window` words that the text holds at least twice.

    Window hashes are sorted with their positions, so that equal ones are neighbours.
    """

    def covered(starts: Column) -> Column:
        # each start covers `window` words, less what the next start covers again
        following = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(1 << 30)))
        steps = F.zip_with(starts, following, lambda a, b: F.least(F.lit(window), b - a))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeats(hashes: Column) -> Column:
        def starts(ordered: Column) -> Column:
            # an entry is repeated if it equals the one before or the one after
            n = F.size(ordered)
            nothing = F.struct(F.lit(None).cast("long").alias("h"), F.lit(-1).alias("p"))
            earlier = F.concat(F.array(nothing), F.slice(ordered, 1, F.greatest(n - 1, F.lit(0))))
            later = F.concat(F.slice(ordered, 2, F.greatest(n - 1, F.lit(0))), F.array(nothing))
            after = F.zip_with(ordered, later, lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False)))
            before = F.zip_with(ordered, earlier, lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False)))
            hit = F.zip_with(before, after, lambda x, y: x | y)
            return F.sort_array(
                F.transform(
                    F.filter(F.arrays_zip(ordered.alias("entry"), hit.alias("hit")), lambda z: z["hit"]),
                    lambda z: z["entry"]["p"],
                )
            )

        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        several = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(several, bind(bind(F.sort_array(placed), starts), covered)).otherwise(0)

    def hashed(w: Column) -> Column:
        last = F.size(w) - window
        positions = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
        hashes = F.transform(positions, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return F.when(last >= 0, bind(hashes, repeats)).otherwise(0)

    return bind(all_words, hashed).cast("long")


def base_measures(docs: DataFrame) -> DataFrame:
    """Every document with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text_or_empty("text")
    measured = docs.select(
        "*",
        word_count(text).alias("n_words"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        symbol_count(text).alias("n_symbols"),
        repeated_line_count(text).alias("n_dup_lines"),
        repeated_window_words(words(text)).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def normalised_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """(row, pos, host, h1, h2, n) for the lines that have words; n: their words."""
    # named before the explode: beside it, the name would be computed for every line
    named = docs.select(row_key(F.col("doc_id"), F.col("text"), F.col(host)).alias("row"), F.col(host).alias("host"), "text")
    lines = named.select("row", "host", F.posexplode(F.split(text_or_empty("text"), "\n")).alias("pos", "line"))
    key = fold_ascii(F.btrim(F.regexp_replace("line", r"[\x20\x09-\x0D]+", " ")))
    h1, h2 = key_hashes(F.col("key"))
    keyed = lines.select(
        "row", "pos", "host", F.regexp_count("line", F.lit(WORD_PATTERN)).alias("n"), key.alias("key")
    )
    return keyed.filter(F.col("n") > 0).select("row", "pos", "host", h1.alias("h1"), h2.alias("h2"), "n")


def frequent_lines(lines: DataFrame, max_docs: int = 50) -> DataFrame:
    """(host, h1, h2, n_docs) of the normalised lines found in more than `max_docs` documents of their host."""
    return (
        lines.groupBy("host", "h1", "h2", "row")
        .agg(F.lit(1).alias("one"))
        .groupBy("host", "h1", "h2")
        .agg(F.count("one").alias("n_docs"))
        .filter(F.col("n_docs") > max_docs)
    )


def judge_documents(
    docs: DataFrame, host: str = "source", max_docs: int = 50, min_share: float = 0.5
) -> DataFrame:
    """(doc_id, base measures, words_removed, kept) for every document.

    kept: the base rule holds, and at least `min_share` of the words is left.
    """
    base = docs.select("doc_id", "text", F.col(host).alias("host"))
    hashed = staged(normalised_lines(base, "host"), "normalised-lines")
    frequent = frequent_lines(hashed, max_docs).withColumnsRenamed({"host": "f_host", "h1": "f_h1", "h2": "f_h2"})
    # a row that is there twice has each of its lines once
    lines = hashed.groupBy("host", "h1", "h2", "row", "pos").agg(F.max("n").alias("n"))
    same_line = (
        F.col("host").eqNullSafe(F.col("f_host")) & (F.col("h1") == F.col("f_h1")) & (F.col("h2") == F.col("f_h2"))
    )
    removed = (
        lines.join(frequent, same_line)
        .groupBy(F.col("row").alias("lost_row"))
        .agg(F.sum("n").cast("long").alias("words_removed"))
    )
    measured = base_measures(base.withColumn("row", row_key(F.col("doc_id"), F.col("text"), F.col("host")))).drop("text", "host")
    joined = measured.join(removed, F.col("row") == F.col("lost_row"), "left").drop("row", "lost_row")
    lost = F.coalesce(F.col("words_removed"), F.lit(0)).cast("long")
    enough = F.col("n_words") - lost >= F.lit(min_share) * F.col("n_words")
    return joined.withColumn("words_removed", lost).withColumn("kept", ~F.col("base_failed") & enough)
