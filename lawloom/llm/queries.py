"""The queries opN_<name> over the given tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm import bpe, importance, periodic_runs
from lawloom.llm import suffix_dedup, ngram_lm, licenses, pii, decontaminate, jaccard_join, line_dedup, mixing, quality, quality_rules
from lawloom.llm.common import crc_fold, table, words


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the rules' spans, and those with the field's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit_field(docs))

    def joined(spans):
        named = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, named), ",")

    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or that of the nearest directory above it.

    The table has no paths; a document's place is source/language/id.
    """
    docs = table(spark, sf_dir, "documents")
    return licenses.scan_licenses(docs.withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learnt from all but the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = ngram_lm.score_documents(docs, crc_fold(F.col("doc_id"), 5) != 1)
    return scored.select(
        "doc_id", (~F.col("in_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that documents with smaller ids have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeats(docs, length=50)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH coded AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), pieces AS MATERIALIZED (
  SELECT doc_id, b, substr(h, CAST(2 * b + 1 AS BIGINT), 226) AS piece, least(64, n - 49 - b) AS k
  FROM (SELECT doc_id, h, n, unnest(range(0, n - 49, 64)) AS b FROM coded WHERE n >= 50)
), starts AS MATERIALIZED (
  SELECT doc_id, b + j AS p, substr(piece, CAST(2 * j + 1 AS BIGINT), 100) AS s FROM pieces JOIN range(64) t(j) ON j < k
), shared AS (
  SELECT s, min(doc_id) AS first FROM starts GROUP BY s HAVING min(doc_id) < max(doc_id)
), marked AS MATERIALIZED (
  SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 AS goes_on
  FROM starts JOIN shared USING (s) WHERE first < doc_id
), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (
    SELECT *, count(*) FILTER (goes_on IS NOT TRUE) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked)
  GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS k, a AS e FROM runs
  UNION ALL SELECT doc_id, coalesce(max(b), 0), any_value(n) FROM coded LEFT JOIN runs USING (doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, CAST(2 * k + 1 AS BIGINT), CAST(2 * (e - k) AS BIGINT)), '' ORDER BY k) AS h
  FROM gaps JOIN coded USING (doc_id) GROUP BY doc_id
), counted AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM coded JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return jaccard_join.near_duplicate_components(table(spark, sf_dir, "documents"), words_per_shingle=3, percent=90)


OP3_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) END AS shingles
  FROM split
), numbered AS MATERIALIZED (
  SELECT min(doc_id) AS first, sorted AS shingles, len(sorted) AS n FROM (SELECT doc_id, list_sort(shingles) AS sorted FROM sets) GROUP BY sorted
), holders AS MATERIALIZED (SELECT first, n, unnest(shingles) AS shingle FROM numbered
), common AS (
  SELECT a.first AS a, b.first AS b, a.n AS n, b.n AS m, count(*) AS met
  FROM holders a JOIN holders b ON a.shingle = b.shingle AND a.first < b.first
    AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common WHERE 100 * met >= 90 * (n + m - met)
  UNION ALL SELECT b, a FROM common WHERE 100 * met >= 90 * (n + m - met)
), reach AS (
  SELECT DISTINCT a AS start, a AS here FROM links
  UNION SELECT start, b FROM reach JOIN links ON here = a
), roots AS (SELECT start, min(here) AS root FROM reach GROUP BY start)
SELECT doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles,
  CASE WHEN len(s.shingles) = 0 THEN doc_id ELSE coalesce(root, first) END AS component_id
FROM sets s JOIN numbered ON list_sort(s.shingles) = numbered.shingles LEFT JOIN roots ON start = first
"""


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with its place and similarity."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt without the labels of the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), 4) == 2
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    scored = quality.score_documents(docs, quality.fit_quality(docs, labels), threshold=0.7)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents at 150 % of their tokens, sources weighing 3, 1, 2 in turn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    counted = mixing.copy_counts(docs)
    return counted.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight
  FROM by_source
), levels AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(weight) OVER () AS all_weight,
    coalesce(sum(cap) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT *, cap * (all_weight - weight_before) <= weight * (budget - cap_before) AS is_full FROM levels
), totals AS (
  SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER () AS full_cap,
    sum(CASE WHEN is_full THEN weight ELSE 0 END) OVER () AS full_weight
  FROM filled
), targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN cap ELSE weight * (budget - full_cap) / (all_weight - full_weight) END AS target
  FROM totals
), rated AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12)) AS BIGINT)
      / 281474976710656.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), counted AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS n FROM rated
)
SELECT doc_id, size, source_size, target, CAST(size * n AS BIGINT) AS taken, CAST(n AS BIGINT) AS copies FROM counted
"""


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document; its source is the host."""
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"), host="source")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "words_removed",
    )


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d
), worded AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id
), frequent AS (
  SELECT source, key FROM worded GROUP BY source, key HAVING count(DISTINCT doc_id) > 50
), removed AS (
  SELECT doc_id, sum(n) AS words_removed
  FROM worded JOIN frequent ON worded.key = frequent.key AND worded.source IS NOT DISTINCT FROM frequent.source
  GROUP BY doc_id
), starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
    unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS gram
  FROM d WHERE len(w) >= 3
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM starts
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE times >= 2) GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(words_removed, 0) AS BIGINT) AS words_removed
  FROM d LEFT JOIN dup_lines USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - words_removed >= 0.5::DOUBLE * n_words AS kept, words_removed
FROM failed
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more in 5 documents or more stay in the largest id only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents with 20 words or more, drawn to be like the benchmark's texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark").select("text"))


_CRC_TABLE = r"""steps AS (
  SELECT i, list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256) t(i)
), crc_table AS (SELECT list(c ORDER BY i) AS tab FROM steps)"""


def _sql_crc32(value: str) -> str:
    """Unsigned crc32 of a text, with the list `tab` of _CRC_TABLE in scope."""
    byte = f"CAST('0x' || substr(hex({value}), k, 2) AS BIGINT)"
    bytes_ = f"list_transform(range(1, length(hex({value})), 2), lambda k: {byte})"
    step = "xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {bytes_}), lambda c, b: {step}))"


OP11_SQL = rf"""
WITH {_CRC_TABLE},
texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark
), split AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), occurrences AS (
  SELECT side, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS feature
  FROM split
), counted AS (SELECT side, doc_id, feature, count(*) AS n FROM occurrences GROUP BY ALL),
hashed AS (
  SELECT feature, {_sql_crc32("feature")} % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), crc_table
), placed AS (SELECT * FROM counted JOIN hashed USING (feature)),
by_bucket AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM placed GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM by_bucket
), weighed AS (
  SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS total
  FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT split.doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    CAST(coalesce((total - (total % n_features + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
    CAST(('0x' || substr(sha256('7:' || CAST(split.doc_id AS VARCHAR)), 1, 8)) AS BIGINT) AS h
  FROM split LEFT JOIN weighed USING (doc_id) WHERE side = 'd'
), noised AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
), places AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS wanted
  FROM noised WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN CAST(place AS BIGINT) END AS rank
FROM noised LEFT JOIN places USING (doc_id)
"""


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document, by crc32 of its id (a null id counts as ''), gets a tail that repeats itself."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    split = docs.select("doc_id", "text", F.when(hashed % 10 == 0, words(F.col("text"))).alias("_words"), F.floor(hashed / 10).alias("_g"))
    placed = split.withColumn("_n", F.size("_words")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    placed = placed.withColumn("_p", F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)) + 1)
    tail = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_n") - F.col("_a") - 1),
        lambda k: F.get("_words", (F.col("_a") + k % F.col("_p")).cast("int")),
    )
    changed = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a").cast("int")), tail), " ")
    return placed.select("doc_id", F.when(F.col("_n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, tails planted in every tenth, and the text without repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(with_periodic_tails(docs))
    listed = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    longest = F.array_min(ranked)
    length, period = -longest["shorter"], longest["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP12_SQL = rf"""
WITH {_CRC_TABLE}, split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_sql_crc32("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents, crc_table
), tails AS (
  SELECT doc_id, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a
  FROM split
), original AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM split
), changed AS MATERIALIZED (
  SELECT r.doc_id, r.i, s.word FROM original r JOIN tails t ON r.doc_id = t.doc_id JOIN original s ON s.doc_id = r.doc_id
    AND s.i = CASE WHEN planted AND r.i >= a THEN a + (r.i - a) % (1 + (n - a) // (3 + g % 8)) ELSE r.i END
), grams AS (
  SELECT doc_id, i, word || ' ' || lead(word) OVER d || ' ' || lead(word, 2) OVER d || ' ' || lead(word, 3) OVER d
    || ' ' || lead(word, 4) OVER d AS gram
  FROM changed WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i
), islands AS MATERIALIZED (
  SELECT doc_id, q, min(i) AS start, max(i) + 5 + q - min(i) AS length FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island
), long AS MATERIALIZED (SELECT * FROM islands WHERE length >= greatest(6, 4 * q)
), runs AS MATERIALIZED (
  SELECT * FROM long r WHERE NOT EXISTS (
    SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines,
    list({{'start': start, 'length': length, 'q': q}} ORDER BY length DESC, start, q)[1] AS best
  FROM runs GROUP BY doc_id
), dropped AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs
), collapsed AS (
  SELECT c.doc_id, string_agg(word, ' ' ORDER BY c.i) AS text
  FROM changed c LEFT JOIN dropped d ON d.doc_id = c.doc_id AND d.i = c.i WHERE d.i IS NULL GROUP BY c.doc_id
)
SELECT split.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start,
  CAST(best.length AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
  CAST(1000 * best.length // best.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed.text, '')) AS collapsed_sha256
FROM split LEFT JOIN listed ON listed.doc_id = split.doc_id LEFT JOIN collapsed ON collapsed.doc_id = split.doc_id
"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the text they decode to."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_documents(docs, bpe.ByteBPE.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


ENTRIES = {
    "op6_suffix_dedup": (op6_suffix_dedup, OP6_SQL),
    "op2_lm_scoring": (op2_lm_scoring, None),
    "op8_license_scan": (op8_license_scan, None),
    "op1_personal_data": (op1_personal_data, None),
    "op3_ngram_jaccard_join": (op3_ngram_jaccard_join, OP3_SQL),
    "op4_benchmark_decontamination": (op4_benchmark_decontamination, None),
    "op5_quality_classifier": (op5_quality_classifier, None),
    "op7_mix_sources": (op7_mix_sources, OP7_SQL),
    "op9_quality_rules": (op9_quality_rules, OP9_SQL),
    "op10_line_dedup": (op10_line_dedup, OP10_SQL),
    "op11_importance_resampling": (op11_importance_resampling, OP11_SQL),
    "op12_periodic_runs": (op12_periodic_runs, OP12_SQL),
    "op13_byte_bpe": (op13_byte_bpe, None),
}
