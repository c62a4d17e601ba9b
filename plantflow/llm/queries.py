"""The text operators as queries over the sample tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantflow.llm import alignment, bpe_codec, common, decontamination, html_extraction, language_id, language_model, license_scan, line_dedup, periodic_runs, quality_ledger, simhash_dedup, token_counts, token_files

Query = Callable[[SparkSession, str], DataFrame]


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(common.table(spark, sf_dir, "pages"))


def codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    decoded = bpe_codec.decode(bpe_codec.encode(docs, keep=["doc_id"]))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return quality_ledger.verdicts(common.table(spark, sf_dir, "documents")).select(*columns)


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.dedup(common.table(spark, sf_dir, "documents"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(common.table(spark, sf_dir, "documents"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(common.table(spark, sf_dir, "documents"), keep=["doc_id"])


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.scan(common.table(spark, sf_dir, "documents"), short_lines=True)


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (common.table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = decontamination.search(docs, items, keep=["doc_id"]).withColumn("n_hit", decontamination.n_hit())
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>"))), 256).alias("items_sha256"),
        decontamination.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(common.table(spark, sf_dir, "documents"))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(common.table(spark, sf_dir, "documents"), keep=["doc_id"])
    digest = F.when(F.col("n_groups") == 0, F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    documents = found.documents.select("block", "row", "doc_id", *alignment.COUNTS, digest.alias("groups_sha256"))
    return alignment.scored(found, documents)


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    return language_model.score(common.table(spark, sf_dir, "documents"), trained, keep=["doc_id"])


def _with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; of one document in ten, by its checksum, the words from some place on repeat with a period."""
    text, h = F.coalesce("text", F.lit("")), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(words):
        n = F.size(words)
        first = (g % n).cast("int")
        period = (F.floor((n - first) / (3 + g % 8)) + 1).cast("int")
        turned = F.transform(words, lambda word, i: F.when(i < first, word).otherwise(words[first + (i - first) % period]))
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(turned, " "))

    words = F.filter(F.split(text, common.WHITE_RUN), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, common.let(words, tail)).otherwise(text).alias("text"))


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(_with_periodic_tails(common.table(spark, sf_dir, "documents")), keep=["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    shown = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(shown.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_html_extraction": pages,
        "op2_byte_bpe": codec,
        "op3_language_id": languages,
        "op4_quality_rules": quality,
        "op5_simhash_dedup": simhash,
        "op6_token_files": files,
        "op7_token_counts": counts,
        "op8_line_dedup": lines,
        "op9_benchmark_decontamination": benchmark_hits,
        "op10_license_scans": licenses,
        "op11_tokenizer_alignment": aligned,
        "op12_language_model": model_scores,
        "op13_periodic_runs": periodic,
        "pipeline": corpus_pipeline.run,
    }


QUALITY_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x09-\x0D\x20]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(words, i, i + 4) AS win
  FROM split, unnest(range(1, len(words) - 3)) AS r(i)),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM counted, unnest([0, 1, 2, 3, 4]) AS d(k) WHERE n >= 2 GROUP BY doc_id),
measured AS (
  SELECT s.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN repeated r ON s.doc_id = r.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_exclamations > n_words OR (n_lines > 3 AND 10 * n_dup_lines > 3 * n_lines)
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM measured"""


DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{common.UPPER}', '{common.UPPER.lower()}'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{common.UPPER}', '{common.UPPER.lower()}'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, list_slice(words, i, i + 12) AS phrase, least(13, len(words)) AS n
  FROM b, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS r(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM phrases),
windows AS (
  SELECT doc_id, i, n, list_slice(words, i, i + n - 1) AS phrase
  FROM d, sizes, unnest(range(1, len(words) - n + 2)) AS r(i)),
found AS (SELECT w.doc_id, w.i, w.n, p.item_id FROM windows w JOIN phrases p ON w.phrase = p.phrase),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM found, unnest(range(0, n)) AS r(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id"""


def _license_sql() -> str:
    templates = ", ".join(
        f"({k}, '{t.label}', [{', '.join(repr(w) for w in sorted(set(license_scan.words_of(t.text))))}])"
        for k, t in enumerate(license_scan.TEMPLATES)
    )
    lowered = f"translate({{}}, '{common.UPPER}', '{common.UPPER.lower()}')"
    words = rf"list_filter(regexp_split_to_array({lowered}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS i, '{label}' AS label FROM split, unnest(range(1, len(words) - {len(p.split()) - 2})) AS r(i) "
        f"WHERE list_slice(words, i, i + {len(p.split()) - 1}) = [{', '.join(map(repr, p.split()))}]"
        for p, label in license_scan.PHRASES
    )
    return rf"""
WITH templates(id, label, words) AS (VALUES {templates}),
split AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS words FROM documents),
places AS ({phrases}),
base AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list_distinct(list(label)) AS labels FROM places GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
blocks AS (SELECT doc_id, list_distinct({words.format("line")}) AS block FROM lines),
matched AS (
  SELECT doc_id, label, len(list_intersect(block, t.words)) / len(t.words) AS share
  FROM blocks, templates t WHERE len(list_intersect(block, t.words)) >= ceil({license_scan.THRESHOLD} * len(t.words) - 1e-9)),
best AS (SELECT doc_id, max(share) AS share, list_distinct(list(label)) AS labels FROM matched GROUP BY doc_id)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base,
       b.lo::BIGINT AS first_word, b.hi::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(m.share, 0.0) END::DOUBLE AS score
FROM split s LEFT JOIN base b ON s.doc_id = b.doc_id LEFT JOIN best m ON s.doc_id = m.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quality_rules": QUALITY_SQL,
        "op9_benchmark_decontamination": DECONTAMINATION_SQL,
        "op10_license_scans": _license_sql(),
    }
