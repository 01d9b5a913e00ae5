"""Registered queries ``opN_<name>``: each applies its operator, with
production parameters, to the whole of its tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import contamination, crosstok, jaccard, langid, licenses, line_runs, lm, mixing, periodic, repeats, rules, secret_scan, wordpiece
from tallyfold.llm.text import crc_mod
from tallyfold.sources.tables import read_table

VOCABULARY = os.environ.get("TALLYFOLD_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
BYTES = os.environ.get("TALLYFOLD_BYTES", "/opt/tokenizers/byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(documents(spark, sf_dir))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix_sources(docs).drop("text")


def op3_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    automaton = wordpiece.LongestMatch(*wordpiece.sentencepiece_vocabulary(vocabulary))
    return wordpiece.count_pieces(documents(spark, sf_dir), automaton)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, sf_dir))
    kind = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long")
    joined = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))
    return found.select(
        "doc_id",
        *[kind(k).alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    fold = crc_mod("doc_id", 3)
    model = langid.fit_languages(docs.where(fold != 1))
    held = F.coalesce(fold == 1, F.lit(False))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    learned = rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    s = F.col("_tf_stats")
    return rules.judge(docs, learned).select(
        "doc_id",
        *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("_tf_failed").alias("base_failed"),
        F.col("_tf_kept").alias("kept"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(documents(spark, sf_dir)).drop("spans")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_runs.dedupe_lines(documents(spark, sf_dir))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str, byte_vocabulary: str = BYTES, piece_model: str = VOCABULARY) -> DataFrame:
    return crosstok.align_documents(documents(spark, sf_dir), *crosstok.read_vocabularies(byte_vocabulary, piece_model))


def looped(docs: DataFrame) -> DataFrame:
    """The documents with the words of every tenth one (by crc32 of its id)
    from some word on replaced by repeats of the first of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))).alias("w"))
    n = F.size("w").cast("long")
    some = words.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    some = some.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    loop = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(F.col("w"), place(i)))
    return some.select("doc_id", F.when(F.col("n") > 0, F.array_join(loop, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(looped(documents(spark, sf_dir).select("doc_id", "text")))
    # Exact comparison of length / period; of equal ones the first stays.
    more = lambda best, r: best.isNull() | (r.length * best.period > best.length * r.period)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(more(best, r), r).otherwise(best))
    line = lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.floor(1000 * best.length / best.period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_mix_sources,
        op3_token_counts,
        op4_decontamination,
        op5_secret_scan,
        op6_ngram_jaccard,
        op7_language_id,
        op8_quality_rules,
        op9_license_scan,
        op10_substring_dedup,
        op11_line_dedup,
        op12_token_alignment,
        op13_periodic_runs,
    )
}

#: DuckDB SQL of the queries that SQL can express over whole tables.
SQL: dict[str, str] = {
    "op4_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(list_slice(w, i + 1, i + 10), ' ') AS t
       FROM (SELECT *, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, l, array_to_string(list_slice(w, i + 1, i + l), ' ') AS t
       FROM (SELECT doc_id, w, l, unnest(range(greatest(len(w) - l + 1, 0))) AS i FROM d, (SELECT DISTINCT l FROM bw))),
m AS (SELECT DISTINCT doc_id, i, l, t FROM dw SEMI JOIN bw USING (t)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m JOIN bw USING (t)) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op11_line_dedup": r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT doc_id, i, line, top IS NOT NULL AND top <> doc_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
}
