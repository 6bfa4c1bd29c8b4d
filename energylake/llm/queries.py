"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from zlib import crc32

import public_tokenizers
from pyspark.sql import functions as F

from energylake.llm import (
    backoff_lm, decontamination, hard_negatives, language, line_dedup, multi_index, periodic_runs, pii, quality,
    secret_scan, sentencepiece_bpe, simhash, sql, toxicity)
from energylake.llm.common import joined_spans, key_remainder, sha256_text
from energylake.llm.registry import query
from energylake.queries.registry import table


def held_out(frame):
    """Adds held_out: the key's crc32 modulo 3 is 1; false for a null key."""
    return frame.withColumn("held_out", F.coalesce(key_remainder(F.col("doc_id")) == 1, F.lit(False)))


@query()
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return held_out(language.predict(docs, language.train(docs))).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query()
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return held_out(toxicity.score(docs, model)).select("doc_id", "held_out", "score", "predicted")


@query()
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return held_out(quality.score(docs, model)).select("doc_id", "held_out", "score", "predicted")


@query(sql.DECONTAMINATION)
def op2_decontamination(spark, sf_dir):
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        sha256_text(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


@query()
def op6_sentencepiece(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), path)
    return sentencepiece_bpe.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256_text(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256_text(F.col("decoded")).alias("decoded_sha256"))


@query()
def op1_multi_index(spark, sf_dir):
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query(sql.LINES)
def op3_line_dedup(spark, sf_dir):
    return line_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_removed", F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("removed"), "text")


def span_report(found, kinds, *more):
    """Counts and digest of the base kinds, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in kinds]
    return found.select("doc_id", *counts, sha256_text(joined_spans(base)).alias("base_sha256"),
                        joined_spans(F.col("spans")).alias("spans"), *more)


@query(sql.SECRETS)
def op4_secrets(spark, sf_dir):
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return span_report(found, [r.kind for r in secret_scan.BASE_RULES])


@query(sql.PII)
def op5_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return span_report(found, [k.name for k in pii.BASE_KINDS])


@query()
def op5_pii_scores(spark, sf_dir):
    """As op5_pii, with the score of each span in the order of the spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    scores = F.transform("spans", lambda s: F.format_number(s["score"], 2))
    return span_report(found, [k.name for k in pii.BASE_KINDS], F.array_join(scores, ",").alias("scores"))


@query()
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def repeated_tail(key, words):
    """The words, of every tenth key (by hash) with a periodic tail."""
    h, n = crc32(str(key).encode()), len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


@query()
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail)
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n"))), "")
    found = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    length = -F.col("best.minus")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        length.alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        sha256_text(lines).alias("runs_sha256"), sha256_text(F.col("collapsed")).alias("collapsed_sha256"))


@query(sql.HARD_NEGATIVES)
def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


@query(sql.LANGUAGE_MODEL)
def op13_language_model(spark, sf_dir):
    held = F.coalesce(key_remainder(F.col("doc_id"), 10) == 0, F.lit(False))
    learn = F.coalesce(key_remainder(F.col("id"), 10) != 0, F.lit(True))
    scored = backoff_lm.score_texts(table(spark, sf_dir, "documents"), learn)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))
