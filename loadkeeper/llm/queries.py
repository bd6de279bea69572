"""The operators of this package over the sample tables. Each query takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkeeper.llm import bpe, katz, leaks, licenses, lines, pii, resample, rules, simhash, sketch, spelling, toxicity, urls
from loadkeeper.llm.oracles import SQL
from loadkeeper.llm.shared import table

__all__ = ["QUERIES", "SQL"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def sha256(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


def tokenizer() -> tuple[str, str]:
    """The rank file and the pattern of the installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op1_byte_bpe(spark, folder):
    path, pattern = tokenizer()
    coded = table(spark, folder, "documents").select("doc_id", bpe.encode(F.col("text"), path, pattern).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256(bpe.decode(F.col("ids"), path)).alias("decoded_sha256"),
    )


@query
def op2_fingerprints(spark, folder):
    rows = sketch.edited(table(spark, folder, "documents").select("doc_id", "text"))
    rows = rows.select("*", sketch.sketch(F.col("text")).alias("own"), sketch.sketch(F.col("edited")).alias("other"))
    own, other, following = F.col("own"), F.col("other"), F.col("next_sketch")
    return rows.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        sha256(F.col("edited")).alias("edited_sha256"),
        sketch.as_text(own).alias("fingerprint"),
        sketch.as_text(other).alias("edited_fingerprint"),
        sketch.resemblance(own, other).alias("near_edited"),
        sketch.resemblance(own, following).alias("near_next"),
        sketch.containment(own, other).alias("kept_share"),
        sketch.distinct_shingles(own).alias("n_shingles"),
    )


@query
def op4_simhash_dedup(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op6_personal_data(spark, folder):
    found = table(spark, folder, "documents").select("doc_id", pii.find(F.col("text")).alias("found"))
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE))
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, sha256(listed(base)).alias("base_sha256"), listed(F.col("found")).alias("spans"))


@query
def op10_licenses(spark, folder):
    ids = table(spark, folder, "documents").select("doc_id", licenses.sentence_ids(F.col("text")).alias("ids"))
    return ids.select(
        "doc_id",
        F.array_join("ids", ",").alias("sentences"),
        F.array_join(licenses.licences(F.col("ids")), ",").alias("licences"),
        F.size(F.filter("ids", lambda i: i == licenses.UNKNOWN)).cast("bigint").alias("n_unknown"),
    )


@query
def op7_toxicity(spark, folder):
    labels = table(spark, folder, "labels")
    rows = toxicity.scored(table(spark, folder, "documents"), labels).select("doc_id", "held_out", "score")
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op9_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lengths = docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint").alias("n_lines"))
    rows = lengths.join(lines.drops(docs), "doc_id", "left")
    places = F.transform(F.coalesce("gone", F.array().cast("array<struct<place:int,line:bigint>>")), lambda g: g["place"])
    return rows.select("doc_id", "n_lines", F.size(places).cast("bigint").alias("n_dropped"), F.array_join(places.cast("array<string>"), ",").alias("dropped"))


#: The rules of the page filter.
PAGE_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@query
def op3_url_filter(spark, folder):
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), PAGE_RULES)


@query
def op5_decontamination(spark, folder):
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_language_model(spark, folder):
    return katz.score(table(spark, folder, "documents").select("doc_id", "text"), katz.learned_rows)


@query
def op11_spelling_variants(spark, folder):
    return spelling.variants(table(spark, folder, "documents"))


@query
def op12_quality_rules(spark, folder):
    counts = table(spark, folder, "documents").select("doc_id", rules.measures(F.col("text")).alias("counts"))
    judged = counts.select("doc_id", "counts.*", rules.failed(F.col("counts")).alias("failed"))
    base = F.arrays_overlap("failed", F.array(*map(F.lit, rules.BASE)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (F.size("failed") == 0).alias("kept"), F.array_join("failed", ",").alias("failed"),
    )


@query
def op13_resampling(spark, folder):
    return resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
