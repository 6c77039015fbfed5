"""The registered queries: one for each operator, over its whole table, with the parameters of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch
from . import bpe, collocations, decontaminate, language, periodic, pii, pitmanyor, quality, simhash, sql, substrings, suffixdedup, tokens, warc
from .texts import documents, read_file, table, tokenizer_path


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixdedup.dedup(documents(spark, sf_dir), length=400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.token_counts(documents(spark, sf_dir), read_file(tokenizer_path("byte_bpe_50k.json")))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.groups(documents(spark, sf_dir), shingle=3, radius=2)
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang").withColumn("held_out", language.held_out())
    model = language.fit(docs.where("not held_out"), tokenizer_path("piece_bpe_32k.model"))
    return language.predict(docs, model, keep=["doc_id", "held_out"])


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    pages = warc.record_types(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    index = cut_lineage(warc.write_archives(pages, folder))
    return warc.with_responses(cut_lineage(warc.page_table(warc.read_records(index, folder))))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.learn(docs), keep=["doc_id"])
    counts = [pii.count_of("base", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = read_file(tokenizer_path("byte_bpe_50k.json"))
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir), vocabulary, keep=["doc_id"]), ["doc_id"])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.dedup(documents(spark, sf_dir), length=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir, "lang", "source"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", pitmanyor.held_out())
    return pitmanyor.score(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(periodic.echoed(documents(spark, sf_dir)), keep=["doc_id"]).withColumn("best", periodic.strongest(F.col("runs")))
    start, length, period = (F.col(f"best.{c}").cast("long") for c in ("start", "length", "period"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("cast(best.length as bigint) * 1000 div best.period").alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_simhash": op3_simhash,
    "op4_language_id": op4_language_id,
    "op5_warc_archive": op5_warc_archive,
    "op6_pii": op6_pii,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_decontamination": op8_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": sql.BYTE_DEDUP,
    "op5_warc_archive": """
with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as digest from pages),
     g as (select digest, max(page_id) as largest from p where n >= 1000 group by digest)
select page_id, n as payload_bytes, p.digest as payload_digest,
       case when largest is not null and page_id is distinct from largest then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from largest then largest end as refers_to
from p left join g on p.digest = g.digest""",
    "op8_decontamination": decontaminate.SQL,
    "op9_substring_dedup": sql.WORD_DEDUP,
    "op10_quality_rules": quality.SQL,
    "op12_periodic_runs": periodic.checking_sql(),
    "op13_collocations": collocations.SQL,
}
