"""The corpus pipeline: five stages over the documents table, each written as Parquet and read again by the next.

Each stage works on all that the one before kept, and returns the columns of its input; the last returns token ids.
Column names beyond ``doc_id``, ``text``, ``lang`` and ``n_chars`` are the user's, and pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opspark.llm import bpe, decontaminate, language, pii, simhash
from opspark.llm.texts import free_name, read_file, table, tokenizer_path
from opspark.session import cut_lineage

#: A document whose best language has a smaller posterior is rejected.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or text, and those of no clear language. With no labelled row, all are dropped."""
    known = docs.select("text", "lang", "doc_id").where(~language.held_out())
    model = language.fit(known, tokenizer_path("piece_bpe_32k.model"))
    name, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    marked = language.predict(docs, model, lang=name, score=score)
    return marked.where((F.col(name) != "und") & (F.col(score) >= LEAST_SCORE)).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked fingerprints."""
    return simhash.one_of_each(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows the new text."""
    name = free_name(docs, "redacted")
    clean = pii.redact(docs, pii.learn(docs), name=name)
    new = {"text": F.col(name), "n_chars": F.coalesce(F.length(name).cast("long"), F.col("n_chars"))} if "n_chars" in docs.columns else {"text": F.col(name)}
    return clean.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and whether they decode to its text."""
    coded = bpe.round_trip(docs, read_file(tokenizer_path("byte_bpe_50k.json")), keep=["doc_id", "lang", "source", "text"])
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("bpe_tokens", encode_tokens),
]

#: Language scores, fingerprints and vocabularies cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
