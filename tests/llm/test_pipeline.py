import corpus_pipeline
from pyspark.sql import functions as F

from opspark.llm import language, pii, queries
from opspark.session import cut_lineage

from . import cases, test_documents

SF = "/root/testdata/sf0.001"


def test_queries_and_stages_are_registered():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert __spark_entry__.queries()["pipeline"].__wrapped__ is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "bpe_tokens"]
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_run_agrees_with_brute_force(spark):
    """Each decision is made again, document by document, from what the stages before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    model = language.fit(docs.where(~language.held_out()), language_path())
    langs, scores = language.Scorer(model).predict([t for _, t in rows])
    rows = [r for r, g, s in zip(rows, langs, scores) if g != "und" and s >= corpus_pipeline.LEAST_SCORE]
    rows.sort()
    label = cases.clusters([cases.simhash(t, 3) for _, t in rows], 2)
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, hit in zip(rows, test_documents.contamination(rows, items)) if not hit[2]]
    stage3 = spark.createDataFrame(rows, "doc_id long, text string")
    weights = pii.learn(stage3)
    from tokenizers import Tokenizer

    from opspark.llm.texts import tokenizer_path

    library = Tokenizer.from_file(tokenizer_path())
    want = []
    for doc, text in rows:
        at, out = 0, []
        for a, b, k in pii.all_spans(text, weights)[1]:
            out += [text[at:a], f"[{pii.KINDS[k].upper()}]"]
            at = b
        ids = library.encode("".join(out) + text[at:], add_special_tokens=False).ids
        want.append((doc, len(ids), cases.sha(",".join(map(str, ids))), True))
    got = corpus_pipeline.run(spark, SF)
    cases.same(got.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256), "decodes"), want)


def language_path():
    from opspark.llm.texts import tokenizer_path

    return tokenizer_path("piece_bpe_32k.model")


def test_stages_on_awkward_rows(spark):
    docs = cases.frame(spark, extra=True).withColumn("n_chars", F.length("text").cast("long"))
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = cut_lineage(stage(spark, docs, SF))
        assert i == 4 or docs.columns == columns
    got = [r.doc_id for r in docs.select("doc_id").collect()]
    assert not set(got) & {50, 51, 52, 60, 41} and {0, 1, 40, 59} <= set(got)
    assert docs.where("not decodes").count() == 0


def test_stages_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF))
    assert docs.count() == 0
