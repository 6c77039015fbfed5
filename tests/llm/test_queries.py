"""The registered queries at the smallest scale, against plain versions of their contracts."""

import re

import pytest
from tokenizers import Tokenizer

from opspark.llm import queries
from opspark.llm.texts import tokenizer_path

from . import cases, test_documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


def run(spark, name):
    return queries.QUERIES[name](spark, SF)


def test_op1(spark, rows):
    cases.same(run(spark, "op1_suffix_dedup"), cases.byte_dedup(rows, 400))


def test_op2_and_op7(spark, rows):
    library = Tokenizer.from_file(tokenizer_path())
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t, _ in rows}
    cases.same(run(spark, "op2_token_counts"), [(d, len(t.encode()), len(ids[d]), len(ids[d]) > 1024) for d, t, _ in rows])
    want = [(d, len(ids[d]), cases.sha(",".join(map(str, ids[d]))), cases.sha(library.decode(ids[d], skip_special_tokens=False))) for d, _, _ in rows]
    cases.same(run(spark, "op7_bpe_codec"), want)


def test_op3(spark, rows):
    rows = sorted(rows)
    fps = [cases.simhash(t, 3) for _, t, _ in rows]
    label = cases.clusters(fps, 2)
    cases.same(run(spark, "op3_simhash"), [(r[0], f"{f:016x}", rows[g][0]) for r, f, g in zip(rows, fps, label)])


def test_op4(spark, rows):
    import zlib

    got = {r.doc_id: r for r in run(spark, "op4_language_id").collect()}
    assert {d: r.held_out for d, r in got.items()} == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in rows}
    held = [got[d].lang_pred == lang for d, _, lang in rows if got[d].held_out]
    assert sum(held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got.values())


def test_op6(spark, rows):
    kinds = ["email", "ip", "card", "phone"]
    got = {r.doc_id: r for r in run(spark, "op6_pii").collect()}
    for d, t, _ in rows:
        spans = test_documents.brute_spans(t)
        text = ",".join(f"{kinds[k]}:{a}:{b}" for a, b, k in spans)
        r = got[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == cases.sha(text)
        assert set(filter(None, text.split(","))) <= set(filter(None, r.spans.split(",")))
        assert re.fullmatch(r"((email|ip|card|phone):\d+:\d+(,|$))*", r.spans)


def test_op8(spark, rows):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = []
    for doc, n, hit, found in test_documents.contamination(rows, items):
        want.append((doc, n, hit, len(found.split(",")) if found else 0, cases.sha(found), hit > 0))
    cases.same(run(spark, "op8_decontamination"), want)


def test_op9(spark, rows):
    cases.same(run(spark, "op9_substring_dedup"), cases.word_dedup(rows, 50))


def test_op10(spark, rows):
    got = run(spark, "op10_quality_rules")
    cases.same(got.drop("kept"), [(d, *test_documents.quality_base(t)) for d, t, _ in rows])
    assert got.where("kept and base_failed").count() == 0


def test_op5(spark):
    import hashlib

    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    want = [(p, len(h.encode()), hashlib.sha1(h.encode()).hexdigest(), "response", None) for p, h in pages]
    cases.same(run(spark, "op5_warc_archive"), want)
