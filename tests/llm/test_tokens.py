import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opspark.llm import bpe, tokens
from opspark.llm.texts import read_file, tokenizer_path

from . import cases

VOCABULARY = read_file(tokenizer_path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
CODER = bpe.Coder(VOCABULARY)
SLOW = bpe.Coder(VOCABULARY, False)

pieces = st.sampled_from(["'s", "'re", "'ll", "'", "!", "é", "ß", "世界", " ", "  ", "\n", "\t", "a", "the", "12", "𝒳", "​", "\x85", "　", "<|endoftext|>", "<|end", "…", "ก", "🙂", "\x00"])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=30), st.lists(pieces, max_size=14).map("".join)))
def test_ids_and_text_as_the_library(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    for coder in (CODER, SLOW):
        ids = np.frombuffer(coder.encode(text), "<i4").tolist()
        assert ids == want
        assert coder.decode(ids) == LIBRARY.decode(want, skip_special_tokens=False)


def data():
    return [*cases.rows(), (70, "before <|endoftext|><|endoftext|> after", "en", "s"), (71, "<|endoftext|>", "en", "s")]


def test_round_trip_query(spark):
    want = []
    for doc, text, *_ in data():
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), cases.sha(",".join(map(str, ids))), cases.sha(text or "")))
    cases.same(bpe.digests(bpe.round_trip(cases.frame(spark, data()), VOCABULARY, keep=["doc_id"]), ["doc_id"]), want)


def test_encode_then_decode(spark):
    coded = bpe.decode(bpe.encode(cases.frame(spark), VOCABULARY), VOCABULARY)
    assert coded.where(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
    assert coded.columns == ["doc_id", "text", "lang", "source", "ids", "decoded"]


def test_token_counts(spark, monkeypatch):
    want = [(d, len((t or "").encode()), len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in data()]
    cases.same(tokens.token_counts(cases.frame(spark, data(), extra=True), VOCABULARY), want)
    for name, value in (("BLOCK_TOKENS", 30), ("SEND", 10)):
        monkeypatch.setattr(tokens, name, value)
    cases.same(tokens.token_counts(cases.frame(spark, data()), VOCABULARY), want)


def test_empty_tables(spark):
    empty = cases.frame(spark, [])
    assert tokens.token_counts(empty, VOCABULARY).count() == 0
    assert bpe.round_trip(empty, VOCABULARY).count() == 0


def test_byte_planes():
    x = np.array([0, 1, 255, 256, 70_000, 2**32 - 1])
    assert tokens.unpack(tokens.pack(x)).tolist() == x.tolist()
