import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opspark.llm import anchors, substrings, suffixdedup
from opspark.llm.suffixes import common_prefixes, equal_groups, suffix_array

from . import cases


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=120).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 40), st.data())
def test_suffix_array_and_groups(raw, length, data):
    raw = raw + raw[len(raw) // 3 :] + raw[: len(raw) // 2]
    a = np.frombuffer(raw, np.uint8)
    sa, _ = suffix_array(a, len(a) + 8)
    assert [raw[i:] for i in sa] == sorted(raw[i:] for i in range(len(raw)))
    back = np.argsort(sa[1:], kind="stable")
    prefix = common_prefixes(a, sa[:-1][back], sa[1:][back], length)
    for p, i, j in zip(prefix, sa[1:][back], sa[:-1][back]):
        n = 0
        while n < length and max(i, j) + n < len(raw) and raw[i + n] == raw[j + n]:
            n += 1
        assert p >= n and (p == n or max(i, j) + n == len(raw))  # behind the end both read zeros
    if len(raw) < length:
        return
    starts = np.array(sorted(data.draw(st.sets(st.integers(0, len(raw) - length), min_size=1))))
    groups = equal_groups(a, starts, length)
    known: dict = {}
    assert all(known.setdefault(raw[s : s + length], g) == g for s, g in zip(starts.tolist(), groups.tolist()))
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("part", [anchors.PART, 64])
def test_winnowing_is_leftmost_minimum(monkeypatch, part):
    monkeypatch.setattr(anchors, "PART", part)
    grams = np.random.default_rng(3).integers(0, 5, 700).astype(np.uint64) << np.uint64(40)
    for width in (1, 2, 7, 31):
        places = anchors.winnow(grams, width)
        assert places.tolist() == [i + int(np.argmin(grams[i : i + width])) for i in range(len(grams) - width + 1)]


@pytest.mark.parametrize(("hot", "shard", "merge"), [(512, 3 << 20, 2_000_000), (1, 4000, 500)])
def test_byte_dedup(spark, monkeypatch, hot, shard, merge):
    for name, value in (("HOT", hot), ("SHARD", shard), ("MERGE", merge)):
        monkeypatch.setattr(suffixdedup, name, value)
    got = suffixdedup.dedup(cases.frame(spark, extra=True), length=400)
    same = got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    cases.same(same, cases.byte_dedup(cases.rows(), 400))


def test_phrases_do_not_make_long_windows_meet():
    """Texts that share phrases, but no window, have no anchor in common: nothing of them is sorted."""
    rng = np.random.default_rng(5)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    made = lambda n: "".join(rng.choice(list(letters), n))
    phrases = [made(40) for _ in range(30)]
    texts = ["".join(phrases[k] + made(30) for k in rng.permutation(30)) for _ in range(20)]
    anchor_sets = [set(anchors.segments(anchors.Bytes(t), 400)[0].tolist()) for t in texts]
    assert sum(map(len, anchor_sets)) == len(set().union(*anchor_sets)) > 100


@pytest.mark.parametrize("length", [16, 64, 255, 256, 300])
def test_byte_dedup_of_other_lengths(spark, length):
    rows = [r for r in cases.rows() if len(r[1] or "") < 20000]
    got = suffixdedup.dedup(cases.frame(spark, rows), length=length)
    same = got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    cases.same(same, cases.byte_dedup(rows, length))


def test_suffix_array_whose_keys_need_two_sorts():
    """From the second refinement on, group, second and place together pass 64 bits."""
    half = np.random.default_rng(6).integers(97, 101, 2_200_000).astype(np.uint8)
    raw = np.concatenate((half, half)).tobytes()
    sa, _ = suffix_array(np.frombuffer(raw, np.uint8), 64)
    assert np.array_equal(np.sort(sa), np.arange(len(raw)))
    for k in np.random.default_rng(7).integers(0, len(raw) - 1, 5000).tolist():
        a, b = int(sa[k]), int(sa[k + 1])
        assert raw[a : a + 64] <= raw[b : b + 64]


@pytest.mark.parametrize("pairs", [48, 1])
def test_word_dedup(spark, monkeypatch, pairs):
    monkeypatch.setattr(substrings, "PAIRS", pairs)
    got = substrings.dedup(cases.frame(spark, extra=True), length=50)
    cases.same(got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)), cases.word_dedup(cases.rows(), 50))


def test_extension_keeps_the_smallest_document():
    a = [b"w%d" % i for i in range(60)]
    group = [(1, 20, 11, a), (4, 20, 11, [b"x"] * 8 + a[8:]), (9, 20, 11, [b"y"] * 3 + a[3:])]
    runs = substrings.extended(group, 50)
    assert runs[0] == [(0, 10, 1)]
    assert runs[1] == [(0, 7, 4), (8, 10, 1)]
    assert runs[2] == [(0, 2, 9), (3, 10, 1)]


def test_empty_tables(spark):
    empty = cases.frame(spark, [])
    assert suffixdedup.dedup(empty).count() == 0
    assert substrings.dedup(empty).count() == 0
