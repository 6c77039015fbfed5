"""Small tables with every awkward case, and the brute-force versions the operators are held against."""

from __future__ import annotations

import hashlib
import random
import re

PROSE = "the quick brown fox jumps over a lazy dog while seven wizards brew strange potions near old castle walls and rivers".split()


def prose(n: int, seed: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(PROSE) + rnd.choice(["", "", "s", "ing", str(rnd.randint(0, 99))]) for _ in range(n))


def rows() -> list[tuple]:
    """(doc_id, text, lang, source): copies, near copies, shared passages, junk, nulls, repeated rows and ids."""
    passage = prose(70, 1)
    long_passage = prose(130, 2)
    out = [(i, prose(40 + 7 * i, 100 + i), "en", f"s{i % 3}") for i in range(12)]
    out += [(20 + i, f"{prose(10 + i, 200 + i)} {passage} {prose(9, 300 + i)}", "en", "s0") for i in range(6)]
    out += [(30 + i, f"{prose(12, 400 + i)} {long_passage}", "de", None) for i in range(3)]
    out += [(40, prose(90, 7), "fr", "s1"), (41, prose(90, 7), "fr", "s1"), (42, prose(90, 7) + " tail", "fr", "s1"), (42, prose(90, 7) + " tail", "fr", "s1")]
    out += [(None, prose(90, 7), None, "s1"), (None, None, "en", None), (50, None, "en", "s2"), (51, "", None, "s2"), (52, " \t\r\n\x0b\x0c ", "en", "s2")]
    out += [(53, "Word", "en", "s2"), (54, "two words", "en", "s2"), (55, "ha " * 300, "en", "s2"), (56, "a\n\nb\na\n b\n" * 30, "en", "s2")]
    out += [(57, "Ünï çødé ÅÄÖ İıẞ 世界  wide space \U0001d4b3 é " * 12, "de", "s2"), (58, "x" * 3000, "en", "s2")]
    out += [(59, prose(20000, 9), "en", "s2"), (60, "#*$ %& |<> " * 50, "en", "s2"), (61, prose(60, 11) + " " + prose(60, 11), "en", "s2")]
    return out


def used_names() -> list[str]:
    """Every name that the operators give a column anywhere in their modules, as columns of the user's."""
    import pathlib

    import opspark.llm

    folder = pathlib.Path(opspark.llm.__file__).parent
    found = set()
    for path in folder.glob("*.py"):
        source = path.read_text()
        found.update(re.findall(r"""alias\(f?["']([a-z_0-9]+)["']""", source))
        found.update(re.findall(r"""withColumn\(["']([a-z_0-9]+)["']""", source))
        found.update(re.findall(r"""free_name\([a-z_]+, ["']([a-z_0-9]+)["']""", source))
        found.update(re.findall(r"""F\.col\(["']([a-z_0-9]+)["']\)""", source))
        found.update(x.split()[0] for group in re.findall(r"""["']([a-z_0-9]+ (?:long|int|string|binary|array)[^"']*)["']""", source) for x in group.split(", ") if re.fullmatch("[a-z_0-9]+", x.split()[0]))
    return sorted(found - {"doc_id", "text", "lang", "source", "page_id", "url", "html", "n_chars", "item_id"})


#: Names that the operators use themselves, as columns of the user's.
CLASHING = used_names()


def frame(spark, data=None, extra: bool = False):
    df = spark.createDataFrame(rows() if data is None else data, "doc_id long, text string, lang string, source string")
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(7).alias(c) for c in CLASHING])
    return df.repartition(3)


def sha(raw: bytes | str) -> str:
    return hashlib.sha256(raw.encode() if isinstance(raw, str) else raw).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def covered(starts: list[int], length: int, n: int) -> list[bool]:
    gone = [False] * n
    for s in starts:
        for i in range(s, s + length):
            gone[i] = True
    return gone


def byte_dedup(data: list[tuple], length: int) -> list[tuple]:
    seen: dict[bytes, int] = {}
    raws = [(r[0], (r[1] or "").encode()) for r in data]
    for _, b in raws:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for doc, b in raws:
        gone = covered([i for i in range(len(b) - length + 1) if seen[b[i : i + length]] > 1], length, len(b))
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def word_dedup(data: list[tuple], length: int) -> list[tuple]:
    least: dict[tuple, float] = {}
    rank = lambda d: float("inf") if d is None else d
    texts = [(r[0], words(r[1])) for r in data]
    for doc, w in texts:
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            least[key] = min(least.get(key, float("inf")), rank(doc))
    out = []
    for doc, w in texts:
        gone = covered([i for i in range(len(w) - length + 1) if least[tuple(w[i : i + length])] < rank(doc)], length, len(w))
        out.append((doc, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def simhash(text: str | None, shingle: int) -> int:
    import xxhash

    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clusters(fps: list[int], radius: int) -> list[int]:
    """For each fingerprint the index of the first one it is connected to."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def key(row) -> tuple:
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def same(df, expected: list[tuple]) -> None:
    got = sorted((tuple(r) for r in df.collect()), key=key)
    want = sorted(expected, key=key)
    assert len(got) == len(want)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, bad[:3]
