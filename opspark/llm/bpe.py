"""BPE encoding and decoding by forced-boundary splitting.

A merge can join two neighbouring bytes only if some token of the vocabulary has them side by side. A pair of
bytes that no token contains is therefore a certain cut: what stands left and right of it can be encoded apart, and
the ids concatenated. In prose nearly every "letter, space" is such a pair, so a text falls into word-sized
fragments that repeat, and each worker encodes a distinct fragment once.

The whole text is cut first at forced pairs in front of a space, where the pre-tokenizer's pattern starts afresh as
well. A fragment is then split by the library's own pre-tokenizer, each piece again at every forced pair (also inside
a character), and the rest is merged by the library's model.

Nulls count as empty texts: no ids, decoded to ''. Rows are independent, so repeated rows and ids change nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .texts import map_texts

#: Distinct fragments a worker remembers before it starts anew, and the bytes of one: about 75 MB, whatever the texts.
CACHE, REMEMBERED = 300_000, 64

#: Fixed: the pattern of byte-level pre-tokenizers (``public_tokenizers.PATTERN``).
PRE_TOKEN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Coder:
    """Encodes and decodes as the library does without begin, end or added special tokens."""

    def __init__(self, content: str, by_rank: bool | None = None):
        """``by_rank``: what ``ranked`` found on the driver, or None to look again."""
        from tokenizers import Tokenizer

        spec = json.loads(content)
        library = Tokenizer.from_str(content)
        self.model, self.pre = library.model, library.pre_tokenizer
        to_byte = byte_of_char()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        joined = np.zeros((256, 256), bool)
        for token, i in spec["model"]["vocab"].items():
            if token in self.special:
                continue
            raw = bytes(to_byte[c] for c in token)
            self.bytes_of[i] = raw
            for a, b in zip(raw, raw[1:]):
                joined[a, b] = True
        self.forced = bytes((~joined).ravel().astype(np.uint8))
        self.char_of = {b: c for c, b in to_byte.items()}
        self._merge = self._library_merge
        if by_rank is None:
            by_rank = self.ranked(spec)
        self.by_rank = by_rank
        if by_rank:
            from tiktoken import Encoding

            ranks = {self.bytes_of[i]: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
            self.encoding = Encoding("ranks", pat_str="x", mergeable_ranks=ranks, special_tokens={})
            self._merge = self.encoding._core_bpe.encode_single_piece
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.any_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # Forced pairs in front of a space, where what comes before is no white space. The last byte of a Unicode
        # space can be any of the upper ones, so texts that have such a space use only the lower half.
        cut = np.zeros((256, 256), bool)
        cut[0x21:, 0x20] = ~joined[0x21:, 0x20]
        self.cut = cut.ravel()
        low = cut.copy()
        low[0x80:] = False
        self.cut_low = low.ravel()
        self.known: dict[bytes, bytes] = {}

    def ranked(self, spec: dict) -> bool:
        """Whether merging by rank of the result gives what the library's merge list gives.

        It does if merge i makes token 256 + i and every token is encoded as itself: then no two neighbours that a
        run of merges leaves can join to a token by another pair than the listed one.
        """
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
        own = (self.model.tokenize(t) for t in vocab if t not in self.special)
        return all(vocab[t] == 256 + i for i, t in enumerate(pairs)) and all(len(x) == 1 for x in own)

    def _library_merge(self, raw: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize("".join([self.char_of[b] for b in raw]))]

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens. The library's own splitter serves the scripts in which the
        Unicode versions of two regular expression engines may differ."""
        if BEYOND_LATIN.search(text) is None:
            return PRE_TOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.pre.pre_tokenize_str(text)]

    def piece(self, raw: bytes) -> list[int]:
        """The ids of one pre-token, merged between its forced cuts."""
        forced, ids, start = self.forced, [], 0
        for i in range(1, len(raw)):
            if forced[raw[i - 1] << 8 | raw[i]]:
                ids += self._merge(raw[start:i])
                start = i
        return ids + self._merge(raw[start:])

    def _fragment(self, raw: bytes) -> bytes:
        """The ids of a fragment as little-endian 32-bit numbers."""
        return np.array([i for t in self.pre_tokens(raw.decode()) for i in self.piece(t.encode())], "<i4").tobytes()

    def _plain(self, raw: bytes) -> bytes:
        if len(raw) < 2:
            cuts = []
        else:
            b = np.frombuffer(raw, np.uint8)
            wide = any(s in raw for s in (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"))
            pairs = (b[:-1].astype(np.uint16) << 8) | b[1:]
            cuts = (np.flatnonzero((self.cut_low if wide else self.cut)[pairs]) + 1).tolist()
        known, out, start = self.known, [], 0
        if len(known) > CACHE:
            known.clear()
        for end in (*cuts, len(raw)):
            part = raw[start:end]
            ids = known.get(part)
            if ids is None:
                ids = self._fragment(part)
                if len(part) <= REMEMBERED:
                    known[part] = ids
            out.append(ids)
            start = end
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        if self.any_special is None or not any(s in text for s in self.special):
            return self._plain(text.encode())
        out = []
        for part in self.any_special.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<i4").tobytes())
            elif part:
                out.append(self._plain(part.encode()))
        return b"".join(out)

    def decode(self, ids: list[int] | None) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids or ()]).decode("utf-8", errors="replace")


def int_lists(parts: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    values = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """Adds the token ids of each text (array<int>). ``vocabulary``: content of a byte-level BPE file of the tokenizers library."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, Coder(vocabulary).by_rank))

    def make() -> Callable:
        coder = Coder(*shared.value)
        return lambda texts: [int_lists([coder.encode(t) for t in texts])]

    return map_texts(docs, text, keep or docs.columns, [(ids, ArrayType(IntegerType()))], make)


def decode(coded: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for (in place of a column of that name); a null list is an empty one."""
    coded = coded.drop(text)
    shared = coded.sparkSession.sparkContext.broadcast((vocabulary, False))
    schema = StructType([*coded.schema.fields, StructField(text, StringType())])
    at = coded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        for batch in batches:
            texts = pa.array([coder.decode(x) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return coded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Token ids, and the text decoded from these ids, in one pass: columns ``ids`` and ``decoded``."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, Coder(vocabulary).by_rank))

    def make() -> Callable:
        coder = Coder(*shared.value)

        def run(texts: list[str | None]) -> list[pa.Array]:
            coded = [coder.encode(t) for t in texts]
            return [int_lists(coded), pa.array([coder.decode(np.frombuffer(c, "<i4").tolist()) for c in coded], pa.string())]

        return run

    return map_texts(docs, text, keep or docs.columns, [("ids", ArrayType(IntegerType())), ("decoded", StringType())], make)


def digests(coded: DataFrame, keep: list[str]) -> DataFrame:
    return coded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
