"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary. The probability of a word is the sum over all
ways to cut it into pieces, which the forward algorithm adds up from left to right; a text is the product of its words.
The prediction is the language with the largest posterior under a uniform prior, and the score is that posterior.

Fitting counts pieces (the vocabulary's own segmentation of the training words) in at most ``MAX_DOCS`` distinct texts of every
language, those with the smallest hashes, each counted once; all texts are then scored whole. Distinct words are scored once
in each worker, many at a time; the more languages, the fewer words are held. The model holds the pieces each language has shown and one
probability for all others, so a column with many odd language names costs no more than its texts.

A text that is null or has no letter is ``und`` with score 0, as is any text if no training row was given. Ties go to the
first language in order of name. Rows with a null language are not learned from; rows are scored one by one.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..session import cut_lineage
from .texts import map_texts, slices

#: Bound of the fit: distinct texts of a language.
MAX_DOCS = 2000

#: Added to each piece count; probability of a character outside the vocabulary.
SMOOTH, UNKNOWN = 0.05, 1e-6

#: Characters of a word that is scored in a batch, at most; distinct words a worker remembers, and the characters of one.
PLAIN, CACHE, REMEMBERED = 40, 400_000, 64

#: Numbers (words by languages) a worker remembers, and of a batch that is scored, at most.
CACHE_NUMBERS, BATCH_NUMBERS = 16_000_000, 160_000

#: Numbers (pieces by languages) of a model that is laid out in full.
DENSE_NUMBERS = 4_000_000

SPACE = "▁"


class Model(NamedTuple):
    """Piece probabilities by language, as far as they were seen: its size follows the sample, not languages times pieces."""

    langs: list[str]
    pieces: dict[str, int]
    #: Probability, by language, of a piece that it has not shown.
    default: np.ndarray
    #: For each piece, where its entries begin (and the last end): languages that have shown it, and its probability there.
    edges: np.ndarray
    where: np.ndarray
    value: np.ndarray

    @classmethod
    def counted(cls, langs: list[str], pieces: list[str], piece: np.ndarray, lang: np.ndarray, n: np.ndarray) -> Model:
        """From counts of pieces: ``SMOOTH`` is added to every piece of every language."""
        order = np.lexsort((lang, piece))
        piece, lang, n = piece[order], lang[order], n[order].astype(float)
        total = np.bincount(lang, n, minlength=len(langs)) + SMOOTH * len(pieces)
        return cls(langs, {p: k for k, p in enumerate(pieces)}, SMOOTH / total, np.searchsorted(piece, np.arange(len(pieces) + 1)), lang, (n + SMOOTH) / total[lang])

    def rows(self, pieces: np.ndarray) -> np.ndarray:
        """The probabilities of some pieces, a row for each; the number after the last piece is a character outside the vocabulary."""
        out = np.empty((len(pieces), len(self.langs)))
        out[:] = self.default
        known = np.minimum(pieces, len(self.pieces) - 1)
        n = np.where(pieces < len(self.pieces), self.edges[known + 1] - self.edges[known], 0)
        at = np.repeat(self.edges[known] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[np.repeat(np.arange(len(pieces)), n), self.where[at]] = self.value[at]
        out[pieces == len(self.pieces)] = UNKNOWN
        return out


def vocabulary(path: str) -> dict[str, int]:
    """Piece -> id of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}


def training_part(rows: DataFrame, lang: str) -> DataFrame:
    """Rows (lang, text) of every language: the ``MAX_DOCS`` distinct texts with the smallest hashes of each, or all it has."""
    known = rows.where(F.col(f"`{lang}`").isNotNull() & F.col("text").isNotNull()).select(F.col(f"`{lang}`").cast("string").alias("lang"), "text")
    known = known.withColumn("h", F.xxhash64("text"))
    keys = cut_lineage(known.select("lang", "h").distinct())
    sizes = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    # Hashes under twice the expected bound are looked at, so that no language brings more than some 4,000 to one task;
    # that these are fewer than MAX_DOCS of more has a probability below 1e-200.
    near = F.col("h").cast("double") <= 2.0**64 * 2 * MAX_DOCS / F.col("texts") - 2.0**63
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    first = keys.join(F.broadcast(sizes), "lang").where(near).withColumn("place", place).where(F.col("place") <= MAX_DOCS)
    last = first.groupBy("lang").agg(F.max("h").alias("last"))
    chosen = known.join(F.broadcast(last), "lang").where(F.col("h") <= F.col("last"))
    return chosen.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def fit(rows: DataFrame, model_path: str, lang: str = "lang", text: str = "text") -> Model:
    """Learns from the rows' text and language alone. The result has a number for each language and piece."""
    sample = training_part(rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")), "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        total: dict[str, Counter] = {}
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                words: dict[str, Counter] = {}
                for language, t in zip(batch.column(0).slice(start, len(texts)).to_pylist(), texts):
                    words.setdefault(language, Counter()).update(t.split())
                for language, found in words.items():
                    own = total.setdefault(language, Counter())
                    for ids, n in zip(sp.encode(list(found), num_threads=1), found.values()):
                        for i in ids:
                            own[i] += n
        rows = [(language, i, n) for language, own in total.items() for i, n in own.items()]
        if rows:
            language, i, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(language), pa.array(i, pa.int32()), pa.array(n, pa.int64())], names=["lang", "piece", "n"])

    counted = sample.mapInArrow(count, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    # At most the languages times the size of the vocabulary, as the model itself.
    found = counted.toPandas()
    pieces = vocabulary(model_path)
    langs = sorted(found["lang"].unique().tolist())
    order = {p: k for k, p in enumerate(pieces.values())}
    known = found[found["piece"].isin(order)]
    number = {x: i for i, x in enumerate(langs)}
    return Model.counted(langs, list(pieces), known["piece"].map(order).to_numpy(int), known["lang"].map(number).to_numpy(int), known["n"].to_numpy())


class Scorer:
    """Log probabilities of words in each language, by the forward algorithm.

    Words of one length go forward together; from each place, a word is looked up no further than pieces go on.
    Probabilities are scaled by a constant for each character, the root of the least one, so a sum over a word of up to
    ``plain`` characters can neither vanish nor overflow; longer words are rescaled at each character.
    """

    def __init__(self, model: Model):
        self.model = model
        self.longest = max(map(len, model.pieces), default=1)
        self.unknown = len(model.pieces)
        many = max(1, len(model.langs))
        self.room, self.part = max(1, min(CACHE, CACHE_NUMBERS // many)), max(1, min(20_000, BATCH_NUMBERS // many))
        self.dense = model.rows(np.arange(len(model.pieces) + 1)) if many * (len(model.pieces) + 1) <= DENSE_NUMBERS else None
        least = min([UNKNOWN, *model.default.tolist()])
        self.scale = 0.5 * np.log(1 / least)
        self.plain = int(min(PLAIN, 600 / self.scale))
        # For pieces and their beginnings: twice (number + 1), plus 1 if a longer piece begins so.
        self.known: dict[str, int] = {p[:k]: 1 for p in model.pieces for k in range(1, len(p))}
        for p, k in model.pieces.items():
            self.known[p] = 2 * (k + 1) + self.known.get(p, 0)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.logs = np.zeros((1024, len(self.model.langs)))

    def rows(self, pieces: np.ndarray) -> np.ndarray:
        return self.model.rows(pieces) if self.dense is None else self.dense[pieces]

    def _batch(self, words: list[str]) -> np.ndarray:
        """Words of one length: from each place along the pieces that begin there, all words at a time that still follow one."""
        get, n = self.known.get, len(words[0])
        alpha = np.zeros((n + 1, len(words), len(self.model.langs)))
        alpha[0] = 1
        for i in range(n):
            at, follow = np.arange(len(words)), words
            for j in range(i + 1, n + 1):
                code = np.array([get(w[i:j], 0) for w in follow])
                piece = code // 2 - 1
                if j == i + 1:
                    piece[piece < 0] = self.unknown
                have = np.flatnonzero(piece >= 0)
                if len(have):
                    alpha[j, at[have]] += alpha[i, at[have]] * (self.rows(piece[have]) * np.exp(self.scale * (j - i)))
                more = np.flatnonzero(code & 1)
                if not len(more):
                    break
                at, follow = at[more], [follow[k] for k in more.tolist()]
        return np.log(alpha[n]) - self.scale * n

    def _long(self, word: str) -> np.ndarray:
        """A word of any length, rescaled at every step; only the last ``longest`` places are held."""
        find = self.model.pieces.get
        many = len(self.model.langs)
        recent, scale = [np.ones(many)], np.zeros(many)
        for j in range(1, len(word) + 1):
            found = [(back, find(word[j - back : j], self.unknown if back == 1 else -1)) for back in range(1, len(recent) + 1)]
            found = [(back, k) for back, k in found if k >= 0]
            total = (np.stack([recent[-back] for back, _ in found]) * self.rows(np.array([k for _, k in found]))).sum(axis=0)
            recent = [a / total for a in recent[-(self.longest - 1) :]] + [np.ones(many)] if self.longest > 1 else [np.ones(many)]
            scale += np.log(total)
        return scale

    def score(self, words: list[str]) -> np.ndarray:
        """A row for each word."""
        out = np.empty((len(words), len(self.model.langs)))
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w) + 1, []).append(k)
        for n, group in by_length.items():
            for at in range(0, len(group), self.part):
                part = group[at : at + self.part]
                marked = [SPACE + words[k] for k in part]
                out[part] = self._batch(marked) if n <= self.plain else np.array([self._long(w) for w in marked])
        return out

    def learn(self, words: list[str]) -> None:
        """Scores new words and remembers them."""
        for at in range(0, len(words), 65_536):
            part = words[at : at + 65_536]
            start = len(self.number)
            while start + len(part) > len(self.logs):
                self.logs = np.vstack([self.logs, np.zeros_like(self.logs)])
            self.logs[start : start + len(part)] = self.score(part)
            self.number.update(zip(part, range(start, start + len(part))))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        totals = np.zeros((len(texts), len(self.model.langs)))
        waiting: list[tuple[int, list[str]]] = []

        def add() -> None:
            if len(self.number) > self.room:
                self.forget()
            self.learn(sorted({w for _, words in waiting for w in words}.difference(self.number)))
            for k, words in waiting:
                totals[k] += self.logs[np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))].sum(axis=0)
            waiting.clear()

        size = 0
        for k, t in enumerate(texts):
            words = (t or "").split()
            if max(map(len, words), default=0) > REMEMBERED:
                # Long words hardly come again, and are not worth their room.
                for w in words:
                    if len(w) > REMEMBERED:
                        totals[k] += self.score([w])[0]
                words = [w for w in words if len(w) <= REMEMBERED]
            for at in range(0, len(words), self.room):
                part = words[at : at + self.room]
                if size + len(part) > self.room:
                    add()
                    size = 0
                waiting.append((k, part))
                size += len(part)
        add()
        langs, scores = [], []
        for t, total in zip(texts, totals):
            if not self.model.langs or not any(map(str.isalpha, t or "")):
                langs.append("und")
                scores.append(0.0)
                continue
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return langs, scores


_LATEST: dict[str, Scorer] = {}


def _scorer_of(key: str, model: Callable[[], Model]) -> Scorer:
    """The scorer of a model; a worker keeps the latest one, with the words it has scored, for its next tasks."""
    if key not in _LATEST:
        _LATEST.clear()
        _LATEST[key] = Scorer(model())
    return _LATEST[key]


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and its posterior; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def make() -> Callable:
        scorer = _scorer_of(key, lambda: shared.value)

        def run(texts: list[str | None]) -> list[pa.Array]:
            langs, scores = scorer.predict(texts)
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return run

    return map_texts(docs, text, keep if keep is not None else docs.columns, [(lang, StringType()), (score, DoubleType())], make)


def held_out(doc_id: str = "doc_id"):
    """Rows that are kept from training: crc32 of the id as text leaves 2 when divided by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))
