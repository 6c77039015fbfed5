"""Vectors as array columns: hash embedding and cosine similarity, without Python."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIMENSIONS = 16


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time, also where ``use`` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def normalised(v: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""

    def divide(w: Column) -> Column:
        n = norm(w)
        return once(
            F.when(n == 0, F.lit(1.0)).otherwise(n), lambda length: F.transform(w, lambda x: x.cast("double") / length)
        )

    return once(v, divide)


def hash_embedding(text: Column) -> Column:
    """Unit vector of 16 numbers from the SHA-256 of the lower-case text, two bytes per number."""
    places = F.sequence(F.lit(0), F.lit(HASH_DIMENSIONS - 1))

    def numbers(digest: Column) -> Column:
        return F.transform(
            places, lambda i: F.conv(F.substring(digest, i * 4 + 1, F.lit(4)), 16, 10).cast("double") / 32767.5 - 1.0
        )

    return normalised(once(F.sha2(F.lower(text), 256), numbers))


def embed_with(embed: Callable[[list[str]], list[list[float]]]):
    """A column function for any Python embedder: it gets the texts of one Arrow batch at a time."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(embed(texts.fillna("").tolist()))

    return run


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 for empty vectors and for different lengths, a zero norm counts as 1."""

    def length(v: Column) -> Column:
        n = norm(v)
        return F.when(n == 0, F.lit(1.0)).otherwise(n)

    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    dot = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    usable = (F.size(a) > 0) & (F.size(a) == F.size(b))
    return F.when(F.coalesce(usable, F.lit(False)), dot / (length(a) * length(b))).otherwise(F.lit(0.0))
