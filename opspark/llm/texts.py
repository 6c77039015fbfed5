"""Helpers the operators share: reading the tables, row-wise text steps in bounded slices, tokenizer files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: A slice of texts that Python holds as objects at one time: so many rows and characters at most (one long text may exceed it).
SLICE_ROWS, SLICE_CHARS = 2048, 8 << 20

#: The words of most contracts: runs of anything but space and the five ASCII controls from tab to carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *extra)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variation of it that no column of the frame has (case is ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_file(path: str) -> str:
    """A tokenizer file (a few MB at most), read once on the driver and sent to the tasks as a value."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of an Arrow column as Python objects, in slices of bounded size: (first row, texts)."""
    size = np.nan_to_num(np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=float)).cumsum()
    start = 0
    while start < len(texts):
        done = size[start - 1] if start else 0
        end = max(start + 1, min(start + SLICE_ROWS, int(np.searchsorted(size, done + SLICE_CHARS, side="right"))))
        yield start, texts.slice(start, end - start).to_pylist()
        start = end


def map_texts(
    docs: DataFrame,
    text: str,
    keep: list[str],
    outputs: list[tuple[str, DataType]],
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
) -> DataFrame:
    """The kept columns and the outputs of a function over the texts, row by row; an output replaces a column of its name.

    ``make`` is called once in each task and returns the function, which maps a list of texts to one Arrow
    array for each output. Nothing is shuffled; a task holds one slice of texts as Python objects.
    """
    taken = {n.lower() for n, _ in outputs}
    keep = [c for c in keep if c.lower() not in taken]
    fields = [docs.schema[c] for c in keep]
    schema = StructType(fields + [StructField(n, t) for n, t in outputs])
    n_keep, names = len(keep), [*keep, *(n for n, _ in outputs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for start, part in slices(batch.column(n_keep)):
                kept = [batch.column(i).slice(start, len(part)) for i in range(n_keep)]
                yield pa.RecordBatch.from_arrays([*kept, *apply(part)], names=names)
        release()

    inner = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias(free_name(docs, "text_of_row")))
    return inner.mapInArrow(run, schema)


def release() -> None:
    """Gives back what Arrow holds in reserve; a worker that waits for its next task should not keep it."""
    pa.default_memory_pool().release_unused()
