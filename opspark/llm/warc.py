"""WARC archives: records written with an index, then read back by coalesced byte ranges of that index.

The archives lie in a shared folder named by the caller and are reached through its URI, so any store that Arrow can
open will do. A task writes files of its own under random names, one gzip member for each record, and returns an index
row (file, offset, length, URL, digest, ...) for each record. The index is a table: rows of a lost or repeated task
appear once, and files of failed attempts are named by no row.

Reading starts from index rows. They are dealt out by pieces of the files, sorted by offset, and neighbouring ranges are read in one
go as long as the gap is small; each member is then cut out of its range, unpacked and parsed.

Definitions: a null payload is empty. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with
the largest id is the response and the others are revisits, which carry no payload. Repeated rows that share the
largest id are all responses, as are records whose ids are all null; a null id is smaller than any other.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .texts import free_name

REVISIT_BYTES = 1000

#: A new archive file starts beyond so many bytes; ranges closer than GAP are read together, up to READ bytes.
FILE_BYTES, GAP, READ = 256 << 20, 64 << 10, 8 << 20

#: Archive bytes that a reading task gets on average.
PIECE = 4 << 20

#: WARC-Date of all records: a run writes the same archives whenever it is made.
DATE = "2000-01-01T00:00:00Z"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI or plain path, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def record_types(pages: DataFrame, page_id: str = "page_id", payload: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Adds ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` to the pages.

    The largest id of each digest is found with a map-side combine on narrow rows; the join back is a plain equi-join,
    whose hot digests AQE can split.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    known = pages.withColumns({"payload_bytes": F.octet_length(body).cast("long"), "payload_digest": F.sha1(body)})
    digest, largest = free_name(known, "of_digest"), free_name(known, "largest_id")
    last = (
        pages.select(F.sha1(body).alias("digest"), F.octet_length(body).alias("bytes"), F.col(f"`{page_id}`").alias("id"))
        .where(F.col("bytes") >= least)
        .groupBy("digest")
        .agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(F.col("digest").alias(digest), F.col("largest").alias(largest))
    )
    revisit = F.col(largest).isNotNull() & ~F.col(f"`{page_id}`").eqNullSafe(F.col(largest))
    types = {"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col(largest))}
    return known.join(last, F.col("payload_digest") == F.col(digest), "left").withColumns(types).drop(digest, largest)


def header(lines: dict[str, str | None]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None) + "\r\n").encode()


def one_line(value: str | None) -> str | None:
    """A header value without line breaks, which would end the header."""
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


INDEX = StructType(
    [
        StructField("file", StringType()),
        StructField("offset", LongType()),
        StructField("length", LongType()),
        StructField("url", StringType()),
        StructField("payload_digest", StringType()),
        StructField("record_type", StringType()),
        StructField("record_id", StringType()),
    ]
)


def write_archives(
    records: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Writes a record for each row that ``record_types`` made, and returns the index of what was written.

    The frame is lazy: store it (``cut_lineage``) before reading from it, or another use writes the archives again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                # A batch has bounded bytes; rows become Python objects one at a time.
                found: list[tuple] = []
                for i in range(batch.num_rows):
                    ident, link, body, digest, kind, refers = (c[i].as_py() for c in batch.columns)
                    if out is None:
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    data = (body or "").encode()
                    base = {
                        "WARC-Type": kind,
                        "WARC-Record-ID": f"<urn:page:{'' if ident is None else ident}>",
                        "WARC-Date": DATE,
                        "WARC-Target-URI": one_line(link),
                        "WARC-Payload-Digest": f"sha1:{digest}",
                    }
                    if kind == "revisit":
                        data = b""
                        base |= {
                            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                            "WARC-Refers-To": f"<urn:page:{refers}>",
                        }
                    base |= {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(data))}
                    member = gzip.compress(header(base) + data + b"\r\n\r\n", 5, mtime=0)
                    out.write(member)
                    found.append((name, offset, len(member), link, digest, kind, None if ident is None else str(ident)))
                    offset += len(member)
                    if offset >= FILE_BYTES:
                        out.close()
                        out = None
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64() if f.dataType == LongType() else pa.string()) for c, f in zip(zip(*found), INDEX)], names=INDEX.names
                    )
        finally:
            if out is not None:
                out.close()

    columns = [page_id, url, payload, "payload_digest", "record_type", "refers_to"]
    return records.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(write, INDEX)


RECORD = StructType(
    [
        StructField("record_id", StringType()),
        StructField("url", StringType()),
        StructField("record_type", StringType()),
        StructField("payload_digest", StringType()),
        StructField("refers_to", StringType()),
        StructField("payload", StringType()),
        StructField("digest_read", StringType()),
    ]
)


def parse(member: bytes) -> tuple:
    """A record as read: its header fields, payload, and the digest of the bytes that were read."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    data = rest[: int(fields["Content-Length"])]

    def ident(name: str) -> str | None:
        value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return value or None

    kind = fields["WARC-Type"]
    body = None if kind == "revisit" else data.decode()
    return (
        ident("WARC-Record-ID"),
        fields.get("WARC-Target-URI"),
        kind,
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        ident("WARC-Refers-To"),
        body,
        None if body is None else hashlib.sha1(data).hexdigest(),
    )


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted (file, offset, length) in runs that are read at once."""
    run: list[tuple[str, int, int]] = []
    for row in rows:
        if run and (row[0] != run[-1][0] or row[1] > run[-1][1] + run[-1][2] + GAP or row[1] + row[2] - run[0][1] > READ):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of an index name, whatever part of it they are; ``payload`` is null for revisits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for run in ranges(rows):
                first = run[0][1]
                with fs.open_input_file(os.path.join(root, run[0][0])) as f:
                    data = f.read_at(run[-1][1] + run[-1][2] - first, first)
                found = [parse(data[o - first : o - first + n]) for _, o, n in run]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=RECORD.names)

    # A fixed number of tasks: the index is tiny, so adaptive execution would give all the reading to one.
    parts = index.select("file", "offset", "length", (F.col("offset") / F.lit(PIECE)).cast("long").alias("piece"))
    tasks = 1 + index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"] // PIECE
    parts = parts.repartition(tasks, "file", "piece").sortWithinPartitions("file", "offset").drop("piece")
    return parts.mapInArrow(read, RECORD)


def page_table(read: DataFrame, id_type: str = "long") -> DataFrame:
    """One row per record as read: bytes and digest of the full payload, which a revisit takes from its response."""
    own = read.select(
        F.col("record_id").cast(id_type).alias("page_id"),
        F.octet_length("payload").cast("long").alias("own_bytes"),
        F.coalesce("digest_read", "payload_digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )
    return own


def with_responses(records: DataFrame) -> DataFrame:
    sizes = (
        records.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest"))
        .agg(F.max("own_bytes").alias("__bytes"))
    )
    return records.join(sizes, (F.col("refers_to") == F.col("__id")) & (F.col("payload_digest") == F.col("__digest")), "left").select(
        "page_id", F.coalesce("own_bytes", "__bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
