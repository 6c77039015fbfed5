import gzip
import hashlib

from opspark.llm import warc
from opspark.session import checkpoint_dir, cut_lineage

LONG = "<p>" + "é text " * 300 + "</p>"


def pages(spark, rows=None):
    rows = (
        [
            (1, "http://a/1", LONG),
            (5, "http://a/5", LONG),
            (3, "http://a/3\r\nX: y", LONG),
            (None, "http://a/n", LONG),
            (7, None, "short"),
            (8, "http://a/8", "short"),
            (9, "http://a/9", None),
            (10, "http://a/10", ""),
            (11, "http://a/11", "lines\r\n\r\nWARC/1.1\r\n" * 100),
            (11, "http://a/11", "lines\r\n\r\nWARC/1.1\r\n" * 100),
            (12, "http://a/12", "x" * 3_000_000),
        ]
        if rows is None
        else rows
    )
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def archive(spark, tmp_path, rows=None):
    folder = f"file://{tmp_path}/warc"
    return cut_lineage(warc.write_archives(warc.record_types(pages(spark, rows)), folder)), folder


def test_pages_come_back(spark, tmp_path):
    index, folder = archive(spark, tmp_path)
    got = warc.with_responses(cut_lineage(warc.page_table(warc.read_records(index, folder)))).collect()
    rows = pages(spark).collect()
    assert len(got) == len(rows)
    largest: dict = {}
    for r in rows:
        if len((r.html or "").encode()) >= 1000:
            largest[r.html] = max(largest.get(r.html, -1), -1 if r.page_id is None else r.page_id)
    want = []
    for r in rows:
        raw = (r.html or "").encode()
        revisit = r.html in largest and r.page_id != largest[r.html]
        want.append((r.page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", largest[r.html] if revisit else None))
    order = lambda t: (t[0] is None, t[0] or 0)
    assert sorted((tuple(g) for g in got), key=order) == sorted(want, key=order)


def test_index_names_single_records(spark, tmp_path):
    index, folder = archive(spark, tmp_path)
    one = index.where("record_id in ('8', '5', '9')")
    got = {r.record_id: r.payload for r in warc.read_records(one, folder).collect()}
    assert got == {"8": "short", "5": LONG, "9": ""}
    row = index.where("record_id = '8'").first()
    with open(f"{tmp_path}/warc/{row.file}", "rb") as f:
        f.seek(row.offset)
        raw = gzip.decompress(f.read(row.length))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"\r\n\r\nshort\r\n\r\n")
    assert b"Content-Length: 5\r\n" in raw


def test_small_files_and_ranges(spark, tmp_path, monkeypatch):
    for name, value in (("FILE_BYTES", 700), ("READ", 900), ("GAP", 10), ("PIECE", 500)):
        monkeypatch.setattr(warc, name, value)
    index, folder = archive(spark, tmp_path)
    assert index.select("file").distinct().count() > 3
    assert warc.read_records(index, folder).count() == 11


def test_ranges_are_joined_up_to_a_gap():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP, 5), ("a", 21 + 2 * warc.GAP, 5), ("b", 0, 1)]
    assert [len(r) for r in warc.ranges(rows)] == [3, 1, 1]
    assert [len(r) for r in warc.ranges([("a", 0, warc.READ), ("a", warc.READ, 1)])] == [1, 1]


def test_empty_table(spark, tmp_path):
    index, folder = archive(spark, tmp_path, [])
    assert warc.with_responses(cut_lineage(warc.page_table(warc.read_records(index, folder)))).count() == 0
    assert checkpoint_dir(spark)
