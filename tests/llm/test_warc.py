"""WARC bundles: round trip, random access, odd pages."""

import hashlib
import io

import zstandard

from cdc_lake.llm import common as C
from cdc_lake.llm.warc import (Bundle, fetch, filesystem, read_archives, read_frame, round_trip, seek_table,
                               write_archives)

from .conftest import SF_SMALL

PAGES = [(1, "u", "x" * 1500), (2, None, "x" * 1500), (2, "v", "x" * 1500), (3, "a\r\nb", None), (None, "q", "x" * 1500),
         (4, "w", "é" * 400), (5, "z", "é" * 400), (6, "y", "é" * 500), (7, "y", "é" * 500), (None, "k", "solo" * 400),
         (8, "", ""), (9, "n", "\r\n\r\nWARC/1.1\r\n" * 100)]


def _pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 1, "c") for r in rows], "page_id long, url string, html string, n int, digest string")


def test_bundle_frames_are_independent():
    out = io.BytesIO()
    b = Bundle(out, 100)
    records = [bytes([65 + k]) * (k * 13 + 1) for k in range(20)]
    at = [b.add(r) for r in records]
    b.close()
    data = out.getvalue()
    table = seek_table(io.BytesIO(data), len(data))
    assert max(f for f, _ in at) == len(table) - 1 > 3
    for r, (f, o) in zip(records, at):
        assert read_frame(io.BytesIO(data), *table[f])[o:o + len(r)] == r
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole == b"".join(records)  # plain readers skip the seek table


def test_round_trip_of_odd_pages(spark):
    got = [tuple(r) for r in round_trip(_pages(spark)).collect()]
    assert len(got) == len(PAGES)
    by = {}
    for p, n, digest, kind, refers in got:
        by.setdefault(p, []).append((n, digest, kind, refers))
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    x, e = "x" * 1500, "é" * 500
    assert by[1] == [(1500, sha(x), "revisit", 2)]
    assert sorted(by[2], key=str) == [(1500, sha(x), "response", None), (1500, sha(x), "revisit", 2)]
    assert by[3] == by[8] == [(0, sha(""), "response", None)]
    assert by[4] == by[5] == [(800, sha("é" * 400), "response", None)]
    assert by[6] == [(1000, sha(e), "revisit", 7)] and by[7] == [(1000, sha(e), "response", None)]
    assert sorted(by[None], key=str) == [(1500, sha(x), "revisit", 2), (1600, sha("solo" * 400), "response", None)]
    assert round_trip(_pages(spark).limit(0)).count() == 0


def test_fetch_reads_single_frames(spark):
    pages = C.table(spark, SF_SMALL, "pages")
    manifest = write_archives(pages, frame_bytes=20_000)
    assert manifest.select("file", "frame").distinct().count() > 3
    wanted = pages.select("page_id").where("page_id % 7 = 3")
    got = {r.page_id: bytes(r.payload) for r in fetch(manifest, wanted).collect()}
    assert got == {r.page_id: r.html.encode() for r in pages.where("page_id % 7 = 3").collect()}
    assert read_archives(manifest).count() == pages.count()


def test_a_damaged_bundle_is_noticed(spark):
    manifest = write_archives(_pages(spark))
    file = manifest.first()["file"]
    fs, path = filesystem(file)
    with fs.open_input_file(path) as f:
        data = f.read()
    with fs.open_output_stream(path) as f:
        f.write(data[:-3])
    try:
        read_archives(manifest).collect()
        raise AssertionError("not noticed")
    except Exception as e:  # noqa: BLE001 - the worker's ValueError comes wrapped
        assert "seek table" in str(e)
