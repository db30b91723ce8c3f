"""Round trips of records, archives and whole tables."""

from __future__ import annotations

import hashlib
import random

import zstandard

from cellpulse.llm import warc
from cellpulse.session import scratch_path

SCHEMA = "page_id long, url string, html string, sha1 string, n_bytes int"


def expected(pages):
    first = {}
    for i, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            first[data] = max(first.get(data, i), i)
    rows = []
    for i, _, html in pages:
        data = (html or "").encode()
        refers = first.get(data)
        refers = None if refers == i else refers
        rows.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return rows


def test_archive_round_trip():
    rng = random.Random(1)
    records = [bytes(rng.choices(b"abc <p>", k=rng.randrange(5000))) for _ in range(300)] + [b"", b"x" * 300_000]
    archive = warc.archive_of(records) + warc.EMPTY_FRAME.encode()
    assert list(warc.records_in(archive)) == records
    assert archive[:4] == (0x184D2A5D).to_bytes(4, "little")
    # Any tool that knows the dictionary reads the rest as one stream of frames.
    size = int.from_bytes(archive[4:8], "little")
    known = zstandard.ZstdCompressionDict(archive[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=known).stream_reader(archive, read_across_frames=True)
    assert reader.read() == b"".join(records)


def test_table_round_trip(spark):
    rng = random.Random(2)
    long = ["".join(rng.choices("abé\n<", k=1500)) for _ in range(5)]
    pages = [(i, f"http://a/{i}\r\n", rng.choice(long)) for i in range(60)]
    pages += [(100, None, None), (101, "u", ""), (102, "u", "x" * 999), (103, "u", "x" * 999)]
    pages += [(104, "u", "y" * 1000), (104, "u", "y" * 1000), (103, "u", "y" * 1000), (None, "u", "y" * 1000)]
    pages += [(None, "u", "z" * 1000), (None, None, "z" * 1000), (2**62 + 1, "u", "w" * 2_000_000)]
    frame = spark.createDataFrame([(*p, "clash", 7) for p in pages], SCHEMA)
    path = scratch_path(spark, "warc")
    warc.write_archives(frame, path)
    got = [tuple(r) for r in warc.read_archives(spark, path).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(expected(pages), key=key)


def test_empty(spark):
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0
