"""Archives with malformed records: rows with a problem, no lost neighbours, every byte read about once."""

from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from landfall.llm import warc
from landfall.sources.staging import scratch_root


def payload(i: int) -> bytes:
    return f"<p>{i} {random.Random(i).random()}</p>".encode() * 3


def member(i: int, fields: dict[str, str] | None = None, dropped: str = "") -> bytes:
    body = payload(i)
    raw = gzip.decompress(warc.record("response", i, f"http://h/{i}", body, hashlib.sha1(body).hexdigest(), len(body), None)).decode()
    head, _, rest = raw.partition("\r\n\r\n")
    lines = [line for line in head.split("\r\n") if not dropped or not line.startswith(dropped)]
    lines = [f"{n}: {(fields or {})[n]}" if (n := line.split(":")[0]) in (fields or {}) else line for line in lines]
    return gzip.compress(("\r\n".join(lines) + "\r\n\r\n" + rest).encode())


def read(spark, name: str, parts: list[bytes], split: int = 1 << 20, records: int | None = None):
    folder = f"{scratch_root(spark)}/malformed-{name}-{split}"
    system, root = warc._open(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/a.warc.gz", compression=None) as out:
        out.write(b"".join(parts))
    manifest = spark.createDataFrame([(f"{folder}/a.warc.gz", sum(map(len, parts)), len(parts) if records is None else records)],
                                     "path string, bytes bigint, records bigint")
    return manifest, warc.read_archives(manifest, split).cache()


@pytest.mark.parametrize("split", [700, 1 << 20])
def test_one_corrupt_byte_costs_one_record_and_shows(spark, split):
    parts = [member(i) for i in range(60)]
    parts.insert(20, warc.record("response", 500, None, bytes(random.Random(1).randbytes(3000)), "00" * 20, 3000, None))
    for at in (0, 1, len(parts[20]) // 2, len(parts[20]) - 6):  # the magic, a content byte, the checksum
        hurt = bytearray(parts[20])
        hurt[at] ^= 0xFF
        manifest, rows = read(spark, f"byte{at}", [*parts[:20], bytes(hurt), *parts[21:]], split)
        got = rows.collect()
        assert sorted(r.page_id for r in got if r.payload is not None) == list(range(60))
        assert [r.page_id for r in got if r.problem == warc.UNFOLLOWED] == ([19] if at < 2 else [])
        bad = [r for r in got if r.problem not in (None, warc.UNFOLLOWED)]
        assert [(r.position, r.payload) for r in bad] == [(sum(map(len, parts[:20])), None)]
        assert [r.problem for r in bad] == [warc.NO_RECORD if at < 2 else warc.BROKEN]
        assert bad[0].page_id == (None if at < 2 else 500)
        assert [(r.records, r.read, r.problems) for r in warc.missing_records(manifest, rows).collect()] == [(61, 60, 2 if at < 2 else 1)]


def test_stated_digests_and_lengths_are_compared_not_trusted(spark):
    hexadecimal = "sha1:" + hashlib.sha1(payload(1)).hexdigest().upper()
    parts = [member(0), member(1, {"WARC-Payload-Digest": hexadecimal}), member(2, {"WARC-Payload-Digest": "sha1:" + "0" * 40}),
             member(3, dropped="Content-Length"), member(4, {"Content-Length": "9999"}), member(5, {"WARC-Payload-Digest": "sha1:?"}),
             member(6, {"WARC-Payload-Digest": "md5:00"}), member(7, {"Content-Length": "many"}), member(8, {"WARC-Type": "metadata"})]
    manifest, rows = read(spark, "stated", parts)
    got = {r.page_id: r for r in rows.collect()}
    assert {i: r.problem for i, r in got.items()} == {
        0: None, 1: None, 2: "payload does not match its digest", 3: "length of the block is not stated", 4: "block is shorter than stated",
        5: "digest is not readable", 6: None, 7: "length of the block is not stated"}
    assert all(r.payload_digest == hashlib.sha1(payload(i)).hexdigest() and bytes(r.payload) == payload(i) for i, r in got.items() if i != 4)
    assert warc.missing_records(manifest, rows).select("records", "read", "problems").collect() == [(9, 8, 5)]


@pytest.mark.parametrize("split", [500, 1 << 20])
def test_a_file_that_breaks_off_and_bytes_that_are_no_record(spark, split):
    parts = [member(i) for i in range(20)]
    _, rows = read(spark, "short", [*parts[:19], parts[19][:-30]], split)
    assert sorted(r.page_id for r in rows.where("problem is null").collect()) == list(range(19))
    assert [(r.position, r.problem) for r in rows.where("problem is not null").collect()] == [(sum(map(len, parts[:19])), warc.BROKEN)]
    _, rows = read(spark, "between", [*parts[:9], b"no record here", *parts[9:]], split)
    assert sorted(r.page_id for r in rows.where("payload is not null").collect()) == list(range(20))
    assert [(r.page_id, r.problem) for r in rows.where("problem is not null").orderBy("position").collect()] == [(8, warc.UNFOLLOWED), (None, warc.NO_RECORD)]
    assert rows.agg(F.max(F.when(F.col("page_id").isNull(), F.col("position")))).first()[0] == sum(map(len, parts[:9]))


def test_whole_archives_miss_nothing(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", payload(i).decode()) for i in range(50)], "page_id bigint, url string, html string")
    manifest = warc.write_archives(pages, f"{scratch_root(spark)}/whole")
    rows = warc.read_archives(manifest, 200)
    assert warc.missing_records(manifest, rows).count() == 0 and rows.where(F.col("problem").isNotNull()).count() == 0
    unread = warc.missing_records(manifest, rows.limit(0)).collect()
    assert sum(r.records for r in unread) == 50 and {r.read for r in unread} == {0}


def test_every_byte_is_read_about_once():
    class Counted(io.BytesIO):
        taken = 0

        def read(self, n: int = -1) -> bytes:
            got = super().read(n)
            self.taken += len(got)
            return got

    raw = b"".join(member(i) for i in range(8000))
    file = Counted(raw)
    assert sum(1 for _ in warc.members(file, 0, len(raw), len(raw))) == 8000
    assert file.taken <= 1.1 * len(raw)
