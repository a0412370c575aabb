import base64
import hashlib
import io

import pytest
import zstandard

from mentionlake.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "old") for r in rows], SCHEMA)


def test_round_trip(spark):
    rows = [(i, f"http://h/{i}?q=ü x", f"<p>page {i % 7} é</p>" * 40) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "", "日本語"), (None, "u", "alone"), (None, "u", rows[0][2]), (5, "u", rows[5][2])]
    manifest = warc.write_archives(pages_of(spark, rows).repartition(3))
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(rows) == sum(r.records for r in manifest.collect())
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max((x for x in (i, largest.get(html or "")) if x is not None), default=None)
    text = {i: html or "" for i, _, html in rows if i is not None}
    for r in got:
        first = r.refers_to if r.record_type == "revisit" else r.page_id
        body = text[first] if first is not None else "alone"
        assert (r.payload_bytes, r.payload_digest) == (len(body.encode()), digest(body))
        assert (r.record_type == "response") == (r.page_id == largest[body])
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or bytes(r.payload) == body.encode()


def test_files_begin_with_a_dictionary_and_hold_a_frame_per_record(spark):
    rows = [(i, f"http://h/{i}", f"<html><body>text number {i} of the site, {i * i}</body></html>" * 5) for i in range(400)]
    manifest = warc.write_archives(pages_of(spark, rows).coalesce(1)).collect()
    fs, path = warc.file_system(manifest[0].path)
    data = fs.open_input_stream(path).read()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
    size = int.from_bytes(data[4:8], "little")
    assert zstandard.ZstdDecompressor().decompress(data[8 : 8 + size], max_output_size=1 << 20)[:4] == b"\x37\xa4\x30\xec"
    assert data.count(warc.FRAME_MAGIC) >= 401


def written(tmp_path, records):
    writer = warc.Writer(str(tmp_path))
    for r in records:
        writer.add(r)
    return writer.close()


def record(i, payload):
    return warc.build(i, f"http://h/{i}", payload, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response", None)


def test_small_and_huge_records_and_several_files(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    payloads = [bytes([i]) * (i * 37) for i in range(50)] + [hashlib.sha512(b"x").digest() * 60_000]
    done = written(tmp_path, [record(i, p) for i, p in enumerate(payloads)])
    assert len(done) > 1 and sum(n for _, n, _ in done) == len(payloads)
    got = [r for path, _, _ in done for r in warc.read_archive(path)]
    assert [r["payload"] for r in got] == payloads


@pytest.mark.parametrize("change", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9", 1),
    lambda r: r.replace(b"WARC-Type: response\r\n", b"", 1),
    lambda r: r.replace(b"WARC-Date", b"X-Date", 1),
    lambda r: r[:-1],
    lambda r: r + b"more",
    lambda r: r.replace(b"hello", b"jello"),
    lambda r: r.replace(b"Content-Length: 5\r\n\r\n", b"Content-Length: 6\r\n\r\n"),
    lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: anything"),
    lambda r: r.replace(b"\r\nWARC-Date", b"\r\nno colon\r\nWARC-Date"),
])
def test_faulty_records_are_refused(change):
    good = record(1, b"hello")
    assert warc.parse(good)["payload"] == b"hello"
    with pytest.raises(warc.ArchiveError):
        warc.parse(change(good))


def test_faulty_files_are_refused(tmp_path):
    (path, _, _), = written(tmp_path, [record(i, b"payload %d" % i * 30) for i in range(300)])
    data = open(path, "rb").read()
    for broken in (data[:-3], data[:6], data + b"junk", data[: len(data) // 2] + data[len(data) // 2 + 9 :]):
        with pytest.raises((warc.ArchiveError, zstandard.ZstdError)):
            list(warc.frames(io.BytesIO(broken)))


def test_archives_without_dictionary_or_records(tmp_path):
    assert written(tmp_path, []) == []
    plain = zstandard.ZstdCompressor().compress(record(3, b"x"))
    assert warc.parse(next(warc.frames(io.BytesIO(plain))))["page_id"] == 3
    assert list(warc.frames(io.BytesIO(b""))) == []


def test_empty_table(spark):
    assert warc.read_archives(warc.write_archives(pages_of(spark, []))).count() == 0
