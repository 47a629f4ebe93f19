import hashlib

import pytest
import zstandard

from mixlab.llm import warc

SCHEMA = "page_id long, url string, html string"


def archive(records, dictionary=b"", gap=b""):
    chosen = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    coder = zstandard.ZstdCompressor(dict_data=chosen, write_checksum=True)
    return warc.dictionary_frame(dictionary) + gap.join(coder.compress(r) for r in records)


def good(number=1, payload=b"payload"):
    return warc.build_record(number, "http://a.example/", payload)


def test_records_round_trip():
    dictionary = zstandard.train_dictionary(2000, [good(i, f"common text {i} of all pages {i * 7}".encode() * 3) for i in range(300)]).as_bytes()
    for known in (b"", dictionary):
        records = [good(1, b""), good(None, b"\r\n\r\n" * 3), good(-5, bytes(range(256)) * 4000), warc.build_record(2, None, b"x", 1, revisit=True)]
        read = list(warc.read_archive(archive(records, known, warc.GAP.encode())))
        assert [r["page_id"] for r in read] == [1, None, -5, 2]
        assert [r["payload"] for r in read] == [b"", b"\r\n\r\n" * 3, bytes(range(256)) * 4000, None]
        assert read[3]["record_type"] == "revisit" and read[3]["refers_to"] == 1 and read[3]["payload_bytes"] == 1
        assert read[0]["url"] == "http://a.example/" and read[3]["url"] is None


def test_raw_dictionary_in_front():
    head = warc.DICTIONARY_MAGIC + (3).to_bytes(4, "little") + b"abc"
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(b"abc"))
    assert [r["page_id"] for r in warc.read_archive(head + coder.compress(good()))] == [1]


@pytest.mark.parametrize(
    "broken",
    [
        b"", b"abc", archive([good()])[8:], archive([good()])[:-3], archive([good()]) + b"junkjunk",
        archive([good().replace(b"WARC/1.1", b"HTTP/1.1", 1)]), archive([good()[:-1]]), archive([good().replace(b"payload\r\n", b"paYload\r\n")]),
        archive([good().replace(b"Content-Length: 7", b"Content-Length: 8")]), archive([good().replace(b"WARC-Type: response", b"WARC-Type: metadata")]),
        archive([good().replace(b"WARC-Type", b"WARC Type: x\r\nWARC-Type", 1).replace(b"WARC Type: x", b"no colon")]), archive([good().replace(b"urn:mixlab:page:1", b"urn:other:1")]),
        archive([good().replace(b"\r\nWARC-Payload-Digest", b"\r\nWARC-Type: response\r\nWARC-Payload-Digest")]), archive([b"x"]),
    ],
)
def test_broken_archives_are_refused(broken):
    with pytest.raises((warc.ArchiveError, zstandard.ZstdError)):
        list(warc.read_archive(broken))


def brute(rows, least):
    best = {}
    for k, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least:
            best[body] = max(best.get(body, -(2**63)), -(2**63) if k is None else k)
    out = []
    for k, _, html in rows:
        body = (html or "").encode()
        first = best.get(body, k)
        first = None if first == -(2**63) else first
        revisit = len(body) >= least and first != k
        out.append((str(k), len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", str(first if revisit else None)))
    return sorted(out)


def got(df):
    return sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in df.collect())


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (2, None, ""), (3, "a\r\nb", "é" * 500), (4, "u", "é" * 500), (5, "u", "é" * 499 + "x"), (6, "u", "é" * 499 + "x"), (9, "u", "é" * 500),
        (9, "u", "é" * 500), (None, "u", "z" * 3000), (None, "u", "é" * 500), (7, "u", "long " * 200000),
    ]
    assert got(warc.archive_round_trip(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 1000)
    assert got(warc.archive_round_trip(spark.createDataFrame([], SCHEMA))) == []
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'q' AS digest", "1 AS response", "'r' AS frame")
    assert got(warc.archive_round_trip(wide)) == brute(rows, 1000)


def test_payloads_come_back_whole(spark, folder, tmp_path):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    warc.write_archives(pages, str(tmp_path / "out"))
    want = {r["page_id"]: r for r in pages.collect()}
    rows = warc.read_archives(spark, str(tmp_path / "out"), payloads=True).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(want)
    for r in rows:
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == want[r["page_id"]]["html"] and r["url"] == want[r["page_id"]]["url"]
        else:
            assert want[r["refers_to"]]["html"] == want[r["page_id"]]["html"]
    kinds = [(str(k), r["url"], r["html"]) for k, r in want.items()]
    assert len(kinds) == len(rows)
