"""WARC archives in Zstandard frames: one frame per record, a shared dictionary in front.

Layout of an archive (the public .warc.zst convention): a skippable frame (magic
0x184D2A5D) that holds the dictionary, then a frame per record. Other skippable frames
may stand between records and are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.session import stage, staging_path

# Fixed values of the Zstandard format (RFC 8878) and of the dictionary frame.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
# An empty skippable frame: pure ASCII, so that a text sink can write it between records.
GAP = "\x50\x2a\x4d\x18\x00\x00\x00\x00"

LEAST_PAYLOAD = 1000
SAMPLE_PAGES = 400
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
MAX_RECORD = 1 << 31



class ArchiveError(ValueError):
    """An archive that breaks the format or whose lengths or digests disagree."""


def _name(page_id: int | None) -> str:
    return f"<urn:mixlab:page:{'none' if page_id is None else page_id}>"


def _id(name: str) -> int | None:
    found = re.fullmatch(r"<urn:mixlab:page:(none|-?[0-9]+)>", name)
    if not found:
        raise ArchiveError(f"unknown record id {name}")
    return None if found[1] == "none" else int(found[1])


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines.append(f"WARC-Refers-To: {_name(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(block: bytes, first: str) -> tuple[dict[str, str], bytes]:
    head, gap, rest = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith(first):
        raise ArchiveError(f"no {first} headers")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"bad header line {line!r}")
        if name.lower() in fields:
            raise ArchiveError(f"header {name} twice")
        fields[name.lower()] = value.strip()
    return fields, rest


def parse_record(record: bytes) -> dict:
    """The fields of a record, after checking version, lengths, end and digest."""
    fields, rest = _headers(record, "WARC/1.")
    for name in ("warc-type", "warc-record-id", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise ArchiveError(f"no {name}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4:
        raise ArchiveError("the block's length is not the one in the header")
    if rest[-4:] != b"\r\n\r\n":
        raise ArchiveError("the record does not end in two line ends")
    http, payload = _headers(rest[:-4], "HTTP/1.")
    if not http.get("content-length", "").isdigit():
        raise ArchiveError("no payload length")
    kind, size = fields["warc-type"], int(http["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ArchiveError("the payload is not the one in the headers")
    elif kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise ArchiveError(f"bad {kind} record")
    return {
        "page_id": _id(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _id(fields["warc-refers-to"]) if kind == "revisit" else None,
    }


def frames(archive: memoryview) -> Iterator[tuple[bool, memoryview]]:
    """(is skippable, frame) for each frame; ends are found from the block headers, without decoding."""
    at, end = 0, len(archive)
    while at < end:
        if end - at < 8:
            raise ArchiveError("cut off between frames")
        magic = int.from_bytes(archive[at : at + 4], "little")
        if magic in SKIPPABLE:
            stop = at + 8 + int.from_bytes(archive[at + 4 : at + 8], "little")
            skip = True
        elif archive[at : at + 4] == FRAME_MAGIC:
            skip, stop = False, at + zstandard.frame_header_size(archive[at : at + 18])
            last = False
            while not last:
                head = int.from_bytes(archive[stop : stop + 3], "little")
                last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
                if kind == 3 or stop + 3 > end:
                    raise ArchiveError("bad block")
                stop += 3 + (1 if kind == 1 else size)
            stop += 4 * (archive[at + 4] >> 2 & 1)
        else:
            raise ArchiveError("neither a frame nor a skippable frame")
        if stop > end:
            raise ArchiveError("cut off inside a frame")
        yield skip, archive[at:stop]
        at = stop


def read_archive(archive: bytes) -> Iterator[dict]:
    """The records of an archive, each decoded and checked by itself."""
    view, decoder = memoryview(archive), None
    for skip, frame in frames(view):
        if decoder is None:
            if frame[:4] != DICTIONARY_MAGIC:
                raise ArchiveError("the archive does not start with a dictionary")
            content = bytes(frame[8:])
            if content[:4] == FRAME_MAGIC:
                content = zstandard.ZstdDecompressor().decompress(content, max_output_size=MAX_RECORD)
            decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content)) if content else zstandard.ZstdDecompressor()
        elif not skip:
            size = zstandard.frame_content_size(frame)
            if size < 0 or size > MAX_RECORD:
                raise ArchiveError("a record must state its length")
            record = decoder.decompress(frame)
            if len(record) != size:
                raise ArchiveError("the frame's length is not the one it states")
            yield parse_record(record)
    if decoder is None:
        raise ArchiveError("empty archive")


def train_dictionary(pages: DataFrame, html_col: str = "html", pages_used: int = SAMPLE_PAGES, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``pages_used`` pages; it only affects how small the archives get.

    Too few or too small pages give an empty dictionary.
    """
    sample = [bytes(r[0]) for r in pages.select(F.substring(html_col, 1, 20000).cast("binary")).where(F.col(html_col).isNotNull()).limit(pages_used).collect()]
    sample = [build_record(0, "http://example.org/", s) for s in sample if s]
    try:
        return zstandard.train_dictionary(size, sample).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
    return DICTIONARY_MAGIC + len(packed).to_bytes(4, "little") + packed


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    chosen = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=chosen, write_checksum=True, write_content_size=True)


def write_archives(pages: DataFrame, path: str, least: int = LEAST_PAYLOAD, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one archive per partition under ``path``.

    Each page is compressed once, as a response, where it is scanned; only these frames
    are shuffled, by payload digest, to meet the largest page id of their payload. Pages
    whose payload of at least ``least`` bytes another page of larger id has become
    revisits. Counting is combined in the map tasks and the join can be split, so that
    many copies of one page are not gathered.

    A null html is an empty payload. A null page id comes before all others. Pages that
    repeat the largest id are all responses. An empty table gives archives without
    records or no archive. Extra columns are not written.
    """
    dictionary = train_dictionary(pages, html_col)
    head = dictionary_frame(dictionary)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _compressor(dictionary)
        for batch in batches:
            ids, urls, bodies = (c.to_pylist() for c in batch.columns)
            payloads = [b or b"" for b in bodies]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(urls, pa.string()),
                    pa.array([len(p) for p in payloads], pa.int64()),
                    pa.array([hashlib.sha1(p).hexdigest() for p in payloads], pa.string()),
                    pa.array([encoder.compress(build_record(i, u, p)) for i, u, p in zip(ids, urls, payloads)], pa.binary()),
                ],
                names=["page_id", "url", "payload_bytes", "digest", "frame"],
            )

    def seal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _compressor(dictionary), zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
        first = True
        for batch in batches:
            if first and batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([head], pa.binary())], names=["frame"])
                first = False
            out = []
            for row in batch.to_pylist():
                frame = row["frame"]
                if row["response"] is not None and row["response"] != row["page_id"]:
                    payload = parse_record(decoder.decompress(frame))["payload"]
                    frame = encoder.compress(build_record(row["page_id"], row["url"], payload, row["response"], revisit=True))
                out.append(frame)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("binary").alias("html")
    )
    packed = stage(source.mapInArrow(compress, "page_id long, url string, payload_bytes long, digest string, frame binary"), "frames")
    chosen = packed.where(F.col("payload_bytes") >= least).groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("response"), F.count("*").alias("_n"))
    chosen = stage(chosen.where("_n > 1").select(F.col("digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"), "response"), "chosen")
    joined = packed.join(chosen, (F.col("digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes")), "left")
    sealed = joined.select("page_id", "url", "frame", "response").mapInArrow(seal, "frame binary")
    # The sink writes a string's bytes as they are, and an empty skippable frame after each.
    sealed.select(F.col("frame").cast("string")).write.option("lineSep", GAP).option("compression", "none").text(path)


def read_archives(spark, path: str, payloads: bool = False) -> DataFrame:
    """The records of all archives under ``path``; a broken one stops the read with ``ArchiveError``.

    With ``payloads`` the url and the payload of responses follow.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        kinds += [("url", pa.string()), ("payload", pa.binary())] if payloads else []

        def rows(held: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], t) for n, t in kinds], names=[n for n, _ in kinds])

        for batch in batches:
            for archive in batch.column(0):
                held: list[dict] = []
                for record in read_archive(archive.as_py()):
                    if not payloads:
                        record["payload"] = None
                    held.append(record)
                    if len(held) >= 1000:
                        yield rows(held)
                        held = []
                if held:
                    yield rows(held)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", url string, payload binary" if payloads else ""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("content")
    return files.mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write the pages' archives into the shared folder and read the records back."""
    spark = pages.sparkSession
    path = staging_path(spark, "warc")
    write_archives(pages, path, least)
    return read_archives(spark, path)
