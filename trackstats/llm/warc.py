"""WARC archives compressed with Zstandard.

An archive begins with a skippable frame that holds the dictionary; every record
is one frame of its own. The reader takes the dictionary from that frame, decodes
frame by frame and checks version, headers, lengths, record ends and digests.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import lookup, scratch_path
from .registry import query, table
from .store import stored

#: Magic number of the skippable frame that holds an archive's dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
#: The dictionary: its size, and the bounded sample of payloads it is trained on.
DICTIONARY_BYTES, SAMPLE_ROWS, SAMPLE_PAYLOAD = 1 << 16, 400, 1 << 16
#: An archive is closed when it has reached this size.
ARCHIVE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = b"\r\n"


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pyarrow.fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(key: int | None, place: str = "") -> str:
    """The name of a page; a record adds its place, since page_ids may repeat or be missing."""
    return f"<urn:page:{'' if key is None else key}{place and ':' + place}>"


def _key(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">").partition(":")[0]
    return int(text) if text else None


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, place: str = "") -> bytes:
    """One record: a response with its payload, or a revisit of the page ``refers_to`` without it."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += b"" if revisit else payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(key, place)), ("WARC-Date", DATE),
            ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        head += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)]
    head.append(("Content-Length", str(len(block))))
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in head]]
    return "\r\n".join(lines).encode() + 2 * _CRLF + block + 2 * _CRLF


def parse(data: bytes) -> dict:
    """The fields of one record; ``problem`` says what is wrong with it, else null."""
    out = dict.fromkeys(("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "problem"))
    try:
        head, _, rest = data.partition(2 * _CRLF)
        version, *lines = head.split(_CRLF)
        if version not in (b"WARC/1.0", b"WARC/1.1"):
            raise ValueError("version")
        fields = {}
        for line in lines:
            name, colon, value = line.partition(b":")
            if not colon or not name.strip():
                raise ValueError("header line")
            fields[name.strip().lower().decode()] = value.strip().decode()
        missing = [x for x in ("warc-type", "warc-record-id", "warc-date", "content-length") if x not in fields]
        if missing:
            raise ValueError(f"missing {missing[0]}")
        length = int(fields["content-length"])
        block, end = rest[:length], rest[length:]
        if len(block) != length or end != 2 * _CRLF:
            raise ValueError("content length")
        out |= {"record_type": fields["warc-type"], "page_id": _key(fields["warc-record-id"]),
                "url": fields.get("warc-target-uri"),
                "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None}
        http, _, payload = block.partition(2 * _CRLF)
        declared = [int(x.split(b":", 1)[1]) for x in http.split(_CRLF) if x.lower().startswith(b"content-length:")]
        out["payload_bytes"] = declared[0] if declared else len(payload)
        if out["record_type"] == "revisit":
            out["refers_to"] = _key(fields["warc-refers-to"])
            if payload:
                raise ValueError("payload of a revisit")
        else:
            out["payload"] = payload
            if len(payload) != out["payload_bytes"]:
                raise ValueError("payload length")
            if digest_of(payload) != out["payload_digest"]:
                raise ValueError("payload digest")
    except (ValueError, KeyError, UnicodeDecodeError) as e:
        out["problem"] = str(e) or "malformed"
    return out


def frames(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one frame each, read piece by piece."""
    data = stream.read(8)
    dictionary = None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        dictionary = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", data[4:])[0]))
        data = b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while True:
        data = data or stream.read(size)
        if not data:
            return
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(size)
            if not data:
                raise ValueError("the last frame is cut off")
        yield b"".join(parts)


def _writer(folder: str, dictionary: bytes | None):
    def run(batches):
        part = TaskContext.get().partitionId()
        files, base = file_system(folder)
        files.create_dir(base, recursive=True)
        lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=True)
        made, out, size, count, temp = [], None, 0, 0, ""

        def close():
            out.close()
            path = f"{base}/part-{part:06d}-{len(made):04d}.warc.zst"
            files.move(temp, path)  # whole archives only bear the final name; a repeated task makes the same ones
            made.append((f"{folder}/{os.path.basename(path)}", count, size))

        for batch in batches:
            for key, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    temp = f"{base}/.{part:06d}-{len(made):04d}-{os.urandom(8).hex()}"
                    out, count = files.open_output_stream(temp, compression=None), 0
                    out.write(lead)
                    size = len(lead)
                frame = packer.compress(record(key, url, payload, digest, refers_to, f"{part}-{len(made)}-{count}"))
                out.write(frame)
                size, count = size + len(frame), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.int64()))], names=["archive", "records", "bytes"])
    return run


def train_dictionary(payloads: DataFrame, *, rows: int = SAMPLE_ROWS) -> bytes | None:
    """A dictionary from at most ``rows`` payloads of at most ``SAMPLE_PAYLOAD`` bytes; None if that is too little."""
    sample = (payloads.where(F.octet_length("payload").between(1, SAMPLE_PAYLOAD))
              .orderBy(F.xxhash64("payload"), "payload").limit(rows).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r.payload) for r in sample]).as_bytes()
    except zstandard.ZstdError:
        return None


def write_archives(pages: DataFrame, folder: str, *, revisit_from: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``) below ``folder``; returns ``archive, records, bytes``.

    Of equal payloads of ``revisit_from`` bytes or more, the one with the
    smallest page_id is the response. Rows that share that page_id are all
    responses, a row without page_id is a revisit if another row has one. A null
    html is an empty payload.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("hex", F.sha1("payload"))
    groups = (rows.select("page_id", "hex", F.octet_length("payload").alias("n")).where(F.col("n") >= revisit_from)
              .groupBy("hex").agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 and owner is not null").select("hex", "owner"))
    joined = lookup(rows, groups, ["hex"], "left")  # the payloads of one digest may go to many tasks
    refers = F.when(~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner"))
    laid = joined.select("page_id", "url", "payload", "hex", refers.alias("refers_to"))
    return stored(laid.mapInArrow(_with_digest(_writer(folder, train_dictionary(rows.select("payload")))),
                                  "archive string, records long, bytes long"), "archives")


def _with_digest(write):
    """Base32 from the hexadecimal digest, record by record."""
    def run(batches):
        def plain():
            for b in batches:
                base32 = [base64.b32encode(bytes.fromhex(x)).decode() for x in b.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(base32, pa.string()), b.column(4)],
                                                 names=b.schema.names)
        return write(plain())
    return run


RECORD = ("archive string, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary, problem string")


def _reader(with_payload: bool):
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                files, path = file_system(uri)
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for data in frames(stream):
                        found = parse(data) | {"archive": uri}
                        if not with_payload:
                            found["payload"] = None
                        rows.append(found)
                        size += len(data)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)
                            rows, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)
    return run


def read_archives(archives: DataFrame, *, payload: bool = True) -> DataFrame:
    """The records of the archives named in the column ``archive``, with ``problem`` null where all checks hold."""
    spark: SparkSession = archives.sparkSession
    paths = archives.select("archive").repartition(spark.sparkContext.defaultParallelism * 4)
    return paths.mapInArrow(_reader(payload), RECORD)


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@query(f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
owner AS (SELECT hex, min(page_id) AS owner, count(*) AS copies FROM p GROUP BY hex)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', CAST(((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER)
    >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN copies > 1 AND page_id IS DISTINCT FROM owner AND owner IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN copies > 1 AND page_id IS DISTINCT FROM owner THEN owner END AS refers_to,
  CAST(NULL AS VARCHAR) AS problem
FROM p JOIN owner USING (hex)""")
def op9_warc_round_trip(spark, folder):
    made = write_archives(table(spark, folder, "pages"), scratch_path(spark) + "/warc")
    found = read_archives(made, payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")
