"""WARC archives compressed with Zstandard: one frame a record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, staged

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
MAGIC = 0xFD2FB528
DICTIONARY = b"\x37\xa4\x30\xec"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST = 100  # bytes of the smallest payload that another may revisit
ARCHIVE = 24 << 20  # bytes of records in an archive before compression
SAMPLE, DICT_BYTES = 200, 64 << 10  # texts, and bytes, of the dictionary of an archive
FRAME_MOST = 1 << 31
MANIFEST = "_manifest"  # table of the archives of a folder that count


class WarcError(ValueError):
    """An archive that breaks the format."""


# --- writing ---------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, serial: str) -> bytes:
    """One record: a response with its payload, or a revisit that names the response's page."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, serial)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url and not any(c in url for c in "\r\n"):
        lines.insert(3, f"WARC-Target-URI: {url}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> bytes:
    """A dictionary from a bounded sample of the archive's first records; raw text where too few."""
    import zstandard

    sample = [r[:4096] for r in records[:SAMPLE]]
    try:
        return zstandard.train_dictionary(DICT_BYTES, sample).as_bytes() if len(sample) >= 50 else b""
    except zstandard.ZstdError:
        return b""


def archive(records: list[bytes]) -> bytes:
    import zstandard

    d = _dictionary(records)
    head = b""
    if d:
        packed = zstandard.ZstdCompressor(level=3).compress(d)
        head = struct.pack("<II", SKIPPABLE, len(packed)) + packed
    c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_checksum=True)
    return head + b"".join(map(c.compress, records))


def _write(folder: str, name: str, data: bytes) -> None:
    """A whole file or none: written beside its place, then renamed; a task run again writes the same."""
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    tmp = f"{path}/_{name}.{uuid.uuid4().hex}"
    with where.open_output_stream(tmp) as f:
        f.write(data)
    where.move(tmp, f"{path}/{name}")


def write_archives(pages: DataFrame, folder: str, *, least: int = LEAST, archive_bytes: int = ARCHIVE) -> int:
    """Write a record for each row of ``page_id, url, html`` to ``folder``; returns the number of records.

    Of rows with equal payloads of ``least`` bytes or more, those with the smallest id are
    responses and the others revisit it. Only digests that occur twice are joined back to the
    pages; counts are combined before the shuffle, and a hot digest is one row there.

    Null html is an empty payload; a null id is never the smallest, unless all of a group are
    null: then all of them are responses. Rows that share the smallest id are all responses. Null
    urls, and those with a line break, have no target line. Other columns are not read.

    Archives are named by the attempt of the task that writes them, and those of successful
    attempts are listed in ``_manifest``: a task that runs again adds no record.
    """
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    repeats = (
        keyed.where(F.octet_length("html") >= least)
        .groupBy(F.col("digest").alias("r_digest"))
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
        .where("n > 1 AND first IS NOT NULL")
        .select("r_digest", "first")
    )
    repeats = staged(repeats, "repeats")
    rows = keyed.join(repeats, F.col("digest") == F.col("r_digest"), "left")
    rows = rows.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, n, k, held, size = context.partitionId(), 0, 0, [], 0
        names: list[tuple[str, int]] = []

        def close() -> None:
            names.append((f"part-{part:06d}-{context.taskAttemptId():010d}-{k:04d}.warc.zst", len(held)))
            _write(folder, names[-1][0], archive(held))

        for batch in batches:
            for page_id, url, html, digest, to in zip(*(batch.column(i) for i in range(5)), strict=True):
                held.append(record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), digest.as_py(), to.as_py(), f"{folder}/{part}/{n}"))
                size += len(held[-1])
                n += 1
                if size >= archive_bytes:
                    close()
                    held, size, k = [], 0, k + 1
        if held:
            close()
        yield pa.RecordBatch.from_pydict({"name": pa.array([x for x, _ in names], pa.string()), "n": pa.array([x for _, x in names], pa.int64())})

    # an attempt that fails, or is made twice, leaves archives that the manifest doesn't name
    rows.mapInArrow(run, "name string, n long").write.parquet(f"{folder}/{MANIFEST}")
    return pages.sparkSession.read.parquet(f"{folder}/{MANIFEST}").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


# --- reading ---------------------------------------------------------------


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its headers alone."""
    if len(data) - at < 6 or struct.unpack_from("<I", data, at)[0] != MAGIC:
        raise WarcError(f"no frame at byte {at}")
    flags = data[at + 4]
    single = flags >> 5 & 1
    pos = at + 5 + (0 if single else 1) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    while True:
        if pos + 3 > len(data):
            raise WarcError(f"the frame at byte {at} is cut off")
        head = data[pos] | data[pos + 1] << 8 | data[pos + 2] << 16
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    pos += 4 * (flags >> 2 & 1)
    if pos > len(data):
        raise WarcError(f"the frame at byte {at} is cut off")
    return pos


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one from each frame."""
    import zstandard

    view, at, d = memoryview(data), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view, 0)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", view, 4)[0]
        if 8 + size > len(view):
            raise WarcError("the dictionary is cut off")
        raw = bytes(view[8 : 8 + size])
        if raw[:4] == struct.pack("<I", MAGIC):
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=FRAME_MOST)
        if raw[:4] != DICTIONARY:
            raise WarcError("the leading frame holds no dictionary")
        d, at = zstandard.ZstdCompressionDict(raw), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=d)
    while at < len(view):
        end = frame_end(view, at)
        size = zstandard.frame_content_size(view[at:end])
        try:
            yield reader.decompress(view[at:end], **({} if size >= 0 else {"max_output_size": FRAME_MOST}))
        except zstandard.ZstdError as e:
            raise WarcError(f"the frame at byte {at}: {e}") from e
        at = end


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record, with version, lengths and digests checked."""
    end = raw.find(b"\r\n\r\n")
    if end < 0 or not raw.startswith(b"WARC/1."):
        raise WarcError("no WARC header")
    fields = {}
    for line in raw[:end].decode().split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise WarcError(f"bad header line {line[:60]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"{name} is missing")
    if not fields["content-length"].isdigit():
        raise WarcError("bad Content-Length")
    n = int(fields["content-length"])
    block = raw[end + 4 : end + 4 + n]
    if len(block) != n or raw[end + 4 + n :] != b"\r\n\r\n":
        raise WarcError("Content-Length and the record's size differ")
    if fields.get("warc-block-digest", "sha256:")[:7] == "sha256:" and "warc-block-digest" in fields:
        if hashlib.sha256(block).hexdigest() != fields["warc-block-digest"][7:]:
            raise WarcError("the block's digest differs")
    http_end = block.find(b"\r\n\r\n")
    if http_end < 0:
        raise WarcError("no HTTP header")
    payload = block[http_end + 4 :]
    length = next((int(x.split(b":")[1]) for x in block[:http_end].split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    if fields["warc-type"] == "response":
        if length is not None and length != len(payload):
            raise WarcError("the HTTP length and the payload differ")
        if fields.get("warc-payload-digest", "").startswith("sha256:") and hashlib.sha256(payload).hexdigest() != fields["warc-payload-digest"][7:]:
            raise WarcError("the payload's digest differs")
    elif payload:
        raise WarcError("a revisit holds a payload")
    fields["http-length"] = str(len(payload) if length is None else length)
    return fields, payload


def read_archives(spark, folder: str, *, payloads: bool = True) -> DataFrame:
    """Records of all ``*.warc.zst`` of a folder: ``page_id, url, record_type, payload_bytes,
    payload_digest, refers_to`` and, with ``payloads``, ``payload`` (null for revisits).

    A broken archive raises ``WarcError``. Archives come whole into a task, so they should be
    written in tens of megabytes, as ``write_archives`` does. In a folder with a ``_manifest`` only the
    archives that it lists are read.
    """
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64())]
    fields += [("payload_digest", pa.string()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if payloads else [])
    out = pa.schema(fields)
    ddl = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payloads

    def number(x: str | None) -> int | None:
        return None if x is None else int(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for raw in frames(content.as_buffer().to_pybytes()):
                    f, payload = parse(raw)
                    kind = f["warc-type"]
                    row = (number(f.get("x-page-id")), f.get("warc-target-uri"), kind, int(f["http-length"]), f["warc-payload-digest"][7:], number(f.get("x-refers-to-page-id")))
                    rows.append(row + ((payload if kind == "response" else None,) if payloads else ()))
                    size += len(payload)
                    if size > 1 << 23:
                        yield _batch(rows, out)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFEST}")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        name = F.element_at(F.split("path", "/"), -1)
        listed = spark.read.parquet(f"{folder}/{MANIFEST}").select("name")
        stray = [r.name for r in files.select(name.alias("name")).join(listed, "name", "left_anti").collect()]  # of failed attempts only
        files = files.where(~name.isin(stray)) if stray else files
    return files.select("content").mapInArrow(run, ddl)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    records = read_archives(spark, folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f
"""
