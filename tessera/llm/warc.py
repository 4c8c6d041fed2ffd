"""WARC archives, dictionary-compressed (``.warc.zst``).

A file begins with a skippable frame that holds a Zstandard dictionary built
from the file's own records; every record follows as a frame of its own,
compressed with it.  Repeated payloads are archived once and referred to by
revisit records.

Files are written by the tasks into a folder that all executors share, through
the file system that its URI names.  A task's files carry its attempt in their
names and count only if the written manifest lists them, so retries and lost
executors leave at most unlisted files behind.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_schema, cut_lineage
from tessera.session import checkpoint_dir

#: Magic number of the skippable frame with the dictionary (fixed by the format).
DICTIONARY_FRAME = 0x184D2A5D
#: What archived files hold at most before the next one begins, uncompressed.
FILE_BYTES = 64 << 20
#: A dictionary is built from at most so many bytes of a file's first records.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 32 << 10

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(kind: str, page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC/1.1 record.  A revisit's block has the HTTP head only; its
    digest and length are those of the payload that it stands for."""
    block = _HTTP + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{kind}/{digest}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compressed(records: list[bytes], dictionary: bytes | None = None, level: int = 3) -> Iterator[bytes]:
    """The leading skippable frame, then a frame for each record.

    Without enough records to build a dictionary from, it is empty and the
    records are compressed without one.
    """
    import zstandard
    if dictionary is None:
        dictionary = build_dictionary(records)
    yield struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
    how = {}
    if dictionary:
        how["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        how["dict_data"].precompute_compress(level)
    pack = zstandard.ZstdCompressor(level=level, write_content_size=True, **how).compress
    for r in records:
        yield pack(r)


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, sample: int = SAMPLE_BYTES) -> bytes:
    """A dictionary from the first ``sample`` bytes of records, at most 16 kB of each."""
    import zstandard
    some, total = [], 0
    for r in records:
        some.append(r[:16 << 10])
        total += len(some[-1])
        if total >= sample:
            break
    try:
        return zstandard.train_dictionary(size, some, k=256, d=8).as_bytes()
    except zstandard.ZstdError:      # too few or too uniform records
        return b""


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, HTTP payload) of each record of an open archive, read in
    sequence with one record in memory."""
    import zstandard
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no leading dictionary frame")
    dictionary = stream.read(size)
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":       # the dictionary may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    how = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    reader = zstandard.ZstdDecompressor(**how).stream_reader(stream, read_across_frames=True, read_size=1 << 20)
    buffer = b""

    def fill(n: int) -> bool:
        nonlocal buffer
        parts, have = [buffer], len(buffer)
        while have < n:
            more = reader.read(max(1 << 18, n - have))
            if not more:
                break
            parts.append(more)
            have += len(more)
        buffer = b"".join(parts)
        return have >= n

    while fill(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("truncated record")
        lines = buffer[:end].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("truncated record")
        block = buffer[end + 4:end + 4 + size]
        buffer = buffer[end + 8 + size:]
        yield headers, block[block.index(b"\r\n\r\n") + 4:]


def plan(pages: DataFrame, id_col: str, url_col: str | None, body_col: str, least: int) -> DataFrame:
    """Adds the digest, and to whom a repeated payload refers.

    Only digests and ids are aggregated, combined map-side; the payloads meet
    the repeated digests in a join that is broadcast when these are few and whose
    hot digests adaptive execution splits.
    """
    body = F.coalesce(pages[body_col], F.lit(""))
    rows = pages.select(pages[id_col].alias("page_id"),
                        (pages[url_col] if url_col else F.lit(None).cast("string")).alias("url"),
                        body.alias("body"))
    keyed = pages.select(pages[id_col].alias("page_id"), F.sha2(body, 256).alias("digest"),
                         F.octet_length(body).alias("size")).where(F.col("size") >= least)
    first = (keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("digest", "first"))
    return rows.withColumn("digest", F.sha2("body", 256)).join(first, "digest", "left").select(
        "page_id", "url", "body", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str | None = "url",
          body_col: str = "html", least: int = 100, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives every row and returns the manifest (path, records, bytes).

    The payload is the body in UTF-8, empty for null.  Of the rows whose equal
    payload has at least ``least`` bytes, those with the smallest id are
    responses (all of them, if rows repeat that id) and the others revisits;
    shorter payloads are always responses.  Ids of null count as larger than any
    other only when all are null, and then all are responses.  An empty table
    has an empty manifest.
    """
    rows = plan(pages, id_col, url_col, body_col, least)
    shape = arrow_schema("path string, records long, bytes long")

    def run(batches):
        import pyarrow.fs as pafs
        from pyspark import TaskContext
        context = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(folder)
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        done, held, size = [], [], 0

        def flush():
            nonlocal held, size
            if held:
                path = f"{root}/{name}-{len(done):04d}.warc.zst"
                with fs.open_output_stream(path, buffer_size=1 << 20) as out:
                    total = 0
                    for part in compressed(held):
                        out.write(part)
                        total += len(part)
                done.append((path, len(held), total))
            held, size = [], 0

        for b in batches:
            for r in b.to_pylist():
                payload = r["body"].encode()
                kind = "response" if r["refers_to"] is None else "revisit"
                held.append(record(kind, r["page_id"], r["url"], payload, r["digest"], r["refers_to"]))
                size += len(held[-1])
                if size >= file_bytes:
                    flush()
        flush()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], schema=shape)

    return cut_lineage(rows.mapInArrow(run, "path string, records long, bytes long"))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to, payload)
    of all records of the listed archives, one archive after another in a task.

    A response's length and digest are taken from the payload as read, and must
    be those of its header; a revisit's are its header's and its payload is null.
    """
    ddl = ("page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "payload binary")
    shape = arrow_schema(ddl)

    def run(batches):
        import pyarrow.fs as pafs
        fs, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                out, size = [], 0
                with fs.open_input_stream(path) as stream:
                    for h, payload in records_of(stream):
                        kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{path}: payload differs from its digest")
                        if kind == "revisit":
                            payload = None
                        page = h.get("X-Page-Id")
                        refers = h.get("X-Refers-To-Page")
                        out.append({"page_id": page and int(page), "record_type": kind,
                                    "payload_bytes": int(h["X-Payload-Length"]) if payload is None else len(payload),
                                    "payload_digest": digest, "refers_to": refers and int(refers),
                                    "payload": payload})
                        size += len(payload or b"")
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=shape)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=shape)

    spark = manifest.sparkSession
    n = max(1, spark.sparkContext.defaultParallelism)
    return manifest.select("path").repartition(n).mapInArrow(run, ddl)


def new_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder, as a URI."""
    import pyarrow.fs as pafs
    root = checkpoint_dir(spark)
    folder = f"{root if '://' in root or root.startswith('file:') else 'file://' + root}/warc-{uuid.uuid4().hex}"
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    return folder
