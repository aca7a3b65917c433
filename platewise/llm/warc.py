"""WARC archives by way of a chunked record table.

Payloads are cut into rows of record and chunk number before any Python code sees them, and
are written and read chunk by chunk, with digests that grow along; no record is held whole.
Archives are WARC 1.1 files with one gzip member per record, in the shared work folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import record, saved
from platewise.session import new_work_path


@dataclass(frozen=True)
class ArchiveParams:
    #: payloads of at least so many bytes are stored once, repetitions as revisits
    least_bytes: int = 0
    chunk_bytes: int = 1 << 16
    #: raw bytes after which a new entry of the manifest begins: what one reader reads in a row
    segment_bytes: int = 4 << 20
    #: chunks sent on together
    batch_bytes: int = 4 << 20
    #: fixed, so that writing again gives the same files
    date: str = "2024-01-01T00:00:00Z"


# Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

MANIFEST = "path string, offset bigint, records bigint"
CHUNKS = (
    "record_id string, page_id bigint, chunk_no int, chunk binary, bytes_so_far bigint, "
    "digest_so_far string, last boolean, record_type string, refers_to bigint"
)


def chunk_table(pages: DataFrame, params: ArchiveParams = ArchiveParams()) -> DataFrame:
    """Rows of page and chunk number, in order within a page: what is to be written.

    Of records with equal payloads (by SHA-1 and length) the one with the smallest page_id
    keeps its payload. The search for it moves digests only.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    whole = pages.select("page_id", "url", payload.alias("payload"))
    whole = whole.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload").cast("bigint"))
    first = (
        whole.filter(F.col("n") >= params.least_bytes)
        .groupBy("digest", "n")
        .agg(F.min("page_id").alias("first_id"))
    )
    known = whole.join(first, ["digest", "n"], "left")
    known = known.withColumn("refers_to", F.when(F.col("page_id") > F.col("first_id"), F.col("first_id")))
    stored = F.when(F.col("refers_to").isNull(), F.col("n")).otherwise(F.lit(0))
    last = F.greatest(F.ceil(stored / params.chunk_bytes) - 1, F.lit(0)).cast("int")
    size = params.chunk_bytes
    chunk = F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.struct(
            k.alias("chunk_no"),
            F.when(F.col("refers_to").isNull(), F.substring(F.col("payload"), k * size + 1, F.lit(size))).alias("chunk"),
        ),
    )
    # the chunks alone go on: a row doesn't carry the payload besides
    return known.select("page_id", "url", "digest", "n", "refers_to", F.inline(chunk))


def _record_id(page_id: int | None, digest: str, where: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}' if page_id is not None else where)}>"


def _head(row: dict, where: str, params: ArchiveParams) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    revisit = row["refers_to"] is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(row['page_id'], digest, where)}",
        f"WARC-Date: {params.date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(HTTP_HEAD) + (0 if revisit else row['n'])}",
        f"X-Payload-Length: {row['n']}",
    ]
    if row["url"]:
        lines.append(f"WARC-Target-URI: {quote(row['url'], safe=''.join(map(chr, range(0x21, 0x7F))))}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {_record_id(row['refers_to'], digest, where)}",
            f"X-Refers-To-Page: {row['refers_to']}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


class _Writer:
    """One archive: records come in chunk by chunk, each becomes a gzip member."""

    def __init__(self, out, params: ArchiveParams) -> None:
        self.out, self.params, self.at, self.member = out, params, 0, None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def start(self, head: bytes) -> None:
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self._put(self.member.compress(head + HTTP_HEAD))

    def add(self, chunk: bytes) -> None:
        self._put(self.member.compress(chunk))

    def finish(self) -> None:
        if self.member is not None:
            self._put(self.member.compress(b"\r\n\r\n"))
            self._put(self.member.flush())
            self.member = None


def write_archives(pages: DataFrame, params: ArchiveParams = ArchiveParams()) -> DataFrame:
    """Write an archive per task and return the manifest: path, offset of a record and how many to read from there.

    A null html is an empty payload, a null or empty url no target; a row with a null
    page_id is written without it and always as a response. Rows that repeat the smallest
    page_id of a payload are all responses. Every attempt of a task writes a file of its
    own; the manifest, written when all are done, names only those of attempts that
    counted. The folder has to be open to the file systems of Arrow (file, s3, gs, hdfs).
    """
    root = new_work_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pyarrow.fs.FileSystem.from_uri(root)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        entries: list[tuple[int, int]] = []
        writer, raw, records = None, params.segment_bytes, 0
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if writer is None:
                        store.create_dir(folder, recursive=True)
                        writer = _Writer(store.open_output_stream(f"{folder}/{name}", compression=None), params)
                    if row["chunk_no"] == 0:
                        writer.finish()
                        if raw >= params.segment_bytes:
                            entries.append((writer.at, 0))
                            raw = 0
                        entries[-1] = (entries[-1][0], entries[-1][1] + 1)
                        writer.start(_head(row, f"{name}:{records}", params))
                        records += 1
                    if row["chunk"]:
                        writer.add(row["chunk"])
                        raw += len(row["chunk"])
                    raw += len(HTTP_HEAD)
            if writer is not None:
                writer.finish()
        finally:
            if writer is not None:
                writer.out.close()
        yield record(
            MANIFEST,
            {
                "path": [f"{root}/{name}"] * len(entries),
                "offset": [e[0] for e in entries],
                "records": [e[1] for e in entries],
            },
        )

    return saved(chunk_table(pages, params).mapInArrow(run, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, params: ArchiveParams = ArchiveParams(), payloads: bool = True) -> DataFrame:
    """The chunked record table of the archives: a row per record and chunk number.

    ``bytes_so_far`` and ``digest_so_far`` (base32 SHA-1) cover the payload up to the end
    of the row's chunk; the row marked ``last`` has those of the full payload. A revisit is
    one row, with the digest and length it states. A payload whose digest isn't the one
    stated raises an error. ``payloads`` False leaves ``chunk`` null. A task reads several
    entries of a long manifest, one after another.
    """
    most = 4 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for entry in batch.to_pylist():
                store, path = pyarrow.fs.FileSystem.from_uri(entry["path"])
                with store.open_input_file(path) as file:
                    file.seek(entry["offset"])
                    stream = gzip.GzipFile(fileobj=file, mode="rb")
                    for _ in range(entry["records"]):
                        for row in _chunks(stream, params, payloads):
                            rows.append(row)
                            held += len(row[3] or b"") + 200
                            if held >= params.batch_bytes:
                                yield _rows(rows)
                                rows, held = [], 0
        if rows:
            yield _rows(rows)

    return manifest.repartition(parts, "path", "offset").mapInArrow(run, CHUNKS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split(" ")[0] for f in CHUNKS.split(", ")]
    return record(CHUNKS, dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))


def _chunks(stream: gzip.GzipFile, params: ArchiveParams, payloads: bool) -> Iterator[tuple]:
    head = _fields(stream)
    page = head.get("x-page-id")
    refers = head.get("x-refers-to-page")
    kind, stated = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    names = (head["warc-record-id"], None if page is None else int(page))
    refers_to = None if refers is None else int(refers)
    left = int(head["content-length"])
    while (line := stream.readline()) != b"\r\n":  # the HTTP head
        left -= len(line)
    left -= 2
    if kind == "revisit":
        yield *names, 0, None, int(head["x-payload-length"]), stated, True, kind, refers_to
    else:
        digest, number, seen = hashlib.sha1(usedforsecurity=False), 0, 0
        while True:
            chunk = stream.read(min(params.chunk_bytes, left))
            if len(chunk) < min(params.chunk_bytes, left):
                raise EOFError(f"{names[0]} ends early")
            left -= len(chunk)
            seen += len(chunk)
            digest.update(chunk)
            text = base64.b32encode(digest.digest()).decode()
            yield *names, number, chunk if payloads else None, seen, text, left == 0, kind, refers_to
            number += 1
            if not left:
                break
        if text != stated:
            raise ValueError(f"{names[0]} has digest {text}, not {stated}")
    stream.read(4)


def _fields(stream: gzip.GzipFile) -> dict[str, str]:
    first = stream.readline()
    if not first.startswith(b"WARC/"):
        raise ValueError(f"no record begins here: {first[:40]!r}")
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()
    return fields
