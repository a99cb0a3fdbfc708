"""WARC archives as a chunked record table.

A payload never is one value on its way in or out: the table has a row for each ``(record, chunk number)``,
and writer and reader hold one chunk and a running SHA-256 of the record. Writing sorts the chunk rows of each
partition by record and chunk and streams them into one gzipped WARC file (a member for each record).
Reading streams a file back into chunk rows, each with the number of bytes so far and, on the last, the digest
of the whole payload, checked against the record's header.

Files go to a shared folder through pyarrow's file systems, under a name that no other attempt uses; only the
files that the finished tasks list in the manifest table are read, so a lost executor or a repeated task
leaves at worst an unread file.

Payloads: null counts as empty. Of records whose payloads are equal and hold at least ``least`` bytes, that of
the smallest id is the response and the others revisit it. Equal means equal SHA-256 and length. Ids may be of
any type that orders; a null id comes last. Rows that repeat an id and payload are one record (where different tasks write
them, the archives hold it more than once); several payloads under one id each make a record of their own.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, table
from tessera.session import cut_lineage, scratch_dir

CHUNK = 1 << 20
BLOCK = 1 << 16
CRLF = b"\r\n"


def plan_records(df: DataFrame, payload: str, id_col: str, least: int = 100) -> DataFrame:
    """``(id, payload_bytes, payload_digest, record_type, refers_to)``; native, and without the payloads."""
    raw = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    seen = cut_lineage(df.select(F.col(id_col).alias("id"), F.octet_length(raw).cast("long").alias("payload_bytes"),
                                 F.sha2(raw, 256).alias("payload_digest")).distinct())
    groups = (seen.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
              .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    known = seen.join(cut_lineage(groups), ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("first")))
    return known.select("id", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
                        F.when(again, F.col("first")).alias("refers_to"))


def chunks(df: DataFrame, payload: Column, keep: list[str], chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of ``payload``, numbered from 0; an empty payload has one empty chunk."""
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(payload) / chunk).cast("int") - 1)
    cut = df.select(*keep, payload.alias("_payload"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    return cut.select(*keep, "chunk_no", F.expr(f"substring(_payload, chunk_no * {chunk} + 1, {chunk})").alias("chunk"))


def header(kind: str, meta: dict, url: str | None, size: int) -> bytes:
    """WARC header fields; the key of the row and the size of the full payload go in extension fields."""
    uri = f"<{url}>" if url else "<urn:tessera:none>"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(meta))}>"),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{meta['digest']}"),
              ("Content-Type", "text/html"), ("X-Record", json.dumps(meta))]
    if kind == "revisit":
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields.append(("Content-Length", str(size)))
    return CRLF.join([b"WARC/1.1", *(f"{k}: {' '.join(v.split())}".encode() for k, v in fields), b"", b""])


class Writer:
    """One WARC file; a record is opened with its header and then fed chunks."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.out, self.records, self.gz, self.at = uri, fs.open_output_stream(path, compression=None), 0, None, None

    def put(self, key: tuple, kind: str, meta: dict, url: str | None, number: int, chunk: bytes) -> None:
        if key != self.at:
            self.end()
            self.at, self.digest, self.number, self.meta, self.kind = key, hashlib.sha256(), 0, meta, kind
            self.gz = zlib.compressobj(4, zlib.DEFLATED, 31)
            self.out.write(self.gz.compress(header(kind, meta, url, meta["bytes"] if kind == "response" else 0)))
        if number != self.number:
            raise ValueError(f"record {meta} lacks chunk {self.number}")
        self.number += 1
        if chunk:
            self.digest.update(chunk)
            self.out.write(self.gz.compress(chunk))

    def end(self) -> None:
        if self.gz:
            if self.kind == "response" and self.digest.hexdigest() != self.meta["digest"]:
                raise ValueError(f"record {self.meta} was written with another payload")
            self.out.write(self.gz.compress(CRLF * 2) + self.gz.flush())
            self.records += 1
        self.gz = None

    def close(self) -> None:
        self.end()
        self.out.close()


def write(df: DataFrame, folder: str, payload: str, id_col: str, url: str | None = None, least: int = 100,
          chunk: int = CHUNK) -> DataFrame:
    """Write a record for each row of ``df`` and return the manifest ``(file, records)``, itself a written table."""
    plan = plan_records(df, payload, id_col, least)
    raw = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_col).alias("_id"), (F.col(url).cast("string") if url else F.lit(None).cast("string")).alias("url"),
                     F.sha2(raw, 256).alias("_digest"), raw.alias("_raw"))
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_digest") == F.col("payload_digest"))
    named = (rows.join(plan, same)
             .select(F.to_json(F.struct("id", F.lit(0).alias("_"))).alias("key"), "id", "url", "payload_bytes", "payload_digest",
                     "record_type", F.to_json(F.struct("refers_to", F.lit(0).alias("_"))).alias("refers"),
                     F.when(F.col("record_type") == "response", F.col("_raw")).otherwise(F.lit(b"")).alias("_raw")))
    keep = ["key", "payload_digest", "url", "payload_bytes", "record_type", "refers"]
    # The chunks of a row are made in the task that writes them, so no further shuffle is needed. Rows that repeat a
    # record in the same task follow each other chunk by chunk after the sort; the first of each chunk is written.
    table_ = chunks(named, F.col("_raw"), keep, chunk).sortWithinPartitions("key", "payload_digest", "chunk_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key, digest, uri, size, kind, refers, number, part = (batch.column(k)[i].as_py() for k in range(8))
                if out is None:
                    out = Writer(f"{folder}/{uuid.uuid4().hex}.warc.gz")
                if last == (key, digest, number):
                    continue
                last = (key, digest, number)
                meta = {"key": json.loads(key).get("id"), "refers": json.loads(refers).get("refers_to"), "bytes": size, "digest": digest}
                out.put((key, digest), kind, meta, uri, number, part)
        if out:
            out.close()
            yield batch_of(pa.schema([("file", pa.string()), ("records", pa.int64())]), [[out.uri], [out.records]])

    return cut_lineage(table_.mapInArrow(run, "file string, records long"))


class Members:
    """A stream of bytes out of a gzip file of several members, decompressed a block at a time."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file, self.gz, self.held, self.raw = fs.open_input_stream(path, compression=None), zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Add a block to ``held``; False at the end of the file."""
        while True:
            if self.gz.eof:
                self.raw = self.gz.unused_data
                self.gz = zlib.decompressobj(31)
            raw = self.raw or self.gz.unconsumed_tail or self.file.read(BLOCK)
            self.raw = b""
            if not raw:
                return False
            if got := self.gz.decompress(raw, BLOCK):
                self.held += got
                return True

    def line(self) -> bytes | None:
        while (end := self.held.find(b"\n")) < 0:
            if not self.more():
                return None
        got, self.held = self.held[: end + 1], self.held[end + 1:]
        return got

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            if not self.held and not self.more():
                raise ValueError("the archive ends within a record")
            part, self.held = self.held[: n - have], self.held[n - have:]
            parts.append(part)
            have += len(part)
        return b"".join(parts)


def records(uri: str, chunk: int = CHUNK) -> Iterator[tuple[str, dict, int, bytes, int, str | None]]:
    """``(type, fields, chunk number, chunk, payload bytes so far, digest if last)`` for each chunk of a file."""
    source = Members(uri)
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no record where one should start")
        fields: dict[str, str] = {}
        while (line := source.line()) is not None and line.strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        left, number, digest, size = int(fields["content-length"]), 0, hashlib.sha256(), 0
        while True:
            part = source.take(min(chunk, left))
            left -= len(part)
            size += len(part)
            digest.update(part)
            yield fields["warc-type"], fields, number, part, size, None if left else digest.hexdigest()
            number += 1
            if not left:
                break


def read(manifest: DataFrame, chunk: int = CHUNK, id_type: str = "long", payloads: bool = True) -> DataFrame:
    """The chunk table of the archives: ``(id, record_type, refers_to, url, chunk_no, chunk, bytes_so_far,
    payload_bytes, payload_digest)``; the last two are of the full payload and stand on each record's last chunk,
    on a revisit as its header has them. ``payloads=False`` leaves ``chunk`` null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("chunk_no", pa.int32()),
                            ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for kind, fields, number, part, size, digest in records(uri, chunk):
                    meta, named = json.loads(fields["x-record"]), fields["warc-payload-digest"].partition(":")[2]
                    if kind == "response" and digest and digest != named:
                        raise ValueError(f"{uri}: the payload of record {meta['key']} has changed")
                    text = [None if x is None else str(x) for x in (meta["key"], meta["refers"])]
                    uri_ = fields["warc-target-uri"].strip("<>")
                    full = meta["bytes"] if kind == "revisit" else size
                    rows.append((text[0], kind, text[1], None if uri_ == "urn:tessera:none" else uri_, number, part if payloads else None, size,
                                 full if digest else None, named if digest else None))
                    held += len(part) if payloads else 100
                    if held > 8 * CHUNK:
                        yield batch_of(schema, list(zip(*rows)))
                        rows, held = [], 0
                if rows:
                    yield batch_of(schema, list(zip(*rows)))

    files = manifest.select("file").repartition("file")
    got = files.mapInArrow(run, "id string, record_type string, refers_to string, url string, chunk_no int, chunk binary, "
                                "bytes_so_far long, payload_bytes long, payload_digest string")
    return got.withColumns({"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def op10_warc(spark, sf_dir: str) -> DataFrame:
    """Archive every page and report what the archives hold."""
    pages = table(spark, sf_dir, "pages")
    manifest = write(pages, scratch_dir(spark, "warc"), "html", "page_id", "url")
    kind = pages.schema["page_id"].dataType.simpleString()
    return (read(manifest, id_type=kind, payloads=False).where("payload_digest is not null")
            .select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to").distinct())


OP10_SQL = """
with p as (select page_id, coalesce(html, '') h, cast(octet_length(encode(coalesce(html, ''))) as bigint) n from pages),
g as (select h, min(page_id) first from p where n >= 100 group by h)
select page_id, n payload_bytes, sha256(p.h) payload_digest, case when first <> page_id then 'revisit' else 'response' end record_type,
       case when first <> page_id then first end refers_to
from p left join g on p.h = g.h
"""
