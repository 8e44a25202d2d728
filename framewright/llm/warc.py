"""WARC archives: writing, normalising whole-file gzip streams to one member per record, reading by offset."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from framewright.llm.common import slices, written
from framewright.session import new_path

GZIP = 31  # zlib's window bits for a gzip wrapper
CHUNK = 1 << 20
URN = "urn:framewright:page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string())])
RECORDS = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
])


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def opened(uri: str):
    """File system and path of a file or folder in the shared storage."""
    return fs.FileSystem.from_uri(uri)


def record(page: str, url: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record; a revisit carries no payload, but the digest and length of the one it refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{URN}{page}>",
        "WARC-Target-URI": "".join(c if c > " " else f"%{ord(c):02X}" for c in url),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": REVISIT, "WARC-Refers-To": f"<{URN}{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def revisits(df: DataFrame, page_id: str, least_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the rows whose payload of ``least_bytes`` or more has a smaller page id too.

    Works on ids and digests alone. The smallest id is added up before the shuffle, so a
    payload that many pages share costs one row for each task."""
    narrow = df.where((F.col("bytes") >= least_bytes) & F.col(page_id).isNotNull()).select(page_id, "digest")
    first = narrow.groupBy("digest").agg(F.min(page_id).alias("refers_to"), F.max(page_id).alias("last"))
    # AQE splits a hot payload only if both sides of the join are shuffled for it and nothing relies on its partitions
    first = written(first.where(F.col("refers_to") < F.col("last")).drop("last"), "first-pages")
    found = narrow.join(first, "digest").where(F.col(page_id) > F.col("refers_to"))
    return written(found, "revisits").distinct()


def write_archives(
    df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 100,
    file_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z", folder: str | None = None,
) -> DataFrame:
    """Write a WARC record for every row and return the files: (file, records, bytes).

    A file is one gzip stream over all of its records, as crawlers often write them; a new one begins after
    ``file_bytes`` of records. Of rows with equal payloads of ``least_bytes`` or more, the one with the smallest id
    is a response and the others are revisits of it. Files go to ``folder`` (default: a new one in the shared
    folder) under names no other attempt uses; a repeated task leaves a file that the result does not list.

    NULL html is an empty payload, NULL url an empty one. A row with a NULL id is a response and never referred to.
    Rows with the same id and html are all responses if that id is the smallest. An empty table gives no files.
    """
    folder = folder or new_path(df.sparkSession, "warc")
    payload = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    rows = df.select(F.col(page_id).alias("page"), F.coalesce(url, F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("bytes"))
    twins = revisits(rows, "page", least_bytes).select(
        F.col("page").alias("p"), F.col("digest").alias("g"), F.col("refers_to").cast("string").alias("refers_to")
    )
    rows = rows.join(twins, (F.col("page") == F.col("p")) & (F.col("digest") == F.col("g")), "left")
    rows = rows.select(F.col("page").cast("string").alias("page"), "url", "payload", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(folder)
        store.create_dir(top, recursive=True)
        done, out = [], None
        for batch in batches:
            for part in slices(batch, "payload", 4 << 20):
                for r in part.to_pylist():
                    if out is None:
                        path, gz, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", zlib.compressobj(6, zlib.DEFLATED, GZIP), 0, 0
                        out = store.open_output_stream(opened(path)[1], compression=None)
                    raw = record(r["page"] or "", r["url"], r["payload"], r["digest"], r["refers_to"], date)
                    out.write(gz.compress(raw))
                    n, size = n + 1, size + len(raw)
                    if size >= file_bytes:
                        out.write(gz.flush())
                        out.close()
                        done.append((path, n, size))
                        out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            done.append((path, n, size))
        yield pa.RecordBatch.from_pylist([dict(zip(FILES.names, x)) for x in done], FILES)

    return written(rows.mapInArrow(write, ddl(FILES)), "warc-files")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and raw bytes of each record of a gzip stream, inflated once; holds one record
    and a chunk. The stream may have one member, several, or one for each record."""
    inflate, data, at = zlib.decompressobj(GZIP), b"", 0
    ended = False

    def more() -> bool:
        nonlocal inflate, data, at, ended
        raw = inflate.unused_data if inflate.eof else b""
        raw = raw or stream.read(CHUNK)
        if not raw:
            ended = True
            return False
        if inflate.eof:
            inflate = zlib.decompressobj(GZIP)
        data, at = data[at:] + inflate.decompress(raw), 0
        return True

    while True:
        while (end := data.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if data[at:].strip() or not inflate.eof and (data or at):
                    raise ValueError("the archive ends inside a record")
                return
        head = headers(data[at:end])
        size = end - at + 4 + int(head["content-length"]) + 4
        parts, have = [data[at:at + size]], len(data) - at
        if have < size:
            data, at = b"", 0
            while have < size:
                if not more():
                    raise ValueError("the archive ends inside a record")
                take = data[:size - have]
                parts.append(take)
                have += len(take)
                at = len(take)
                if have < size:
                    data, at = b"", 0
        else:
            at += size
        yield head, b"".join(parts)


def normalise(files: DataFrame, file: str = "file", folder: str | None = None) -> DataFrame:
    """Rewrite archives so that every record is a gzip member of its own; returns the index.

    Each file is inflated once, by one task, as a stream: memory holds one record. Beside every new file
    a sidecar ``.index.jsonl`` lists record id, type, offset and length; the same rows are the result. A file with
    no record gives an empty file and index. A truncated file is an error. Rows with a NULL file are left out.
    """
    folder = folder or new_path(files.sparkSession, "warc-members")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(folder)
        store.create_dir(top, recursive=True)
        for batch in batches:
            for source in batch.column("file").to_pylist():
                path = f"{folder}/{uuid.uuid4().hex}"
                from_store, from_path = opened(source)
                at, rows = 0, []
                with (
                    from_store.open_input_stream(from_path, compression=None) as stream,
                    store.open_output_stream(opened(f"{path}.warc.gz")[1], compression=None) as out,
                    store.open_output_stream(opened(f"{path}.index.jsonl")[1], compression=None) as side,
                ):
                    for head, raw in records_of(stream):
                        gz = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                        member = gz.compress(raw) + gz.flush()
                        out.write(member)
                        row = dict(zip(INDEX.names, (f"{path}.warc.gz", at, len(member), head["warc-record-id"].strip("<>"), head["warc-type"])))
                        side.write(json.dumps(row).encode() + b"\n")
                        rows.append(row)
                        at += len(member)
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, INDEX)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, INDEX)

    sources = files.where(F.col(file).isNotNull()).select(F.col(file).alias("file"))
    n = max(1, min(sources.count(), 10_000))
    return written(sources.repartition(n).mapInArrow(rewrite, ddl(INDEX)), "warc-index")


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that an index lists, each read by its offset; columns as in ``RECORDS``.

    The digest of a response is computed from the payload read and must agree with its header. A revisit has a
    NULL payload; its digest and length are those of the payload it refers to, by its headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, rows, size = None, None, [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["file"] != name:
                    if source:
                        source.close()
                    store, path = opened(r["file"])
                    name, source = r["file"], store.open_input_file(path)
                source.seek(r["offset"])
                raw = zlib.decompress(source.read(r["length"]), GZIP)
                head, _, block = raw.partition(b"\r\n\r\n")
                head = headers(head)
                payload = block[:int(head["content-length"])].partition(b"\r\n\r\n")[2]
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                revisit = head["warc-type"] == "revisit"
                if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload and digest differ in {r['file']} at {r['offset']}")
                rows.append(dict(zip(RECORDS.names, (
                    head["warc-record-id"].strip("<>"), head["warc-type"], head.get("warc-target-uri"),
                    payload if with_payload and not revisit else None,
                    int(head["x-payload-length"]) if revisit else len(payload), digest,
                    head["warc-refers-to"].strip("<>") if revisit else None,
                ))))
                size += len(payload)
                if size > 4 << 20 or len(rows) >= 10_000:
                    yield pa.RecordBatch.from_pylist(rows, RECORDS)
                    rows, size = [], 0
        if source:
            source.close()
        yield pa.RecordBatch.from_pylist(rows, RECORDS)

    return index.select(*INDEX.names).mapInArrow(read, ddl(RECORDS))


def page_of(col: str):
    """The page id in a record id."""
    return F.nullif(F.substring_index(F.col(col), ":", -1), F.lit("")).cast("bigint")
