"""WARC archives: writing, and a sequential reader.

Archives hold one gzip member per record. The reader decompresses a file in
small pieces, frames each record by its Content-Length, and checks block and
payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, materialise, table

REVISIT_BYTES = 1000
#: Digits of a stated length; a longer one is damage.
MAX_DIGITS = 15
FILE_BYTES = 1 << 30
PIECE = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "path string, offset long, record_id string, type string, target_uri string, date string, page_id string, refers_to string, "
    "content_length long, payload_length long, payload_digest string, payload binary, valid boolean"
)


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def bare_digest(label: str | None) -> str | None:
    """The hexadecimal form of a SHA-1 label; null where it is none."""
    try:
        return base64.b32decode(label[5:]).hex() if label and label.startswith("sha1:") else None
    except ValueError:
        return None


def _number(stated: str | None) -> int | None:
    """A length as headers state it; None for anything but a few ASCII digits."""
    return int(stated) if stated and stated.isascii() and stated.isdigit() and len(stated) <= MAX_DIGITS else None


def _named(value: str | None) -> str | None:
    """A field written by ``record``, without its escapes."""
    return None if value is None else urllib.parse.unquote(value)


def record_id(page_id: str | None, payload: bytes) -> str:
    """A record's id, by which revisits refer to it: the same for the same page and payload."""
    name = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {hashlib.sha1(payload).hexdigest()}")
    return f"<urn:uuid:{name}>"


def record(kind: str, record_id: str, uri: str, payload: bytes, extra: dict[str, str]) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head and leaves out the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id,
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": uri,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": sha1_label(block),
        "WARC-Payload-Digest": sha1_label(payload),
        **extra,
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + deflate.flush()


def members(stream: BinaryIO, piece: int = PIECE) -> Iterator[tuple[int, bytes]]:
    """The gzip members of a stream: offset and content, one at a time."""
    offset, rest = 0, stream.read(piece)
    while rest:
        inflate, content, used = zlib.decompressobj(31), bytearray(), 0
        while not inflate.eof:
            if not rest:
                raise ValueError(f"the gzip member at {offset} is cut off")
            try:
                content += inflate.decompress(rest)
            except zlib.error as damage:
                raise ValueError(f"no gzip member at {offset}") from damage
            used += len(rest) - len(inflate.unused_data)
            rest = inflate.unused_data if inflate.eof else stream.read(piece)
        yield offset, bytes(content)
        offset += used
        rest = rest or stream.read(piece)


def readable(stream: BinaryIO) -> Iterator[tuple[int, bytes | None]]:
    """The members of a stream up to damage, and then None at its offset."""
    found, offset = members(stream), 0
    while True:
        try:
            offset, content = next(found)
        except StopIteration:
            return
        except ValueError:
            yield offset, None
            return
        yield offset, content


def parse(content: bytes) -> dict:
    """The fields of a record; valid is False where a length or digest does not hold."""
    head, _, body = content.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = _number(fields.get("content-length"))
    length = -1 if length is None else length
    block = body[: max(0, length)]
    valid = version.startswith("WARC/") and len(block) == length and body[length:] == b"\r\n\r\n"
    http, payload = {}, block
    if fields.get("content-type", "").startswith("application/http"):
        http_head, _, payload = block.partition(b"\r\n\r\n")
        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http_head.decode("latin-1").split("\r\n")[1:])}
    if "warc-block-digest" in fields:
        valid &= fields["warc-block-digest"] == sha1_label(block)
    label, kind = fields.get("warc-payload-digest"), fields.get("warc-type")
    if label and kind != "revisit":
        valid &= label == sha1_label(payload)
    declared = len(payload)
    if "content-length" in http:
        declared = _number(http["content-length"])
        valid &= declared is not None
    return {
        "record_id": fields.get("warc-record-id"),
        "type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "page_id": _named(fields.get("x-page-id")),
        "refers_to": _named(fields.get("x-refers-to-page")),
        "content_length": length,
        "payload_length": declared if kind == "revisit" and declared is not None else len(payload),
        "payload_digest": bare_digest(label),
        "payload": payload,
        "valid": bool(valid),
    }


def mark_revisits(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``pages(page_id, url, html)`` with record_type and refers_to.

    Of records with equal payloads of at least ``min_bytes``, that with the
    largest page_id is the response; the others revisit it. Rows that repeat
    the largest page_id are all responses, and so are all rows of a payload
    whose page_ids are all null.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("body")).withColumn("digest", F.sha2("body", 256))
    repeated = (
        pages.select("page_id", body.alias("body"))
        .where(F.octet_length("body") >= min_bytes)
        .groupBy(F.sha2("body", 256).alias("digest"))
        .agg(F.max("page_id").alias("_last"), F.count("*").alias("_n"))
        .where("_n > 1 and _last is not null")
        .select("digest", "_last")
    )
    repeated = materialise(repeated, "revisited")
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return rows.join(repeated, "digest", "left").select(
        "page_id",
        "url",
        "body",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_last")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, base: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes marked pages under ``base`` and returns the manifest: path, records.

    Each task names its files afresh, and only files of tasks that ended well
    reach the manifest; a repeated task leaves unlisted files at worst.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(base)
        store.create_dir(root, recursive=True)
        out, path, size, count, done = None, "", 0, 0, []

        def close() -> None:
            if out is not None:
                out.close()
                done.append((path, count))

        for batch in batches:
            for page_id, url, body, kind, refers in batch.itertuples(index=False):
                if out is None or size >= file_bytes:
                    close()
                    path, size, count = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                extra = {} if page_id is None else {"X-Page-ID": urllib.parse.quote(page_id, safe="")}
                if kind == "revisit":
                    extra |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers, bytes(body)), "X-Refers-To-Page": urllib.parse.quote(refers, safe="")}
                uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
                data = record(kind, record_id(page_id, bytes(body)), uri, bytes(body), extra)
                out.write(data)
                size, count = size + len(data), count + 1
        close()
        yield pd.DataFrame(done, columns=["path", "records"])

    rows = pages.select(F.col("page_id").cast("string"), "url", "body", "record_type", F.col("refers_to").cast("string"))
    return rows.mapInPandas(write, "path string, records long")


def read_archives(paths: DataFrame, base: str, keep_payload: bool = True) -> DataFrame:
    """The records of the archives in ``paths(path)``, one task per group of files, in file order.

    A file is read up to where its compression breaks; a row with no fields but
    path, offset and valid, which is False, stands for the rest.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(base)
        names = [x.split(" ")[0] for x in RECORD.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for offset, content in readable(stream):
                        row = parse(content) if content is not None else parse(b"") | {"payload": None}
                        if not keep_payload:
                            row["payload"] = None
                        rows.append({"path": path, "offset": offset, **row})
                        size += len(row.get("payload") or b"") + 500
                        if size >= 8 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return paths.select("path").mapInPandas(read, RECORD)


def round_trip(pages: DataFrame, base: str, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Writes a record per row of ``pages(page_id, url, html)``, then reads the archives back.

    Null html is an empty payload; a null url is an empty target. An empty
    table writes no file and gives no record. Other columns are ignored.
    """
    manifest = materialise(write_archives(mark_revisits(pages, min_bytes), base), "manifest", 500)
    files = manifest.repartition(max(1, manifest.count()), F.col("path"))
    return read_archives(files, base, keep_payload=False)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    base = fresh_path(spark, "warc")
    kind = pages.schema["page_id"].dataType
    as_id = lambda c: F.col(c).cast(kind).alias(c)
    checked: Column = F.when(F.col("valid"), F.col("type")).otherwise(F.raise_error(F.concat(F.lit("damaged record in "), F.col("path"))))
    return round_trip(pages, base if "://" in base or base.startswith("file:") else f"file://{base}").select(
        as_id("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        checked.alias("record_type"),
        as_id("refers_to"),
    )


OP4_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
g AS (SELECT body, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY body)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN g.last IS NOT NULL AND p.page_id IS DISTINCT FROM g.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.last IS NOT NULL AND p.page_id IS DISTINCT FROM g.last THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.body = g.body
"""
