"""Secret scans through nested encodings.

A worklist of layers starts with the text itself. Each layer is scanned, then
unwrapped: URL escapes, Unicode escapes and character references decode the
whole layer; each base64 run, and each stretch of escaped bytes that is
compressed, decodes with decompression to a layer of its own. A layer whose text was seen before at the same stretch of the original is
not entered again, so cycles end and the list runs until a fixpoint; the same
text at another place is a layer of its own. Every character of a layer knows
the stretch of the original text that it came from.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import html
import lzma
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

KINDS = ("assign", "access", "hex")
#: A decompressed layer is scanned in pieces of so many bytes, which overlap by so many.
MAX_LAYER_BYTES, OVERLAP = 64 << 20, 1 << 16
#: Memory that a compressed layer may ask of its decoder.
MEMORY = 256 << 20
SPAN = "array<struct<kind:string,start:int,end:int,value:string,layer:string>>"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A run that is too short holds no shorter run that is long enough, so the
# lengths can stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|amp|quot|apos|lt|gt|colon|equals);")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+\r?\n[\x20\t]*+)+[A-Za-z0-9+/_-]++={0,2}")
#: Bytes in a URL, and in a string literal.
QUOTED = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~+/-])+")
LITERAL = re.compile(r"(?:\\(?:x[0-9A-Fa-f]{2}|[nrt'\"\\])|[\x20!#-&(-\[\]-~])+")
QUOTED_BYTE, LITERAL_BYTE = re.compile(r"%..|."), re.compile(r"\\(?:x..|.)|.")
SLASHED = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|(.))")
#: How compressed data begins; ``HEAD`` bytes tell.
MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\x00")
HEAD = 6


@dataclass
class Layer:
    """Decoded text; starts and ends give each character's stretch of the original, None for the original itself."""

    text: str
    starts: array | None
    ends: array | None
    path: str

    def span(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.starts is None else (min(self.starts[start:end]), max(self.ends[start:end]))


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """Base matches of each kind, leftmost and non-overlapping; matches that are too short are passed over."""
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        yield from (("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6)
    yield from (("access", *m.span()) for m in ACCESS.finditer(text))
    yield from (("hex", *m.span()) for m in HEX.finditer(text))


def _text(data: bytes) -> str:
    """UTF-8, or UTF-16 where every other byte is zero, or else a character for each byte."""
    try:
        text = data.decode("utf-8")
        if "\0" not in text:
            return text
    except UnicodeDecodeError:
        pass
    for first, codec in ((1, "utf-16-le"), (0, "utf-16-be")):
        if len(data) > 3 and len(data) % 2 == 0 and not any(data[first::2]):
            return data.decode(codec)
    return data.decode("latin-1")


def _percent(run: str) -> str:
    return _text(bytes.fromhex(run.replace("%", "")))


def _escape(run: str) -> str:
    if run[0] == "&":
        return html.unescape(run)
    if run[1] == "x":
        return _text(bytes.fromhex(run.replace("\\x", "")))
    if run[1] == "U" or run[2] == "{":
        return chr(int(run[2:].strip("{}"), 16))
    return bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "replace")


def _replaced(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with every match of ``pattern`` decoded; None if there is none."""
    parts, starts, ends, at = [], array("i"), array("i"), 0

    def plain(end: int) -> None:
        parts.append(layer.text[at:end])
        starts.extend(range(at, end) if layer.starts is None else layer.starts[at:end])
        ends.extend(range(at + 1, end + 1) if layer.ends is None else layer.ends[at:end])

    for m in pattern.finditer(layer.text):
        try:
            decoded = decode(m[0])
        except ValueError:
            continue
        plain(m.start())
        start, end = layer.span(*m.span())
        parts.append(decoded)
        starts.extend(array("i", [start]) * len(decoded))
        ends.extend(array("i", [end]) * len(decoded))
        at = m.end()
    if not at:
        return None
    plain(len(layer.text))
    return Layer("".join(parts), starts, ends, f"{layer.path}>{name}".lstrip(">"))


def _stream(data: bytes):
    """A fresh decompressor for the data by its first bytes, and the codec; ``(None, "")`` if it is not compressed."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31), "gzip"
    if data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj(), "zlib"
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor(), "bz2"
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=MEMORY), "xz"
    return None, ""


def _inflated(pieces: Iterator[bytes], limit: int) -> Iterator[bytes]:
    """The content of all members of compressed data that comes in pieces, in pieces of up to ``limit`` bytes; ends where the data is damaged."""
    rest = b""
    while True:
        while len(rest) < HEAD and (more := next(pieces, b"")):
            rest += more
        stream, codec = _stream(rest)
        if stream is None:
            return
        try:
            while not stream.eof:
                piece = stream.decompress(rest, limit)
                rest = stream.unconsumed_tail if codec in ("gzip", "zlib") else b""
                if piece:
                    yield piece
                elif not rest and not stream.eof and not (rest := next(pieces, b"")):
                    return
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return
        rest = stream.unused_data


def _opened(pieces: Iterator[bytes], limit: int, path: str = "") -> Iterator[tuple[bytes, str]]:
    """Data that comes in pieces, or where it is compressed, its content through all codecs: pieces that overlap, and the codecs.

    Every codec has one decoder, which the one around it feeds, so a nested stream
    is read to its end whatever the size of the pieces.
    """
    first = b""
    while len(first) < HEAD and (more := next(pieces, b"")):
        first += more
    if codec := _stream(first)[1]:
        read = [first]

        def noted() -> Iterator[bytes]:
            yield first
            for piece in pieces:
                if read and sum(map(len, read)) <= limit:
                    read.append(piece)
                yield piece

        inner = _inflated(noted(), limit)
        content = next(inner, None)
        if content is not None:
            read.clear()
            yield from _opened(chain((content,), inner), limit, f"{path}>{codec}")
            return
        pieces = chain(read[1:], pieces)  # it only looked compressed
    held = b""
    for piece in chain((first,), pieces):
        yield held + piece, path
        held = (held + piece)[-OVERLAP:]


def _raw_deflate(data: bytes, limit: int) -> Iterator[bytes]:
    """The content of deflate data without a header, in pieces; none unless all of the data is that."""
    trial, rest = zlib.decompressobj(-15), data
    try:
        while not trial.eof:
            piece = trial.decompress(rest, limit)
            rest = trial.unconsumed_tail
            if not piece and not rest and not trial.eof:
                return
    except zlib.error:
        return
    if trial.unused_data:
        return
    stream, rest = zlib.decompressobj(-15), data
    while not stream.eof:
        yield stream.decompress(rest, limit)
        rest = stream.unconsumed_tail


def _binary(data: bytes, limit: int) -> Iterator[tuple[bytes, str, int, int]]:
    """The contents of what is compressed from a magic number in the data on, the codecs, and where it begins and ends."""
    for m in MAGIC.finditer(data):
        end = None
        for piece, codecs in _opened(iter((data[m.start() :],)), limit):
            if codecs:
                end = end or m.start() + _extent(data[m.start() :], limit)
                yield piece, codecs, m.start(), end


def _extent(data: bytes, limit: int) -> int:
    """The length of the compressed members that data begins with; all of it where they are cut off or damaged."""
    rest = data
    while (stream := _stream(rest)[0]) is not None:
        try:
            while not stream.eof:
                piece = stream.decompress(rest, limit)
                rest = getattr(stream, "unconsumed_tail", b"")
                if not piece and not rest and not stream.eof:
                    return len(data)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return len(data)
        rest = stream.unused_data
    return len(data) - len(rest)


def _whole(layer: Layer, start: int, end: int, data: bytes, name: str) -> Layer:
    """A layer every character of which comes from the stretch start to end."""
    text = _text(data)
    a, b = layer.span(start, end)
    return Layer(text, array("i", [a]) * len(text), array("i", [b]) * len(text), f"{layer.path}>{name}".lstrip(">"))


def _escaped_bytes(layer: Layer, limit: int) -> Iterator[Layer]:
    """Contents of compressed bytes that stand in a text as URL or string escapes."""
    for pattern, mark, decode, byte, name in ((QUOTED, "%", unquote_to_bytes, QUOTED_BYTE, "url"), (LITERAL, "\\x", _literal, LITERAL_BYTE, "unicode")):
        for m in pattern.finditer(layer.text) if mark in layer.text else ():
            data = decode(m[0]) if mark in m[0] else b""
            if MAGIC.search(data):
                at = array("i", (m.start() + b.start() for b in byte.finditer(m[0])))
                at.append(m.end())
                for piece, codecs, start, end in _binary(data, limit):
                    yield _whole(layer, at[start], at[end], piece, name + codecs)


def _literal(run: str) -> bytes:
    """The bytes of a string literal's inside."""
    plain = {"n": "\n", "r": "\r", "t": "\t"}
    return SLASHED.sub(lambda m: chr(int(m[1], 16)) if m[1] else plain.get(m[2], m[2]), run).encode("latin-1")


def _decoded_runs(layer: Layer, limit: int) -> Iterator[Layer]:
    """Layers of base64 runs: of a run, of a run wrapped over lines, and where a run begins with other characters, of its other phases."""
    for m in BASE64.finditer(layer.text):
        yield from _decoded_base64(layer, m[0], m.start(), None, limit)
    for m in WRAPPED.finditer(layer.text) if "\n" in layer.text else ():
        at = [i for i, c in enumerate(m[0]) if c not in "\r\n\t "]
        yield from _decoded_base64(layer, "".join(m[0][i] for i in at), m.start(), at, limit)


def _decoded_base64(layer: Layer, found: str, start: int, at: list[int] | None, limit: int) -> Iterator[Layer]:
    """``at`` are the places of the digits from ``start``, where they do not follow one another."""
    digits = found.rstrip("=").replace("-", "+").replace("_", "/")
    length = len(found) if at is None else at[-1] + 1

    def place(i: int) -> int:
        return start + (i if at is None else at[min(i, len(at) - 1)])

    for phase in range(4):
        run = digits[phase:]
        if len(run) % 4 == 1:
            run = run[:-1]
        try:
            whole = base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        compressed = _stream(whole)[1]
        clean = not compressed and _is_text(whole)
        for data, codecs, first, last in _binary(whole, limit) if not clean and MAGIC.search(whole) else ():
            yield _whole(layer, place(phase + first * 8 // 6), place(phase + -(-last * 8 // 6) - 1) + 1, data, "base64" + codecs)
        if not clean and not phase:
            for data in _raw_deflate(whole, limit):
                yield _whole(layer, start, start + length, data, "base64>deflate")
        text, path = _text(whole), f"{layer.path}>base64".lstrip(">")
        if not compressed and len(text) * 2 == len(whole):
            yield _whole(layer, start, start + length, whole, "base64")
        elif not compressed:
            # Byte i comes from the base64 digits that hold its bits.
            starts, ends, byte = array("i"), array("i"), 0
            utf8 = len(text) != len(whole)
            for c in text:
                size = len(c.encode("utf-8")) if utf8 else 1
                a, b = layer.span(place(phase + byte * 8 // 6), place(phase + -(-(byte + size) * 8 // 6) - 1) + 1)
                starts.append(a)
                ends.append(b)
                byte += size
            yield Layer(text, starts, ends, path)
        if clean:
            return


def _is_text(data: bytes) -> bool:
    try:
        return "\0" not in data.decode("utf-8")
    except UnicodeDecodeError:
        return False


def unwrap(layer: Layer, limit: int) -> Iterator[Layer]:
    if "%" in layer.text and (found := _replaced(layer, PERCENT, _percent, "url")):
        yield found
    if ("\\" in layer.text or "&" in layer.text) and (found := _replaced(layer, ESCAPE, _escape, "unicode")):
        yield found
    yield from _escaped_bytes(layer, limit)
    yield from _decoded_runs(layer, limit)


def find(text: str | None, limit: int = MAX_LAYER_BYTES) -> list[tuple[str, int, int, str, str]]:
    """All spans (kind, start, end, value, layer) of a text, by start and then kind.

    layer is empty for a match in the text itself, else the encodings that were
    unwrapped, outermost first. A span that several layers give is returned
    once, for the layer that had it first.
    """
    if not text:
        return []
    found: dict[tuple[str, int, int], tuple[str, str]] = {}
    work, seen = deque([Layer(text, None, None, "")]), {(text, 0, len(text))}
    while work:
        layer = work.popleft()
        for kind, start, end in scan(layer.text):
            found.setdefault((kind, *layer.span(start, end)), (layer.text[start:end], layer.path))
        for inner in unwrap(layer, limit):
            if inner.text and (place := (inner.text, *inner.span(0, len(inner.text)))) not in seen:
                seen.add(place)
                work.append(inner)
    return [(*k, *v) for k, v in sorted(found.items(), key=lambda x: (x[0][1], KINDS.index(x[0][0]), x[0][2]))]


def secret_spans(limit: int = MAX_LAYER_BYTES):
    """A column function ``text -> array<struct(kind, start, end, value, layer)>``."""
    @F.pandas_udf(SPAN)
    def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([[dict(zip(("kind", "start", "end", "value", "layer"), x)) for x in find(t, limit)] for t in batch], dtype=object)

    return spans


def find_secrets(docs: DataFrame, limit: int = MAX_LAYER_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id and its spans.

    Positions are code points, end exclusive. A null or empty text has no
    spans. Repeated rows give repeated rows; an empty table gives an empty
    result; other columns are ignored. A compressed layer is read in pieces of
    ``limit`` bytes, against decompression bombs; a secret longer than their
    overlap can be cut.
    """
    return docs.select("doc_id", secret_spans(limit)("text").alias("spans"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = find_secrets(table(spark, sf_dir, "documents")).withColumn("_base", F.filter("spans", lambda s: s["layer"] == ""))
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined("_base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
