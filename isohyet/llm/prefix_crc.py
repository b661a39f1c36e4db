"""CRC-32 of any n-gram of a text from running CRCs at its word edges.

``crc(xy) = shift(crc(x), len(y)) ^ crc(y)``, where shift carries a CRC over zero
bytes and is linear over GF(2). So one scan stores the CRC at the end of every
word, and the CRC of each n-gram follows from two of these by cancelling the
shifted prefix.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np

#: Bytes of a word: digits, lower-case letters, and all of a character beyond ASCII. Others separate.
_WORD_BYTE = [48 <= b < 58 or 97 <= b < 123 or b >= 128 for b in range(256)]
NORMAL = bytes(b + 32 if 65 <= b < 91 else b if _WORD_BYTE[b] else 32 for b in range(256))
PIECE = re.compile(rb" [^ ]+")
BLOCK_WORDS = 1 << 16
SHORT = 64


def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables of the shift by 0 to 63 bytes, and by 64, 128, 256, ... bytes; a table holds 256 entries for each byte of a CRC."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    one = [(x >> 8) ^ byte[x & 255] for x in (np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4))]
    tables = [np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])]
    for _ in range(SHORT):
        r = tables[-1]
        tables.append(_apply(np.concatenate(one), r))
    powers = [tables[SHORT]]
    while len(powers) < 26:
        powers.append(_apply(powers[-1], powers[-1]))
    return np.concatenate(tables[:SHORT]), powers


def _apply(table: np.ndarray, crc: np.ndarray, at: np.ndarray | int = 0) -> np.ndarray:
    return table[(crc & 255) + at] ^ table[((crc >> 8) & 255) + 256 + at] ^ table[((crc >> 16) & 255) + 512 + at] ^ table[(crc >> 24) + 768 + at]


_SHORT, _POWERS = _shifts()


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC (uint32) carried over so many zero bytes (int64)."""
    out = _apply(_SHORT, crc.astype(np.int64), (length & (SHORT - 1)) << 10)
    length = length >> 6
    for table in _POWERS:
        if not length.any():
            break
        odd = np.flatnonzero(length & 1)
        out[odd] = _apply(table, out[odd].astype(np.int64))
        length = length >> 1
    return out


def ngram_crcs(text: bytes, longest: int) -> Iterator[tuple[np.ndarray, int]]:
    """CRCs (uint32) of all runs of 1 to ``longest`` words of a UTF-8 text, joined by one space, and the words scanned, by block.

    The text is read once, as `` w1 w2 w3``; a block carries the last words of the
    one before, so that runs cross it.
    """
    pieces = (m[0] for m in PIECE.finditer(b" " + text.translate(NORMAL)))
    carried: list[bytes] = []
    while block := list(islice(pieces, BLOCK_WORDS)):
        words, old = carried + block, len(carried)
        ends = np.fromiter(accumulate(words, lambda crc, piece: zlib.crc32(piece, crc), initial=0), np.uint32, len(words) + 1)
        width = np.fromiter(map(len, words), np.int64, len(words))
        space = (~ends[:-1]).astype(np.int64)
        starts = ~((space >> 8).astype(np.uint32) ^ _BYTE[(space ^ 0x20) & 255])
        total, out = np.append(0, np.cumsum(width)), []
        for n in range(1, longest + 1):
            first = np.arange(max(0, old - n + 1), len(words) - n + 1)
            length = total[first + n] - total[first] - 1
            out.append(ends[first + n] ^ shifted(starts[first], length))
        yield np.concatenate(out), len(block)
        carried = words[len(words) - longest + 1 :] if longest > 1 else []


_BYTE = _apply(_SHORT[1024:2048], np.arange(256, dtype=np.int64))
