"""Winnowed anchors: the seeds that two equal windows are certain to share.

A window of ``length`` symbols is represented by the smallest hash of its grams
of ``gram`` symbols, so equal windows have the same anchor. Consecutive windows
with one anchor form a run. Runs whose keys no other text has cannot repeat; a
first pass finds the keys that occur again and leaves a Bloom filter, with which
a second pass lists the runs that remain. The filter grows with the texts; one
that would be too large for a task is held a range of anchors at a time.

Short seeds meet by chance, ever more often in a larger corpus. So where only
other texts count, a run's keys are longer than its seed: a window that has half
or more of what surrounds the seed to the left of it shares the seed and that
half, any other the seed and the half to the right.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: The size of ``maybe_in``'s filters of documents, which does not grow with the corpus.
FILTER_BITS = 26
HASH_BITS = 48
_SHIFTS = (0, HASH_BITS - FILTER_BITS)
BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


#: Bytes of text whose anchors one task of the first pass holds.
PART_BYTES = 64 << 20
#: Bytes of text for a bit of the filter of keys, and bytes of a filter that a task holds; over more, runs are listed in several passes.
BIT_BYTES, PASS_BYTES = 20, 1 << 26
#: Symbols of the texts that are hashed at once.
CHUNK = 1 << 15
#: Windows of a run; a longer one, of text with a short period, is cut.
RUN_WINDOWS = 1 << 16


@dataclass(frozen=True)
class Spec:
    """What a window is: its length and gram, the units of a text, their symbols (64-bit values), and the bytes of a stretch."""

    length: int
    gram: int
    units: Callable[[bytes], Sequence]
    symbols: Callable[[Sequence], np.ndarray]
    piece: Callable[[Sequence, int, int], bytes]

    @property
    def width(self) -> int:
        return self.length - self.gram + 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x ^= x >> np.uint64(29)
    return x * np.uint64(BASE)


class Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


class Hashed:
    """Prefix hashes of a symbol sequence: the hash of any stretch in constant time."""

    def __init__(self, symbols: np.ndarray, powers: Powers) -> None:
        n = len(symbols)
        powers.reach(n + 1)
        self.down = powers.down
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers.up[:n], out=self.prefix[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """The hashes of all stretches of k symbols."""
        n = max(0, len(self.prefix) - k)
        return mixed((self.prefix[k : k + n] - self.prefix[:n]) * self.down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def least(grams: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """For each window of ``width`` grams the smallest hash, and in the low 16 bits its first place, counted from the last multiple of the step that is also returned."""
    step = (1 << 16) - width
    n = max(0, len(grams) - width + 1)
    out = [np.empty(0, np.uint64)]
    for s in range(0, n, step):
        some = grams[s : min(s + step, n) + width - 1]
        out.append(sliding_min((some << np.uint64(16)) | np.arange(len(some), dtype=np.uint64), width))
    return np.concatenate(out), step


def cut_runs(names: np.ndarray, most: int, start: np.ndarray | None = None, stop: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The first and last positions of stretches of one name, at most ``most`` long, within the given stretches [start, stop)."""
    start, stop = (np.array([0]), np.array([len(names)])) if start is None else (start, stop)
    head = np.ones(len(names), bool)
    head[1:] = names[1:] != names[:-1]
    edges = np.concatenate((start, stop))
    head[edges[edges < len(names)]] = True
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(names)))
    inside = first < stop[np.searchsorted(start, first, "right") - 1]
    first, size = first[inside], size[inside]
    cuts = (size - 1) // most + 1
    nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    return np.repeat(first, cuts) + nth * most, np.repeat(first, cuts) + np.minimum(np.repeat(size, cuts), (nth + 1) * most) - 1


@dataclass(frozen=True)
class Runs:
    """Runs of some texts: the text of each, its anchor, first and last window, and whether the anchor is in the text again; and by key, its run and hash."""

    text: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    looped: np.ndarray
    run: np.ndarray
    key: np.ndarray


def runs(texts: Sequence[Sequence], spec: Spec, powers: Powers, within_text: bool) -> Runs:
    """The runs of texts, given as their units. looped is only looked for ``within_text``."""
    sizes = np.array([len(x) for x in texts])
    start = np.cumsum(sizes) - sizes
    hashed = Hashed(np.concatenate([spec.symbols(x) for x in texts]), powers)
    grams = hashed.grams(spec.gram)
    low, step = least(grams, spec.width)
    stop = start + np.maximum(sizes - spec.length + 1, 0)
    first, last = cut_runs(low >> np.uint64(16), RUN_WINDOWS, start, stop)
    text, anchor = np.searchsorted(start, first, "right") - 1, low[first] >> np.uint64(16)
    looped = np.zeros(len(first), bool)
    if within_text:
        # Even one run can repeat inside itself.
        run, key = np.arange(len(first)), mixed(anchor)
        for i in np.unique(text):
            own = np.sort(grams[start[i] : start[i] + sizes[i] - spec.gram + 1] & np.uint64((1 << HASH_BITS) - 1))
            again = own[1:][own[1:] == own[:-1]]
            if len(again):
                at = slice(*np.searchsorted(text, (i, i + 1)))
                looped[at] = np.isin(anchor[at], again)
    else:
        # A run has a seed for each stretch of windows whose smallest gram is at one place.
        begins, head = np.zeros((2, len(low)), bool)
        begins[first] = head[first] = True
        head[1:] |= low[1:] != low[:-1]
        head = np.flatnonzero(head)
        run = np.cumsum(begins[head]) - 1
        inside = (run >= 0) & (head <= np.append(last, -1)[run])
        head, run = head[inside], run[inside]
        tail = np.minimum(np.append(head[1:] - 1, len(low)), last[run])
        seed = head // step * step + (low[head] & np.uint64(0xFFFF)).astype(np.int64)
        around = spec.length - spec.gram
        left, right = seed - head >= around // 2, seed - tail < around // 2
        a, b = seed[left], seed[right]
        key = np.concatenate((hashed.stretch(a - around // 2, a + spec.gram), hashed.stretch(b, b + spec.length - around // 2 + 1)))
        run = np.concatenate((run[left], run[right]))
    return Runs(text, anchor, first - start[text], last - start[text], looped, run, key & np.uint64((1 << HASH_BITS) - 1))


def chunks(texts: Sequence[bytes | None], spec: Spec) -> Iterator[tuple[int, list[Sequence]]]:
    """The units of texts, about CHUNK symbols at a time, and the place of the first text."""
    lot, total, first = [], 0, 0
    for i, text in enumerate(texts):
        lot.append(spec.units(text or b""))
        total += len(lot[-1])
        if total >= CHUNK or i + 1 == len(texts):
            yield first, lot
            lot, total, first = [], 0, i + 1


@dataclass(frozen=True)
class Filter:
    """A Bloom filter in parts, which go by the anchor: ``maps(part, map)`` of ``size`` bits each."""

    maps: DataFrame
    parts: int
    size: int

    def passes(self) -> list[tuple[int, int]]:
        """The ranges of parts whose maps a task holds together."""
        step = max(1, PASS_BYTES * 8 // self.size)
        return [(a, min(a + step, self.parts)) for a in range(0, self.parts, step)]

    def of(self, low: int, high: int) -> np.ndarray:
        out = np.zeros((high - low) * self.size // 8, np.uint8)
        for r in self.maps.where((F.col("part") >= low) & (F.col("part") < high)).toLocalIterator():
            out[(r["part"] - low) * self.size // 8 :][: self.size // 8] = np.frombuffer(r["map"], np.uint8)
        return out


def places(key: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The bits of keys in a map of ``size`` bits."""
    for x in (key, key >> np.uint64(24), mixed(key) >> np.uint64(40)):
        yield ((x & np.uint64(0xFFFFFF)) * np.uint64(size)) >> np.uint64(24)


def recurring(texts: DataFrame, spec: Spec, within_text: bool) -> Filter:
    """A filter of the keys that occur in two texts, or twice in one if ``within_text``.

    Tasks combine the keys of a batch before the shuffle, so a key that very
    many texts have arrives at most twice from each.
    """
    spark = texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART_BYTES), 1 << 16)
    size = max(1 << 10, total // BIT_BYTES // parts) // 8 * 8

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = []
            for _, lot in chunks(batch.column(0).cast(pa.binary()).to_pylist(), spec):
                some = runs(lot, spec, powers, within_text)
                values = ((some.anchor % np.uint64(parts)) << np.uint64(HASH_BITS))[some.run] | some.key
                if within_text:
                    found += [values, values[some.looped]]
                    continue
                # A text counts once: those with a key of several texts may stay twice.
                order = np.argsort(values)
                values, text = values[order], some.text[some.run][order]
                once = np.ones(len(values), bool)
                once[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
                found.append(values[once])
            values = np.sort(np.concatenate(found))
            twice = np.ones(len(values), bool)
            twice[2:] = values[2:] != values[:-2]
            values = values[twice]
            ends = np.searchsorted(values, np.arange(1, parts, dtype=np.uint64) << np.uint64(HASH_BITS))
            six = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :6])
            rows = [(i, six[a:b].tobytes()) for i, (a, b) in enumerate(zip(np.append(0, ends), np.append(ends, len(values)), strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "anchors"])

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        six = np.frombuffer(b"".join(pdf["anchors"]), np.uint8).reshape(-1, 6)
        values = np.sort(np.pad(six, ((0, 0), (0, 2))).view(np.uint64).ravel())
        values = values[1:][values[1:] == values[:-1]]
        bits = np.zeros(size, bool)
        for at in places(values, size):
            bits[at.astype(np.int64)] = True
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "map": [np.packbits(bits, bitorder="little").tobytes()]})

    maps = texts.select("text").mapInArrow(emit, "part int, anchors binary").groupBy("part").applyInPandas(repeated, "part int, map binary")
    return Filter(materialise(maps, "bits", 2000), parts, size)


def bit_filter(bits: DataFrame) -> np.ndarray:
    """The filter with the given ``bits(bit)`` set, counted from 1."""
    maps = bits.groupBy(F.bitmap_bucket_number("bit").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("m"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in maps.toLocalIterator():  # at most 2^FILTER_BITS bits in all
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["m"], np.uint8)
    return out


def key_bits(keys: DataFrame) -> DataFrame:
    """The filter bits of ``keys(key)``."""
    at = [F.shiftrightunsigned("key", s).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1 for s in _SHIFTS]
    return keys.select(F.explode(F.array(*at)).alias("bit"))


def passing(anchors: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    ok = np.ones(len(anchors), bool)
    for s in _SHIFTS:
        at = (anchors >> np.uint64(s)) & np.uint64((1 << FILTER_BITS) - 1)
        ok &= (bloom[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def digests(pieces: Sequence[bytes]) -> np.ndarray:
    """A 128-bit cryptographic digest of each piece, as two columns of integers."""
    return np.frombuffer(b"".join(blake2b(x, digest_size=16).digest() for x in pieces), np.int64).reshape(-1, 2)


def recurring_runs(texts: DataFrame, spec: Spec, found: Filter, within_text: bool) -> DataFrame:
    """``texts(text, <keys>)`` to one row per run of which a key passes the filter: keys, anchor, c1, c2, first, last, looped.

    c1 and c2 are the digest of all that the run's windows cover; looped, which
    only ``within_text`` looks for, says that the anchor occurs again in the text.
    """
    keys = [c for c in texts.columns if c != "text"]
    types = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in keys)
    names = [*keys, "anchor", "c1", "c2", "first", "last", "looped"]
    parts, size = found.parts, found.size

    def listed(low: int, high: int) -> DataFrame:
        held = texts.sparkSession.sparkContext.broadcast(found.of(low, high))

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers, bits = Powers(), held.value
            for batch in batches:
                row, out = [], []
                for at, lot in chunks(batch.column(0).cast(pa.binary()).to_pylist(), spec):
                    some = runs(lot, spec, powers, within_text)
                    part = (some.anchor % np.uint64(parts)).astype(np.int64)[some.run]
                    live = np.flatnonzero((part >= low) & (part < high))
                    for place in places(some.key, size):
                        bit = (part[live] - low) * size + place[live].astype(np.int64)
                        live = live[(bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
                    ok = np.zeros(len(some.text), bool)
                    ok[some.run[live]] = True
                    text, first, last = some.text[ok], some.first[ok], some.last[ok]
                    content = digests([spec.piece(lot[i], a, b) for i, a, b in zip(text.tolist(), first.tolist(), (last + spec.length).tolist(), strict=True)])
                    row.append(at + text)
                    out.append((some.anchor[ok].view(np.int64), content[:, 0], content[:, 1], first.astype(np.int32), last.astype(np.int32), some.looped[ok]))
                take = pa.array(np.concatenate(row).astype(np.int64))
                arrays = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(j + 1).take(take) for j in range(len(keys))] + arrays, names)

        return texts.select("text", *keys).mapInArrow(emit, f"{types}, anchor long, c1 long, c2 long, first int, last int, looped boolean")

    return reduce(DataFrame.unionByName, [listed(a, b) for a, b in found.passes()])


def deeper_runs(parts: DataFrame, spec: Spec, depth: int, most: int, within_text: bool) -> DataFrame:
    """``parts(key, doc, anchor, first, piece)``, stretches of text, to runs of windows named by more than their anchor.

    A window is named by the ``depth`` smallest hashes of its grams (all of them
    at the most), so equal windows still share a name. Returns key, doc, anchor
    (the name), seed (the gram that all names of a stretch have), c1, c2, first,
    last, looped like ``recurring_runs``, and the piece that a run covers.
    """
    seed = "seed" if "seed" in parts.columns else "anchor"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            origin, gram = batch.column(3).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            for at, lot in chunks(batch.column(4).to_pylist(), spec):
                sizes = np.array([len(x) for x in lot])
                start = np.cumsum(sizes) - sizes
                grams = Hashed(np.concatenate([spec.symbols(x) for x in lot]), powers).grams(spec.gram) & np.uint64((1 << HASH_BITS) - 1)
                n_windows = sizes - spec.length + 1
                head = np.cumsum(n_windows) - n_windows
                within = np.arange(int(n_windows.sum())) + np.repeat(start - head, n_windows)
                ranked = np.sort(np.lib.stride_tricks.sliding_window_view(grams, spec.width)[within], axis=1)[:, :depth]
                names = np.zeros(len(ranked), np.uint64)
                for column in ranked.T:
                    names = mixed(names + column)
                first, last = cut_runs(names, most, head, head + n_windows)
                piece = np.searchsorted(head, first, "right") - 1
                anchor, first, last = names[first].view(np.int64), first - head[piece], last - head[piece]
                cut = [spec.piece(lot[i], a, b) for i, a, b in zip(piece.tolist(), first.tolist(), (last + spec.length).tolist(), strict=True)]
                content = digests(cut)
                again = np.zeros(len(lot), bool)
                if within_text:
                    again[:] = [(grams[a : a + n - spec.gram + 1] == g).sum() > 1 for a, n, g in zip(start, sizes, gram[at:], strict=False)]
                take = at + piece
                where = [(x + origin[take]).astype(np.int32) for x in (first, last)]
                arrays = [anchor, gram[take].view(np.int64), content[:, 0], content[:, 1], *where, again[piece]]
                arrays = [*(batch.column(j).take(pa.array(take)) for j in (0, 1)), *map(pa.array, arrays), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "doc", "anchor", "seed", "c1", "c2", "first", "last", "looped", "piece"])

    types = "key long, doc long, anchor long, seed long, c1 long, c2 long, first int, last int, looped boolean, piece binary"
    return parts.select("key", "doc", seed, "first", "piece").mapInArrow(emit, types)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the stretches [start, end)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:n]) > 0
