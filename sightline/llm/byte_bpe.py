"""Byte-level BPE by segment trees over byte positions: text to ids and ids to bytes.

A tree's leaf ``i`` holds the rank of the pair that starts at byte position ``i``; an inner node holds the smallest
rank below it, so the leftmost smallest pair is found by going down from the root, left first.  A merge changes three
leaves (the merged pair, and the pairs of its two live neighbours) and the nodes above them.  Short pieces are merged
many at a time, one row of a numpy array each; long ones one by one.
"""

import base64
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

NONE = np.iinfo(np.int32).max
#: Widths of the trees in which pieces of at most so many bytes are merged together with others.
WIDTHS = (8, 16, 32)
#: Bytes of merged units that a worker process remembers at most, and characters of text per step.
MEMORY, STEP_BYTES = 48 << 20, 1 << 20
#: What a unit costs beside its own characters and ids: two objects, and its place in a dictionary.
ENTRY = 220
#: A blank beside other white space: only there can a blank belong to a longer run.
LONGER_BLANK = re.compile(r" [\t-\r \x85\xa0  -     　]|[\t-\r\x85\xa0  -     　] ")


class Ranks:
    """The ranks of a tokenizer file: token bytes by id, and the rank of each pair of tokens that joins to a token."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.byte = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError(f"{path} lacks a token for some byte")
        pairs = {(self.ids[t[:i]] << 32) | self.ids[t[i:]]: rank for t, rank in self.ids.items()
                 for i in range(1, len(t)) if t[:i] in self.ids and t[i:] in self.ids}
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()] + [NONE], np.int32)
        self.keys = np.append(self.keys, np.iinfo(np.int64).max)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one piece, as little-endian int32."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before, get = list(range(1, n + 1)), list(range(-1, n - 1)), self.pairs.get
        tree = [int(NONE)] * (2 * width)
        tree[width:width + n - 1] = [get((a << 32) | b, int(NONE)) for a, b in zip(ids, ids[1:])]
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(at: int, rank: int) -> None:
            k = at + width
            tree[k] = rank
            k >>= 1
            while k:
                low = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1

        while (low := tree[1]) != NONE:
            k = 1
            while k < width:
                k = 2 * k if tree[2 * k] == low else 2 * k + 1
            i = k - width
            j = after[i]
            ids[i], after[i] = low, after[j]
            put(j, int(NONE))
            if after[i] < n:
                before[after[i]] = i
                put(i, get((low << 32) | ids[after[i]], int(NONE)))
            else:
                put(i, int(NONE))
            if (h := before[i]) >= 0:
                put(h, get((ids[h] << 32) | low, int(NONE)))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return np.array(out, "<i4").tobytes()

    def merge_short(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of each piece of at most ``width`` bytes, every piece with a tree of its own."""
        count = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, count)
        raw = np.zeros((count, width + 1), np.uint8)
        raw[np.arange(width + 1) < size[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        ids, place = self.byte[raw], np.arange(width + 1)
        alive = place < size[:, None]
        after = np.broadcast_to(place + 1, ids.shape).copy()
        before = np.broadcast_to(place - 1, ids.shape).copy()
        tree = np.full((count, 2 * width), NONE, np.int32)
        inside = place[:width] + 1 < size[:, None]
        tree[:, width:][inside] = self.pair_ranks(ids[:, :width][inside], ids[:, 1:][inside])
        for k in range(width - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])

        def put(row: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
            k = at + width
            tree[row, k] = rank
            for _ in range(width.bit_length() - 1):
                k >>= 1
                tree[row, k] = np.minimum(tree[row, 2 * k], tree[row, 2 * k + 1])

        live = np.nonzero(tree[:, 1] != NONE)[0]
        while live.size:
            low = tree[live, 1]
            k = np.ones(live.size, np.int64)
            for _ in range(width.bit_length() - 1):
                k = 2 * k + (tree[live, 2 * k] != low)
            i = k - width
            j = after[live, i]
            beyond = after[live, j]
            ids[live, i], after[live, i], alive[live, j] = low, beyond, False
            put(live, j, np.full(live.size, NONE, np.int32))
            there = beyond < size[live]
            right = np.full(live.size, NONE, np.int32)
            before[live[there], beyond[there]] = i[there]
            right[there] = self.pair_ranks(low[there].astype(np.int64), ids[live[there], beyond[there]])
            put(live, i, right)
            h = before[live, i]
            there = h >= 0
            put(live[there], h[there], self.pair_ranks(ids[live[there], h[there]], low[there].astype(np.int64)))
            live = live[tree[live, 1] != NONE]
        joined, ends = ids[alive].astype("<i4").tobytes(), np.cumsum(alive.sum(1) * 4).tolist()
        return [joined[a:b] for a, b in zip([0, *ends], ends)]

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        out: list = [self.ids[p].to_bytes(4, "little") if p in self.ids else None for p in pieces]
        above = 0
        for width in WIDTHS:
            short = [k for k, p in enumerate(pieces) if out[k] is None and above < len(p) <= width]
            above = width
            for start in range(0, len(short), 1 << 14):
                some = short[start:start + (1 << 14)]
                for k, ids in zip(some, self.merge_short([pieces[k] for k in some], width)):
                    out[k] = ids
        return [ids if ids is not None else self.merge_long(p) for ids, p in zip(out, pieces)]


class Memory:
    """Ids of units, in two generations of at most half of ``MEMORY`` bytes each.

    A unit found in the old generation moves to the young one; when that is full it becomes the old one, so what is used
    again stays and the rest goes.
    """

    def __init__(self):
        self.young, self.old, self.size = {}, {}, 0

    def put(self, unit: str, ids: bytes) -> None:
        cost = ENTRY + 4 * len(unit) + len(ids)
        if cost > MEMORY // 2:
            return
        if self.size + cost > MEMORY // 2:
            self.young, self.old, self.size = {}, self.young, 0
        self.young[unit] = ids
        self.size += cost

    def known(self, units: set[str]) -> dict[str, bytes]:
        """The ids of those of the units that are remembered."""
        old = self.old
        found = {u: self.young[u] for u in units.intersection(self.young)}
        for unit in units.difference(found).intersection(old) if old else ():
            found[unit] = old[unit]
            self.put(unit, old[unit])
        return found


class Encoder:
    """Whole texts to little-endian int32 ids.  What lies between two single blanks is merged once and remembered; a unit
    that follows a blank is remembered with it."""

    def __init__(self, ranks: Ranks):
        self.ranks, self.memory = ranks, Memory()

    def learn(self, units: set[str]) -> dict[str, bytes]:
        """Ids of all the units, merged now or remembered."""
        known = self.memory.known(units)
        missing = units.difference(known)
        split = [self.ranks.pattern.findall(u) for u in missing]
        pieces = list({p for some in split for p in some})
        ids = dict(zip(pieces, self.ranks.merge([p.encode() for p in pieces])))
        for unit, some in zip(missing, split):
            known[unit] = made = b"".join(map(ids.__getitem__, some))
            self.memory.put(unit, made)
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        """No piece of the pattern spans a blank but at its front, unless that blank touches other white space: texts
        without such blanks are cut before each blank; others are cut by the pattern."""
        cuts = []
        for text in texts:
            if LONGER_BLANK.search(text):
                cuts.append(self.ranks.pattern.findall(text))
            else:
                first, *rest = text.split(" ")
                cuts.append([first, *map(" ".__add__, rest)])
        ids = self.learn(set(chain.from_iterable(cuts))).__getitem__
        return [b"".join(map(ids, cut)) for cut in cuts]


@cache
def encoder_of(path: str, pattern: str) -> Encoder:
    """One encoder for all tasks of a worker process."""
    return Encoder(Ranks(path, pattern))


@cache
def tokens_of(path: str) -> dict[int, bytes]:
    with open(path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}


def steps(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``STEP_BYTES`` characters."""
    start = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total >= STEP_BYTES or k + 1 == len(sizes):
            yield start, k + 1
            start, total = k + 1, 0


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids``, an array of token ids, in place of the column ``text``; if ``decoded`` is named, also with the
    bytes that these ids stand for, in the same pass over the rows.

    Each match of ``pattern`` is encoded separately by the ranks in the file ``path``, which every worker can read;
    there are no special tokens.  Null and empty texts have no ids.  Other columns pass through unchanged, except those
    that are themselves called ``ids`` or ``decoded``, which are replaced.  Repeated rows are encoded each; an empty table
    stays empty.
    """
    added = [ids] if decoded is None else [ids, decoded]
    keep = [c for c in df.columns if c not in (text, *added)]
    rows = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(text))
    kinds = (T.ArrayType(T.IntegerType()), T.BinaryType())
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, kind) for c, kind in zip(added, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        token = tokens_of(path).__getitem__ if decoded else None
        for batch in batches:
            sizes = pc.utf8_length(batch.column(text)).to_numpy(zero_copy_only=False).tolist()
            for start, end in steps(sizes):
                part = batch.slice(start, end - start)
                found = encoder.encode(part.column(text).to_pylist())
                offsets = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(found), "<i4"))
                made = [pa.ListArray.from_arrays(pa.array(offsets), values)]
                if decoded:
                    made.append(pa.array([b"".join(map(token, np.frombuffer(x, "<i4").tolist())) for x in found], pa.binary()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], [*keep, *added])

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes ``decoded`` for which the array ``ids`` stands.  Null arrays, like empty ones, give no
    bytes; an id that the file lacks is an error.  Other columns, ``ids`` among them, pass through."""
    keep = [c for c in df.columns if c != decoded]
    rows = df.select(*(F.coalesce(F.col(c), F.array().cast("array<int>")).alias(c) if c == ids else F.col(c) for c in keep))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens_of(path).__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [b"".join(map(token, x.values.to_pylist())) for x in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found, pa.binary())], [*keep, decoded])

    return rows.mapInArrow(run, schema)
