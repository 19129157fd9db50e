"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index over Hamming blocks, exact check.

A window is a run of as many words as an item has (a shorter document is one window).  A window that shares no shingle
with an item has similarity 0 to it, so fingerprints are taken of all windows that hold a shingle of some item of that
length.  Fingerprints have ``BLOCKS`` blocks of ``BLOCK_BITS`` bits; two of them within ``RADIUS`` bits differ by at most
RADIUS // BLOCKS bits in some block, so looking up every block among the values that near to an item's finds all items
within the radius.  What is found is checked by the weighted Jaccard similarity of the shingles themselves, weighted by
occurrences: the sum of the smaller counts over the sum of the larger ones.

At a similarity of 0.75 a bit differs with chance about 0.17, so the distance is about 41 bits, with a deviation of 6;
the radius lies five deviations above.  Unrelated texts lie at about 120 bits.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sightline.llm import shingles

BLOCKS, BLOCK_BITS, RADIUS = 20, 12, 71
#: Least similarity of a window, and items that are looked up at once: more are taken in several passes.
AT_LEAST, ITEMS = 0.75, 4096
FOUND = "doc_id long, item_id long, start_word long, n_words long, similarity double"

_BITS = BLOCKS * BLOCK_BITS


def bit_votes(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each shingle and bit."""
    words = [shingles.mix(hashes + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))) for k in range(-(-_BITS // 64))]
    raw = np.stack(words, -1).view(np.uint8).reshape(len(hashes), -1)
    return np.unpackbits(raw, axis=1)[:, :_BITS].astype(np.int16) * 2 - 1


def fingerprints(votes: np.ndarray, size: int) -> np.ndarray:
    """Of each run of ``size`` shingles, a fingerprint as bits."""
    sums = np.concatenate((np.zeros((1, _BITS), np.int32), np.cumsum(votes, 0, dtype=np.int32)))
    return sums[size:] - sums[:-size] > 0


def block_values(bits: np.ndarray) -> np.ndarray:
    return bits.reshape(len(bits), BLOCKS, BLOCK_BITS) @ (1 << np.arange(BLOCK_BITS))


class Items:
    """A bounded block of benchmark items, and the index over their fingerprints."""

    def __init__(self, ids: list[int], texts: list[str]):
        words, starts = shingles.word_hashes(pa.array(texts, pa.string()))
        sizes = np.diff(starts)
        keep = [k for k, n in enumerate(sizes) if n]
        self.ids, self.sizes = [ids[k] for k in keep], [int(sizes[k]) for k in keep]
        self.widths = [min(shingles.WORDS, n) for n in self.sizes]
        self.own = [grams(words[starts[k]:starts[k + 1]], w) for k, w in zip(keep, self.widths)]
        prints = np.concatenate([np.zeros((0, _BITS), bool), *(fingerprints(bit_votes(own), len(own)) for own in self.own)])
        near = [sum(1 << b for b in flips) for n in range(RADIUS // BLOCKS + 1) for flips in combinations(range(BLOCK_BITS), n)]
        values = block_values(prints)[:, :, None] ^ np.array(near)
        slot = (values + (np.arange(BLOCKS) << BLOCK_BITS)[None, :, None]).reshape(-1)
        item = np.repeat(np.arange(len(keep), dtype=np.int32), BLOCKS * len(near))
        order = np.argsort(slot, kind="stable")
        self.listed = item[order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(slot, minlength=BLOCKS << BLOCK_BITS))))
        self.prints = prints
        self.known = {w: self.table([k for k in range(len(keep)) if self.widths[k] == w]) for w in set(self.widths)}

    def table(self, items: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A filter by low bits, and the sorted distinct (shingle, item size) of some items."""
        pairs = np.array(sorted({(int(h), self.sizes[k]) for k in items for h in self.own[k]}), np.uint64)
        low = np.zeros(1 << 20, bool)
        low[pairs[:, 0] & np.uint64((1 << 20) - 1)] = True
        hashes, first = np.unique(pairs[:, 0], return_index=True)
        return low, hashes, np.append(first, len(pairs)), pairs[:, 1].astype(np.int64)

    def near(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) within the radius."""
        slots = block_values(prints) + (np.arange(BLOCKS) << BLOCK_BITS)
        for window in range(len(prints)):
            found = np.unique(np.concatenate([self.listed[self.first[s]:self.first[s + 1]] for s in slots[window]]))
            apart = (self.prints[found] != prints[window]).sum(1)
            for item in found[apart <= RADIUS]:
                yield window, int(item)

    def search(self, words: np.ndarray, hashes: np.ndarray, width: int, hits: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, start, words) of its best window, the first of equals, in a text with the given word
        and shingle hashes, of which those at ``hits`` belong to items."""
        _, known, first, sizes = self.known[width]
        windows: dict[int, set[int]] = {}
        for at in hits.tolist():
            k = int(np.searchsorted(known, hashes[at]))
            for size in sizes[first[k]:first[k + 1]].tolist():
                last = max(len(words) - size, 0)
                windows.setdefault(size, set()).update(range(max(0, at - size + width), min(at, last) + 1))
        best: dict[int, tuple[float, int, int]] = {}
        for size, starts in windows.items():
            count = min(size, len(words)) - width + 1
            begins = sorted(starts)
            runs = np.split(np.array(begins), np.flatnonzero(np.diff(begins) > 1) + 1)
            for run in runs:
                a, b = int(run[0]), int(run[-1])
                prints = fingerprints(bit_votes(hashes[a:b + count]), count)
                for window, item in self.near(prints):
                    if self.sizes[item] != size or self.widths[item] != width:
                        continue
                    alike = similarity(hashes[a + window:a + window + count], self.own[item])
                    if alike >= AT_LEAST and (item not in best or (-alike, a + window) < (-best[item][0], best[item][1])):
                        best[item] = (alike, a + window, min(size, len(words)))
        return best


def grams(words: np.ndarray, width: int) -> np.ndarray:
    return shingles.combine(np.lib.stride_tricks.sliding_window_view(words, width))


def similarity(one: np.ndarray, two: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of shingles, weights being occurrences."""
    names, codes = np.unique(np.concatenate((one, two)), return_inverse=True)
    a, b = np.bincount(codes[:len(one)], minlength=len(names)), np.bincount(codes[len(one):], minlength=len(names))
    return float(np.minimum(a, b).sum() / np.maximum(a, b).sum())


def matches(texts: pa.Array, items: Items) -> Iterator[tuple[int, int, tuple[float, int, int]]]:
    """(row, item, best window) of a string array without nulls."""
    for start, end in shingles.chunks(texts):
        words, starts = shingles.word_hashes(texts.slice(start, end - start))
        for width, (low, known, _, _) in items.known.items():
            if len(words) < width:
                continue
            hashes = grams(words, width)
            hits = np.flatnonzero(low[hashes & np.uint64((1 << 20) - 1)])
            hits = hits[np.isin(hashes[hits], known)]
            row = np.searchsorted(starts, hits, "right") - 1
            inside = hits + width <= starts[row + 1]
            hits, row = hits[inside], row[inside]
            for k in np.unique(row).tolist():
                a, b = int(starts[k]), int(starts[k + 1])
                for item, best in items.search(words[a:b], hashes[a:b - width + 1], width, hits[row == k] - a).items():
                    yield start + k, item, best


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """The benchmark in blocks of about ``ITEMS`` items; ids that repeat, and equal texts, are items of their own."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    blocks = -(-rows.count() // ITEMS)
    for k in range(blocks):
        found = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        yield [r.item_id for r in found], [r.text for r in found]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a window similar to a benchmark item.

    Takes ``doc_id`` and ``text``, and ``item_id`` and ``text``; other columns are ignored.  Returns ``doc_id``,
    ``item_id``, ``start_word``, ``n_words`` and ``similarity`` of the best window, the first of equals, one row per pair.
    Null and empty texts, on either side, match nothing; items of fewer than five words are one shingle.  Items are
    taken in blocks that a task can hold, each against all documents.  Repeated rows of documents each give their rows;
    a null ``doc_id`` is carried, and so is a null ``item_id``, whose item is searched for by its text.  Without documents or items the result is empty.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = None
    for ids, items in item_blocks(benchmark):
        def run(batches: Iterator[pa.RecordBatch], ids=ids, items=items) -> Iterator[pa.RecordBatch]:
            index = Items(ids, items)
            for batch in batches:
                doc = batch.column("doc_id")
                rows = [(doc[k].as_py(), index.ids[item], start, size, alike) for k, item, (alike, start, size) in matches(batch.column("text"), index)]
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                                 ["doc_id", "item_id", "start_word", "n_words", "similarity"])

        part = texts.mapInArrow(run, FOUND)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else texts.sparkSession.createDataFrame([], FOUND)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; every other row and column stays."""
    for ids, items in item_blocks(benchmark):
        def run(batches: Iterator[pa.RecordBatch], ids=ids, items=items) -> Iterator[pa.RecordBatch]:
            index = Items(ids, items)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[k for k, _, _ in matches(batch.column("text").fill_null(""), index)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
