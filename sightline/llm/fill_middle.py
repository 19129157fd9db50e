"""Fill-in-the-middle forms of whole texts, cut by an indexable skip list over the units of each text.

A text is tiled by units: code points, or what a pattern gives.  The bottom lane of the list holds runs of units; every
lane above holds the taller towers of the one below.  Each node carries how many units and how many code points it spans,
so going down from the top lane and adding up widths reaches the code point at which any unit begins.
"""

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Marks of prefix, suffix and middle.  Each begins with "<", ends with ">" and has neither inside, so no mark can arise
#: where a part and a mark meet.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units of a bottom node, and nodes of a lane for each one of the lane above, on average.
RUN, FANOUT = 64, 8


class SkipList:
    """Lanes over the units of one text; each lane is (unit widths, code-point widths, first child in the lane below).

    A tower's height comes from a fixed sequence of numbers, so equal texts have equal lanes.
    """

    def __init__(self, units: Iterator[int] | int):
        """``units``: the code points of each unit in order, or the number of units that are single code points."""
        if isinstance(units, int):
            spans = np.full(-(-units // RUN), RUN, np.int64)
            if units % RUN:
                spans[-1] = units % RUN
            counts, self.inside = spans, None
        else:
            runs, counts, spans = [], [], []
            while run := list(islice(units, RUN)):
                runs.append(run)
                counts.append(len(run))
                spans.append(sum(run))
            counts, spans, self.inside = np.array(counts, np.int64), np.array(spans, np.int64), runs
        self.n = int(counts.sum())
        self.lanes = [(counts, spans, np.arange(len(counts)))]
        heights = np.random.default_rng(1).geometric(1 - 1 / FANOUT, len(counts))
        level = 2
        while len(counts) > FANOUT:
            tall = heights >= level
            tall[0] = True  # the head of every lane
            at = np.flatnonzero(tall)
            counts, spans, heights = np.add.reduceat(counts, at), np.add.reduceat(spans, at), heights[at]
            self.lanes.append((counts, spans, at))
            level += 1

    def start(self, rank: int) -> int:
        """The code point at which unit ``rank`` begins; for ``rank == n`` the end of the text."""
        unit = point = node = 0
        for counts, spans, below in reversed(self.lanes):
            while node < len(counts) and unit + counts[node] <= rank:
                unit += int(counts[node])
                point += int(spans[node])
                node += 1
            if node == len(counts):
                return point  # past the last node of a lane lies the end
            node = int(below[node])
        return point + (rank - unit if self.inside is None else sum(self.inside[node][:rank - unit]))


def unit_widths(text: str, pattern: regex.Pattern) -> Iterator[int]:
    """Code points of each unit: a non-empty match begins a unit that lasts until the next; what stands before the
    first match belongs to it."""
    begun = None
    for match in pattern.finditer(text):
        if match.end() > match.start():
            if begun is None:
                begun = 0
            else:
                yield match.start() - begun
                begun = match.start()
    if text:
        yield len(text) - (begun or 0)


def draw(key: Column, seed: int, k: int) -> Column:
    """The ``k``-th group of eight hex digits of the SHA-256 of ``seed:key``, as a number."""
    digest = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), "UTF-8"), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, rate: int = 90, spm: int = 20, unit: str | None = None) -> DataFrame:
    """``docs`` with every whole text in fill-in-the-middle form.

    ``rate`` per cent of the texts are cut in three at two ranks among their units; of those, ``spm`` per cent give the
    suffix first.  ``unit`` is a pattern whose matches begin units; without it a unit is a code point.  All draws depend on
    ``seed`` and the key alone, so repeated rows get the same form; a null key draws as the empty one.  Null and empty
    texts, and those that hold a mark, stay plain.  Adds ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points, null if plain) and ``output``; columns with these names are replaced, others pass
    through, the text too (null as empty).  An empty table stays empty.
    """
    added = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}
    keep = [c for c in docs.columns if c not in {*added, text} and not c.startswith("_fim")]
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    form = F.when((whole == "") | marked | (draw(F.col(key), seed, 2) % 100 >= rate), "plain").when(
        draw(F.col(key), seed, 3) % 100 < spm, "spm").otherwise("psm")
    rows = docs.select(*keep, whole.alias(text), form.alias("_fim_form"), draw(F.col(key), seed, 0).alias("_fim_h1"), draw(F.col(key), seed, 1).alias("_fim_h2"))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(text, T.StringType()), *(T.StructField(c, kind) for c, kind in added.items())])

    def cut(whole: str, form: str, h1: int, h2: int, pattern) -> tuple:
        units = SkipList(unit_widths(whole, pattern) if pattern else len(whole))
        if form == "plain":
            return units.n, form, None, None, whole
        low, high = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
        a, b = units.start(low), units.start(high)
        prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
        parts = (PREFIX, prefix, SUFFIX, suffix) if form == "psm" else (SUFFIX, suffix, PREFIX, prefix)
        return units.n, form, a, b - a, "".join((*parts, MIDDLE, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(unit) if unit else None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cuts = [cut(*row, pattern) for row in zip(*(part.column(c).to_pylist() for c in (text, "_fim_form", "_fim_h1", "_fim_h2")))]
                made = [pa.array(values, kind) for values, kind in zip(zip(*cuts), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), part.column(text), *made], [*keep, text, *added])

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text from its output and form alone: marks cut it into parts, which go back into their order."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
