"""Language ID by the nearest of several centroids per language, over TF-IDF vectors of letter n-grams.

Texts are lower-cased, every run of other characters than letters is one boundary, and pairs and triples of what is
left are hashed into ``WIDTH`` counts.  Vectors are (1 + log count) * idf, of length 1.  Document frequencies come from
all labelled documents; centroids from a bounded sample (``SAMPLE`` documents of each language, by a hash of their
ids), clustered by spherical k-means.  The nearest centroid by cosine names the language.  A text is rejected where it
is much farther from it than sampled texts with about as many letters are from theirs.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sightline.llm import shingles

WIDTH, CENTROIDS, SAMPLE, ROUNDS = 4096, 4, 300, 12
#: Length classes are powers of two of the letters; a text is rejected below this share of its class's low cosines.
CLASSES, LOW_SHARE, SLACK = 24, 0.01, 0.5
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of n-gram counts for each text, and its number of letters."""
    joined = "\n".join(texts).lower() + "\n"
    # lower-casing may change lengths, so texts are told apart by the line ends that they themselves may not have
    if joined.count("\n") != len(texts):
        joined = "\n".join(" ".join(t.split("\n")) for t in texts).lower() + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(codes == 10)
    letter = letters()[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # one boundary after each run of letters
    kept[ends] = True
    text = np.searchsorted(ends, np.flatnonzero(kept))
    value = np.where(letter, codes, 0)[kept].astype(np.uint64)
    row = text.astype(np.int64) * WIDTH
    counts = np.zeros(len(texts) * WIDTH, np.int64)
    for n in (2, 3):
        if len(value) >= n:
            gram = np.zeros(len(value) - n + 1, np.uint64)
            for k in range(n):
                gram = gram * np.uint64(0x110001) + value[k:len(value) - n + 1 + k]
            inside = (text[:len(gram)] == text[n - 1:]) & (gram != 0)
            counts += np.bincount(row[:len(gram)][inside] + (shingles.mix(gram[inside]) % np.uint64(WIDTH)).astype(np.int64), minlength=len(counts))
    return counts.reshape(len(texts), WIDTH), np.bincount(np.searchsorted(ends, np.flatnonzero(letter)), minlength=len(texts))


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.zeros(counts.shape, np.float32)
    there = counts > 0
    weights[there] = 1 + np.log(counts[there])
    weights *= idf
    length = np.linalg.norm(weights, axis=1, keepdims=True)
    return weights / np.maximum(length, 1e-12)


def class_of(size: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), CLASSES - 1)


@dataclass
class Model:
    names: list[str]
    of: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, cosine, whether it is rejected, and length class of each text."""
        counts, size = counted(texts)
        if not self.names or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool), class_of(size)
        cosine = vectors(counts, self.idf) @ self.centroids.T
        best = cosine.argmax(1)
        some, kind = size > 0, class_of(size)
        score = np.where(some, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0.0).astype(float)
        names = [self.names[self.of[b]] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
        return names, score, ~some | (score < self.least[kind]), kind


def clustered(rows: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means from far starting points: at most ``count`` centroids of length 1."""
    starts = [int((rows @ rows.mean(0)).argmax())]
    while len(starts) < min(count, len(rows)):
        starts.append(int((rows @ rows[starts].T).max(1).argmin()))
    centroids = rows[starts]
    for _ in range(ROUNDS):
        near = (rows @ centroids.T).argmax(1)
        sums = np.stack([rows[near == k].sum(0) if (near == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    texts = batch.column("text").fill_null("")
    for start, end in shingles.chunks(texts):
        for low in range(start, end, 256):
            high = min(end, low + 256)
            yield batch.slice(low, high - low), texts.slice(low, high - low).to_pylist()


def frequencies(labelled: DataFrame) -> tuple[np.ndarray, int]:
    """In how many labelled documents each n-gram is, and how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH + 1, np.int64)
        for batch in batches:
            for _, texts in parts(batch):
                counts, _ = counted(texts)
                total[:WIDTH] += (counts > 0).sum(0)
                total[WIDTH] += len(texts)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "docs"])

    found = np.zeros(WIDTH + 1, np.int64)
    for r in labelled.select("text").mapInArrow(run, "gram long, docs long").groupBy("gram").agg(F.sum("docs").alias("docs")).collect():
        found[r.gram] = r.docs
    return found[:WIDTH], int(found[WIDTH])


def sampled(labelled: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` documents of each language, chosen by a hash of their ids."""
    spark = labelled.sparkSession
    ids: set[int] = set()
    order = F.xxhash64("doc_id")
    for name in sorted(r.lang for r in labelled.select("lang").distinct().collect()):
        ids.update(r.doc_id for r in labelled.where(F.col("lang") == name).select("doc_id").orderBy(order, "doc_id").limit(SAMPLE).collect())
    chosen = spark.createDataFrame([(i,) for i in sorted(ids)], "chosen long")
    return labelled.select("doc_id", "lang", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"), "left_semi")


def fit(labelled: DataFrame) -> Model:
    """A model from ``doc_id``, ``text`` and ``lang``; rows without any of them, and texts without letters, teach nothing."""
    labelled = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    seen, total = frequencies(labelled)
    idf = np.log((total + 1) / (seen + 1)).astype(np.float32) + np.float32(0.1)
    sample = sampled(labelled)

    def vectorised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch):
                counts, size = counted(texts)
                rows = vectors(counts, idf)
                some = pa.array(size > 0)
                vector = pa.array([r.tobytes() for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), vector], ["doc_id", "lang", "vector"]).filter(some)

    found = sorted(sample.mapInArrow(vectorised, "doc_id long, lang string, vector binary").distinct().collect())
    names = sorted({r.lang for r in found})
    centroids = [clustered(np.stack([np.frombuffer(r.vector, np.float32) for r in found if r.lang == name]), CENTROIDS) for name in names]
    model = Model(names, np.repeat(np.arange(len(names)), [len(c) for c in centroids]) if names else np.zeros(0, int),
                  np.concatenate(centroids) if names else np.zeros((0, WIDTH), np.float32), idf, np.zeros(CLASSES))
    if not names:
        return model

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in parts(batch):
                # pieces of every length class, so that short texts are held against short ones
                pieces = [p for t in texts for p in {t, *(t[:1 << k] for k in range(2, 12))}]
                for k in range(0, len(pieces), 256):
                    _, score, _, kind = model.predict(pieces[k:k + 256])
                    yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(score)], ["kind", "score"])

    low = sample.mapInArrow(cosines, "kind long, score double").where("score > 0").groupBy("kind").agg(F.percentile("score", F.lit(LOW_SHARE)).alias("low"))
    known = {r.kind: r.low * SLACK for r in low.collect()}
    # a class that no sample reaches takes the bar of the nearest that one does, of two the shorter
    least = [known[min(known, key=lambda other: (abs(other - k), other))] if known else 0.0 for k in range(CLASSES)]
    model.least = np.minimum.accumulate(np.array(least)[::-1])[::-1]  # a longer text is never held to less
    return model


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected`` of each row, from its text alone.

    Null texts and texts without a letter are ``und``, with score 0, and rejected.  A rejected text with letters still
    names its nearest language.  Ties go to the language first in order.  Repeated rows get a row each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch):
                names, score, rejected, _ = model.predict(texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names), pa.array(score), pa.array(rejected)], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``predictions`` for all rows, and ``held_out``: learned from the labelled rows that are not held out."""
    model = fit(docs.where(~held_out()))
    return predictions(docs, model).withColumn("held_out", held_out())


def drop_rejected(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the model rejects; all columns stay as they are."""
    model = fit(docs.where(~held_out()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts(batch):
                yield part.filter(pa.array(~model.predict(texts)[2]))

    return docs.mapInArrow(run, docs.schema)
