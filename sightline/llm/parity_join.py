"""N-gram Jaccard join by parity sketches.

A document's set of shingles is hashed into a long bit sketch in which every shingle flips one bit, so the Hamming
distance of two sketches is at most the symmetric difference of the sets.  At a similarity of at least ``t`` that
difference is at most (1-t)/(1+t) of the two sizes together: with one block more than this bound, two linked sketches
agree in at least one block.  Sketches are laid out per size band and joined on (band, partition, block, content).
The sketch is kept sparsely: a block's content is the XOR of the mixed positions of its set bits, and a shingle that
occurs an even number of times cancels, as in the bits themselves.

A band's sketch is cut anew by several independent hash partitions until there are ``BLOCKS`` blocks; a band with more
blocks than that uses the first ``BLOCKS``.  A linked pair disagrees in a given block with chance at most 1 - 1/e, so
it is missed by all with chance below 2e-13, which is the only way a link can be lost.

Within a block's group no pairs are listed.  Each set is compared with the nearest of its groups' leaders first; what
that joins is one class.  Sets outside of a group's largest class are compared with the nearest of other leaders, drawn
from those classes, ``STARS`` times.  Only then are members of different classes compared with one another.  A linked
pair differs in a bounded number of shingles, so of the blocks in which a set has bits all but as many are the same in
both; that number of groups, summed over a band's partitions, the pair shares for ``sure``.  A set leaves at most one
group less than that, and at most ``SPARE``: the commonest of its groups that have more than ``COMMON`` members.  By one
order of all groups, the rarest that a linked pair shares is then left by neither, whatever the hashes.

A short sketch of ``SKETCH_WORDS`` words bounds the distance of two sets wherever they meet.  In sets of more shingles
than it has bits most of it is chance, so these have a wide sketch as well, with at least a bit for each shingle; a pair of
them is held against it before its texts are fetched.  Unlike long texts that share a passage end there.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.llm import shingles
from sightline.llm.common import settle

BLOCKS, COMMON, SPARE, STARS = 64, 48, 2, 1
#: Least similarity, as a ratio of whole numbers.
AT_LEAST = (75, 100)
SKETCH_WORDS = 16
_PROFILE = "row long, doc_id long, n_shingles long, node long, keys array<long>, lower int, sure array<int>, " + ", ".join(f"s{k} long" for k in range(SKETCH_WORDS)) + ", wide array<long>"


def blocks_of(band: int, at_least: tuple[int, int]) -> int:
    """Blocks for sets of 2**band to 2**(band+1)-1 shingles."""
    low, high = at_least
    return (high - low) * 2 * (2 ** (band + 1) - 1) // (high + low) + 1


def bands_of(size: int, at_least: tuple[int, int]) -> list[int]:
    """The band of a size, and the next one if a linked set can lie there."""
    if not size:
        return []
    band = size.bit_length() - 1
    return [band] if size * at_least[1] < 2 ** (band + 1) * at_least[0] else [band, band + 1]


def band_keys(found: np.ndarray, band: int, at_least: tuple[int, int]) -> np.ndarray:
    """The keys of a set in a band: one for each block in which the sketch has a bit."""
    return keys_and_sure(found, band, at_least)[0]


def keys_and_sure(found: np.ndarray, band: int, at_least: tuple[int, int]) -> tuple[np.ndarray, int]:
    """``band_keys``, and how many of them every set of the band that is linked with this one has as well."""
    count = blocks_of(band, at_least)
    low, high = at_least
    differ = min((len(found) + len(found) * high // low) * (high - low) // (high + low), count - 1)
    keys, sure = [], 0
    for part in range(-(-BLOCKS // count)):
        seed = np.uint64(((band << 32 | part) * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
        place = shingles.mix(found ^ seed)
        block = ((place >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        take = block < BLOCKS - part * count if count > BLOCKS or (part + 1) * count > BLOCKS else slice(None)
        block, content = block[take], shingles.mix(place[take] + seed)
        if not len(block):
            continue
        order = np.argsort(block, kind="stable")
        block, content = block[order], content[order]
        first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        keys.append(shingles.mix(np.bitwise_xor.reduceat(content, first) + shingles.mix(seed + block[first])))
        sure += max(0, len(first) - differ)
    return (np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)), sure


def sketch_of(found: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """A parity sketch of 64 bits a word; ``words`` is a power of two, and the halves of a sketch XORed are that of half as many."""
    bits = np.bincount((found >> np.uint64(20) & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def wide_sketch(found: np.ndarray) -> np.ndarray | None:
    """A sketch of one to two bits a shingle; none for a set that the short one has a bit for each shingle of."""
    return sketch_of(found, 2 ** len(found).bit_length() // 64) if len(found) >= 64 * SKETCH_WORDS else None


def profiles(docs: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """Per row: size of its set, ``node`` (a hash of the set), band keys, how many of them are of its own band, how many
    of each band are ``sure``, a short sketch, and a wide one if the set is large."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in shingles.chunks(batch.column("text")):
                part = batch.slice(start, end - start)
                found, first = shingles.shingles(part.column("text"))
                sizes, nodes, keys, lower, sure, sketches, wide = [], [], [], [], [], [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    own = np.unique(found[a:b])
                    sizes.append(len(own))
                    nodes.append(set_hash(own))
                    banded = [keys_and_sure(own, band, at_least) for band in bands_of(len(own), at_least)]
                    keys.append(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in banded)]))
                    lower.append(len(banded[0][0]) if banded else 0)
                    sure.append([n for _, n in banded])
                    sketches.append(sketch_of(own))
                    wide.append(wide_sketch(own))
                sketch = np.array(sketches, np.int64)
                offsets = pa.array(np.cumsum([0, *map(len, keys)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys).view(np.int64))), pa.array(lower, pa.int32()), pa.array(sure, pa.list_(pa.int32())),
                     *(pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(SKETCH_WORDS)), pa.array(wide, pa.list_(pa.int64()))],
                    ["row", "doc_id", "n_shingles", "node", "keys", "lower", "sure", *(f"s{k}" for k in range(SKETCH_WORDS)), "wide"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, _PROFILE)


def apart() -> Column:
    """Hamming distance of the sketches of ``a`` and ``b``."""
    return sum((F.bit_count(F.col(f"a_s{k}").bitwiseXOR(F.col(f"b_s{k}"))) for k in range(SKETCH_WORDS)), F.lit(0))


def may_link(at_least: tuple[int, int]) -> Column:
    """What the sizes and sketches of ``a`` and ``b`` allow: never false for a linked pair."""
    low, high = at_least
    a, b = F.col("a_n"), F.col("b_n")
    return (F.least(a, b) * high >= F.greatest(a, b) * low) & (apart() * (high + low) <= (a + b) * (high - low))


def side(nodes: DataFrame, name: str, *more: str) -> DataFrame:
    return nodes.select(F.col("node").alias(name), F.col("doc_id").alias(f"{name}_doc"), F.col("n_shingles").alias(f"{name}_n"),
                        *(F.col(f"s{k}").alias(f"{name}_s{k}") for k in range(SKETCH_WORDS)), *(F.col(c).alias(f"{name}_{c}") for c in more))


def set_hash(own: np.ndarray) -> int:
    """One number for a set of distinct hashes; 0 for the empty set."""
    if not len(own):
        return 0
    both = np.array([np.bitwise_xor.reduce(shingles.mix(own)), own.sum(dtype=np.uint64)], np.uint64)
    return int(shingles.combine(both[None])[0].astype(np.int64))


def nearest(stars: DataFrame, nodes: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """Of the pairs (a, b), for each b the one whose sketches are least apart, if any may link."""
    both = stars.distinct().join(side(nodes, "b"), "b").join(side(nodes, "a"), "a").where(may_link(at_least))
    best = both.groupBy("b").agg(F.min_by(F.struct("a", "a_doc", "b_doc"), F.struct(apart(), "a")).alias("best"))
    return best.select("b", "best.a", "best.a_doc", "best.b_doc")


def folded(sketch: Column, words: Column) -> Column:
    """A sketch of ``words`` words, or of twice as many, as one of ``words``."""
    halves = F.zip_with(F.slice(sketch, F.lit(1), words), F.slice(sketch, words + 1, words), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(sketch) > words, halves).otherwise(sketch)


def likely(pairs: DataFrame, nodes: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (a, a_doc, b, b_doc) that their wide sketches allow, and those without two: never without a linked one."""
    low, high = at_least
    wide = nodes.where("wide IS NOT NULL")
    both = (pairs.select("a", "a_doc", "b", "b_doc")
            .join(wide.select(F.col("node").alias("a"), F.col("n_shingles").alias("a_n"), F.col("wide").alias("a_wide")), "a", "left")
            .join(wide.select(F.col("node").alias("b"), F.col("n_shingles").alias("b_n"), F.col("wide").alias("b_wide")), "b", "left"))
    words = F.least(F.size("a_wide"), F.size("b_wide"))
    differ = F.zip_with(folded(F.col("a_wide"), words), folded(F.col("b_wide"), words), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    near = F.aggregate(differ, F.lit(0), lambda total, n: total + n) * (high + low) <= (F.col("a_n") + F.col("b_n")) * (high - low)
    return both.where(F.when(F.col("a_wide").isNotNull() & F.col("b_wide").isNotNull(), near).otherwise(True)).select("a", "a_doc", "b", "b_doc")


def verified(pairs: DataFrame, texts: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (a, a_doc, b, b_doc) whose sets are similar enough, by their ``texts`` (_id, _text).  Where rows
    of different texts share an id, only the text that has the pair's set counts."""
    low, high = at_least
    both = (pairs.select("a", "a_doc", "b", "b_doc")
            .join(texts.select(F.col("_id").alias("a_doc"), F.col("_text").alias("a_text")), "a_doc")
            .join(texts.select(F.col("_id").alias("b_doc"), F.col("_text").alias("b_text")), "b_doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                x, x_first = shingles.shingles(part.column("a_text"))
                y, y_first = shingles.shingles(part.column("b_text"))
                good = np.zeros(part.num_rows, bool)
                for k, (a, b) in enumerate(zip(part.column("a").to_pylist(), part.column("b").to_pylist())):
                    one, two = np.unique(x[x_first[k]:x_first[k + 1]]), np.unique(y[y_first[k]:y_first[k + 1]])
                    common = len(np.intersect1d(one, two, assume_unique=True))
                    good[k] = (set_hash(one), set_hash(two)) == (a, b) and common * high >= (len(one) + len(two) - common) * low
                yield part.select(["a", "a_doc", "b", "b_doc"]).filter(pa.array(good))

    return both.select("a", "a_doc", "b", "b_doc", "a_text", "b_text").mapInArrow(run, "a long, a_doc long, b long, b_doc long")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` of each node that has a link (a, a_doc, b, b_doc): the smallest id that its links reach.

    Labels go along links to the neighbours and then to the node that bears the label, until none changes; every
    round is a written table.
    """
    there = links.select("a", "a_doc", "b", "b_doc")
    both = there.unionByName(there.select(F.col("b").alias("a"), F.col("b_doc").alias("a_doc"), F.col("a").alias("b"), F.col("a_doc").alias("b_doc")))
    label = F.least("b_doc", F.min("a_doc"))
    labels = settle(both.groupBy(F.col("b").alias("node"), "b_doc").agg(label.alias("label")).withColumnRenamed("b_doc", "doc_id"))
    while True:
        heard = (both.select("a", "b").join(labels.select(F.col("node").alias("a"), "label"), "a")
                 .groupBy(F.col("b").alias("node")).agg(F.min("label").alias("heard")))
        spread = settle(labels.join(heard, "node").select("node", "doc_id", F.col("label").alias("was"), F.least("label", "heard").alias("label")))
        of = spread.groupBy(F.col("doc_id").alias("label")).agg(F.min("label").alias("further"))
        jumped = settle(spread.join(of, "label").select("node", "doc_id", "was", F.least("label", "further").alias("label")))
        if jumped.where("label <> was").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "doc_id", "label")


def near_groups(docs: DataFrame, at_least: tuple[int, int] = AT_LEAST) -> DataFrame:
    """Connected groups of documents whose sets of five-word shingles are similar.

    Takes ``doc_id`` and ``text``; other columns are ignored.  Returns one row per input row: ``doc_id``,
    ``n_shingles`` and ``component_id``, the smallest ``doc_id`` reachable by links, itself included.

    Null and empty texts, and texts of white space, have no shingles and no links.  Documents with equal sets are one
    node of the join, however many they are.  Rows without an id link nothing and get a null ``component_id``; repeated
    rows get a row each.  An empty table gives an empty result.
    """
    rows = settle(profiles(docs, at_least))
    own = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = own.groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    nodes = settle(own.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").drop("row"))

    upper = F.col("at") >= F.col("lower")
    spare = F.greatest(F.least(F.get("sure", upper.cast("int")) - 1, F.lit(SPARE)), F.lit(0))
    keys = nodes.select("node", "lower", "sure", F.posexplode("keys").alias("at", "key")).select("key", "node", upper.alias("upper"), spare.cast("byte").alias("spare"))
    groups = settle(keys.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("leader")).where("members > 1"))
    met = settle(keys.join(groups, "key"))

    shared = met.select("node").distinct().join(nodes.select("node", F.col("doc_id").alias("_id")), "node").select("_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    texts = settle(texts.join(shared, "_id", "left_semi"))
    stars = met.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    links = settle(verified(likely(nearest(stars, nodes, at_least), nodes, at_least), texts, at_least))
    commonest = Window.partitionBy("node", "upper").orderBy(F.desc("members"), F.desc("key"))
    common = met.where(F.col("members") > COMMON).withColumn("nth", F.row_number().over(commonest)).where(F.col("nth") > F.col("spare"))
    met = settle(met.where(F.col("members") <= COMMON).select("key", "node").unionByName(common.select("key", "node")))

    # sets that are still in different classes, wherever they share a group
    for step in range(STARS + 1):
        labels = components(links)
        classes = settle(nodes.drop("keys", "lower", "sure", "wide").join(labels, "node", "left").withColumn("label", F.coalesce("label", "doc_id")))
        left = met.join(classes.select("node", "label"), "node")
        sizes = left.groupBy("key", "label").agg(F.count("*").alias("n"), F.max_by("node", F.xxhash64("node", "key", F.lit(step))).alias("one"))
        mixed = settle(sizes.groupBy("key").agg(F.max(F.struct("n", "label", "one")).alias("top"), F.count("*").alias("labels"))
                       .where("labels > 1").select("key", F.col("top.label").alias("major"), F.col("top.one").alias("leader")))
        left = settle(left.join(mixed, "key"))
        if step == STARS:
            break
        stars = left.where("label <> major").select(F.col("leader").alias("a"), F.col("node").alias("b"))
        more = settle(verified(likely(nearest(stars, nodes, at_least), nodes, at_least), texts, at_least))
        if more.isEmpty():
            break
        links = settle(links.union(more))
    a = side(classes, "a", "label").join(left.where("label <> major").select("key", F.col("node").alias("a")), "a")
    b = side(classes, "b", "label").join(left.select("key", F.col("node").alias("b"), (F.col("label") == F.col("major")).alias("b_major")), "b")
    rest = (a.join(b, (a["key"] == b["key"]) & (F.col("a_label") != F.col("b_label")) & (F.col("b_major") | (F.col("a") < F.col("b"))) & may_link(at_least))
            .select("a", "a_doc", "b", "b_doc").distinct())
    more = settle(verified(likely(rest, nodes, at_least), texts, at_least))
    if not more.isEmpty():
        labels = components(links.union(more))
    final = settle(nodes.select("node", "doc_id").join(labels, "node", "left").select("node", F.coalesce("label", "doc_id").alias("label")))
    return (rows.select("doc_id", "n_shingles", "node").join(final, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id")))


def drop_near(docs: DataFrame, at_least: tuple[int, int] = AT_LEAST) -> DataFrame:
    """``docs`` with one document of each group, the one whose id names it; rows without an id stay."""
    stays = near_groups(docs, at_least).where("doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    named = docs.join(stays, docs["doc_id"] == stays["_stays"], "left_semi")
    return named.unionByName(docs.where("doc_id IS NULL"))
