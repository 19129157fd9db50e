"""Approximate nearest neighbours by inner product over balanced posting lists.

Centroids are fitted on a bounded sample: balanced k-means cuts it into regions, and each region into lists.  A graph over
the centroids, held in memory, is searched outward from the nearest region.  Every vector is in the list of its nearest
centroid, and in a few more when it lies close to the boundary.  A query visits the lists whose centroids are within a fixed
ratio of its nearest one.  Lists are packed into shelves of bounded size, so that a query travels once to each shelf that
holds one of its lists, whatever their number.

Inner product becomes distance by one more coordinate, sqrt(R^2 - |x|^2) for vectors and 0 for queries, which are scaled to
the greatest norm R.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sightline.llm.common import settle

#: Bytes of the sample that fits the centroids, of all centroids, and of the vectors of a shelf: bounds of memory.
SAMPLE_BYTES, CENTROID_BYTES, SHELF_BYTES = 1 << 24, 1 << 24, 1 << 25
#: Vectors a list should have, sampled vectors a centroid needs at least, lists a vector may be in.
LIST, SAMPLE_OF_LIST, REPLICAS = 256, 16, 3
#: A vector joins, and a query visits, the lists whose centroids are at most so many times as far as the nearest.
JOIN_RATIO, VISIT_RATIO = 1.1, 1.15
#: Shelves into which a small table is packed; a large one has as many as its bytes need.  Queries of a block.
SHELVES, BLOCK = 16, 1 << 16
#: Near neighbours of a centroid in the graph, and how far beyond the ratio the search goes on.
DEGREE, SLACK = 12, 1.1


def balanced_means(points: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and the centroid of each point; a crowded centroid gets dearer until sizes are near equal."""
    rng = np.random.default_rng(len(points))
    k = min(k, len(points))
    centres = points[np.sort(rng.choice(len(points), k, replace=False))]
    price, mine = np.zeros(k), np.zeros(len(points), np.int64)
    for _ in range(rounds if k > 1 else 1):
        far = (centres ** 2).sum(1) - 2 * (points @ centres.T)
        mine = (far + price).argmin(1)
        sizes = np.bincount(mine, minlength=k)
        spread = max(float(far.std()), 1e-12)
        price += 0.1 * spread * np.clip(sizes * k / len(points) - 1, -1, 1)
        full = sizes > 0
        centres[full] = np.add.reduceat(points[np.argsort(mine, kind="stable")], (np.cumsum(sizes) - sizes)[full]) / sizes[full, None]
    return centres, mine


class Index:
    """Centroids in the order of their regions, a neighbour graph over them, and the search in that graph."""

    def __init__(self, sample: np.ndarray, lists: int):
        regions, mine = balanced_means(sample, max(1, round(lists ** 0.5)))
        centres = []
        for region in range(len(regions)):
            inside = sample[mine == region]
            if len(inside):
                centres.append(balanced_means(inside, max(1, round(lists * len(inside) / len(sample))))[0])
        self.centres = np.concatenate(centres).astype(np.float32)
        self.squares = (self.centres.astype(np.float64) ** 2).sum(1)
        count = len(self.centres)
        ends = np.cumsum([len(c) for c in centres])
        self.seeds = np.array([start + ((self.centres[start:end] - self.centres[start:end].mean(0)) ** 2).sum(1).argmin()
                               for start, end in zip([0, *ends[:-1]], ends)])
        near = np.empty((count, min(DEGREE, count - 1)), np.int64)
        for start in range(0, count, 1024):
            far = self.distances(self.centres[start:start + 1024])
            far[np.arange(len(far)), np.arange(start, start + len(far))] = np.inf
            near[start:start + 1024] = np.argpartition(far, near.shape[1] - 1, axis=1)[:, :near.shape[1]] if near.shape[1] else 0
        places = np.arange(count)
        # The ring through all centroids, in the order of their regions, keeps the graph in one piece.
        edges = np.concatenate([np.stack([np.repeat(places, near.shape[1]), near.ravel()]), np.stack([near.ravel(), np.repeat(places, near.shape[1])]),
                                np.stack([places, (places + 1) % count]), np.stack([(places + 1) % count, places])], axis=1)
        edges = np.unique(edges[0] * count + edges[1])
        self.ends = edges % count
        self.first = np.searchsorted(edges // count, np.arange(count + 1))
        picked = np.sqrt(np.maximum(self.distances(sample[:: max(1, len(sample) // 2048)]).min(1), 0))
        self.radius = float(picked.mean())

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        return (points.astype(np.float64) ** 2).sum(1)[:, None] + self.squares - 2 * (points.astype(np.float32) @ self.centres.T).astype(np.float64)

    def around(self, points: np.ndarray, ratio: float, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, centroid, distance) of the centroids within ``ratio`` times the nearest distance, or ``floor``, that are
        reached in the graph through such ones or those a little farther; sorted by point, then distance."""
        count, step = len(self.centres), max(16, (1 << 22) // len(self.centres))
        found = []
        for start in range(0, len(points), step):
            block = points[start:start + step]
            own = (block.astype(np.float64) ** 2).sum(1)
            toward = own[:, None] + self.squares[self.seeds] - 2 * (block @ self.centres[self.seeds].T)
            p, c = np.arange(len(block)).repeat(len(self.seeds)), np.tile(self.seeds, len(block))
            d, seen = np.sqrt(np.maximum(toward, 0)).ravel(), np.zeros((len(block), count), bool)
            seen[p, c] = True
            best = d.reshape(len(block), -1).min(1)
            kept = []
            while len(p):
                within = d <= SLACK * np.maximum(best[p] * ratio, floor)
                p, c, d = p[within], c[within], d[within]
                kept.append((p, c, d))
                widths = self.first[c + 1] - self.first[c]
                offsets = np.arange(widths.sum()) - np.repeat(np.cumsum(widths) - widths, widths)
                keys = np.repeat(p, widths) * count + self.ends[np.repeat(self.first[c], widths) + offsets]
                keys = np.unique(keys[~seen.ravel()[keys]])
                seen.ravel()[keys] = True
                p, c = keys // count, keys % count
                d = np.empty(len(keys))
                for at in range(0, len(keys), 1 << 16):
                    q, r = p[at:at + (1 << 16)], c[at:at + (1 << 16)]
                    d[at:at + (1 << 16)] = own[q] + self.squares[r] - 2 * np.einsum("ij,ij->i", block[q], self.centres[r])
                d = np.sqrt(np.maximum(d, 0))
                np.minimum.at(best, p, d)
            p, c, d = map(np.concatenate, zip(*kept))
            within = d <= np.maximum(best[p] * ratio, floor)
            p, c, d = p[within], c[within], d[within]
            order = np.lexsort((c, d, p))
            found.append((p[order] + start, c[order], d[order]))
        return tuple(map(np.concatenate, zip(*found)))

    def rest(self, point: np.ndarray) -> np.ndarray:
        """All centroids from the nearest to the farthest, for a query that needs more lists than its ratio gives."""
        return np.argsort(self.distances(point[None, :])[0], kind="stable")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` of rows that can take part: an id, no null or non-finite component, not all zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(key).isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0)).select(F.col(key).alias("id"), v.alias("v"))


def distinct_vectors(rows: DataFrame, top: int, every: int) -> tuple[DataFrame, DataFrame]:
    """Rows of one copy of each vector with the least ids of its copies, and the (query, copy) pairs.

    A vector is known by two 64-bit hashes of its components.  Ids of a group are pruned to ``top + 1`` in every task, so
    a vector that a third of all rows share is one row here, and its other rows are searched for once.
    """
    keys = rows.select("id", F.xxhash64("v").alias("h0"), F.xxhash64(F.lit("second"), "v").alias("h1"))
    ranked = keys.withColumn("_rank", F.row_number().over(Window.partitionBy("h0", "h1").orderBy("id"))).where(F.col("_rank") <= top + 1)
    asked = keys.where(F.col("id") % every == 0).groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("_asked"))
    groups = settle(ranked.groupBy("h0", "h1").agg(F.array_sort(F.collect_list("id")).alias("ids")).where(F.size("ids") > 1)
                    .join(asked, ["h0", "h1"], "left").withColumn("asked", F.col("_asked").isNotNull()).drop("_asked"))
    hashed = rows.withColumns({"h0": F.xxhash64("v"), "h1": F.xxhash64(F.lit("second"), "v")})
    marked = hashed.join(groups, ["h0", "h1"], "left")
    one = marked.where(F.col("ids").isNull() | (F.col("id") == F.col("ids")[0])).select(
        "id", "v", "ids", F.coalesce("asked", F.col("id") % every == 0).alias("asked"))
    queries = keys.where(F.col("id") % every == 0).join(groups.select("h0", "h1", F.col("ids")[0].alias("_copy")), ["h0", "h1"], "left").select(
        F.col("id").alias("query_id"), F.coalesce("_copy", "id").alias("copy"))
    return one, queries


def nearest(df: DataFrame, key: str = "vec_id", vector: str = "embedding", top: int = 20, every: int = 20) -> DataFrame:
    """For each row whose id is divisible by ``every``, its ``top`` nearest other rows by inner product.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` (the inner product of the original components in double
    precision); ties go to the smaller id.  All rows are indexed; each visited list is searched whole, so the only rows that
    can be missed are those in lists beyond ``VISIT_RATIO``.  A query whose lists hold too few vectors visits further ones,
    up to all.  Vectors that are null, zero or hold null or non-finite components, rows without an id, and vectors of another
    length than the commonest (the longer of equally common ones) take no part.  Of rows with one id, that with the greatest
    vector counts.  Equal vectors are searched for once, and each copy is an answer of its own.  Other columns are ignored;
    an empty table gives no rows.
    """
    spark = df.sparkSession
    valid = usable(df, key, vector)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    shapes = valid.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm")).orderBy(F.desc("n"), F.desc("dims")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if shapes is None:
        return empty
    dims, greatest = shapes.dims, shapes.norm ** 0.5
    valid = valid.where(F.size("v") == dims)
    twice = valid.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id")
    if not twice.isEmpty():
        again = valid.join(twice, "id", "left_semi").groupBy("id").agg(F.max("v").alias("v"))
        valid = valid.join(twice, "id", "left_anti").unionByName(again)
    rows, queries = distinct_vectors(valid, top, every)

    width = max(1, dims * 4)
    share = min(1.0, SAMPLE_BYTES / width / shapes.n)
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.array(drawn.orderBy("id").select("v").toArrow().column("v").combine_chunks().flatten(), np.float64).reshape(-1, dims)
    if not len(sample):
        sample = np.array([rows.select("v").first().v], np.float64)

    def lifted(v: np.ndarray, query: bool) -> np.ndarray:
        v = v.astype(np.float64) / greatest
        length = (v ** 2).sum(1)
        if query:
            return np.c_[v / np.sqrt(length)[:, None], np.zeros(len(v))].astype(np.float32)
        return np.c_[v, np.sqrt(np.maximum(1 - length, 0))].astype(np.float32)

    lists = int(max(1, min(shapes.n // LIST, len(sample) // SAMPLE_OF_LIST, CENTROID_BYTES // width)))
    index = Index(lifted(sample, False), lists)
    shared = spark.sparkContext.broadcast(index)

    def join_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = lifted(matrix(batch.column("v"), dims), False)
                p, c, _ = shared.value.around(points, JOIN_RATIO)
                turn = np.arange(len(p)) - np.searchsorted(p, p)
                p, c = p[turn < REPLICAS], c[turn < REPLICAS]
                offsets = np.searchsorted(p, np.arange(batch.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(c.astype(np.int32)))], [*batch.schema.names, "lists"])

    placed = settle(rows.mapInArrow(join_lists, T.StructType([*rows.schema.fields, T.StructField("lists", T.ArrayType(T.IntegerType()))])))

    # The size of every list: at most as many rows as there are centroids.
    sizes = np.zeros(len(index.centres), np.int64)
    firsts = np.zeros(len(index.centres), np.int64)
    for r in placed.select(F.posexplode("lists").alias("turn", "list")).groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("turn") == 0).cast("int")).alias("own")).collect():
        sizes[r["list"]], firsts[r["list"]] = r["n"], r["own"]
    room = max(1, min(SHELF_BYTES // width, max(1024, -(-int(sizes.sum()) // SHELVES))))
    shelf, filled, shelf_of, chunks = 0, 0, np.zeros(len(sizes), np.int32), [1]
    for k, size in enumerate(sizes):
        if filled and filled + size > room:
            shelf, filled = shelf + 1, 0
            chunks.append(1)
        shelf_of[k] = shelf
        filled += int(size)
        chunks[shelf] = max(1, -(-filled // room))  # a list larger than a shelf is cut into chunks
    wanted = int(min(top + 1, firsts.sum()))
    plan = spark.sparkContext.broadcast((shelf_of, firsts, wanted))

    def visit_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf_of, firsts, wanted = plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = lifted(matrix(batch.column("v"), dims), True)
            p, c, _ = shared.value.around(points, VISIT_RATIO, shared.value.radius)
            enough = np.bincount(p, firsts[c], batch.num_rows)
            for short in np.flatnonzero(enough < wanted):
                order = shared.value.rest(points[short])
                some = order[:int(np.searchsorted(np.cumsum(firsts[order]), wanted)) + 1]
                c, p = np.concatenate([c[p != short], some]), np.concatenate([p[p != short], np.full(len(some), short)])
            at = np.lexsort((c, p))
            p, c = p[at], c[at]
            pairs = p * (int(shelf_of.max()) + 1) + shelf_of[c]
            key, start = np.unique(pairs, return_index=True)
            q, shelf = key // (int(shelf_of.max()) + 1), key % (int(shelf_of.max()) + 1)
            picked = batch.take(pa.array(q))
            yield pa.RecordBatch.from_arrays([picked.column("id"), picked.column("v"), pa.array(shelf.astype(np.int32)),
                                              pa.ListArray.from_arrays(pa.array(np.r_[start, len(c)].astype(np.int32)), pa.array(c.astype(np.int32)))], ["id", "v", "shelf", "lists"])

    kind = dict(placed.dtypes)
    asked = placed.where("asked").select("id", "v")
    visits = asked.mapInArrow(visit_lists, f"id {kind['id']}, v {kind['v']}, shelf int, lists array<int>")
    # Queries of a shelf are dealt out in blocks by the share of all queries, so that a block is of bounded size.
    blocks = int(-(-shapes.n // (every * BLOCK)))
    by_list = F.split(F.lit(",".join(map(str, shelf_of.tolist()))), ",").cast("array<int>")
    cut = F.split(F.lit(",".join(map(str, chunks))), ",").cast("array<int>")
    held = (placed.withColumn("shelf", F.explode(F.array_distinct(F.transform("lists", lambda x: F.get(by_list, x)))))
            .withColumn("chunk", F.pmod(F.xxhash64("id"), F.get(cut, F.col("shelf"))).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("shelf", "chunk", "block", "id", "v", "lists"))
    sought = (visits.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.get(cut, F.col("shelf")) - 1))))

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """The best of one block of queries in one chunk of a shelf, list by list."""
        empty = pa.table({"query": pa.array([], pa.int64()), "found": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        asks, has = left.column("lists").combine_chunks(), right.column("lists").combine_chunks()
        q, x = (matrix(t.column("v").combine_chunks(), dims).astype(np.float64) for t in (left, right))
        near_q, near_x = ((m / greatest).astype(np.float32) for m in (q, x))
        qid, xid = (t.column("id").to_numpy() for t in (left, right))

        def by_list(lists):
            rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            values = lists.flatten().to_numpy()
            order = np.argsort(values, kind="stable")
            return rows[order], values[order]

        ask_rows, ask_lists = by_list(asks)
        has_rows, has_lists = by_list(has)
        low, best = np.full(len(q), -np.inf, np.float32), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        hits = []

        def settle_hits():
            """Keep the ``top + 1`` best of every query, ties to the smaller id."""
            a, b, s = map(np.concatenate, zip(best, *hits))
            order = np.lexsort((xid[b], -s, a))
            a, b, s = a[order], b[order], s[order]
            fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            a, b, s = a[fresh], b[fresh], s[fresh]
            turn = np.arange(len(a)) - np.searchsorted(a, a)
            last = turn == top
            low[a[last]] = s[last] / greatest ** 2 - (1e-6 + 3e-7 * dims)
            return a[turn <= top], b[turn <= top], s[turn <= top]

        for one in np.unique(has_lists):
            theirs = has_rows[np.searchsorted(has_lists, one):np.searchsorted(has_lists, one, "right")]
            mine = ask_rows[np.searchsorted(ask_lists, one):np.searchsorted(ask_lists, one, "right")]
            for start in range(0, len(mine), 1024):
                some = mine[start:start + 1024]
                for first in range(0, len(theirs), 4096):
                    those = theirs[first:first + 4096]
                    # single precision with room for its error, then products in one fixed order, so that a pair has one
                    # score wherever it is met
                    a, b = np.nonzero(near_q[some] @ near_x[those].T >= low[some][:, None])
                    a, b = some[a], those[b]
                    for at in range(0, len(a), 1 << 15):
                        i, j = a[at:at + (1 << 15)], b[at:at + (1 << 15)]
                        hits.append((i, j, (q[i] * x[j]).sum(1)))
                    if sum(len(h[0]) for h in hits) > 4 * (top + 1) * len(q):
                        best, hits = settle_hits(), []
        if hits:
            best = settle_hits()
        a, b, s = best
        return pa.table({"query": pa.array(qid[a]), "found": pa.array(xid[b]), "score": pa.array(s)})

    place = ["shelf", "chunk", "block"]
    met = sought.groupBy(*place).cogroup(held.groupBy(*place)).applyInArrow(search, "query long, found long, score double")
    # A vector found in several shelves has one score, so dense ranks are the same however often it was found.
    best = met.withColumn("_rank", F.dense_rank().over(Window.partitionBy("query").orderBy(F.desc("score"), "found"))).where(F.col("_rank") <= top + 1)
    best = best.groupBy("query").agg(F.collect_set(F.struct("score", "found")).alias("best")).select("query", F.explode("best").alias("b")).select("query", "b.*")
    copies = placed.where("ids IS NOT NULL").select(F.col("id").alias("found"), "ids")
    answers = best.join(copies, "found", "left").withColumn("vec_id", F.explode(F.coalesce("ids", F.array("found"))))
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id")))
    ranked = answers.groupBy("query").agg(order.alias("answers"))
    # Copies of one query meet its answers in sixteen places.
    dealt = queries.withColumn("_salt", F.when(F.col("query_id") == F.col("copy"), 0).otherwise(F.pmod(F.xxhash64("query_id"), F.lit(16))).cast("int"))
    many = ranked.join(placed.where("ids IS NOT NULL").select(F.col("id").alias("query"), F.lit(True).alias("_many")), "query", "left")
    many = many.withColumn("_salt", F.explode(F.when(F.col("_many"), F.sequence(F.lit(0), F.lit(15))).otherwise(F.array(F.lit(0))))).select(F.col("query").alias("copy"), "_salt", "answers")
    kept = dealt.join(many, ["copy", "_salt"]).withColumn("answers", F.slice(F.filter("answers", lambda a: a["vec_id"] != F.col("query_id")), 1, top))
    return kept.select("query_id", F.posexplode("answers").alias("place", "a")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("a.vec_id").alias("vec_id"), (-F.col("a.less")).alias("score"))
