"""Approximate nearest neighbours by balanced posting lists.

1. Vectors that take no part (null, zero, null or non-finite components) go.
   Equal vectors form a class; a class keeps its ``keep + 1`` smallest ids,
   which is all that any answer can hold.  The rest of a hot vector's rows is
   dropped by a per-task limit before the shuffle.
2. Centroids are fitted on at most ``SAMPLE`` classes (the smallest hashes of
   their ids): k-means on unit vectors, with a penalty on list sizes.
   There are about ``sqrt(classes)`` of them at every size, at most
   ``MAX_LISTS``, so sample and centroids have a fixed bound and are what the
   driver holds.
3. A graph over the centroids (each with its nearest ones) is searched best
   first, in memory, by the tasks that place vectors and queries.
4. A vector goes to its nearest list and, near a boundary, to up to
   ``COPIES - 1`` others within ``BOUNDARY`` times that distance, unless an
   already chosen centroid is closer to the new one than the vector is.
5. Vectors of each length are indexed and searched on their own (one index per
   length that occurs).  A query takes the lists within ``PRUNE`` times its nearest centroid's
   distance, at least ``LEAST`` and at most ``PROBES``, and further ones only
   until their rows are sure to hold ``keep`` candidates besides itself.  Lists
   are cut into blocks of about ``BLOCK`` vectors, and the queries that read a
   list into groups of about ``GROUP``, so no task gets a whole hot list; a block
   is copied once per group of its own list's queries.
6. Each (block, query group) task scores its pairs in double precision and
   keeps the best per query; the few best per task meet in one aggregate.

Every vector is indexed.  Scores are exact; only which candidates are seen is
approximate.  Defined cases: ties go to the smaller id, fewer candidates give
shorter answers, only vectors of the query's length are its candidates, rows
repeated with one id count once, a query without a valid vector has
no rows, and an empty table gives none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import pinned, ship

SAMPLE, MAX_LISTS, ROUNDS = 20_000, 4096, 12
DEGREE, BEAM = 24, 160
COPIES, BOUNDARY = 4, 1.15
PROBES, PRUNE, LEAST = 128, 1.9, 8
BLOCK, GROUP = 4096, 2048


class Centroids:
    """Unit centroids and the graph that finds the nearest of them."""

    def __init__(self, centers: np.ndarray):
        self.centers = centers
        sims = centers @ centers.T
        k = min(DEGREE + 1, len(centers))
        self.near = np.argsort(-sims, axis=1, kind="stable")[:, 1:k]
        # entries spread over the graph, so that every part can be reached
        self.entries = np.unique(np.linspace(0, len(centers) - 1, min(16, len(centers))).astype(int))

    def search(self, v: np.ndarray, beam: int) -> list[tuple[float, int]]:
        """(distance, centroid) of the nearest ones, nearest first: best-first
        search that stops when the next place is worse than the whole beam."""
        seen = set(self.entries.tolist())
        d = 1.0 - self.centers[self.entries] @ v
        open_ = [(x, int(c)) for x, c in zip(d, self.entries, strict=True)]
        heapq.heapify(open_)
        best = [(-x, c) for x, c in open_]
        heapq.heapify(best)
        while len(best) > beam:
            heapq.heappop(best)
        while open_:
            x, c = heapq.heappop(open_)
            if len(best) >= beam and x > -best[0][0]:
                break
            new = [n for n in self.near[c].tolist() if n not in seen]
            seen.update(new)
            if not new:
                continue
            for y, n in zip((1.0 - self.centers[new] @ v).tolist(), new, strict=True):
                if len(best) < beam:
                    heapq.heappush(best, (-y, n))
                elif y < -best[0][0]:
                    heapq.heapreplace(best, (-y, n))
                else:
                    continue
                heapq.heappush(open_, (y, n))
        return sorted((-x, c) for x, c in best)

    def lists_of(self, v: np.ndarray) -> list[int]:
        """The lists that hold ``v``."""
        found = self.search(v, 4 * COPIES)
        first = max(found[0][0], 1e-12)
        out: list[int] = []
        for d, c in found:
            if len(out) == COPIES or d > BOUNDARY * first:
                break
            if all(1.0 - self.centers[c] @ self.centers[o] > d for o in out) or not out:
                out.append(c)
        return out

    def probes_of(self, v: np.ndarray, rows: np.ndarray, enough: int) -> list[int]:
        """The lists that a query for ``v`` reads: beyond the pruned ones, as
        many as it takes for ``enough`` of the lists' ``rows``."""
        found = self.search(v, min(BEAM, max(PROBES, 1)))[:PROBES]
        out = [c for k, (d, c) in enumerate(found) if k < LEAST or d <= PRUNE * max(found[0][0], 1e-12)]
        seen = rows[out].sum()
        if seen < enough:
            taken = set(out)
            for c in np.argsort(-(self.centers @ v), kind="stable").tolist():
                if seen >= enough:
                    break
                if c not in taken and rows[c]:
                    out.append(c)
                    seen += rows[c]
        return out


def fit(sample: np.ndarray, lists: int) -> Centroids:
    """Balanced k-means on unit vectors; the penalty on a list grows with its
    share of the sample, so no list attracts far more than the mean."""
    rng = np.random.default_rng(7)
    lists = max(1, min(lists, len(sample)))
    centers = sample[rng.choice(len(sample), lists, replace=False)].copy()
    load = np.zeros(lists)
    for _ in range(ROUNDS):
        mine = np.concatenate([np.argmax(part @ centers.T - 0.02 * load, axis=1)
                               for part in np.array_split(sample, max(1, len(sample) // 4096))])
        count = np.bincount(mine, minlength=lists)
        load = count / max(1.0, len(sample) / lists)
        sums = np.zeros_like(centers)
        np.add.at(sums, mine, sample)
        norm = np.linalg.norm(sums, axis=1)
        empty = norm < 1e-12
        centers[~empty] = sums[~empty] / norm[~empty, None]
        centers[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
    return Centroids(centers)


def valid(v: Column) -> Column:
    """Has components, all finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0.0), F.lit(False))


def _unit(vectors) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    big = np.abs(x).max(axis=1, keepdims=True)  # so that no square leaves the range
    x = x / big
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): the valid vectors in double precision, one per id (of rows
    that repeat an id, the smallest vector)."""
    v = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # one zero of two
    return (rows.select(F.col(id_col).cast("long").alias("id"), v.alias("vec"))
            .filter(valid(F.col("vec")) & F.col("id").isNotNull())
            .groupBy("id").agg(F.min("vec").alias("vec")))


def classes(rows: DataFrame, id_col: str, vec_col: str, keep: int) -> DataFrame:
    """(vec, ids): each distinct valid vector with its ``keep + 1`` smallest ids."""
    ok = vectors(rows, id_col, vec_col)
    w = Window.partitionBy("vec").orderBy("id")
    few = ok.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= keep + 1)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def search(rows: DataFrame, is_query: Column, id_col: str = "vec_id",
           vec_col: str = "embedding", keep: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``keep`` nearest found by cosine of
    every row that ``is_query`` selects."""
    spark = rows.sparkSession
    ship(spark)
    kept = pinned(classes(rows, id_col, vec_col, keep))
    asked = vectors(rows.filter(is_query), id_col, vec_col)
    # one row per length
    sizes = kept.groupBy(F.size("vec").alias("d")).count().orderBy("d").collect()
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for r in sizes:
        of_length = F.size("vec") == r["d"]
        out = out.unionByName(_search(kept.filter(of_length), r["count"], asked.filter(of_length), keep))
    return out


def _search(kept: DataFrame, n: int, asked: DataFrame, keep: int) -> DataFrame:
    """The answers to ``asked`` among the ``n`` classes, all of one length."""
    spark = kept.sparkSession
    lists = int(min(MAX_LISTS, round(n ** 0.5)))
    sample = kept.orderBy(F.xxhash64(F.element_at("ids", 1)), F.element_at("ids", 1)).limit(SAMPLE)
    index = spark.sparkContext.broadcast(fit(_unit(sample.select("vec").toPandas()["vec"]), lists))

    def place(batches):
        for b in batches:
            u = _unit(b["vec"]) if len(b) else []
            yield b.assign(list=[index.value.lists_of(x) for x in u])

    def probe(batches):
        for b in batches:
            u = _unit(b["vec"]) if len(b) else []
            yield b.assign(list=[index.value.probes_of(x, held, COPIES * (keep + 1)) for x in u])

    shape = "vec array<double>, ids array<long>, list array<int>"
    postings = pinned(kept.mapInPandas(place, shape).withColumn("list", F.explode("list")))
    # at most MAX_LISTS rows
    sizes = pinned(postings.groupBy("list").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"),
        F.sum(F.size("ids")).alias("rows")))
    held = np.zeros(lists, dtype=np.int64)  # ids of each list; an id is in at most COPIES
    for r in sizes.select("list", "rows").collect():
        held[r["list"]] = r["rows"]

    # the classes of the queries: one search serves all queries of a class
    distinct = pinned(asked.groupBy("vec").agg(F.min("id").alias("q")))
    probes = pinned(distinct.mapInPandas(probe, "vec array<double>, q long, list array<int>")
                    .withColumn("list", F.explode("list")))
    # a list's blocks go to the groups of the queries that read it, and to no others
    readers = probes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).cast("int").alias("groups"))
    sizes = F.broadcast(sizes.select("list", "blocks").join(readers, "list"))
    wanted = (probes.join(sizes, "list")
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("group", F.pmod(F.xxhash64("q"), "groups").cast("int")))
    blocks = postings.join(sizes, "list").select(
        "list", F.pmod(F.xxhash64("ids"), "blocks").cast("int").alias("block"), "vec", "ids",
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))

    def score(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(block):
            x = np.stack(block["vec"].to_numpy())
            ids = block["ids"].to_numpy()
            first = np.array([i[0] for i in ids])
            scale = np.sqrt((x * x).sum(axis=1))
            for q, v in zip(queries["q"], queries["vec"], strict=True):
                s = (x * v).sum(axis=1) / (np.sqrt((v * v).sum()) * scale)
                top = np.lexsort((first, -s))[:keep + 1]
                out += [(q, float(s[k]), int(i)) for k in top for i in ids[k]]
        return pd.DataFrame(out, columns=["q", "score", "id"])

    hits = (wanted.groupBy("list", "block", "group").cogroup(blocks.groupBy("list", "block", "group"))
            .applyInPandas(score, "q long, score double, id long")
            .distinct())
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    top = hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= keep + 1)
    answers = (asked.join(distinct.select("vec", "q"), "vec")
               .select(F.col("id").alias("query_id"), "q")
               .join(top.select("q", "score", F.col("id").alias("vec_id")), "q")
               .filter("query_id != vec_id"))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= keep)
            .select("query_id", "rank", "vec_id", "score"))
