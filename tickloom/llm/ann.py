"""Approximate nearest neighbours by inner product over a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is indexed. Equal vectors
are one entry that lists its smallest ids, as many as a result can need, which
is exact. A query walks the tree best bin first: a priority queue holds inner
nodes and leaves by the inner product of query and centroid, so leaves come out
most promising first. How many leaves a query visits is calibrated: sample
queries are answered exhaustively within the sample, and the number is widened
until the wanted recall is reached there. Neighbours lie closer in the full data
than in a sample of it, so the calibrated number errs to the safe side.

Visits and vectors meet by leaf. A leaf with many vectors is split into parts,
and visits into blocks, so no task holds a whole hot leaf.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component take no part, nor do rows without an id or of a dimension
other than the most common one; repeated ids count once, with their smallest
vector; ties go to the smaller id; with fewer candidates than ``k`` all come
back; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.scratch import cut

K = 20
#: Vectors the tree is fitted and calibrated on, at most about.
SAMPLE = 20_000
#: Sample queries of the calibration, and the recall it asks for.
PROBES, RECALL = 400, 0.97
FANOUT = 8
#: Sample vectors in a leaf, at most about.
LEAF = 64
#: Vectors in a part of a leaf, and queries in a block of visits.
PART, VISITS = 4096, 1024
_ROUNDS = 8


class Tree:
    """Centroids of all nodes, the children of inner nodes, and leaf numbers."""

    def __init__(self, sample: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.centroids, self.children, self.leaf = [sample.mean(0)], [[]], [-1]
        self.members: list[np.ndarray] = []
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            parts = self._split(sample[rows], rng) if len(rows) > LEAF else None
            if parts is None:
                self.leaf[node] = len(self.members)
                self.members.append(rows)
                continue
            for label in np.unique(parts):
                child = rows[parts == label]
                self.children[node].append(len(self.centroids))
                todo.append((len(self.centroids), child))
                self.centroids.append(sample[child].mean(0))
                self.children.append([])
                self.leaf.append(-1)
        self.centroids = np.array(self.centroids)
        self.leaves = len(self.members)

    @staticmethod
    def _split(x: np.ndarray, rng: np.random.Generator) -> np.ndarray | None:
        c = x[rng.choice(len(x), FANOUT, replace=False)]
        for _ in range(_ROUNDS):
            label = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
            c = np.array([x[label == k].mean(0) if (label == k).any() else c[k] for k in range(len(c))])
        return label if len(np.unique(label)) > 1 else None

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at every level."""
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
            elif len(rows):
                c = self.centroids[kids]
                near = ((c * c).sum(1) - 2 * x[rows] @ c.T).argmin(1)
                todo += [(kid, rows[near == k]) for k, kid in enumerate(kids)]
        return out

    def visit(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in best-bin-first order."""
        score = self.centroids @ q
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            for kid in self.children[node]:
                heapq.heappush(queue, (-score[kid], kid))
        return out

    def calibrate(self, sample: np.ndarray, seed: int = 1) -> int:
        """Visits that reach RECALL over the sample's own queries, widened one leaf at a time."""
        probes = np.random.default_rng(seed).permutation(len(sample))[:PROBES]
        home = np.empty(len(sample), dtype=np.int64)
        for leaf, rows in enumerate(self.members):
            home[rows] = leaf
        k = min(K, len(sample) - 1)
        if k < 1:
            return self.leaves
        found = np.zeros(self.leaves + 1)
        for p in probes:
            score = sample @ sample[p]
            score[p] = -np.inf
            top = np.argpartition(-score, k - 1)[:k]
            place = np.empty(self.leaves, dtype=np.int64)
            place[self.visit(sample[p], self.leaves)] = np.arange(1, self.leaves + 1)
            found += np.bincount(place[home[top]], minlength=self.leaves + 1)
        recall = np.cumsum(found) / (k * len(probes))
        return int(np.argmax(recall >= RECALL))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64) if len(vectors) else np.zeros((0, 1))


def _best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of each query's best ``k``. Scores are summed component by component, in order."""
    rough = q @ x.T
    take = min(len(x), k + 8)
    top = np.argpartition(-rough, take - 1, axis=1)[:, :take] if take < len(x) else np.tile(np.arange(len(x)), (len(q), 1))
    score = np.zeros(top.shape)
    for d in range(q.shape[1]):
        score += q[:, d, None] * x[top, d]
    order = np.lexsort((ids[top], -score), axis=1)[:, :k]
    rows = np.repeat(np.arange(len(q)), order.shape[1])
    return rows, ids[np.take_along_axis(top, order, 1)].ravel(), np.take_along_axis(score, order, 1).ravel()


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` best of ``vectors`` for each row of ``queries`` but the row of its own id: query_id, rank, vec_id, score."""
    data = cut(_valid(vectors, id_col, vector_col), "vectors")
    common = data.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim, total = common or (0, 0)
    data = data.filter(F.size("v") == dim)
    if not total:
        return data.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    per_vector = Window.partitionBy("mark", "v").orderBy("vec_id")
    few = data.withColumn("mark", F.xxhash64("v")).withColumn("_rn", F.row_number().over(per_vector)).filter(F.col("_rn") <= k + 1)
    entries = few.groupBy("mark", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("entry", F.element_at("ids", 1))
    spot = F.pmod(F.xxhash64(F.lit("sample"), "entry"), F.lit(1 << 30)) / float(1 << 30)
    rows = entries.filter(spot < min(1.0, sample / total)).select("entry", "v").toPandas().sort_values("entry")
    fitted = _matrix(rows["v"]) if len(rows) else _matrix(data.orderBy("vec_id").limit(1).toPandas()["v"])
    tree = Tree(fitted)
    visits = tree.calibrate(fitted)
    shared = data.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(leaf=shared.value.assign(_matrix(pdf["v"])))

    schema = "mark bigint, v array<double>, ids array<bigint>, entry bigint"
    index = cut(entries.mapInPandas(place, schema + ", leaf bigint"), "index")
    sizes = index.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            leaves = [shared.value.visit(q, visits) for q in _matrix(pdf["v"])]
            yield pdf[["entry", "v"]].assign(leaves=leaves)

    asked = _valid(queries, id_col, vector_col).filter(F.size("v") == dim).withColumn("mark", F.xxhash64("v"))
    of_query = cut(asked.join(entries.select("mark", "v", "entry"), ["mark", "v"]).select(F.col("vec_id").alias("query_id"), "entry", "v"), "queries")
    walked = of_query.select("entry", "v").groupBy("entry").agg(F.first("v").alias("v")).mapInPandas(walk, "entry bigint, v array<double>, leaves array<bigint>")
    visited = cut(walked.select("entry", "v", F.explode("leaves").alias("leaf")), "visits")
    loads = visited.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / VISITS).alias("blocks")).join(sizes, "leaf")
    part_of, block_of = F.pmod(F.xxhash64("entry"), F.col("parts")), F.pmod(F.xxhash64("entry"), F.col("blocks"))
    all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = visited.join(loads, "leaf").select("leaf", all_of("parts").alias("part"), block_of.alias("block"), "entry", "v")
    right = index.join(loads, "leaf").select("leaf", part_of.alias("part"), all_of("blocks").alias("block"), "entry", "v")

    def search(key: tuple, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query": [], "entry": [], "score": []})
        rows, ids, score = _best(_matrix(q["v"]), _matrix(x["v"]), x["entry"].to_numpy(), k + 1)
        return pd.DataFrame({"query": q["entry"].to_numpy()[rows], "entry": ids, "score": score})

    keys = ["leaf", "part", "block"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query bigint, entry bigint, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    top = hits.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k + 1).select("query", "entry", "score")
    named = top.join(index.select("entry", "ids"), "entry").select("query", F.explode("ids").alias("vec_id"), "score")
    ids = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = named.withColumn("_rn", F.row_number().over(ids)).filter(F.col("_rn") <= k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("found"))
    mine = of_query.select("query_id", F.col("entry").alias("query")).join(lists, "query")
    others = mine.select("query_id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    return others.select("query_id", F.posexplode("found").alias("rank", "f")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.s")).alias("score"))


def _valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, in double precision."""
    v = F.col(vector_col).cast("array<double>")
    base = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = base.filter(finite & F.exists("v", lambda x: x != 0))
    return base.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).groupBy("vec_id").agg(F.min("v").alias("v"))
