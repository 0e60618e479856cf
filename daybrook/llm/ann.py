"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample (``FIT_SAMPLE`` distinct vectors, chosen by hash) and sent to the tasks; every
distinct vector is assigned to a leaf. A query walks the tree with a priority queue of nodes, nearest centroid first, and
visits leaves in the order they leave the queue. How many leaves all queries visit is calibrated: ``CALIBRATION_SAMPLE``
queries are answered by brute force over all vectors, and the visits widen until the share of true neighbours that lie in
visited leaves reaches ``RECALL``; with enough visits that is every leaf, so the target can always be met.

Copies of one vector are searched once: each distinct vector keeps its k+1 smallest ids, all that any answer can use (its
own id may fall away). Leaves are divided into cells of about ``CELL_ROWS`` vectors, so no leaf is one task.

Scores are computed in double precision on the original vectors, by the same summation for every pair, so equal vectors
tie exactly; ties go to the smaller id. Vectors that are null, zero or hold null or non-finite components take no part,
nor do rows with a null id or of another dimension than most. Rows that repeat id and vector are one row; an id with
several vectors is searched with each, answers with its nearest, and excludes all of them from its own answer. Extra columns are left behind. Empty tables give empty results.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daybrook.llm.common import materialize

K = 5
FIT_SAMPLE, CALIBRATION_SAMPLE = 20_000, 100
BRANCHES, LEAF_SAMPLE = 8, 100   # children of a node; sampled vectors below which a node is a leaf
RECALL = 0.98
CELL_ROWS = 20_000


def usable(table: DataFrame, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(vec_id, embedding): rows that take part."""
    slim = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = slim.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & F.exists("embedding", lambda x: x != 0))
    common = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return good.where(F.size("embedding") == (common[0]["d"] if common else 0))


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def cosine(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row, each row summed alike."""
    return (q * c).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)))


class Tree:
    """Nodes in breadth order: centroid, children (none for leaves), leaf number."""

    def __init__(self, sample: np.ndarray, seed=7):
        rng = np.random.default_rng(seed)
        self.centroids, self.children, self.leaf = [sample.mean(axis=0)], [[]], [-1]
        queue, leaves = [(0, sample)], 0
        while queue:
            node, rows = queue.pop(0)
            parts = self._split(rows, rng) if len(rows) > LEAF_SAMPLE else []
            if len(parts) < 2:
                self.leaf[node] = leaves
                leaves += 1
                continue
            for part in parts:
                self.children[node].append(len(self.leaf))
                self.centroids.append(part.mean(axis=0))
                self.children.append([])
                self.leaf.append(-1)
                queue.append((len(self.leaf) - 1, part))
        self.n_leaves = leaves
        self.centroids = np.array(self.centroids)

    @staticmethod
    def _split(rows, rng):
        centres = rows[rng.choice(len(rows), min(BRANCHES, len(rows)), replace=False)]
        for _ in range(8):
            owner = ((centres ** 2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)
            centres = np.array([rows[owner == k].mean(axis=0) if (owner == k).any() else centres[k] for k in range(len(centres))])
        return [rows[owner == k] for k in range(len(centres)) if (owner == k).any()]

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest child at every level."""
        out = np.empty(len(rows), np.int32)
        stack = [(0, np.arange(len(rows)))]
        while stack:
            node, at = stack.pop()
            kids = self.children[node]
            if not kids:
                out[at] = self.leaf[node]
                continue
            c = self.centroids[kids]
            nearest = ((c ** 2).sum(axis=1) - 2 * rows[at] @ c.T).argmin(axis=1)
            stack += [(kid, at[nearest == k]) for k, kid in enumerate(kids) if (nearest == k).any()]
        return out

    def visits(self, query: np.ndarray, most: int, held: dict[int, int] | None = None, least=0) -> list[int]:
        """The first ``most`` leaves, best bin first; more where those hold fewer than ``least`` vectors (``held``: by leaf)."""
        order, seen, queue = [], 0, [(0.0, 0)]
        while queue and (len(order) < most or seen < least):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                order.append(self.leaf[node])
                seen += (held or {}).get(self.leaf[node], 0)
                continue
            distance = ((self.centroids[kids] - query) ** 2).sum(axis=1)
            for d, kid in zip(distance.tolist(), kids):
                heapq.heappush(queue, (d, kid))
        return order


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(embedding, ids): each distinct vector with its k+1 smallest ids; cut to that many before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def fit(vectors: DataFrame, sample_rows=FIT_SAMPLE) -> Tree | None:
    sample = vectors.select("embedding", F.xxhash64("embedding").alias("h")).orderBy("h").limit(sample_rows).select("embedding").toArrow()
    return Tree(unit(matrix(sample.column(0)))) if sample.num_rows else None


def top(scores: np.ndarray, first_ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n best by score, ties (within rounding) kept whole for the exact step."""
    if len(scores) <= n:
        return np.arange(len(scores))
    border = np.partition(scores, -n)[-n] - 1e-9
    return np.flatnonzero(scores >= border)


def best_pairs(qid, q, cand, first_ids, n):
    """For each query the n best candidates: (qid, candidate position, exact score)."""
    cu, out = unit(cand), []
    for start in range(0, len(q), 256):
        block = q[start:start + 256]
        rough = unit(block) @ cu.T
        for i in range(len(block)):
            at = top(rough[i], first_ids, n)
            exact = cosine(np.broadcast_to(block[i], (len(at), block.shape[1])), cand[at])
            pick = np.lexsort((first_ids[at], -exact))[:n]
            out.append((np.full(len(pick), qid[start + i]), at[pick], exact[pick]))
    return [np.concatenate(x) if out else np.empty(0) for x in (zip(*out) if out else ((), (), ()))]


def calibrate(tree: Tree, stored: DataFrame, queries: DataFrame, k: int, recall=RECALL) -> int:
    """Leaf visits per query that reach the recall on the sampled queries, measured against brute force over all vectors."""
    sample = (queries.select("qid", "embedding", F.xxhash64("embedding").alias("h")).orderBy("h").limit(CALIBRATION_SAMPLE)
              .select("qid", "embedding").toArrow())
    if not sample.num_rows:
        return 1
    qid, q = sample.column(0).to_numpy(), matrix(sample.column(1))

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                cand = matrix(batch.column(0))
                first = batch.column(2).to_numpy()
                ids, at, scores = best_pairs(qid, q, cand, first, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(scores), pa.array(first[at]), batch.column(1).take(pa.array(at))],
                                                 names=["qid", "score", "first", "leaf"])

    rows = stored.select("embedding", "leaf", F.element_at("ids", 1).alias("first")).mapInArrow(
        scan, "qid bigint, score double, first bigint, leaf int")
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "first")
    truth = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).collect()
    places = {int(i): {leaf: p for p, leaf in enumerate(tree.visits(x, tree.n_leaves))} for i, x in zip(qid, unit(q))}
    needed = sorted(places[r["qid"]][r["leaf"]] + 1 for r in truth)
    return needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]


def search(table: DataFrame, is_query, k=K, recall=RECALL, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``is_query`` (a condition on vec_id) holds."""
    rows = materialize(usable(table, id_col, vector_col), "vectors")
    spark = rows.sparkSession
    vectors = distinct_vectors(rows, k)
    tree = fit(vectors)
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if tree is None:
        return spark.createDataFrame([], result)

    def place(batches):
        for batch in batches:
            leaf = tree.assign(unit(matrix(batch.column(0)))) if batch.num_rows else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["embedding", "ids", "leaf"])

    stored = materialize(vectors.mapInArrow(place, "embedding array<float>, ids array<bigint>, leaf int"), "leaves")
    asked = rows.where(is_query).distinct()
    queries = materialize(asked.groupBy("embedding").agg(F.min("vec_id").alias("qid")), "queries")
    visits = calibrate(tree, stored, queries, k, recall)

    held = {r["leaf"]: r["count"] for r in stored.groupBy("leaf").count().collect()}  # one row per leaf
    cells = {leaf: -(-n // CELL_ROWS) for leaf, n in held.items()}

    def walk(batches):
        for batch in batches:
            pairs = [(i, leaf, cell) for i, q in enumerate(unit(matrix(batch.column(0))) if batch.num_rows else ())
                     for leaf in tree.visits(q, visits, held, 2 * k + 2) for cell in range(cells.get(leaf, 0))]
            at, leaf, cell = (np.array(x, np.int32) for x in (zip(*pairs) if pairs else ((), (), ())))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(cell), batch.column(1).take(pa.array(at)),
                                              batch.column(0).take(pa.array(at))], names=["leaf", "cell", "qid", "query"])

    routed = queries.select("embedding", "qid").mapInArrow(walk, "leaf int, cell int, qid bigint, query array<float>")
    n_cells = F.element_at(F.create_map(*(F.lit(x) for pair in cells.items() for x in pair)), F.col("leaf"))
    cut = stored.withColumn("cell", F.pmod(F.xxhash64("embedding"), n_cells).cast("int"))

    def compare(key, asked_here, held):
        empty = {"qid": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))}
        if not (asked_here.num_rows and held.num_rows):
            return pa.table(empty)
        ids = held.column("ids").combine_chunks()
        first = np.array([x[0] for x in ids.to_pylist()])
        qid, at, scores = best_pairs(asked_here.column("qid").to_numpy(), matrix(asked_here.column("query")),
                                     matrix(held.column("embedding")), first, k + 1)
        return pa.table({"qid": pa.array(qid, pa.int64()), "score": pa.array(scores, pa.float64()), "ids": ids.take(pa.array(at))})

    found = (routed.groupBy("leaf", "cell").cogroup(cut.groupBy("leaf", "cell"))
             .applyInArrow(compare, "qid bigint, score double, ids array<bigint>"))
    per_vector = (found.select("qid", "score", F.explode("ids").alias("vec_id"))
                  .groupBy("qid", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    best = per_vector.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).drop("rank")
    answers = best.groupBy("qid").agg(F.collect_list(F.struct("score", "vec_id")).alias("answers"))
    each = asked.join(queries, "embedding").select("qid", F.col("vec_id").alias("query_id")).join(answers, "qid")
    flat = each.select("query_id", F.explode("answers").alias("a")).select("query_id", "a.score", "a.vec_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best_of = flat.where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (best_of.withColumn("rank", F.row_number().over(last))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def digest(table: DataFrame) -> DataFrame:
    """Queries: ids divisible by 50."""
    return search(table, F.col("vec_id") % 50 == 0)
