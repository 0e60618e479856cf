"""Candidate groups: spanning links instead of all pairs, and exact confirmation on full sets.

A group's rows lie in one task, or, above a bound, in cells of which every two meet in a task of their own. There the rows are
searched breadth first: what has been reached is not compared again, so a group of n near copies costs about n comparisons
with what is left and yields n - 1 links. A comparison multiplies one set's row of the incidence matrix with all rows that
are left, which gives the overlap counts of the whole group at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybrook.llm.common import materialize, shards_for, texts_of

GROUP = 4_000_000  # shingles of a group that are compared in one task
BROADCAST_ROWS = 500_000  # rows of 50 bytes, counted first, up to which a side is broadcast


def cell_parts(rows: DataFrame, key: str, size, bound: int) -> DataFrame:
    """(key, parts) of the keys whose rows weigh more than ``bound`` together: two of so many cells fit into one task."""
    heavy = rows.groupBy(key).agg(F.sum(size).alias("weight")).where(F.col("weight") > bound)
    return materialize(heavy.select(key, F.ceil(2 * F.col("weight") / bound).cast("int").alias("parts")), "heavy")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows with the cell pairs (c1, c2) in which they meet the others of their key; ``parts`` is null where all fit together.

    A row goes to every pair with its own cell, so any two rows of a key meet in the pair of their cells.
    """
    cell = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    pair = lambda c: F.struct(F.least(cell, c).alias("c1"), F.greatest(cell, c).alias("c2"))
    alone = F.array(F.struct(F.lit(0).alias("c1"), F.lit(0).alias("c2")))
    pairs = F.when(F.col("parts").isNull(), alone).otherwise(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), pair))
    return rows.withColumn("pair", F.explode(pairs)).select(*(c for c in rows.columns if c != "parts"), "pair.c1", "pair.c2")


def changes(table: pa.Table, *names) -> np.ndarray:
    """Where a sorted table's row differs from the row before it in one of these columns."""
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for values in (table.column(c).to_numpy() for c in names):
        change[1:] |= values[1:] != values[:-1]
    return change


def spanning(count: int, reached) -> list[tuple[int, int]]:
    """Edges of a spanning forest; ``reached(x, rest)`` is the mask of the still unreached ``rest`` that x touches."""
    rest, edges = np.arange(count), []
    while len(rest):
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            x = waiting.pop()
            mask = reached(x, rest)
            if mask.any():
                found, rest = rest[mask], rest[~mask]
                edges += [(x, y) for y in found]
                waiting += list(found)
    return edges


def confirm(groups: DataFrame, slim: DataFrame, shingles, node_of, num: int, den: int, bound=None) -> DataFrame:
    """(a, b): spanning links of each candidate group, judged on full sets.

    ``groups``: id, node, rep, n, root, one row a set; ``shingles`` and ``node_of`` make a text's sorted hashes and name them.
    """
    bound = bound or GROUP
    wanted = materialize(groups.join(cell_parts(groups, "root", F.col("n"), bound), "root", "left"), "groups")
    count, weight = wanted.select(F.count("*"), F.coalesce(F.sum(F.col("n") * F.coalesce("parts", F.lit(1))), F.lit(0))).first()
    side = F.broadcast(wanted) if count <= BROADCAST_ROWS else wanted
    texts = slim.join(side, slim["doc_id"] == side["rep"]).select("id", "node", "root", "parts", "text")

    def sets(batches):
        seen = set()
        for batch in batches:
            keep, packed = [], []
            for k, (own, node, text) in enumerate(zip(batch.column("id").to_pylist(), batch.column("node").to_pylist(), texts_of(batch))):
                if own in seen:
                    continue
                tokens = shingles(text)
                if len(tokens) and node_of(tokens) == node:  # rows with equal ids may hold other texts
                    seen.add(own)
                    keep.append(k)
                    packed.append(tokens.tobytes())
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "root", "parts")), pa.array(packed, pa.binary())],
                                             names=["id", "root", "parts", "tokens"])

    rows = dealt(texts.mapInArrow(sets, "id bigint, root bigint, parts int, tokens binary"))
    shards = shards_for(weight, bound // 8 + 1)

    def run(key, table):
        table = table.sort_by([("root", "ascending"), ("c1", "ascending"), ("c2", "ascending"), ("id", "ascending")])
        fresh = np.flatnonzero(changes(table, "root", "c1", "c2", "id"))  # a repeated row comes from several tasks
        table = table.take(pa.array(fresh)) if len(fresh) < table.num_rows else table
        ids = table.column("id").to_numpy()
        starts = np.flatnonzero(changes(table, "root", "c1", "c2"))
        a, b = [], []
        for start, stop in zip(starts, np.append(starts[1:], len(ids))):
            if stop - start < 2:
                continue
            packed = table.column("tokens").slice(start, stop - start).to_pylist()
            size = np.fromiter(map(len, packed), np.int64, len(packed)) // 8
            _, flat = np.unique(np.frombuffer(b"".join(packed), np.uint64), return_inverse=True)
            ends = np.cumsum(size)
            mark = np.zeros(flat.max() + 1, bool)
            for x, y in spanning(stop - start, _linked(flat, ends - size, size, mark, num, den)):
                a.append(ids[start + x])
                b.append(ids[start + y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    grouped = rows.withColumn("shard", F.pmod(F.xxhash64("root", "c1", "c2"), F.lit(shards))).groupBy("shard")
    return grouped.applyInArrow(run, "a bigint, b bigint").distinct()


def _linked(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, mark: np.ndarray, num: int, den: int):
    """``reached`` for sets laid end to end in ``flat``: exact intersections of one set with all that are left."""
    state = {"rest": None}

    def reached(x, rest):
        if state["rest"] is None or 2 * len(rest) < len(state["rest"]):  # the sets that are left, side by side
            order = np.concatenate([flat[begin[y]:begin[y] + size[y]] for y in rest])
            state.update(rest=rest, flat=order, begin=np.append(0, np.cumsum(size[rest])[:-1]))
        own = flat[begin[x]:begin[x] + size[x]]
        mark[own] = True
        common = np.add.reduceat(mark[state["flat"]], state["begin"], dtype=np.int64)
        mark[own] = False
        held, have = state["rest"], size[state["rest"]]
        return (den * common >= num * (have + size[x] - common))[np.searchsorted(held, rest)]

    return reached
