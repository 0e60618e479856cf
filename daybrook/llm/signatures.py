"""MinHash near-duplicates by an inverted join of signature coordinates.

Documents with the same set of shingles are one *node*. A node's signature has ``K`` coordinates, each the least of all
its shingles under another permutation; linked sets agree in each with probability NUM / DEN or more.

1. Every node is posted under each of its coordinate-value pairs. Posting lists are counted; a node of which fewer than
   ``MATCHES`` pairs occur elsewhere has no partner and leaves. Most nodes do.
2. The others are posted under their *prefix*, the K - MATCHES + 1 rarest of their pairs: two nodes that collide
   ``MATCHES`` times meet in one of these. Pairs that occur once are the rarest and need no posting at all.
3. In a posting list collisions are counted on whole signatures of small prints. Only connected groups are wanted, so a
   list is searched breadth first and a node that has been reached is skipped in all later counts: a list of n near copies
   costs about n counts of what is left, and yields n - 1 rows, never its pairs.
4. Candidate groups (at least ``MATCHES`` collisions along every step) are confirmed on full sets, again breadth first with
   exact intersections, and yield links that span each component.

Lists above ``LIST`` nodes and groups above ``groups.GROUP`` shingles are cut into cells; every two cells meet in a task of their own, so no
task's input grows with a list. The cells' spanning links are joined by the component step.

``MATCHES`` lies 6.7 standard deviations below what a pair at the threshold has (a pair is missed with a probability below
1e-9), prints and hashes can only add candidates.

Words: runs of anything but ASCII white space, A-Z lowered; sets: distinct 4-word shingles, or the whole sequence of fewer
words. Null and empty texts have an empty set, link with nothing and keep their own id. Rows with equal ids are judged by
their texts; equal texts share a component. Rows with a null id link with nothing and have null component and kept. Equal
sets are recognised by 128-bit hashes, equal shingles by 64-bit ones. Texts are read whole, extra columns are left behind.
Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from daybrook.llm.common import id_text, materialize, mix64, shards_for, texts_of
from daybrook.llm.components import components
from daybrook.llm.groups import cell_parts, changes, confirm, dealt, spanning

WORDS, NUM, DEN = 4, 80, 100
K, MATCHES = 64, 30
BLOCK = 500_000  # postings a task holds
LIST = 8_192  # nodes of a list or group compared in one task

_POWERS = mix64(np.arange(31, 31 + WORDS, dtype=np.uint64)) | np.uint64(1)
_FACTORS = mix64(np.arange(101, 101 + K, dtype=np.uint64)) | np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    total = h[:len(h) - size + 1] * _POWERS[0]
    for k in range(1, size):
        total = total + h[k:len(h) - size + 1 + k] * _POWERS[k]
    return np.unique(mix64(total + np.uint64(size)))


def node_of(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def signature(tokens: np.ndarray) -> np.ndarray:
    """``K`` 32-bit coordinates of a set that is not empty."""
    least = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(tokens), 2048):  # long texts in parts, within the cache
        np.minimum(least, (tokens[start:start + 2048] * _FACTORS[:, None]).min(axis=1), out=least)
    return (mix64(least) >> np.uint64(32)).astype(np.uint32)


def sign(slim: DataFrame) -> DataFrame:
    """doc_id, n, node, signature, prints: one pass over the texts; equal sets of a batch are signed once."""
    def run(batches):
        for batch in batches:
            sizes, nodes, signatures, prints, known = [], [], [], [], {}
            for text in texts_of(batch):
                tokens = shingles(text)
                node = node_of(tokens) if len(tokens) else None
                if node is not None and node not in known:
                    coordinates = signature(tokens)
                    known[node] = coordinates.tobytes(), coordinates.astype(np.uint8).tobytes()
                whole, short = known.get(node, (None, None))
                sizes.append(len(tokens))
                nodes.append(node)
                signatures.append(whole)
                prints.append(short)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *(pa.array(c, pa.binary()) for c in (nodes, signatures, prints))],
                names=["doc_id", "n", "node", "signature", "prints"])

    return slim.mapInArrow(run, "doc_id bigint, n bigint, node binary, signature binary, prints binary")


def _keys(signatures: np.ndarray) -> np.ndarray:
    """64-bit names of the coordinate-value pairs, one row of ``K`` per node."""
    return mix64(signatures.astype(np.uint64) | (np.arange(K, dtype=np.uint64) << np.uint64(32)))


def _matrix(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def postings(nodes: DataFrame, blocks: int) -> DataFrame:
    """Packed postings (key, node) by block of keys."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _keys(_matrix(batch.column("signature"), np.uint32)).reshape(-1)
            ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), K)
            block = (keys % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(block[order])) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(block[p[0]]) for p in parts], pa.int64()), pa.array([keys[p].tobytes() for p in parts], pa.binary()),
                 pa.array([ids[p].tobytes() for p in parts], pa.binary())], names=["block", "keys", "ids"])

    return nodes.select("id", "signature").mapInArrow(run, "block bigint, keys binary, ids binary")


def shared_pairs(packed: DataFrame) -> DataFrame:
    """(id, key, count) of every posting whose list has more than one node."""
    def run(key, table):
        keys, ids = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (("keys", np.uint64), ("ids", np.int64)))
        _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
        often = counts[back]
        keep = often > 1
        return pa.table({"id": ids[keep], "key": keys[keep].view(np.int64), "often": often[keep].astype(np.int64)})

    return packed.groupBy("block").applyInArrow(run, "id bigint, key bigint, often bigint")


def prefixes(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, id, prints): the postings of the prefixes of nodes that may have a partner."""
    ranked = shared.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("often", "key"))).alias("pairs")).where(
        F.size("pairs") >= MATCHES)  # at most K pairs a node
    # pairs that occur once stand first in the prefix and meet nobody
    head = F.slice("pairs", F.lit(1), F.size("pairs") - MATCHES + 1)
    met = ranked.select("id", head.alias("head")).join(nodes.select("id", "prints"), "id")
    return met.select("id", "prints", F.explode("head.key").alias("key"))


def collide(posted: DataFrame) -> DataFrame:
    """(a, b): spanning links of the nodes that collide often enough within a list."""
    rows = dealt(posted.join(cell_parts(posted, "key", F.lit(1), LIST), "key", "left"))
    shards = shards_for(rows.count(), BLOCK // 10)

    def run(key, table):
        table = table.sort_by([("key", "ascending"), ("c1", "ascending"), ("c2", "ascending"), ("id", "ascending")])
        ids = table.column("id").to_numpy()
        prints = _matrix(table.column("prints"), np.uint8) if len(ids) else np.empty((0, K), np.uint8)
        a, b = [], []
        starts = np.flatnonzero(changes(table, "key", "c1", "c2"))
        for start, stop in zip(starts, np.append(starts[1:], len(ids))):
            own = prints[start:stop]
            if len(own) < 2:
                continue
            for x, y in spanning(len(own), lambda x, rest: (own[rest] == own[x]).sum(axis=1) >= MATCHES):
                a.append(ids[start + x])
                b.append(ids[start + y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    grouped = rows.withColumn("shard", F.pmod(F.xxhash64("key", "c1", "c2"), F.lit(shards))).groupBy("shard")
    return grouped.applyInArrow(run, "a bigint, b bigint").distinct()


def assign(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    slim = id_text(docs, id_col, text_col)
    signed = materialize(sign(slim), "signed")
    rows = signed.select("doc_id", "n", "node")
    found = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("n", "signature", "prints")))
    nodes = materialize(found.withColumn("id", F.monotonically_increasing_id()), "nodes")  # numbered once, then read back
    n_nodes = nodes.count()
    packed = postings(nodes, shards_for(n_nodes * K, BLOCK))
    shared = materialize(shared_pairs(packed), "shared-pairs")
    posted = materialize(prefixes(shared, nodes), "prefixes")
    candidates = materialize(collide(posted), "candidates")
    groups = components(candidates).select(F.col("node").alias("id"), "root")
    links = materialize(confirm(groups.join(nodes.select("id", "node", "rep", "n"), "id"), slim, shingles, node_of, NUM, DEN), "links")
    roots = materialize(components(links).select(F.col("node").alias("id"), "root"), "roots")
    named = roots.join(nodes.select("id", "rep"), "id")
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    of_node = nodes.select("node", "rep", "id").join(roots, "id", "left").join(least, "root", "left").select(
        "node", F.coalesce("component", "rep").alias("component"))
    out = rows.join(of_node, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).cast("bigint")
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), (F.col("doc_id") == own).alias("kept"))
