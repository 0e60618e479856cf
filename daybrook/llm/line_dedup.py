"""Line dedup by probing sharded minimal perfect hashes.

1. Every line's key (ASCII white space stripped at both ends, A-Z lowered) of ``MIN_CHARS`` code points or more gets a
   128-bit hash. Counts of documents and the largest id per hash come from a map-side combining aggregate.
2. The distinct hashes are split into shards by their first word, about ``KEYS_PER_SHARD`` each, so the number of shards
   follows the data. Each shard becomes one row: displacement table of a minimal perfect hash, and arrays of
   fingerprints, document counts and largest ids in slot order.
3. The lines' hashes, once per document, are sent to their shard and probe the arrays; a shard with many probes is
   divided into cells that each hold a copy of its arrays, so a line found in a third of all documents is no hot task.
   Only hits (count reached, another document is the largest) return, packed per document, and meet the documents.

Every probed hash is a key of its shard, so a slot is never wrong; the fingerprint is checked all the same.

Null and empty texts are one empty line. Rows with equal ids count as one document and lose the same lines; rows with a
null id neither count nor lose lines. Keys repeated inside a document count once. Ties do not occur: the largest id of a
key is unique. Extra columns, whatever their names, do not matter. Empty tables give empty results.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from daybrook.llm import mph
from daybrook.llm.common import id_text, materialize, shards_for, texts_of, unused

MIN_CHARS, MIN_DOCS = 40, 5
KEYS_PER_SHARD = 100_000
PROBES_PER_CELL = 200_000


def line_key(line: bytes) -> bytes:
    return line.strip().lower()  # for bytes: ASCII only


def long_enough(key: bytes, chars: int) -> bool:
    return len(key) >= chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= chars)


def key_hash(key: bytes) -> int:
    return xxhash.xxh3_128_intdigest(key)


def line_hashes(slim: DataFrame, min_chars=MIN_CHARS) -> DataFrame:
    """(doc_id, h1, h2), once per document row and distinct key."""
    def run(batches):
        for batch in batches:
            ids, hashes = [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                if doc is None or len(text) < min_chars:
                    continue
                own = {key_hash(k) for k in map(line_key, text.split(b"\n")) if long_enough(k, min_chars)}
                ids += [doc] * len(own)
                hashes += own
            words = np.frombuffer(b"".join(h.to_bytes(16, "little") for h in hashes), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words[:, 0]), pa.array(words[:, 1])],
                                             names=["doc_id", "h1", "h2"])

    return slim.mapInArrow(run, "doc_id bigint, h1 bigint, h2 bigint")


def build_index(lines: DataFrame) -> tuple[DataFrame, int]:
    """One row per shard: displacement table and slot arrays. Returns the stored table and the number of shards."""
    counted = materialize(lines.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last")), "lines")
    shards = shards_for(counted.count(), KEYS_PER_SHARD)

    def build(key, table):
        h1, h2 = (table.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        seeds = mph.build(h1, h2)
        slot = mph.slots(seeds, h1, h2, len(h1))
        prints, counts, lasts = (np.empty(len(h1), t) for t in (np.uint32, np.int64, np.int64))
        prints[slot] = mph.fingerprint(h1, h2)
        counts[slot] = table.column("n_docs").to_numpy()
        lasts[slot] = table.column("last").to_numpy()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "probes": pa.array([int(counts.sum())], pa.int64()),
                         **{name: pa.array([a.tobytes()], pa.binary()) for name, a in
                            (("seeds", seeds), ("prints", prints), ("counts", counts), ("lasts", lasts))}})

    index = (counted.withColumn("shard", F.pmod("h1", F.lit(shards))).groupBy("shard")
             .applyInArrow(build, "shard bigint, probes bigint, seeds binary, prints binary, counts binary, lasts binary"))
    return materialize(index, "line-index"), shards


def dropped_lines(slim: DataFrame, min_chars=MIN_CHARS, min_docs=MIN_DOCS) -> DataFrame:
    """(doc_id, dropped): the 16-byte hashes, packed, of the lines each document loses; documents that lose none are absent."""
    # equal ids are one document: distinct rows of (doc_id, hash)
    lines = materialize(line_hashes(slim, min_chars).distinct(), "line-hashes")
    index, shards = build_index(lines)
    cells = F.greatest(F.lit(1), F.ceil(F.col("probes") / PROBES_PER_CELL)).cast("int")
    plan = index.select("shard", cells.alias("cells"))
    located = (lines.withColumn("shard", F.pmod("h1", F.lit(shards))).join(plan, "shard")
               .withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells")).cast("int")).drop("cells"))
    copies = index.withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1)))

    def probe(key, probes, arrays):
        if not probes.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "h1": pa.array([], pa.int64()), "h2": pa.array([], pa.int64())})
        read = lambda name, kind: np.frombuffer(arrays.column(name)[0].as_py(), kind)
        doc, h1, h2 = (probes.column(c).to_numpy() for c in ("doc_id", "h1", "h2"))
        counts = read("counts", np.int64)
        u1, u2 = h1.view(np.uint64), h2.view(np.uint64)
        slot = mph.slots(read("seeds", np.uint32), u1, u2, len(counts))
        hit = ((read("prints", np.uint32)[slot] == mph.fingerprint(u1, u2)) & (counts[slot] >= min_docs)
               & (read("lasts", np.int64)[slot] != doc))
        return pa.table({"doc_id": doc[hit], "h1": h1[hit], "h2": h2[hit]})

    hits = (located.groupBy("shard", "cell").cogroup(copies.groupBy("shard", "cell"))
            .applyInArrow(probe, "doc_id bigint, h1 bigint, h2 bigint"))
    return hits.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("dropped"))


def split_text(text: bytes, dropped: set[int], min_chars=MIN_CHARS) -> tuple[int, list[bytes]]:
    """Number of lines and the lines that stay."""
    lines = text.split(b"\n")
    if not dropped:
        return len(lines), lines
    stay = []
    for line in lines:
        key = line_key(line)
        if not (long_enough(key, min_chars) and key_hash(key) in dropped):
            stay.append(line)
    return len(lines), stay


def _dropped_sets(column):
    for value in column.to_pylist():
        yield {int.from_bytes(np.array([d["h1"], d["h2"]], np.int64).tobytes(), "little") for d in value or ()}


def dedup_lines(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows (doc_id, n_lines, n_dropped, text): the text without the dropped lines."""
    slim = id_text(docs, id_col, text_col)
    joined = slim.join(dropped_lines(slim), "doc_id", "left")

    def rebuild(batches):
        for batch in batches:
            n_lines, n_dropped, texts = [], [], []
            for text, dropped in zip(texts_of(batch), _dropped_sets(batch.column(2))):
                n, stay = split_text(text, dropped)
                n_lines.append(n)
                n_dropped.append(n - len(stay))
                texts.append(b"\n".join(stay) if dropped else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

    return joined.mapInArrow(rebuild, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines cut out of ``text`` and ``n_chars`` brought up to date; all columns stay."""
    columns = docs.columns
    key, found = unused(columns, "line_doc"), unused(columns, "line_hashes")
    hits = dropped_lines(id_text(docs)).select(F.col("doc_id").alias(key), F.col("dropped").alias(found))
    joined = docs.join(hits, docs["doc_id"] == hits[key], "left").drop(key)

    def rebuild(batches):
        at = columns.index("text")
        for batch in batches:
            texts = [t if t is None or not dropped else b"\n".join(split_text(t, dropped)[1])
                     for t, dropped in zip(texts_of(batch), _dropped_sets(batch.column(len(columns))))]
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    out = joined.mapInArrow(rebuild, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in columns else out
