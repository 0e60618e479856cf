"""Token-id files with a minimal perfect hash index.

Documents are ordered by id, encoded, closed by the end id and cut into shards. A shard is one row of a Parquet table
(the container that every Spark store can hold), written by the task that owns its range of ids:

| column | content |
|---|---|
| part, shard | range of ids (ascending), number inside it |
| n_ids | ids in the payload |
| first_doc, last_doc | smallest and largest document id, for finding the shard of a key |
| width | bytes per id: 2 if every id of the vocabulary fits, else 4 |
| payload | the ids, little-endian, documents in order |
| docs, turns | each row's document id (64-bit; 0 for null) and its number among rows of that id (32-bit; top bit: null id) |
| seeds | displacements of the minimal perfect hash over (id, number) |
| prints, offsets, lengths | by slot: fingerprint (32-bit), first id (64-bit), number of ids (32-bit) |

A keyed read hashes the id to its slot, compares the fingerprint and cuts ``lengths[slot]`` ids at ``offsets[slot]``: no
search, whatever the shard holds.

Null texts are empty: the end id alone. Null ids come first. Rows with equal ids keep apart by their number, ordered by
text. Long texts make a shard of their own size. Extra columns are left behind. Empty tables give an empty file and no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from daybrook.llm import mph
from daybrook.llm.bpe_units import encoder
from daybrook.llm.common import id_text, mix64, texts_of
from daybrook.session import work_path

END_ID = 2
SHARD_IDS = 500_000  # a shard is closed by the document that reaches this many ids
_NULL = np.uint32(1 << 31)

SCHEMA = ("part int, shard int, n_ids bigint, first_doc bigint, last_doc bigint, width int, payload binary, docs binary, "
          "turns binary, seeds binary, prints binary, offsets binary, lengths binary")


def key_words(docs: np.ndarray, turns: np.ndarray):
    """The two hash words of (id, number) keys."""
    h1 = mix64(docs.view(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    return h1, mix64(h1 ^ (turns.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


class _Shard:
    def __init__(self):
        self.docs, self.turns, self.lengths, self.payload, self.n = [], [], [], [], 0

    def add(self, doc, turn, ids: bytes):
        self.docs.append(0 if doc is None else doc)
        self.turns.append(turn | (int(_NULL) if doc is None else 0))
        self.lengths.append(len(ids) // 4)
        self.payload.append(ids)
        self.n += len(ids) // 4

    def row(self, part: int, number: int, width: int) -> dict:
        docs, turns = np.array(self.docs, np.int64), np.array(self.turns, np.uint32)
        lengths = np.array(self.lengths, np.uint32)
        offsets = np.cumsum(lengths, dtype=np.int64) - lengths
        h1, h2 = key_words(docs, turns)
        seeds = mph.build(h1, h2)
        order = np.argsort(mph.slots(seeds, h1, h2, len(docs)))
        ids = np.frombuffer(b"".join(self.payload), "<u4").astype(f"<u{width}")
        known = docs[turns < _NULL]
        return {"part": part, "shard": number, "n_ids": self.n, "first_doc": int(known[0]) if len(known) else None,
                "last_doc": int(known[-1]) if len(known) else None, "width": width, "payload": ids.tobytes(),
                "docs": docs.tobytes(), "turns": turns.tobytes(), "seeds": seeds.tobytes(),
                "prints": mph.fingerprint(h1, h2)[order].tobytes(), "offsets": offsets[order].tobytes(),
                "lengths": lengths[order].tobytes()}


_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_ids", pa.int64()), ("first_doc", pa.int64()),
                    ("last_doc", pa.int64()), ("width", pa.int32()),
                    *((c, pa.binary()) for c in ("payload", "docs", "turns", "seeds", "prints", "offsets", "lengths"))])


def write(docs: DataFrame, path: str, vocabulary: str, end_id=END_ID, spaces=False, shard_ids=SHARD_IDS) -> None:
    """Write the file for ``docs`` at ``path``."""
    ordered = id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        units = encoder(vocabulary, spaces)
        end = np.array([end_id], "<u4").tobytes()
        width = 2 if units.tokenizer.get_vocab_size() <= 1 << 16 else 4
        part, number, shard, last, turn = TaskContext.get().partitionId(), 0, _Shard(), (), 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                turn = turn + 1 if (doc,) == last else 0
                last = (doc,)
                shard.add(doc, turn, units.encode(text) + end)
                if shard.n >= shard_ids:
                    yield pa.RecordBatch.from_pylist([shard.row(part, number, width)], _ARROW)
                    number, shard = number + 1, _Shard()
        if shard.n:
            yield pa.RecordBatch.from_pylist([shard.row(part, number, width)], _ARROW)

    ordered.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)


class ShardReader:
    """Keyed access to one shard row."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids = read("payload", f"<u{row['width']}")
        self.docs, self.turns = read("docs", np.int64), read("turns", np.uint32)
        self.seeds, self.prints = read("seeds", np.uint32), read("prints", np.uint32)
        self.offsets, self.lengths = read("offsets", np.int64), read("lengths", np.uint32)

    def find(self, docs: np.ndarray, turns: np.ndarray):
        """(found, offset, length) of each key."""
        h1, h2 = key_words(docs, turns)
        slot = mph.slots(self.seeds, h1, h2, len(self.prints))
        return self.prints[slot] == mph.fingerprint(h1, h2), self.offsets[slot], self.lengths[slot].astype(np.int64)

    def cut(self, offset: int, length: int) -> bytes:
        return self.ids[offset:offset + length].astype("<u4").tobytes()


def read_documents(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored row; each is found through its shard's index."""
    table = spark.read.schema(SCHEMA).parquet(path)
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per writing task
    parts = sizes.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (table.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("base"))
             .join(parts, "part").select("part", "shard", (F.col("base") + F.col("part_base")).alias("base")))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(row)
                found, offsets, lengths = reader.find(reader.docs, reader.turns)
                if not found.all():
                    raise ValueError(f"damaged index in part {row['part']}, shard {row['shard']}")
                null = reader.turns >= _NULL
                cuts = [reader.cut(o, n) for o, n in zip(offsets.tolist(), lengths.tolist())]
                k = len(cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * k, pa.int32()), pa.array([row["shard"]] * k, pa.int32()),
                     pa.array(reader.docs, pa.int64(), mask=null), pa.array(offsets), pa.array(lengths),
                     pa.array([zlib.crc32(c) for c in cuts], pa.int64())],
                    names=["part", "shard", "doc_id", "offset", "n_tokens", "ids_crc32"])

    rows = table.mapInArrow(run, "part int, shard int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(bases, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark, path: str, keys: DataFrame, key_col="doc_id") -> DataFrame:
    """(doc_id, ids): the first stored row of each wanted id that exists. Only shards whose range holds a key are probed.

    The directory of parts (one row per writing task) goes to the tasks; inside its part a key meets the shard ranges.
    """
    table = spark.read.schema(SCHEMA).parquet(path)
    parts = sorted((r["first"], r["part"]) for r in table.where("first_doc IS NOT NULL").groupBy("part")
                   .agg(F.min("first_doc").alias("first")).collect())
    firsts, numbers = (np.array(x, np.int64) for x in (list(zip(*parts)) or [(), ()]))

    def route(batches):
        for batch in batches:
            docs = batch.column(0).to_numpy()
            at = np.searchsorted(firsts, docs, side="right") - 1
            docs, at = docs[at >= 0], at[at >= 0]
            yield pa.RecordBatch.from_arrays([pa.array(numbers[at].astype(np.int32)), pa.array(docs)], names=["part", "doc_id"])

    wanted = keys.select(F.col(key_col).cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    ranges = table.select("part", "shard", "first_doc", "last_doc")
    routed = (wanted.mapInArrow(route, "part int, doc_id bigint").join(ranges, "part")
              .where("doc_id BETWEEN first_doc AND last_doc").select("part", "shard", "doc_id"))

    def run(key, asked, shards):
        docs_out, ids_out = [], []
        if asked.num_rows and shards.num_rows:
            docs = np.unique(asked.column("doc_id").to_numpy())
            # equal ids may reach into the next shard: their first row answers
            for row in sorted(shards.to_pylist(), key=lambda r: r["shard"]):
                reader = ShardReader(row)
                found, offsets, lengths = reader.find(docs, np.zeros(len(docs), np.uint32))
                known = np.isin(docs, reader.docs[reader.turns == 0])
                for doc, o, n in zip(*(x[found & known].tolist() for x in (docs, offsets, lengths))):
                    docs_out.append(doc)
                    ids_out.append(reader.cut(o, n))
        return pa.table({"doc_id": pa.array(docs_out, pa.int64()), "ids": pa.array(ids_out, pa.binary())})

    held = spark.read.schema(SCHEMA).parquet(path)
    return routed.groupBy("part", "shard").cogroup(held.groupBy("part", "shard")).applyInArrow(run, "doc_id bigint, ids binary")


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of a file written for ``docs`` under the shared folder and read back."""
    path = work_path(docs.sparkSession, "token-file")
    write(docs, path, vocabulary)
    return read_documents(docs.sparkSession, path)
