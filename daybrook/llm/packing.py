"""Best-fit packing of token sequences by exact-complement hashing.

Only the histogram of piece lengths (at most ``size`` entries, whatever the input) is planned: for each length, longest
first, indexes of single, pair and triple sums name combinations that fill the gap exactly, consumed as often as the
availability counts allow; what has no exact complement is packed best fit, longest pieces first. The plan is a list of
(length, ranks, first sequence, offset) entries; pieces find theirs by their rank among the pieces of their length. Ranks
come from counts per task and length, so a length that holds a third of all pieces is no hot group, and no piece passes
through the driver.

Documents are ids followed by the end id; only documents longer than ``size`` are cut, the first piece taking the
remainder. Null and empty texts are one piece with the end id alone. Repeated rows and null ids are packed like any other
row. Ties between equal lengths are broken by task and order, so sequence ids may differ between runs; lengths, pieces
and the number of sequences do not. Texts of any length are cut whole, extra columns are left behind. Empty tables give empty
results.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from daybrook.llm.bpe_units import encoder
from daybrook.llm.common import id_text, store, texts_of

SIZE, END_ID = 1024, 2


def plan_patterns(counts: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(how many sequences, lengths in each) that use up ``counts`` (pieces per length)."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[tuple[int, list[int]]] = []

    def consume(lengths: list[int]) -> None:
        need = Counter(lengths)
        times = min(int(left[x]) // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= times * n
        patterns.append((times, lengths))

    if left[size]:
        consume([size])
    for length in range(size - 1, 0, -1):
        while left[length]:
            lengths = exact_complement(left, length, size - length)
            if lengths is None:
                break
            consume(lengths)
    while left.any():
        lengths, gap = [], size
        spare = left.copy()
        while gap:
            fits = np.flatnonzero(spare[1:gap + 1])
            if not len(fits):
                break
            best = int(fits[-1]) + 1  # the longest that fits leaves the least
            lengths.append(best)
            spare[best] -= 1
            gap -= best
        consume(lengths)
    return patterns


def exact_complement(left: np.ndarray, length: int, gap: int) -> list[int] | None:
    """``length`` with one, two or three available lengths that sum to ``gap``."""
    spare = left.copy()
    spare[length] -= 1
    if spare[gap] > 0:
        return [length, gap]
    have = spare[:gap + 1] > 0
    have[0] = False

    def pair(total: int, have: np.ndarray, spare: np.ndarray) -> tuple[int, int] | None:
        a = np.arange((total + 1) // 2, total)  # the larger part
        ok = have[a] & have[total - a] & ((a * 2 != total) | (spare[a] > 1))
        hit = np.flatnonzero(ok)
        return (int(a[hit[-1]]), total - int(a[hit[-1]])) if len(hit) else None

    found = pair(gap, have, spare)
    if found:
        return [length, *found]
    for first in np.flatnonzero(have)[::-1].tolist():
        if first * 3 < gap:
            break
        if first >= gap - 1:
            continue
        spare[first] -= 1
        now = have.copy()
        now[first] = spare[first] > 0
        found = pair(gap - first, now, spare)
        spare[first] += 1
        if found:
            return [length, first, *found]
    return None


def plan_slots(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted by length and rank: the ranks of a row go to consecutive sequences."""
    rows, used, sequence = [], Counter(), 0
    for times, lengths in patterns:
        offset = 0
        for x in lengths:
            rows.append((x, used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` ids."""
    first = n % size or size
    starts = [0, *range(first, n, size)] if n > size else [0]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n])]


def encode_pieces(docs: DataFrame, path: str, size=SIZE, end_id=END_ID) -> DataFrame:
    """Stored pieces: doc_id, piece, start, length, ids (32-bit words), crc, and their task's number and rank by length."""
    def run(batches):
        units = encoder(path, spaces=True)
        end = np.array([end_id], "<u4").tobytes()
        part, ranks = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = [], [], [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                ids = units.encode(text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    own = ids[4 * start:4 * (start + length)]
                    for column, value in zip(rows, (doc, k, start, length, own, zlib.crc32(own), ranks[length])):
                        column.append(value)
                    ranks[length] += 1
            kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()
            arrays = [pa.array(c, k) for c, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(rows[0]), pa.int32())],
                                             names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "place", "part"])

    return id_text(docs).mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary, "
                                         "ids_crc32 bigint, place bigint, part int")


def pack(docs: DataFrame, path: str, size=SIZE, end_id=END_ID, with_ids=True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if wanted, ids (32-bit words) for every piece."""
    pieces = store(encode_pieces(docs, path, size, end_id), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan_slots(plan_patterns(histogram, size))  # bounded by the distinct lengths, not by the pieces
    columns = ["length", "doc_id", "piece", "start", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = pieces.join(bases, ["length", "part"]).select((F.col("base") + F.col("place")).alias("rank"), *columns)

    def place(batches):
        starts = slots[:, 0] << np.int64(44) | slots[:, 1]
        for batch in batches:
            rank, length = (batch.column(i).to_numpy() for i in (0, 1))
            at = np.searchsorted(starts, length << np.int64(44) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(slots[at, 2] + rank - slots[at, 1]), pa.array(slots[at, 3]),
                                              *batch.columns[1:]], names=["sequence_id", "offset", *columns])

    kinds = "length bigint, doc_id bigint, piece int, start bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    placed = ranked.mapInArrow(place, f"sequence_id bigint, offset bigint, {kinds}")
    return placed.select("doc_id", "piece", "start", "length", *columns[4:], "sequence_id", "offset")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(docs, path, with_ids=False)
