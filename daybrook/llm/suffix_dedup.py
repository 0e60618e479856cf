"""Suffix-array dedup: bytes covered by a long string that also starts in a document with a smaller id are removed.

A distributed suffix array of the whole corpus would hold eight bytes or more per byte of text. Here every string of
``LENGTH`` bytes is represented by its *anchor*, the ``GRAM`` bytes inside it with the smallest hash: equal strings have
equal anchors at equal places, so they meet wherever strings are brought together by anchor.

1. Documents are packed, compressed, into *packs* of some megabytes; all later steps carry packs, not rows of text.
2. Anchors' hashes (5 bytes each, once per pack) go to shards, whose number follows the size of the text; each pack gets
   back the anchors that occur in another document.
3. For these, a pack sends the *context*: the bytes of all strings the anchor stands for. Copies of a context inside a
   pack are settled there (only the smallest id's goes on), so a passage found in a third of all documents sends one
   context per pack. An anchor in more than ``HOT_PLACES`` places (a phrase with other words around it) would gather all its
   contexts in one task: its strings are sent one by one and meet by their own hash as well, so any number is dealt evenly.
4. In a shard, copies of a context are settled likewise; the distinct ones form a text whose suffix array (starts: the
   strings' starts) and common prefixes are scanned with a stack. Every common-prefix interval of ``LENGTH`` or more whose
   occurrences are preceded by different bytes is a maximal repeat group; all its occurrences but those of the smallest
   id are removed.
5. Removed ranges return to their packs, are merged, and the remaining bytes are joined.

Matches never cross documents; all comparisons are on bytes of the input. Null texts are empty. Rows with equal ids do not
remove each other's bytes, each is judged against smaller ids; rows with a null id neither remove nor lose bytes. Texts
shorter than ``LENGTH`` lose nothing; texts of any length are read whole. Extra columns are left behind. Empty tables give
empty results.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from daybrook.llm.common import id_text, mix64, shards_for, store, texts_of

LENGTH, GRAM = 50, 20
WINDOW = LENGTH - GRAM + 1   # grams in a string
PACK_BYTES = 4_000_000
SEGMENT_BYTES = 1_000_000    # text hashed at a time
ANCHORS_PER_SHARD = 1_000_000
CONTEXTS_PER_SHARD = 100_000
HOT_PLACES = 20_000
_PLACE = (1 << 28) - 1


def _pack_arrays(*arrays: np.ndarray) -> bytes:
    head = struct.pack(f"<{1 + len(arrays)}q", len(arrays), *(a.nbytes for a in arrays))
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack_arrays(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (count,) = struct.unpack_from("<q", raw)
    sizes = struct.unpack_from(f"<{count}q", raw, 8)
    out, at = [], 8 * (1 + count)
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


class Pack:
    """Some documents: ids, which of them are known (not null), offsets into the joined bytes."""

    def __init__(self, blob: bytes):
        self.ids, known, lengths, self.raw = _unpack_arrays(blob, np.int64, np.uint8, np.int64, np.uint8)
        self.known = known.astype(bool)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])

    @staticmethod
    def build(ids, texts) -> bytes:
        return _pack_arrays(np.array([0 if i is None else i for i in ids], np.int64), np.array([i is not None for i in ids], np.uint8),
                            np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))

    def anchors(self):
        """(row, first string's start in the row, number of strings, anchor key) of every run of strings with one anchor."""
        out = []
        row = 0
        while row < len(self.ids):
            last = row + 1
            if self.offsets[last] - self.offsets[row] > 2 * SEGMENT_BYTES:  # a very long text, in overlapping parts
                for at in range(int(self.offsets[row]), int(self.offsets[last]), SEGMENT_BYTES):
                    piece = self.raw[at:min(at + SEGMENT_BYTES + LENGTH - 1, int(self.offsets[last]))]
                    found = _anchors(piece, np.array([0, len(piece)]), self.known[row:last])
                    if found is not None:
                        out.append((found[0] + row, found[1] + (at - self.offsets[row]), *found[2:]))
                row = last
                continue
            while last < len(self.ids) and self.offsets[last + 1] - self.offsets[row] <= SEGMENT_BYTES:
                last += 1
            found = _anchors(self.raw[self.offsets[row]:self.offsets[last]], self.offsets[row:last + 1] - self.offsets[row], self.known[row:last])
            if found is not None:
                out.append((found[0] + row, *found[1:]))
            row = last
        if not out:
            return [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)]
        return [np.concatenate(x) for x in zip(*out)]


def _anchors(raw: np.ndarray, offsets: np.ndarray, known: np.ndarray):
    n = len(raw)
    if n < LENGTH:
        return None
    # bytes i..i+7 as one word, then the gram's 20 bytes from three words
    word = raw[:n - 7].astype(np.uint64)
    for j in range(1, 8):
        word |= raw[j:n - 7 + j].astype(np.uint64) << np.uint64(8 * j)
    m = n - GRAM + 1
    gram = mix64(word[:m] * np.uint64(0x9E3779B97F4A7C15) + word[8:8 + m] * np.uint64(0xC2B2AE3D27D4EB4F)
                 + word[GRAM - 8:GRAM - 8 + m] * np.uint64(0x165667B19E3779F9))
    least = (gram & ~np.uint64(_PLACE)) | np.arange(m, dtype=np.uint64)
    covered = 1
    while covered * 2 <= WINDOW:  # smallest of the next 2, 4, 8, 16 grams
        least = np.minimum(least[:len(least) - covered], least[covered:])
        covered *= 2
    rest = WINDOW - covered
    least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
    # strings that stay inside a document
    owner = np.repeat(np.arange(len(known)), np.diff(offsets))
    start = np.arange(len(least))
    valid = (owner[start] == owner[start + LENGTH - 1]) & known[owner[start]]
    start = start[valid]
    if not len(start):
        return None
    anchor = (least[valid] & np.uint64(_PLACE)).astype(np.int64)
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (owner[start[1:]] != owner[start[:-1]])))
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    row = owner[begin]
    return row, begin - offsets[row], count, mix64(gram[anchor[first]] ^ np.uint64(0xD6E8FEB86659FD93))


def pack_documents(slim: DataFrame) -> DataFrame:
    """(pack, n_bytes, blob), stored."""
    def run(batches):
        task, number, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0
        row = lambda: pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) + number], pa.int64()), pa.array([held], pa.int64()), pa.array([Pack.build(ids, texts)], pa.binary())],
            names=["pack", "n_bytes", "blob"])
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                ids.append(doc)
                texts.append(text)
                held += len(text)
                if held >= PACK_BYTES or len(ids) >= 1 << 20:
                    yield row()
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield row()

    return store(slim.mapInArrow(run, "pack bigint, n_bytes bigint, blob binary"), "packs")


def _short(keys: np.ndarray) -> np.ndarray:
    """40 bits of the keys, five bytes each."""
    return (keys & np.uint64((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]


def _long(five: np.ndarray) -> np.ndarray:
    out = np.zeros((len(five) // 5, 8), np.uint8)
    out[:, :5] = five.reshape(-1, 5)
    return out.reshape(-1).view(np.uint64)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def repeated_anchors(packs: DataFrame, shards: int) -> DataFrame:
    """(pack, shard, hits, keys): per pack the short keys of its anchors that occur in more than one document, and which are hot.

    ``hits`` bounds the contexts (hot anchors: strings) the pack will send for them.
    """
    def spread(batches):
        for batch in batches:
            for pack, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row, _, _, key = Pack(blob).anchors()
                order = np.lexsort((row, key))
                row, key = row[order], key[order]
                first = np.append(True, key[1:] != key[:-1])[:len(key)]
                several = np.zeros(len(key), np.uint32)
                several[1:] = (key[1:] == key[:-1]) & (row[1:] != row[:-1])
                keys, at = key[first], np.flatnonzero(first)
                # places of each key, doubled; odd if they are in several documents
                places = 2 * np.diff(np.append(at, len(key))) + np.maximum.reduceat(several, at) if len(keys) else at
                shard = _shard(keys, shards)
                cells = [(s, shard == s) for s in np.unique(shard)] if shards < 64 else _groups(shard)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(s) for s, _ in cells], pa.int64()), pa.array([pack] * len(cells), pa.int64()),
                     pa.array([_pack_arrays(_short(keys[at]), places[at].astype(np.uint32)) for _, at in cells], pa.binary())],
                    names=["shard", "pack", "cell"])

    def meet(key, table):
        packs_here = table.column("pack").to_pylist()
        cells = [_unpack_arrays(c, np.uint8, np.uint32) for c in table.column("cell").to_pylist()]
        keys = [_long(k) for k, _ in cells]
        every = np.concatenate(keys)
        places = np.concatenate([p for _, p in cells]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        edge = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)])
        # of each key over all packs: is it in several documents, in how many places
        size = np.diff(np.append(edge, len(every)))
        shared, total = np.empty(len(every), bool), np.empty(len(every), np.int64)
        if len(edge):
            shared[order] = np.repeat((size > 1) | (np.maximum.reduceat(places[order] & 1, edge) > 0), size)
            total[order] = np.repeat(np.add.reduceat(places[order] >> 1, edge), size)
        out, at = [], 0
        for pack, k in zip(packs_here, keys):
            mine, here = shared[at:at + len(k)], places[at:at + len(k)] >> 1
            hot = total[at:at + len(k)][mine] > HOT_PLACES
            at += len(k)
            if mine.any():
                sent = int((here[mine] * np.where(hot, WINDOW, 1)).sum())
                out.append((pack, sent, _pack_arrays(_short(k[mine]), hot.astype(np.uint8))))
        return pa.table({"pack": pa.array([p for p, _, _ in out], pa.int64()), "shard": pa.array([key[0].as_py()] * len(out), pa.int64()),
                         "hits": pa.array([h for _, h, _ in out], pa.int64()), "keys": pa.array([k for _, _, k in out], pa.binary())})

    spread_out = packs.select("pack", "blob").mapInArrow(spread, "shard bigint, pack bigint, cell binary")
    return store(spread_out.groupBy("shard").applyInArrow(meet, "pack bigint, shard bigint, hits bigint, keys binary"), "repeated")


def _groups(values: np.ndarray):
    order = np.argsort(values, kind="stable")
    ends = np.flatnonzero(np.diff(values[order])) + 1
    return [(int(values[p[0]]), p) for p in np.split(order, ends) if len(p)]


def contexts(packs: DataFrame, repeated: DataFrame, shards: int, groups: int) -> DataFrame:
    """(group, pack, kind, cell). Kind 0: ranges already settled (row, start, end). Kind 1: distinct contexts and their places."""
    def run(key, pack_rows, key_rows):
        empty = {"group": pa.array([], pa.int64()), "pack": pa.array([], pa.int64()), "kind": pa.array([], pa.int32()), "cell": pa.array([], pa.binary())}
        if not (pack_rows.num_rows and key_rows.num_rows):
            return pa.table(empty)
        pack = Pack(pack_rows.column("blob")[0].as_py())
        wanted = {s: _unpack_arrays(k, np.uint8, np.uint8) for s, k in zip(key_rows.column("shard").to_pylist(), key_rows.column("keys").to_pylist())}
        row, start, count, keys = pack.anchors()
        hit, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for s, at in _groups(_shard(keys, shards)):
            if s in wanted:
                short, theirs, is_hot = keys[at] & np.uint64((1 << 40) - 1), _long(wanted[s][0]), wanted[s][1].astype(bool)
                hit[at] = np.isin(short, theirs)
                if is_hot.any():
                    hot[at] = np.isin(short, theirs[is_hot])
        raw = pack.raw.tobytes()
        if hot.any():  # their strings one by one, by anchor and own hash
            parent = np.repeat(np.flatnonzero(hot), count[hot])
            string = start[parent] + np.arange(len(parent)) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
            own = np.array([zlib.crc32(raw[b:b + LENGTH]) for b in (pack.offsets[row[parent]] + string).tolist()], np.uint64)
            hit &= ~hot
            row, start, keys, count = (np.concatenate(x) for x in (
                (row[hit], row[parent]), (start[hit], string), (keys[hit], mix64(keys[parent] ^ mix64(own + np.uint64(1)))),
                (count[hit], np.ones(len(parent), count.dtype))))
        else:
            row, start, count, keys = row[hit], start[hit], count[hit], keys[hit]
        begin = pack.offsets[row] + start
        ids = pack.ids
        # copies inside the pack: the smallest id's places go on, the others are settled
        places: dict[bytes, list[int]] = {}
        for i, (b, e) in enumerate(zip(begin.tolist(), (begin + count + LENGTH - 1).tolist())):
            places.setdefault(raw[b:e], []).append(i)
        settled, parts = [], {}
        doc = ids[row]
        group = (mix64(keys) % np.uint64(groups)).astype(np.int64)
        for text, at in places.items():
            if len(at) > 1:
                least = min(doc[i] for i in at)
                settled += [i for i in at if doc[i] > least]
                at = [i for i in at if doc[i] == least]
            parts.setdefault(int(group[at[0]]), []).append((text, at))
        number = key[0].as_py()
        out = []
        if settled:
            out.append((int(mix64(np.array([number], np.int64).view(np.uint64))[0] % np.uint64(groups)), 0, _pack_arrays(
                row[settled].astype(np.int32), start[settled].astype(np.int32), (start + count + LENGTH - 1)[settled].astype(np.int32))))
        for g, found in parts.items():
            lead = [at[0] for _, at in found]
            flat = [i for _, at in found for i in at]
            out.append((g, 1, _pack_arrays(
                doc[lead], keys[lead], count[lead].astype(np.int32), np.array([len(at) for _, at in found], np.int32),
                row[flat].astype(np.int32), start[flat].astype(np.int32), np.frombuffer(b"".join(t for t, _ in found), np.uint8))))
        return pa.table({"group": pa.array([g for g, _, _ in out], pa.int64()), "pack": pa.array([number] * len(out), pa.int64()),
                         "kind": pa.array([k for _, k, _ in out], pa.int32()), "cell": pa.array([c for _, _, c in out], pa.binary())})

    return (packs.select("pack", "blob").groupBy("pack").cogroup(repeated.groupBy("pack"))
            .applyInArrow(run, "group bigint, pack bigint, kind int, cell binary"))


def suffix_array(texts: list[bytes], counts: np.ndarray):
    """Starts of strings in ``texts`` (the first ``counts[i]`` places of each) in the order of what follows, with common prefixes.

    Returns (text number, place) in suffix order and ``lcp``: common prefix with the suffix before (first: 0).
    """
    width = max(map(len, texts))
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    flat = np.frombuffer(b"".join(texts) + bytes(width), np.uint8)
    length = (base[owner + 1] - base[owner]) - place
    rows = flat[(base[owner] + place)[:, None] + np.arange(width)]
    rows[np.arange(width) >= length[:, None]] = 0
    keys = rows.view(f"S{width}").ravel()
    # padding and zero bytes of the text look alike: the shorter comes first
    order = np.argsort(keys, kind="stable") if flat[:base[-1]].all() else np.lexsort((length, keys))
    rows, length = rows[order], length[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp = np.concatenate([[0], np.minimum(common, np.minimum(length[1:], length[:-1]))])
    return owner[order], place[order], lcp


def repeat_groups(lcp: np.ndarray, before: list[int], least: int):
    """Maximal repeat groups of a suffix array: (first, last, length) for each common-prefix interval of at least ``least`` whose
    occurrences differ in the byte before (``before``; negative values differ from all others)."""
    varied = None  # marks an interval preceded by different bytes
    stack: list[list] = []  # [length, first suffix, byte before]
    heights = lcp.tolist()
    for i in range(1, len(heights) + 1):
        height = heights[i] if i < len(heights) else 0
        if height < least:
            height = 0
        first, byte = i - 1, before[i - 1]
        while stack and stack[-1][0] > height:
            length, first, held = stack.pop()
            byte = held if held == byte and held is not varied and held >= 0 else varied
            if byte is varied:
                yield first, i, length
        if height:
            if stack and stack[-1][0] == height:
                held = stack[-1][2]
                stack[-1][2] = held if held == byte and held is not varied and held >= 0 else varied
            else:
                stack.append([height, first, byte])


def settle(found: DataFrame) -> DataFrame:
    """(pack, cell): ranges (row, start, end) to remove, of both kinds."""
    def run(key, table):
        out = []
        cells = []
        for pack, kind, cell in zip(*(table.column(c).to_pylist() for c in ("pack", "kind", "cell"))):
            if kind == 0:
                out.append((pack, cell))
            else:
                cells.append((pack, _unpack_arrays(cell, np.int64, np.uint64, np.int32, np.int32, np.int32, np.int32, np.uint8)))
        # distinct contexts of all packs, each with the smallest id that has it
        number: dict[bytes, int] = {}
        texts, docs, counts, anchors, mine = [], [], [], [], []
        for _, (doc, anchor, count, _, _, _, raw) in cells:
            ends = np.cumsum(count.astype(np.int64) + LENGTH - 1)
            blob, own, b = raw.tobytes(), [], 0
            for d, a, c, e in zip(doc.tolist(), anchor.tolist(), count.tolist(), ends.tolist()):
                text = blob[b:e]
                b = e
                k = number.setdefault(text, len(texts))
                if k == len(texts):
                    texts.append(text)
                    docs.append(d)
                    counts.append(c)
                    anchors.append(a)
                elif d < docs[k]:
                    docs[k] = d
                own.append(k)
            mine.append(own)
        removed = _between_contexts(texts, np.array(docs, np.int64), np.array(counts, np.int64), np.array(anchors, np.uint64))
        for (pack, (doc, _, count, times, row, start, _)), own in zip(cells, mine):
            r, s, e, at = [], [], [], 0
            for d, c, t, k in zip(doc.tolist(), count.tolist(), times.tolist(), own):
                ranges = [(0, c + LENGTH - 1)] if d > docs[k] else removed.get(k, ())
                if ranges:
                    for x in range(at, at + t):
                        for a, b in ranges:
                            r.append(row[x])
                            s.append(start[x] + a)
                            e.append(start[x] + b)
                at += t
            if r:
                out.append((pack, _pack_arrays(*(np.array(v, np.int32) for v in (r, s, e)))))
        return pa.table({"pack": pa.array([p for p, _ in out], pa.int64()), "cell": pa.array([c for _, c in out], pa.binary())})

    return found.groupBy("group").applyInArrow(run, "pack bigint, cell binary")


def _between_contexts(texts, docs, counts, anchors) -> dict[int, list[tuple[int, int]]]:
    """Ranges to remove from each distinct context because of another context with a smaller id."""
    removed: dict[int, list[tuple[int, int]]] = {}
    if not texts:
        return removed
    _, back, sizes = np.unique(anchors, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(sizes[back] > 1)  # contexts of one anchor can only meet each other
    if not len(shared):
        return removed
    shared = shared[np.argsort(back[shared], kind="stable")]
    edges = np.append(np.flatnonzero(np.append(True, np.diff(back[shared]) != 0)), len(shared))
    start = 0
    while start < len(edges) - 1:  # some anchors at a time, so the suffixes of a slice stay small
        stop = start + 1
        while stop < len(edges) - 1 and edges[stop + 1] - edges[start] <= 20_000:
            stop += 1
        part = shared[edges[start]:edges[stop]]
        start = stop
        own = [texts[k] for k in part]
        owner, place, lcp = suffix_array(own, counts[part])
        before = [t[p - 1] if p else -1 for t, p in zip((own[o] for o in owner), place.tolist())]
        doc = docs[part][owner]
        for first, last, length in repeat_groups(lcp, before, LENGTH):
            here = doc[first:last]
            least = here.min()
            for x in np.flatnonzero(here > least) + first:
                removed.setdefault(int(part[owner[x]]), []).append((int(place[x]), int(place[x]) + int(length)))
    return removed


def merge(start: np.ndarray, end: np.ndarray):
    """Maximal runs covered by the ranges."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.append(True, start[1:] > end[:-1])
    at = np.flatnonzero(first)
    return start[at], np.append(end[at[1:] - 1], end[-1])


def remove(packs: DataFrame, ranges: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""
    def run(key, pack_rows, range_rows):
        pack = Pack(pack_rows.column("blob")[0].as_py())
        cells = [_unpack_arrays(c, np.int32, np.int32, np.int32) for c in range_rows.column("cell").to_pylist()]
        row, start, end = (np.concatenate(x).astype(np.int64) for x in zip(*cells)) if cells else [np.empty(0, np.int64)] * 3
        by_row = dict(_groups(row)) if len(row) else {}
        raw = pack.raw.tobytes()
        lost, spans, kept = [], [], []
        for i in range(len(pack.ids)):
            b, e = int(pack.offsets[i]), int(pack.offsets[i + 1])
            at = by_row.get(i)
            if at is None:
                lost.append(0)
                spans.append(0)
                kept.append(raw[b:e])
                continue
            s, t = merge(start[at], end[at])
            lost.append(int((t - s).sum()))
            spans.append(len(s))
            kept.append(b"".join(raw[b + x:b + y] for x, y in zip([0, *t.tolist()], [*s.tolist(), e - b])))
        return pa.table({"doc_id": pa.array(pack.ids, pa.int64(), mask=~pack.known), "n_bytes": pa.array(np.diff(pack.offsets)),
                         "n_removed": pa.array(lost, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return (packs.select("pack", "blob").groupBy("pack").cogroup(ranges.groupBy("pack"))
            .applyInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"))


def dedup(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the remaining bytes ``kept`` of every row."""
    packs = pack_documents(id_text(docs, id_col, text_col))
    n_bytes = packs.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    shards = shards_for(2 * n_bytes // (WINDOW + 1), ANCHORS_PER_SHARD)
    repeated = repeated_anchors(packs, shards)
    hits = repeated.agg(F.coalesce(F.sum("hits"), F.lit(0))).first()[0]
    ranges = store(settle(contexts(packs, repeated, shards, shards_for(hits, CONTEXTS_PER_SHARD))), "ranges")
    return remove(packs, ranges)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
