"""BPE encoding by content-defined chunk reuse, and decoding.

A rolling hash over the bytes marks chunk borders, so equal passages are cut alike wherever they stand. A chunk is encoded
once per worker and kept, under a 128-bit digest and its length, in a cache bounded in bytes; later documents take its ids. A border may fall anywhere, also inside a word,
so each join is repaired: the units that meet there are encoded together, and the zone grows until encoding it jointly
with one more unit on each side gives exactly the ids that the parts have. Texts too short to be cut, or whose white
space is not all ASCII, are encoded whole.

Sharing is per worker, not across the cluster: exchanging every chunk's text to encode it once in all would move more
bytes than the encoding costs.

Null texts are empty and have no ids. Texts of any length are encoded whole. Extra columns are left behind. Repeated rows are encoded row by row, null ids stay null. Special tokens' strings in
a text become their ids, as in the library. Empty tables give empty results.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from daybrook.llm.bpe_units import BYTE_CHARS, UnitEncoder, after_blank, encoder
from daybrook.llm.common import id_text, mix64, texts_of

WINDOW = 16          # bytes in the rolling hash
MASK_BITS = 10       # a border about every 1024 bytes
MIN_CHUNK = 64       # bytes
EDGE = 3             # units kept apart at each end of a chunk, for the joins
CACHE_BYTES = 16 << 20  # of chunks per worker, both generations
UNIT_BYTES = 40 << 20   # of units per worker: a decoding worker runs beside each encoding one, which leaves it less than others have
CHUNK_BYTES = 1_500  # a chunk's key, its units at both ends with their ids, and its share of the table, about

_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def borders(text: bytes) -> list[int]:
    """Cut positions: the window's hash has its low bits clear, no character is split, chunks keep a least length."""
    raw = np.frombuffer(text, np.uint8)
    n = len(raw)
    if n < 2 * MIN_CHUNK:
        return []
    # buzhash: the window's byte codes, each rotated by its age, combined by xor; doubling the covered length each time
    h = _TABLE[raw]
    length = 1
    while length < WINDOW:
        turned = (h[:-length] << np.uint64(length)) | (h[:-length] >> np.uint64(64 - length))
        h = turned ^ h[length:]
        length *= 2
    ends = np.flatnonzero((mix64(h) & np.uint64((1 << MASK_BITS) - 1)) == 0) + WINDOW
    ends = ends[ends < n]
    ends = ends[(raw[ends] & 0xC0) != 0x80]
    out, last = [], 0
    for e in ends.tolist():
        if e - last >= MIN_CHUNK and n - e >= MIN_CHUNK:
            out.append(e)
            last = e
    return out


class ChunkEncoder:
    """Ids of texts through cached chunks."""

    def __init__(self, units: UnitEncoder):
        self.units = units
        self.young: dict[tuple, tuple] = {}
        self.old: dict[tuple, tuple] = {}
        self.reused = self.encoded = self.held = 0

    def _chunk(self, text: bytes, single_spaced: bool):
        """(first units, their ids, ids between, last units, their ids), or None for a chunk of too few units."""
        key = xxhash.xxh3_128_intdigest(text), len(text)
        found = self.young.get(key) or self.old.get(key)
        if found is not None:
            self.reused += 1
            return found
        self.encoded += 1
        if single_spaced:
            first, *keys = self.units.keys(text)
            if len(keys) < 2 * EDGE:
                return None
            ids = self.units.even_ids(text)
            head, last = [first, *map(after_blank, keys[:EDGE - 1])], list(map(after_blank, keys[-EDGE:]))
        else:
            units = self.units.split(text)
            if len(units) < 2 * EDGE:
                return None
            ids, head, last = self.units.ids(units), units[:EDGE], units[-EDGE:]
        found = (head, ids[:EDGE], b"".join(ids[EDGE:-EDGE]), last, ids[-EDGE:])
        self.held += len(found[2]) + CHUNK_BYTES
        if self.held > CACHE_BYTES // 2:
            self.young, self.old, self.held = {}, self.young, len(found[2]) + CHUNK_BYTES
        self.young[key] = found
        return found

    def _joint(self, units: list[bytes]) -> bytes:
        """Ids of neighbouring units' text, cut anew."""
        text = b"".join(units)
        return b"".join(self.units.ids(self.units.split(text)))

    def _agrees(self, left: bytes, zone: list[bytes], right: bytes, ids: bytes) -> bool:
        """Does the library encode the zone among its neighbours as the parts' ids?"""
        outer = self.units.ids([left, right])
        return self.units.library([b"".join([left, *zone, right])])[0] == outer[0] + ids + outer[1]

    def encode(self, text: bytes) -> bytes:
        cuts = borders(text)
        if not cuts or not self.units.separable(text):
            return self.units.encode(text)
        single_spaced = self.units.single_spaced(text)
        out: list[bytes] = []
        tail_units: list[bytes] = []  # of the last chunk, not yet written
        tail_ids: list[bytes] = []
        start = 0
        held = b""  # text of chunks too poor in units, carried into the next one
        for end in [*cuts, len(text)]:
            chunk = self._chunk(held + text[start:end], single_spaced)
            if chunk is None:
                held, start = held + text[start:end], end
                continue
            held, start = b"", end
            head_units, head_ids, middle, last_units, last_ids = chunk
            if not tail_units:
                out += head_ids
            else:
                for width in range(1, EDGE):
                    zone = tail_units[-width:] + head_units[:width]
                    ids = self._joint(zone)
                    if self._agrees(tail_units[-width - 1], zone, head_units[width], ids):
                        out += [*tail_ids[:-width], ids, *head_ids[width:]]
                        break
                else:  # no agreement near the border: the whole text decides
                    return self.units.encode(text)
            out.append(middle)
            tail_units, tail_ids = last_units, last_ids
        if held:  # the end is poor in units: encode it with the units before it
            if not tail_units:
                return self.units.encode(text)
            zone = [tail_units[-1], held]
            ids = self._joint(zone)
            if not self._agrees(tail_units[-2], zone, b"", ids):
                return self.units.encode(text)
            out += [*tail_ids[:-1], ids]
        else:
            out += tail_ids
        return b"".join(out)


class Decoder:
    """Texts of ids: each id's bytes by the byte-level alphabet of the vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in BYTE_CHARS.items()}
        words = {i: w for w, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.table = [b""] * (max(words) + 1)
        for i, w in words.items():
            self.table[i] = bytes(byte_of[c] for c in w) if all(c in byte_of for c in w) else w.encode()

    def decode(self, ids: bytes) -> bytes:
        raw = b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


_ENCODERS: dict = {}
_DECODERS: dict = {}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(encoder(path, spaces=True, cache_bytes=UNIT_BYTES))
    return _ENCODERS[path]


def _decoder(path: str) -> Decoder:
    """Decoding runs in a worker of its own, which needs no encoder."""
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def encode_documents(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, ids): ids as little-endian 32-bit words. One pass, no shuffle."""
    def run(batches):
        chunks = _encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([chunks.encode(t) for t in texts_of(batch)], pa.binary())], names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of rows with ``doc_id`` and ``ids``."""
    def run(batches):
        decoder = _decoder(path)
        for batch in batches:
            texts = [decoder.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode_documents(encode_documents(docs, path), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
