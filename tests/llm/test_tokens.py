"""Chunked encoding, token files and packing against the library itself."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from daybrook.llm import bpe_units, chunk_bpe, packing, token_files
from daybrook.llm.queries import BYTES, WORDS, vocabulary
from tests.llm.conftest import by_id

HARD = ["", " ", "  two  blanks ", "line\n\nbreak \n x", "tab\tand\r\nreturn", "nb sp 　x \n\ny", "can't we'll I'D o'clock 'S",
        "<|endoftext|> inside<|endoftext|>", "x́ é ﬁ Ǆ İ ß Σας", "😀😀 👩‍👩‍👧 x", "word.,!? (a) [b] --", "12 345 6.7 ١٢",
        "a" * 5000, " " * 3000, "Der " * 2000, "x\x00y \x1c z\x85w", "trailing \n", "\nleading", "<|startoftext|>Mixed CASE"]


@pytest.fixture(scope="module")
def texts(sample):
    passage = sample[7][1] * 3
    return HARD + [t or "" for _, t in sample] + [f"{k} own start {passage} own end {k}" for k in range(4)]


@pytest.fixture(scope="module", params=[BYTES, WORDS])
def both(request):
    path = vocabulary(request.param)
    return path, Tokenizer.from_file(path), request.param == BYTES


def test_units_equal_the_library(both, texts):
    path, library, spaces = both
    encoder = bpe_units.UnitEncoder(path, spaces)
    for t in texts:
        assert np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t[:50]


def test_unit_cache_is_bounded(texts, monkeypatch):
    monkeypatch.setattr(bpe_units, "CACHE_BYTES", 100 * bpe_units.ENTRY_BYTES)
    path = vocabulary(BYTES)
    encoder, library = bpe_units.UnitEncoder(path, True), Tokenizer.from_file(path)
    for t in texts[:60]:
        assert np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert max(len(c) + len(c.old) for c in (encoder.common, encoder.others)) <= 100


def test_chunk_cache_is_bounded(texts, monkeypatch):
    monkeypatch.setattr(chunk_bpe, "CACHE_BYTES", 40 * chunk_bpe.CHUNK_BYTES)
    chunks, library = chunk_bpe.ChunkEncoder(bpe_units.UnitEncoder(vocabulary(BYTES), True)), Tokenizer.from_file(vocabulary(BYTES))
    for t in texts[:150] * 2:
        assert np.frombuffer(chunks.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(chunks.young) + len(chunks.old) <= 40


def test_encoders_beside_decoders_hold_smaller_caches(monkeypatch):
    monkeypatch.setattr(chunk_bpe, "_ENCODERS", {})
    units = chunk_bpe._encoder(vocabulary(BYTES)).units
    assert (units.common.entries + units.others.entries) * 2 * bpe_units.ENTRY_BYTES <= chunk_bpe.UNIT_BYTES
    assert chunk_bpe.UNIT_BYTES + chunk_bpe.CACHE_BYTES <= bpe_units.CACHE_BYTES // 2
    assert bpe_units.encoder(vocabulary(BYTES), True) is not units


def test_texts_of_several_megabytes(table):
    """One text of 3 MB with a passage that repeats, beside short ones, through encoding and packing."""
    words = [f"w{k * 7919 % 5003}{'.' * (k % 11 == 0)}" for k in range(400_000)]
    rows = [(1, " ".join(words)), (2, "short"), (3, "x" * 500_000), (4, "\n\n  " * 50_000)]
    library = Tokenizer.from_file(vocabulary(BYTES))
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert {r["doc_id"]: r["n_tokens"] for r in chunk_bpe.digest(table(rows), vocabulary(BYTES)).collect()} == want
    pieces = packing.digest(table(rows), vocabulary(BYTES)).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0]: r[1] for r in pieces} == {i: n + 1 for i, n in want.items()}


@pytest.mark.parametrize("bits", [4, 7, 10])
def test_chunks_equal_the_library(texts, monkeypatch, bits):
    """Short chunks cut words and white space everywhere; the repaired joins must hide it."""
    monkeypatch.setattr(chunk_bpe, "MASK_BITS", bits)
    monkeypatch.setattr(chunk_bpe, "MIN_CHUNK", 4 * bits)
    path = vocabulary(BYTES)
    chunks, library, decoder = chunk_bpe.ChunkEncoder(bpe_units.UnitEncoder(path, True)), Tokenizer.from_file(path), chunk_bpe.Decoder(path)
    for t in texts:
        ids = chunks.encode(t.encode())
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t[:50]
        assert decoder.decode(ids).decode() == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
    assert chunks.reused > 0


def test_chunks_are_cut_by_content():
    rng = np.random.default_rng(1)
    passage = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    cuts = [{c - n for c in chunk_bpe.borders(b"y" * n + passage) if c - n > 2000} for n in (0, 777, 1301)]
    assert cuts[0] and cuts[0] == cuts[1] == cuts[2]


def test_encode_decode_query(table, sample, edges):
    rows = edges + [(1000 + i, t) for i, t in enumerate(HARD)] + sample
    library = Tokenizer.from_file(vocabulary(BYTES))
    want = []
    for doc, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = chunk_bpe.digest(table(rows), vocabulary(BYTES))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert by_id(got) == sorted(want, key=repr)
    assert chunk_bpe.digest(table(rows).where("false"), vocabulary(BYTES)).count() == 0


def stored(rows):
    library, out, start = Tokenizer.from_file(vocabulary(WORDS)), [], 0
    for doc, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_ids", [500, 500_000])
def test_token_files(spark, table, sample, edges, tmp_path, shard_ids):
    rows = edges + [(1000 + i, t) for i, t in enumerate(HARD)] + sample + [(None, "again")]
    path = str(tmp_path / "file")
    token_files.write(table(rows), path, vocabulary(WORDS), shard_ids=shard_ids)
    back = token_files.read_documents(spark, path)
    assert back.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert by_id(back) == stored(rows)
    keys = [1005, 7, 4, 999_999, -5, None, 1005]
    found = {r["doc_id"]: r["ids"] for r in token_files.lookup(spark, path, spark.createDataFrame([(k,) for k in keys], "doc_id bigint")).collect()}
    library = Tokenizer.from_file(vocabulary(WORDS))
    texts = dict(rows)
    assert set(found) == {k for k in (1005, 7, 4) if k in texts}
    assert all(np.frombuffer(v, "<u4").tolist() == library.encode(texts[k] or "", add_special_tokens=False).ids + [2] for k, v in found.items())


def test_empty_token_file(spark, table, tmp_path):
    token_files.write(table([(1, "x")]).where("false"), str(tmp_path / "none"), vocabulary(WORDS))
    assert token_files.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_packing(table, sample, edges):
    rows = edges + [(1000 + i, t) for i, t in enumerate(HARD)] + sample
    library = Tokenizer.from_file(vocabulary(BYTES))
    want = Counter()
    for doc, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)] if len(ids) > 1024 else [0]
        for k, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[doc, k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())] += 1
    got = packing.digest(table(rows), vocabulary(BYTES))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    pieces = got.collect()
    assert Counter(tuple(r)[:5] for r in pieces) == want
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(r["length"] for r in pieces)
    assert len(sequences) <= -(-total // 1024) + 2
    ids = packing.pack(table(rows[:6]), vocabulary(BYTES)).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in ids)
    assert packing.digest(table(rows).where("false"), vocabulary(BYTES)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([8, 50, 300]))
    counts = {int(x): int(n) for x, n in enumerate(rng.integers(0, 40, size + 1)) if x and n}
    patterns = packing.plan_patterns(counts, size)
    used = Counter()
    for times, lengths in patterns:
        assert times > 0 and sum(lengths) <= size
        for x in lengths:
            used[x] += times
    assert used == Counter(counts)
    need = -(-sum(x * n for x, n in counts.items()) // size)
    assert sum(t for t, _ in patterns) <= need * 1.05 + 1


def test_exact_complements_fill_the_gap():
    left = np.zeros(101, np.int64)
    left[[70, 20, 10, 5]] = [1, 1, 1, 2]
    assert sorted(packing.exact_complement(left, 70, 30)) == [10, 20, 70]
    left[30] = 1
    assert packing.exact_complement(left, 70, 30) == [70, 30]
    left[[30, 20]] = 0
    assert packing.exact_complement(left, 70, 30) is None
    left[[5, 15]] = [2, 1]
    assert sorted(packing.exact_complement(left, 70, 30)) == [5, 10, 15, 70]
