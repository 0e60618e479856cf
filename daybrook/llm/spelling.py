"""Spelling variant grouping by dense prefix-suffix tiles.

1. Letter runs are counted per document and task in Arrow batches, then summed; words of ``MIN_CHARS`` code points and
   ``MIN_COUNT`` occurrences form the vocabulary. Everything after this is as large as the vocabulary.
2. Two words whose longer one has m code points are one edit apart exactly if common prefix plus common suffix reach
   m - 1. So either the prefix has at least half of m - 1, or the suffix has the rest. Words meet in *families*: the longer
   length m, a prefix of ``a`` and a suffix of ``b`` code points in common. Each word enters the families of its own length
   and of the next one, as the shorter word.
3. A family of more than ``TILE`` words is divided by the same rule on the part between its prefix and its suffix, until it
   is small or nothing is left between: then its words differ in one place, and there are no more of them than letters. So
   no family grows with the table and no pair is lost. ``first`` (a prefix length that pairs must not reach) leaves each
   pair to exactly one family.
4. Families are dealt to tasks by hash. In a task the words are rows of padded code-point matrices, one aligned left, one
   aligned right; all pairs of a family's rows form a dense tile, tiles lie end to end in chunks of bounded size, and one
   comparison of matrices gives all common prefixes and suffixes of a chunk. Only sums and the best neighbour per word leave.
5. A word's form is the near word of largest count (ties: smallest), if that is at least twice its own. Counts at least
   double along forms, so following them ends; roots are found by doubling the step.

Null texts have no words. A null id is written as nothing before the colon. Repeated rows and equal ids count row by row.
Texts and words of any length are read whole. Extra columns are left behind. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybrook.llm.common import id_text, materialize, shards_for, texts_of

MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
EVERY = 97  # one run in so many loses a letter
TILE = 256
ROWS_PER_TASK = 50_000
CHUNK_BYTES = 16 << 20
HELD = 300_000  # distinct words a task holds before it passes them on

# fixed value: the letters A-Z, a-z and U+00C0 to U+00FF, in UTF-8
RUNS = re.compile(rb"(?:[A-Za-z]+|\xc3[\x80-\xbf])+")


def word_size(word: bytes) -> int:
    return len(word) if word.isascii() else len(word) - word.count(b"\xc3")


def without(word: bytes, place: int) -> bytes:
    if word.isascii():
        return word[:place] + word[place + 1:]
    letters = word.decode()
    return (letters[:place] + letters[place + 1:]).encode()


def words_of(doc_id, text: bytes):
    """(word, occurrences) of one document; a run that loses a letter loses it everywhere in the document."""
    start = crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run, n in Counter(RUNS.findall(text.lower())).items():  # for bytes, lower() changes A-Z only
        drawn = crc32(run, start)
        if not drawn % EVERY:
            run = without(run, drawn % word_size(run))
        if word_size(run) >= MIN_CHARS:
            yield run, n


def vocabulary(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(word, n) of the words that occur often enough, stored."""
    def count(batches):
        held = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()),
                                                pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                for word, n in words_of(doc_id, text):
                    held[word] += n
                if len(held) > HELD:
                    yield flush()
        yield flush()

    counted = id_text(docs, id_col, text_col).mapInArrow(count, "word string, n bigint")
    return materialize(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT), "vocabulary")


def _divided(rows: DataFrame) -> DataFrame:
    """Each row in the two families that its family divides into: a longer prefix, or else a longer suffix."""
    rest = F.col("m") - 1 - F.col("a") - F.col("b")
    half = F.ceil(rest / 2).cast("int")
    longer = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("first").alias("first"))
    other = F.struct(F.col("a").alias("a"), (F.col("b") + rest - half + 1).alias("b"),
                     F.least("first", F.col("a") + half).alias("first"))
    parts = rows.select("word", "n", "m", F.explode(F.array(longer, other)).alias("f")).select("word", "n", "m", "f.*")
    return parts.withColumn("family", _family())


def _family() -> Column:
    """Names a family: 64 bits of what its words share. A false match costs a comparison, never a result."""
    size = F.length("word")
    return F.xxhash64("m", "a", "b", "first", F.substring(F.col("word"), F.lit(1), F.col("a")),
                      F.substring(F.col("word"), size - F.col("b") + 1, F.col("b")))


def families(words: DataFrame, tile=None) -> DataFrame:
    """(word, n, m, first, family): rows of families of at most ``tile`` words, or of words that differ in one place."""
    tile = tile or TILE
    size = F.length("word").cast("int")
    whole = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m")).select(
        "word", "n", "m", F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("m").alias("first"))
    rows, ready = materialize(_divided(whole), "families"), []
    while True:
        # only families that may be divided are looked up; the rest stays where it is
        large = materialize(rows.where("a + b < m - 1").groupBy("family").count().where(F.col("count") > tile).select("family"),
                            "large-families")
        if large.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(large, "family", "left_anti").select(*rows.columns))
        rows = materialize(_divided(rows.join(large, "family")), "families")
    out = ready[0]
    for more in ready[1:]:
        out = out.unionByName(more)
    return out.select("word", "n", "m", "first", "family")


def _tiles(words: list[str], family: np.ndarray, first: np.ndarray, m: int):
    """Indices (i, j) of all single edits among words of ``m`` or ``m - 1`` code points, family by family."""
    count = len(words)
    size = np.fromiter(map(len, words), np.int64, count)
    left = np.zeros((count, m), np.uint8)
    right = np.zeros((count, m), np.uint8)
    for k, word in enumerate(words):
        codes = np.frombuffer(word.encode("latin-1"), np.uint8)
        left[k, :len(codes)] = codes
        right[k, m - len(codes):] = codes
    right = right[:, ::-1]
    ends = np.append(np.flatnonzero(family[1:] != family[:-1]) + 1, count)
    behind = np.repeat(ends, np.diff(np.append(0, ends))) - np.arange(count) - 1  # rows of the same family after each row
    step = max(1, CHUNK_BYTES // (4 * m))
    total = np.cumsum(behind)
    at = 0
    while at < count:
        # as many rows as fill a chunk; one row has fewer partners than its family has words
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step, "right")))
        many = behind[at:stop]
        i = np.repeat(np.arange(at, stop), many)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        at = stop
        chosen = np.maximum(size[i], size[j]) == m
        i, j = i[chosen], j[chosen]
        for start in range(0, len(i), step):
            x, y = i[start:start + step], j[start:start + step]
            prefix = np.argmin(left[x] == left[y], axis=1)
            suffix = np.argmin(right[x] == right[y], axis=1)
            near = (prefix + suffix >= m - 1) & (prefix < first[x])
            yield x[near], y[near]


def neighbours(rows: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): near words of every word that has any."""
    shards = shards_for(rows.count(), ROWS_PER_TASK)

    def compare(key, table):
        table = table.sort_by([("m", "ascending"), ("family", "ascending"), ("word", "ascending")])
        n, m, first, family = (table.column(c).to_numpy() for c in ("n", "m", "first", "family"))
        words = table.column("word").to_pylist()
        found, starts = {}, np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        for start, stop in zip(starts, np.append(starts[1:], len(m))):
            own = words[start:stop]
            for i, j in _tiles(own, family[start:stop], first[start:stop], int(m[start])):
                for x, y in zip(i.tolist(), j.tolist()):
                    for word, other, count in ((own[x], own[y], n[start + y]), (own[y], own[x], n[start + x])):
                        near, best = found.get(word, (0, None))
                        rank = (-count, other)
                        found[word] = near + 1, rank if best is None or rank < best else best
        return pa.table({"word": pa.array(list(found), pa.string()),
                         "near": pa.array([v[0] for v in found.values()], pa.int64()),
                         "form": pa.array([v[1][1] for v in found.values()], pa.string()),
                         "form_n": pa.array([-v[1][0] for v in found.values()], pa.int64())})

    parts = (rows.withColumn("shard", F.pmod("family", F.lit(shards))).groupBy("shard")
             .applyInArrow(compare, "word string, near bigint, form string, form_n bigint"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; ``forms``: (word, form). Steps double, so rounds are few."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        far = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(now.join(far, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                 F.col("further").isNotNull().alias("moved")), "forms")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def digest(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary."""
    words = vocabulary(docs, id_col, text_col)
    near = neighbours(families(words))
    chosen = F.col("form_n") >= RATIO * F.col("n")
    named = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(chosen, F.col("form")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n")), "variants")
    ends = roots(named.where("form IS NOT NULL"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
