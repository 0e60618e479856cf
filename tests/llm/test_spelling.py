"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from daybrook.llm import spelling
from tests.llm.conftest import by_id


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:k] + y[k + 1:] == x for k in range(len(y)))


def plain(rows):
    words = counted(rows)
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()), key=repr)


def random_rows(seed, n=150):
    rng = random.Random(seed)
    letters = "abàÿ×c"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 12))) for _ in range(25)]
    base += ["prefixes" + "".join(rng.choice(letters) for _ in range(4)) for _ in range(25)] + ["aaaaa", "aaaaaa", "aaaaaaa"]
    rows = []
    for doc in range(n):
        words = []
        for _ in range(rng.randrange(0, 60)):
            word = rng.choice(base[:rng.randrange(1, len(base) + 1)])
            if rng.random() < 0.4:
                k = rng.randrange(len(word) + 1)
                word = word[:k] + rng.choice(["", rng.choice(letters), rng.choice(letters).upper()]) + word[k + rng.randrange(2):]
            words.append(word)
        rows.append((rng.choice([doc, None]), rng.choice([" ", "-", "1", "漢"]).join(words)))
    return rows + [(1, None), (2, ""), (3, "x" * 20000)] + [(k, ("y" * 9000 + " ") + ("y" * 9001 + " ") * 3) for k in (4, 5, 6)]


@pytest.mark.parametrize("seed, tile", [(1, 256), (2, 8), (3, 1)])
def test_digest_equals_brute_force(table, monkeypatch, seed, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(spelling, "ROWS_PER_TASK", 500)
    monkeypatch.setattr(spelling, "HELD", 20)
    rows = random_rows(seed)
    assert by_id(spelling.digest(table(rows))) == plain(rows)


def test_real_texts(table, sample):
    assert by_id(spelling.digest(table(sample))) == plain(sample)


def test_words_that_share_most_letters_are_divided(spark, monkeypatch):
    rng = random.Random(5)
    words = sorted({"common" + "".join(rng.choice("abcd") for _ in range(5)) + "ending" for _ in range(600)})
    rows = spelling.families(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint"), tile=16).collect()
    sizes = Counter(r["family"] for r in rows)
    assert max(sizes.values()) <= 16
    met = {(x["word"], y["word"]) for f in [[r for r in rows if r["family"] == k] for k in sizes] for x in f for y in f}
    assert all((x, y) in met for x in words for y in words if one_edit(x, y))


def test_edges(table, edges):
    assert by_id(spelling.digest(table(edges * 3))) == plain(edges * 3)
    assert spelling.digest(table(edges).limit(0)).collect() == []
