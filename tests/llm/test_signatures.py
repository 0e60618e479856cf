"""Near duplicates by signatures against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from daybrook.llm import groups, signatures
from tests.llm.conftest import by_id


def shingle_set(text):
    words = [w for w in re.split(r"[ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def plain(rows):
    sets = [shingle_set(t) if i is not None else frozenset() for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if sets[k]:
            least[find(k)] = min(i, least.get(find(k), i))
    out = []
    for k, (i, t) in enumerate(rows):
        own = None if i is None else least[find(k)] if sets[k] else i
        out.append((i, len(shingle_set(t)), own, None if i is None else own == i))
    return sorted(out, key=repr)


def near_rows(seed, families=6, copies=14):
    """Groups whose members drift from a common text by different amounts, around the threshold; and a shared passage."""
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    for _ in range(families):
        base = [word() for _ in range(rng.choice([3, 12, 60, 150]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 14))):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own[:rng.randrange(max(1, len(own) * 4 // 5), len(own) + 1)]))
    for _ in range(40):
        rows.append(" ".join(passage + [word() for _ in range(rng.choice([3, 8, 14, 20, 60]))]))
    rng.shuffle(rows)
    return [(2 * i + 5, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, tight", [(1, False), (2, True)])
def test_components(table, edges, monkeypatch, seed, tight):
    if tight:  # every list and group in several cells
        monkeypatch.setattr(signatures, "LIST", 6)
        monkeypatch.setattr(groups, "GROUP", 400)
        monkeypatch.setattr(signatures, "BLOCK", 2000)
        monkeypatch.setattr(groups, "BROADCAST_ROWS", 0)
    rows = near_rows(seed) + edges
    assert by_id(signatures.assign(table(rows))) == plain(rows)


def test_real_texts(table, sample):
    assert by_id(signatures.assign(table(sample))) == plain(sample)


def test_large_group_yields_few_rows(table):
    rng = random.Random(9)
    base = [str(rng.random()) for _ in range(80)]
    rows = []
    for k in range(1500):
        own = list(base)
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = str(rng.random())
        rows.append((k, " ".join(own)))
    got = {r["doc_id"]: r["component_id"] for r in signatures.assign(table(rows)).collect()}
    sets = {k: shingle_set(t) for k, t in rows}
    # every direct link stays inside a component
    assert all(got[a] == got[b] for a in range(0, 1500, 50) for b in range(1500)
               if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    forest = groups.spanning(1500, lambda x, rest: np.ones(len(rest), bool))
    assert len(forest) == 1499


def test_edges(table, edges):
    assert by_id(signatures.assign(table(edges * 3))) == plain(edges * 3)
    assert signatures.assign(table(edges).limit(0)).collect() == []
    long = [(1, "a b c " * 200_000), (2, "a b c " * 200_000 + "d"), (3, "x " * 9)]
    assert by_id(signatures.assign(table(long))) == plain(long)
