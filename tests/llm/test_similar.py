"""N-gram Jaccard join, components, suffix dedup and nearest neighbours against brute force."""

import hashlib
import random

import numpy as np
import pytest

from daybrook.llm import ann, common, components, groups, jaccard, suffix_dedup
from tests.llm.conftest import by_id


def shingle_set(text):
    words = [w for w in __import__("re").split(r"[ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def plain_components(rows):
    sets = [shingle_set(t) if i is not None else frozenset() for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None and sets[k]:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(shingle_set(t)), None if i is None else least[find(k)] if sets[k] else i)
                   for k, (i, t) in enumerate(rows)), key=repr)


def near_rows(seed, groups=6, copies=14):
    """Groups whose members drift from a common text by different amounts, around the threshold; and a shared passage."""
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    for g in range(groups):
        base = [word() for _ in range(rng.choice([4, 12, 60, 150]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own[:rng.randrange(max(1, len(own) * 4 // 5), len(own) + 1)]))
    for k in range(40):
        rows.append(" ".join(passage + [word() for _ in range(rng.choice([3, 8, 14, 20, 60]))]))
    rng.shuffle(rows)
    return [(2 * i + 5, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, tight", [(1, False), (2, True)])
def test_jaccard_components(table, sample, edges, monkeypatch, seed, tight):
    if tight:  # many blocks, frequent shingles, groups in cells, no broadcast
        for module, name, value in ((jaccard, "BLOCK", 60), (jaccard, "BLOCKS_PER_SHARD", 5), (groups, "GROUP", 400), (groups, "BROADCAST_ROWS", 0)):
            monkeypatch.setattr(module, name, value)
    rows = edges + [(900 + i, "Same WORDS here") for i in range(3)] + [(910, "same words here"), (911, "same words there")]
    rows += [(1000 + i, t) for i, t in near_rows(seed)] + sample + sample[:2]
    assert by_id(jaccard.assign(table(rows))) == plain_components(rows)


def test_jaccard_links_and_filter(table):
    rows = near_rows(3)
    docs = table(rows)
    sets = dict((i, shingle_set(t)) for i, t in rows)
    rows_out, nodes, links = jaccard.join(docs)
    rep = {r["id"]: r["rep"] for r in nodes.collect()}
    for r in links.collect():
        x, y = sets[rep[r["a"]]], sets[rep[r["b"]]]
        assert 100 * len(x & y) >= 75 * len(x | y)
    want = [i for i, _, c in plain_components(rows) if i == c]
    kept = jaccard.keep_first(docs)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    clash = docs.selectExpr("*", "1 AS __loser", "2 AS node", "3 AS component_id", "4 AS label")
    assert jaccard.keep_first(clash).columns == clash.columns and jaccard.keep_first(clash).count() == kept.count()
    assert jaccard.assign(docs.where("false")).count() == 0 and jaccard.keep_first(docs.where("false")).count() == 0


def test_jaccard_nodes_of_one_label(table, monkeypatch):
    """Entries of several sets under one label: the sets are compared with each other, and nobody loses a link."""
    monkeypatch.setattr(jaccard, "label_of", lambda node: node[0] & 3)
    rows = near_rows(5)
    assert by_id(jaccard.assign(table(rows))) == plain_components(rows)


def test_packed_entries_are_small():
    rng = np.random.default_rng(3)
    labels = np.sort(rng.integers(0, 1 << 40, 200).astype(np.uint64).repeat(20))
    tokens = rng.integers(0, 1 << 32, len(labels)).astype(np.uint64)
    assert (common.unpack_sorted(common.pack_sorted(labels), len(labels)) == labels).all()
    assert (common.unpack(common.pack(tokens), len(tokens)) == tokens).all()
    assert len(common.pack_sorted(labels)) + len(common.pack(tokens)) < 5 * len(labels)


def test_keep_first_moves_no_text(table, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jaccard.keep_first(table(near_rows(3)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_unlinked_texts_that_share_a_passage(table):
    """The passage is half of each text: no links, however many texts hold it, and few rows on the way."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(rng.randrange(20, 30))])) for i in range(400)]
    rows += [(1000 + i, " ".join(rows[i][1].split()[:-2])) for i in range(0, 400, 20)]
    assert by_id(jaccard.assign(table(rows))) == plain_components(rows)


def test_prefix_bounds_hold():
    """For random linked sets in a common order the shared prefix shingles reach both nodes' bounds."""
    rng = random.Random(12)
    for _ in range(3000):
        n = rng.randrange(1, 60)
        x = set(rng.sample(range(200), n))
        y = set(rng.sample(sorted(x), rng.randrange(max(1, n * 3 // 4), n + 1))) | set(rng.sample(range(200, 400), rng.randrange(0, n // 4 + 1)))
        if 100 * len(x & y) < 75 * len(x | y):
            continue
        heads = [set(sorted(s)[:int(jaccard.prefix_size(len(s), jaccard.extra(len(s))))]) for s in (x, y)]
        shorts = [set(sorted(s)[:int(jaccard.prefix_size(len(s)))]) for s in (x, y)]
        assert len(heads[0] & heads[1]) >= max(jaccard.shared_bound(len(s)) for s in (x, y)) and shorts[0] & shorts[1]


def test_a_chain_is_one_component(spark):
    n = 60
    edges = [(i, i + 1) for i in range(n)] + [(100, 200), (200, 150), (7, 7)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 100: 100, 150: 100, 200: 100}


def plain_suffix(rows, length=50):
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for p in range(len(b) - length + 1):
                s = b[p:p + length]
                least[s] = min(i, least.get(s, i))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        if i is not None:
            for p in range(len(b) - length + 1):
                if least[b[p:p + length]] < i:
                    gone[p:p + length] = True
        runs = int((np.diff(gone.astype(int)) == 1).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeat_rows(seed):
    rng = random.Random(seed)
    text = lambda n, letters="abcdé \n": "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n) for n in (49, 50, 51, 80, 300)]
    rows = []
    for i in range(40):
        parts = [text(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) - 40)
            parts += [p[a:], text(rng.randrange(0, 30))]
        rows.append((rng.randrange(0, 60), "".join(parts)))
    return rows + [(70, "ab" * 200), (71, "x" + "ab" * 90), (72, "a" * 49), (73, "a" * 50), (74, "a" * 500), (75, "\x00" * 60), (76, "y\x00" * 5 + "\x00" * 70),
                   (None, passages[4]), (77, text(3, "z") + passages[4] + "w")]


@pytest.mark.parametrize("seed, tight", [(1, False), (2, True)])
def test_suffix_dedup(table, sample, edges, monkeypatch, seed, tight):
    if tight:
        for name, value in (("PACK_BYTES", 700), ("SEGMENT_BYTES", 100), ("ANCHORS_PER_SHARD", 50), ("CONTEXTS_PER_SHARD", 20)):
            monkeypatch.setattr(suffix_dedup, name, value)
    rows = edges + [(None if i is None else 1000 + i, t) for i, t in repeat_rows(seed)] + [(i + 10, t) for i, t in sample[:60]]
    rows += [(5000, sample[3][1]), (5001, sample[3][1][40:])]
    got = suffix_dedup.digest(table(rows))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert by_id(got) == plain_suffix(rows)
    assert suffix_dedup.digest(table(rows).where("false")).count() == 0


def test_contexts_of_a_common_phrase_are_dealt_out(table, monkeypatch):
    """A phrase with other words around it: no key gathers its contexts, and results stay exact."""
    for name, value in (("PACK_BYTES", 3000), ("HOT_PLACES", 8), ("CONTEXTS_PER_SHARD", 50)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(4)
    words = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(i, words(60) + " a phrase of about thirty byte " + words(60)) for i in range(150)]
    rows += [(150 + i, words(20) + rows[i][1][10:130] + words(20)) for i in range(30)] + [(None, rows[3][1]), (7, rows[5][1])]
    assert by_id(suffix_dedup.digest(table(rows))) == plain_suffix(rows)
    packs = suffix_dedup.pack_documents(table(rows).select("doc_id", "text"))
    repeated = suffix_dedup.repeated_anchors(packs, 2)
    texts = {}
    for r in suffix_dedup.contexts(packs, repeated, 2, 4).where("kind = 1").collect():
        _, keys, count, _, _, _, raw = suffix_dedup._unpack_arrays(r["cell"], np.int64, np.uint64, np.int32, np.int32, np.int32, np.int32, np.uint8)
        ends = np.cumsum(count + suffix_dedup.LENGTH - 1)
        for key, b, e in zip(keys.tolist(), [0, *ends.tolist()], ends.tolist()):
            texts.setdefault(key, set()).add(raw[b:e].tobytes())
    assert texts and max(map(len, texts.values())) <= 8


@pytest.mark.parametrize("seed", range(4))
def test_repeat_groups_are_maximal(seed):
    """Against all pairs: groups of a text over two letters."""
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(4, 30))) for _ in range(6)]
    counts = np.array([max(1, len(t) - 2) for t in texts])
    owner, place, lcp = suffix_dedup.suffix_array(texts, counts)
    order = [texts[o][p:] for o, p in zip(owner, place)]
    assert order == sorted(order)
    before = [texts[o][p - 1] if p else -1 for o, p in zip(owner, place.tolist())]
    found = {(length, frozenset(zip(owner[a:b].tolist(), place[a:b].tolist()))) for a, b, length in suffix_dedup.repeat_groups(lcp, before, 3)}
    every = [(o, p) for o, t in enumerate(texts) for p in range(counts[o])]
    want = set()
    for o, p in every:
        for length in range(3, len(texts[o]) - p + 1):
            s = texts[o][p:p + length]
            at = [(x, q) for x, q in every if texts[x][q:q + length] == s]
            follow = {texts[x][q + length:q + length + 1] or (x, q) for x, q in at}
            lead = {texts[x][q - 1] if q else (x, q) for x, q in at}
            if len(at) > 1 and len(follow) > 1 and len(lead) > 1:
                want.add((length, frozenset(at)))
    assert found == want


def vectors(seed, n=1500, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, d))
    rows = [(i, (centres[rng.integers(20)] + 0.4 * rng.normal(size=d)).astype(np.float32).tolist(), 0) for i in range(n)]
    hot = rows[3][1]
    rows += [(n + i, hot, 1) for i in range(400)]  # a hot vector
    rows += [(5000, None, 1), (5050, [0.0] * d, 1), (5100, [float("nan")] * d, 1), (5150, [1.0] * (d - 1) + [None], 1),
             (5200, [float("inf")] + [1.0] * (d - 1), 1), (None, hot, 1), (5250, [1.0] * (d + 1), 1), rows[0], (50, rows[7][1], 2)]
    return rows


def brute(rows, is_query, k=5):
    good, seen = [], set()
    for i, v, _ in rows:
        if i is not None and v is not None and len(v) == 12 and None not in v and np.isfinite(v).all() and np.any(v) and (i, tuple(v)) not in seen:
            seen.add((i, tuple(v)))
            good.append((i, np.array(v, np.float32).astype(np.float64)))
    x = np.array([v for _, v in good])
    ids = np.array([i for i, _ in good])
    out = {}
    for i, v in good:
        if is_query(i):
            scores = ann.cosine(np.broadcast_to(v, x.shape), x)
            out.setdefault(i, []).extend((-s, c) for s, c in zip(scores.tolist(), ids.tolist()) if c != i)
    best = {i: {c: min(s for s, x in found if x == c) for c in {c for _, c in found}} for i, found in out.items()}
    return {i: [(c, -s) for s, c in sorted((s, c) for c, s in found.items())[:k]] for i, found in best.items()}


@pytest.mark.parametrize("cells", [20_000, 30])
def test_nearest_neighbours(spark, monkeypatch, cells):
    monkeypatch.setattr(ann, "CELL_ROWS", cells)
    rows = vectors(4)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int").repartition(4)
    got = ann.digest(table)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute(rows, lambda i: i % 50 == 0)
    assert set(found) == set(want) and all(len(found[q]) == 5 for q in want)
    hits = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    hot = [q for q in want if q >= 1500 and q < 1900]
    assert hot and all(found[q] == want[q] for q in hot)  # exact ties go to the smallest ids


def test_every_leaf_is_exact(spark):
    rows = vectors(5, n=700)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    found = {}
    for r in ann.search(table, "vec_id % 50 = 0", recall=1.0).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = brute(rows, lambda i: i % 50 == 0)
    hits = sum(len(set(found[q].values()) & set(want[q])) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))


def test_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 2.0])], schema)
    got = [tuple(r)[:3] for r in ann.digest(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert ann.digest(few.where("false")).count() == 0
    assert ann.digest(spark.createDataFrame([(0, None), (50, [0.0])], schema)).count() == 0
