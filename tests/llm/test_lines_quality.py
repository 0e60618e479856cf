"""Line dedup, its hash, and quality rules against plain Python."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from daybrook.llm import line_dedup, mph, quality, secrets
from daybrook.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import by_id

LONG = "A line that is certainly long enough to count"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 5000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    h1, h2 = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
    seeds = mph.build(h1, h2)
    assert sorted(mph.slots(seeds, h1, h2, n).tolist()) == list(range(n))


def plain_dedup(rows):
    strip = lambda l: l.strip(" \t\n\x0b\x0c\r")
    key = lambda l: "".join(c.lower() if "A" <= c <= "Z" else c for c in strip(l))
    holders = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [doc is not None and len(key(l)) >= 40 and len(holders[key(l)]) >= 5 and max(holders[key(l)]) != doc for l in lines]
        kept = "\n".join(l for l, g in zip(lines, gone) if not g)
        out.append((doc, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows(sample, edges):
    hot = [(100 + i, f"own {i}\n {LONG.upper() if i % 2 else LONG}\t\nend\n{LONG}") for i in range(9)]
    four = [(200 + i, "é" * 40) for i in range(4)] + [(300 + i, "é" * 39) for i in range(6)] + [(200, "é" * 40)]
    return edges + hot + four + sample + sample[:3]


def test_line_dedup(table, sample, edges):
    rows = line_rows(sample, edges)
    assert by_id(line_dedup.digest(table(rows))) == plain_dedup(rows)


def test_line_dedup_with_divided_shards(table, sample, edges, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 50)
    monkeypatch.setattr(line_dedup, "PROBES_PER_CELL", 20)
    rows = line_rows(sample, edges)
    assert by_id(line_dedup.digest(table(rows))) == plain_dedup(rows)


def test_line_dedup_keeps_columns(table, edges):
    docs = table(edges + [(100 + i, LONG) for i in range(6)])
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    texts = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()}
    assert (105, LONG, len(LONG)) in texts and (100, "", 0) in texts and (1, None, None) in texts
    assert line_dedup.digest(docs.where("false")).count() == 0


def plain_quality(text):
    words = [w for w in __import__("re").split(r"[ \t-\r]+", text or "") if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    lines = [l for l in (text or "").split("\n") if l.strip(" \t\n\x0b\x0c\r")]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_features(table, sample, edges):
    rows = edges + [(50, "a b c " * 40), (51, "x y \x1c z\n" * 30)] + [(i, (t or "")[:1500]) for i, t in sample]
    got = quality.judge(table(rows))
    assert got.columns == ["doc_id", *quality.BASE_FEATURES, "base_failed", "kept"]
    assert by_id(got.drop("kept")) == sorted(((i, *plain_quality(t)) for i, t in rows), key=repr)


def test_quality_verdict_is_the_conjunction_in_any_order(table, sample, edges):
    rows = edges + sample
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(not any(rule(quality.Features((t or "").encode())) for rule in quality.RULES.values()))
    assert all(r["kept"] in texts[r["doc_id"]] and not (r["base_failed"] and r["kept"]) for r in quality.judge(table(rows)).collect())
    measured = [("a", 1.0, 0.5), ("b", 0.1, 0.4), ("c", 0.5, 0.0)]
    assert quality.cascade_order(measured) == ["b", "a", "c"] and set(quality.cascade_order([])) == set(quality.RULES)


def test_quality_filter(table, sample, edges):
    docs = table(edges + sample)
    kept = quality.keep_documents(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in quality.judge(docs).where("kept").collect())
    assert quality.judge(docs.where("false")).count() == 0 and quality.keep_documents(docs.where("false")).count() == 0


def test_quality_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 AND toxic = 0")
    judged = QUERIES["op5_quality_rules"](spark, sf).join(labels, "doc_id").where("NOT base_failed")
    assert judged.where("kept").count() >= 0.99 * judged.count()


def test_registered_line_dedup_equals_sql(spark):
    from tools.compare import compare, connect
    sf = "/root/testdata/sf0.001"
    ok, _, message = compare(spark, connect(sf), sf, QUERIES["op10_line_dedup"], ORACLES["op10_line_dedup"])
    assert ok, message


def test_columns_of_any_name_stay(table):
    """Columns named like intermediate ones go through line dedup and redaction untouched."""
    line = "a line of more than forty characters, the same everywhere"
    docs = table([(i, f"{line}\nown {i} password = hunter2hunter2") for i in range(6)])
    clash = docs.selectExpr("*", "1 AS dropped", "2 AS __doc", "3 AS line_doc", "4 AS line_hashes", "5 AS __secret_run", "6 AS __secret_spans")
    cut = line_dedup.drop_repeated_lines(clash)
    assert cut.columns == clash.columns and cut.where("text LIKE 'a line%'").count() == 1
    clean = secrets.redact(cut)
    row = clean.first()
    assert clean.columns == clash.columns and "hunter2" not in row["text"]
    assert (row["dropped"], row["__doc"], row["line_doc"], row["line_hashes"], row["__secret_run"], row["__secret_spans"]) == (1, 2, 3, 4, 5, 6)
