"""Secret and license scans against plain Python."""

import hashlib
import re

from daybrook.llm import licenses, secrets
from tests.llm.conftest import by_id

BASE = [("assign", re.compile(secrets.ASSIGN, re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
SECRETS = [
    (2000, "x token:token: abcdef1 Password = 'hunter22' api_key=abc"), (2100, "😀 secret: " + "ab12" * 12 + " AKIA" + "A1" * 9),
    (2200, "AKIA" + "B" * 15 + " and AKIA" + "B" * 16), (2300, "key zQ8xT4vLp0Rk9WnYc7Jd2MfHs5 in prose"), (2400, "0123456789abcdef" * 4000),
    (2500, "MixedCaseIdentifierOfAProgram and another_long_identifier_name"), (2500, "TOKEN=\"aaaaaa\"\nsecret = bbbbbbb"),
]


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
    return sorted(found)


def test_secrets_match_plain_regexes(table, sample, edges):
    rows = edges + SECRETS + sample
    want = []
    for doc, text in rows:
        spans = base_spans(text or "")
        joined = ",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in spans)
        want.append((doc, *(sum(k == x for _, k, _ in spans) for x in range(3)), hashlib.sha256(joined.encode()).hexdigest()))
    got = secrets.digest(table(rows))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert by_id(got.drop("spans")) == sorted(want, key=repr)


def test_markov_spans_hold_random_runs_only(table, sample):
    found = {r["doc_id"]: r["spans"] for r in secrets.digest(table(SECRETS[:6] + sample)).collect()}
    assert "markov:4:30" in found[2300]
    assert found[2500] == ""
    clean = [t for _, t in sample if t and not re.search(r"[0-9]", t)]
    assert clean and all("markov" not in found[i] for i, t in sample if t in clean)


def test_spans_hold_the_base_ones(table, sample):
    rows = SECRETS + sample
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(text or "")
    for r in secrets.digest(table(rows)).collect():
        own = {s for s in r["spans"].split(",") if s and not s.startswith("markov")}
        assert own in [{f"{BASE[k][0]}:{s}:{e}" for s, k, e in base_spans(t)} for t in texts[r["doc_id"]]]


def test_held_out_strings_are_told_apart(spark, table, sample):
    """The models on strings they were not trained on."""
    from pyspark.sql import functions as F
    weights = secrets.train(table(sample).select("doc_id", "text"))
    import random
    rng = random.Random(5)
    strange = ["".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(24)) for _ in range(300)]
    usual = [re.sub(r"[^A-Za-z]", "", t)[:24] for _, t in sample if t and len(t) > 200]
    rows = [(s, 1) for s in strange] + [(s, 0) for s in usual if len(s) == 24]
    ratio = spark.createDataFrame(rows, "s string, y int").select("y", (secrets.log_ratio(F.col("s"), weights) > 8).alias("hit")).collect()
    hits = [r["hit"] == bool(r["y"]) for r in ratio]
    assert sum(hits) / len(hits) > 0.97


def test_random_runs_with_few_digits_or_none_are_found(spark):
    """Recall by kind on strings of texts whose ids keep them out of the training sample; the other texts stay clean."""
    import random
    import string
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert docs.count() > secrets.ORDINARY_SAMPLE
    kinds = {"mixed": string.ascii_letters, "lower": string.ascii_lowercase, "upper": string.ascii_uppercase,
             "one digit": string.ascii_letters, "alphanumeric": string.ascii_letters + string.digits}
    last = spark.range(10**9, 10**9 + 5000).orderBy(F.xxhash64("id").desc()).limit(len(kinds)).collect()
    rng, rows, want = random.Random(11), [], {}
    for (doc,), (kind, letters) in zip(last, kinds.items()):
        text, want[doc] = "keys:", set()
        for n in [*range(16, 41, 4)] * 30:
            key = [rng.choice(letters) for _ in range(n)]
            if kind == "one digit":
                key[rng.randrange(n)] = rng.choice(string.digits)
            want[doc].add(f"markov:{len(text) + 1}:{len(text) + 1 + n}")
            text += " " + "".join(key)
        rows.append((doc, text))
    found = {r["doc_id"]: set(r["spans"].split(",")) for r in secrets.digest(docs.union(spark.createDataFrame(rows, docs.schema))).collect()}
    for (doc, _), kind in zip(rows, kinds):
        assert len(want[doc] & found[doc]) >= 0.97 * len(want[doc]), kind
    plain = [r["doc_id"] for r in docs.where("text not rlike '[0-9]'").collect()]
    assert len(plain) > 100 and not any("markov" in s for i in plain for s in found[i])


def test_redaction(table, edges):
    rows = edges + SECRETS
    docs = table(rows)
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (2200, "AKIA" + "B" * 15 + " and [SECRET]") in texts and (2400, "[SECRET]") in texts and (1, None) in texts
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())
    assert secrets.digest(docs.where("false")).count() == 0 and secrets.redact(docs.where("false")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LICENSES = [
    (3000, "Released under the MIT License."), (3100, "cc-by, CC by! cc by 4.0"), (3200, "GNU\nGeneral public  license, version 3; apache license"),
    (3300, "licence of Apache Software License, Version 2.0 and the apache license"), (3400, "mit licenses, submit license"), (3500, "é mit license " * 300),
    (3600, "Public domain. All rights reserved."), (3600, "MIT Lİcense"),
]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_licenses_match_word_positions(table, sample, edges):
    rows = edges + LICENSES + sample
    want = []
    for doc, text in rows:
        words = WORD.findall(lower(text or ""))
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places]
        want.append((doc, len(words), len(places), min(starts, default=None), max(starts, default=None),
                     ",".join(sorted({x for _, x in places}))))
    got = licenses.digest(table(rows))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert by_id(got.drop("labels", "score")) == sorted(want, key=repr)
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got.collect())


def test_license_rules_and_suppression(table):
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.digest(table(LICENSES[:4])).collect()}
    assert got[3000] == ("mit", 0.99)
    assert got[3200][0] == "apache,gpl,gpl-3"
    assert got[3300][0] == "apache,apache-2.0"
    detections = licenses.detect(table(LICENSES[:1])).first()["detections"]
    assert [(d["start"], d["end"], d["label"]) for d in detections] == [(0, 5, "mit")]  # the name inside is suppressed
    assert len(licenses.rules()) >= 250 and licenses.digest(table([(1, "x")]).where("false")).count() == 0


def wordings(regex):
    """Texts a rule's regex matches: every alternative, optional parts left out and taken."""
    def of(parsed):
        out = [""]
        for op, arg in parsed:
            op = str(op)
            if op == "LITERAL":
                more = [chr(arg)]
            elif op == "IN":
                more = [chr(v) if str(o) == "LITERAL" else chr(v[0]) if str(o) == "RANGE" else "x" for o, v in arg[:2]]
            elif op == "BRANCH":
                more = [t for branch in arg[1] for t in of(branch)]
            elif op == "SUBPATTERN":
                more = of(arg[3])
            elif op == "MAX_REPEAT":
                least, _, body = arg
                more = [t * n for t in of(body) for n in (least, least + 1)]
            elif op in ("ASSERT", "ASSERT_NOT"):
                more = [""]
            else:
                raise ValueError(op)
            out = list(dict.fromkeys(a + b for a in out for b in more))
        return out
    return of(re._parser.parse(regex))


def test_license_rules_imply_the_gate(table):
    gate = re.compile(licenses.GATE, re.A)
    for label, _, regex, _, _ in licenses.rules():
        for text in wordings(regex):
            assert gate.search(text.strip()) and gate.search(text.strip().upper().replace(" ", "_")), (label, text)
    rows = [(1, "This program is released under the GNU GPL version 2."), (2, "Dedicated under CC0 1.0"), (3, "mit no attribution"),
            (4, "public_domain"), (5, "no notice here")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.digest(table(rows)).collect()}
    assert [got[i][0].split("-2")[0] for i in range(1, 6)] == ["gpl", "cc0", "mit-0", "public-domain", ""]
    assert all(got[i][1] > 0 for i in range(1, 5)) and got[5][1] == 0


def test_each_license_signature_finds_its_text(table):
    texts, labels = [], []
    for label, _, regex, _, _ in licenses.rules():
        texts.append(max(wordings(regex), key=len))
        labels.append(label)
    for label, regex in licenses.IDS:
        texts += [f"// SPDX-License-Identifier: {t}" for t in wordings(regex)]
        labels += [label] * len(wordings(regex))
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.digest(table(list(enumerate(texts)))).collect()}
    assert [(texts[i], label, got[i]) for i, label in enumerate(labels) if label not in got[i]] == []


NOTICES = [
    ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"), ("Licensed under GPLv3", "gpl-3"), ("released under MIT", "mit"), ("GNU GPL, version 2", "gpl-2"),
    ('"license": "MIT OR Apache-2.0"', "apache-2.0,mit"), ("SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR MIT) AND ISC", "gpl-2,isc,mit"),
    ("SPDX-License-Identifier: GPL-2.0 WITH OpenSSL-exception OR ISC and more", "gpl-2,isc"), ("licensed under MIT and something else", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"), ("Redistribution and use in source and binary forms", "bsd"),
    ("Neither the name of the University nor the names of its contributors", "bsd-3-clause"), ("under LGPL 2.1 or later", "lgpl-2.1"),
    ("Isc and zlib are words, so is mit; the Apache web server, Ruby and JSON", ""), ("license mit" + " or mit" * 2_000 + " or isc", "isc,mit"),
]


def test_common_license_notices(table):
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.digest(table([(i, t) for i, (t, _) in enumerate(NOTICES)])).collect()}
    assert [got[i][0] for i in range(len(NOTICES))] == [labels for _, labels in NOTICES]
    assert all((got[i][1] > 0) == bool(labels) for i, (_, labels) in enumerate(NOTICES))


def test_scans_use_no_python(table, capsys):
    for df in (secrets.digest(table(SECRETS)), licenses.digest(table(LICENSES)), secrets.redact(table(SECRETS))):
        df.explain()
        assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
