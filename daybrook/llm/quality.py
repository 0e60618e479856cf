"""Quality rules as a short-circuit cascade.

A document is kept if no rule rejects it. Each rule's cost and rejection rate are measured on a bounded sample
(``SAMPLE_DOCS`` documents, chosen by a hash of the id); the rules then run in the order of rejections per second of
work, and a document leaves at its first rejection. The verdict is a conjunction, so the measured order, which may
differ from run to run, changes the work only, never the result.

Words are runs of anything but ASCII white space. Null and empty texts have no words and are rejected. Repeated rows and
equal ids are judged row by row; a null id stays null. Texts are judged whole, whatever their length. An empty table
gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import re
import time
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybrook.llm.common import id_text, texts_of

SAMPLE_DOCS = 400

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")  # fixed values: the symbol characters
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


class Features:
    """Features of one text, each computed at its first use."""

    def __init__(self, text: bytes):
        self.text = text
        self.words = text.split()  # for bytes: exactly the ASCII white space
        self.n_words = len(self.words)

    def __getattr__(self, name):
        value = getattr(self, f"_{name}")()
        self.__dict__[name] = value
        return value

    def _word_chars(self):
        joined = b"".join(self.words)
        return len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))

    def _n_symbols(self):
        return sum(self.text.count(s) for s in SYMBOLS)

    def _lines(self):
        return [line for line in self.text.split(b"\n") if line.strip()]

    def _n_dup_lines(self):
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self):
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered, end = 0, 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
        return covered

    def _n_letter_words(self):
        return sum(1 for w in self.words if _LETTER.search(w))

    def _n_shouted(self):
        return sum(1 for w in self.words if len(w) > 1 and w.isupper())

    def _n_distinct_words(self):
        return len(set(self.words))


# name -> rejects(features); integer arithmetic, so the borders are exact
RULES = {
    "few_words": lambda f: f.n_words < 50,
    "repeated_windows": lambda f: 100 * f.n_repeat_words > 50 * f.n_words,
    "symbols": lambda f: 100 * f.n_symbols > 10 * f.n_words,
    "repeated_lines": lambda f: 100 * f.n_dup_lines > 40 * len(f.lines),
    "word_length": lambda f: f.word_chars < 2 * f.n_words or f.word_chars > 15 * f.n_words,
    "few_letters": lambda f: 100 * f.n_letter_words < 60 * f.n_words,
    "shouting": lambda f: 100 * f.n_shouted > 60 * f.n_words,
    "few_distinct": lambda f: 100 * f.n_distinct_words < 5 * f.n_words,
}
BASE = ("few_words", "repeated_windows")
BASE_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, sample_docs=SAMPLE_DOCS, rules=None) -> list[tuple[str, float, float]]:
    """(rule, seconds per document, rejected share) on the sample; one task, one row per rule comes back."""
    rules = rules or RULES
    sample = (docs.select("text", F.xxhash64("doc_id").alias("h")).orderBy("h").limit(sample_docs)
              .select("text").coalesce(1))

    def trial(batches):
        seconds, rejected, n = Counter(), Counter(), 0
        for batch in batches:
            for text in texts_of(batch):
                n += 1
                for name, rule in rules.items():
                    fresh = Features(text)
                    start = time.perf_counter()
                    rejected[name] += bool(rule(fresh))
                    seconds[name] += time.perf_counter() - start
        names = list(rules) if n else []
        yield pa.RecordBatch.from_pydict({"rule": pa.array(names, pa.string()),
                                          "cost": pa.array([seconds[r] / n for r in names], pa.float64()),
                                          "share": pa.array([rejected[r] / n for r in names], pa.float64())})

    return [tuple(r) for r in sample.mapInArrow(trial, "rule string, cost double, share double").collect()]


def cascade_order(measured) -> list[str]:
    """Most rejections per second first; without a sample the written order."""
    return [r for r, _, _ in sorted(measured, key=lambda m: -(m[2] / max(m[1], 1e-9)))] or list(RULES)


def judge(docs: DataFrame, features=BASE_FEATURES, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, the asked features, ``base_failed`` and ``kept`` for every row of ``docs``."""
    slim = id_text(docs, id_col, text_col)
    order = cascade_order(measure(slim))
    schema = ", ".join(["doc_id bigint", *(f"{f} bigint" for f in features), "base_failed boolean", "kept boolean"])

    def run(batches):
        for batch in batches:
            columns = {f: [] for f in features}
            base, kept = [], []
            for text in texts_of(batch):
                f = Features(text)
                for name in features:
                    columns[name].append(getattr(f, name))
                failed = any(RULES[r](f) for r in BASE)
                base.append(failed)
                kept.append(not failed and not any(RULES[r](f) for r in order))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(columns[f], pa.int64()) for f in features),
                 pa.array(base, pa.bool_()), pa.array(kept, pa.bool_())],
                names=["doc_id", *features, "base_failed", "kept"])

    return slim.mapInArrow(run, schema)


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects. No shuffle: rows are filtered where they are read."""
    order = cascade_order(measure(id_text(docs)))

    def run(batches):
        for batch in batches:
            mask = []
            for text in texts_of(batch):
                f = Features(text or b"")
                mask.append(not any(RULES[r](f) for r in order))
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
