"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

All of it is DataFrame code. Two first-order models over the characters of ``ALPHABET`` are trained from labelled samples:
*random* strings, derived from hashes (base-64, hexadecimal and base-32-like forms of ``RANDOM_SAMPLE`` digests), and
*ordinary* identifiers, the words of ``ORDINARY_SAMPLE`` documents chosen by a hash of their id. A run of at least
``MIN_RUN`` characters that holds a letter is reported when its log-likelihood ratio exceeds ``MIN_TOTAL`` in
all and ``MIN_MEAN`` per character. The models are two bounded tables of counts; every text is scanned whole.

Spans are code points, end exclusive, ordered by start and then by kind as in ``KINDS``; spans of different kinds may
overlap. Null and empty texts have no spans. Rows are judged one by one, so repeated rows and equal ids repeat their
result and null ids stay null. Empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from daybrook.llm.common import id_text, unused
from daybrook.llm.spans import spans_where

# fixed values: the base patterns of the result definition
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"  # runs of 24 and more are the maximal runs that pass
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE, MIN_ACCESS = 6, 20

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
MIN_RUN = 16
RUN = rf"[A-Za-z0-9+/_-]{{{MIN_RUN},}}"
RANDOM_SAMPLE, ORDINARY_SAMPLE = 3000, 600
MIN_TOTAL, MIN_MEAN = 8.0, 0.5
SMOOTHING, BACKOFF = 0.5, 10.0


def _bigram_counts(strings: DataFrame) -> dict[str, int]:
    """Counts of neighbouring characters of the column ``s``: at most the square of the alphabet."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))
    rows = strings.where(F.length("s") > 1).select(F.explode(pairs).alias("pair")).groupBy("pair").count().collect()
    return {r["pair"]: r["count"] for r in rows}


def random_strings(spark, n=RANDOM_SAMPLE) -> DataFrame:
    digest = F.sha2(F.col("id").cast("string"), 256)
    forms = F.array(F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.substring(digest, 1, 40),
                    F.upper(F.substring(F.base64(F.unhex(F.reverse(digest))), 1, 40)))
    return spark.range(n).select(F.explode(forms).alias("s")).select(F.regexp_replace("s", "=", "").alias("s"))


def ordinary_strings(slim: DataFrame, n=ORDINARY_SAMPLE) -> DataFrame:
    sample = slim.select("text", F.xxhash64("doc_id").alias("h")).orderBy("h").limit(n)
    return sample.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9_-]{4,}"), F.lit(0))).alias("s"))


def _probabilities(pairs: dict[str, int]) -> dict[str, float]:
    """Of a character after another; what a character rarely or never precedes falls back on how often characters occur at all."""
    after = {b: sum(pairs.get(a + b, 0) for a in ALPHABET) for b in ALPHABET}
    everything, out = sum(after.values()) + len(ALPHABET) * SMOOTHING, {}
    for a in ALPHABET:
        total = sum(pairs.get(a + b, 0) for b in ALPHABET)
        for b in ALPHABET:
            out[a + b] = (pairs.get(a + b, 0) + BACKOFF * (after[b] + SMOOTHING) / everything) / (total + BACKOFF)
    return out


def train(slim: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of neighbouring characters, first character major."""
    strange, usual = (_probabilities(_bigram_counts(s)) for s in (random_strings(slim.sparkSession), ordinary_strings(slim)))
    return [round(math.log(strange[a + b] / usual[a + b]), 4) for a in ALPHABET for b in ALPHABET]


def log_ratio(run: Column, weights: list[float]) -> Column:
    """Sum of the pairs' log-likelihood ratios."""
    table = F.from_json(F.lit("[" + ",".join(map(str, weights)) + "]"), "array<double>")
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.aggregate(
        codes, F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(c.alias("last"), F.when((acc["last"] == 0) | (c == 0), acc["sum"]).otherwise(
            acc["sum"] + F.element_at(table, (acc["last"] - 1) * len(ALPHABET) + c)).alias("sum")))
    return pairs["sum"]


def _labelled(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                 s["end"].alias("end")))


def scan(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, text, base and spans: arrays of (start, kind number, end), ordered; ``base`` holds the fixed patterns' spans."""
    slim = id_text(docs, id_col, text_col)
    return _with_spans(slim, train(slim)).select("doc_id", "text", F.col("__secret_base").alias("base"), F.col("__secret_spans").alias("spans"))


def _with_spans(slim: DataFrame, weights: list[float]) -> DataFrame:
    text = F.col("text")
    long_run = lambda s: F.length(s["match"])
    found = slim.select(
        "*",
        F.filter(spans_where(text.rlike(ASSIGN), text, ASSIGN),
                 lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= MIN_VALUE).alias("__secret_assign"),
        F.filter(spans_where(text.contains("AKIA"), text, ACCESS), lambda s: long_run(s) >= MIN_ACCESS).alias("__secret_access"),
        spans_where(text.rlike(HEX), text, HEX).alias("__secret_hex"),
        F.filter(spans_where(text.rlike(RUN), text, RUN),
                 lambda s: s["match"].rlike("[A-Za-z]")).alias("__secret_run"))
    scored = found.withColumn("__secret_run", F.transform("__secret_run", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), log_ratio(s["match"], weights).alias("ratio"))))
    kept = F.filter("__secret_run", lambda s: (s["ratio"] >= MIN_TOTAL) & (s["ratio"] >= MIN_MEAN * (s["end"] - s["start"])))
    base = F.array_sort(F.concat(*(_labelled(F.col(f"__secret_{k}"), k) for k in KINDS[:3])))
    spans = F.array_sort(F.concat("__secret_base", _labelled(F.col("__secret_markov"), "markov")))
    return (scored.withColumn("__secret_markov", kept).withColumn("__secret_base", base).withColumn("__secret_spans", spans)
            .drop(*(f"__secret_{k}" for k in ("assign", "access", "hex", "run", "markov"))))


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return scan(docs).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                             F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redact(docs: DataFrame, mark="[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones merged) replaced by ``mark`` in ``text``; all columns stay, ``n_chars`` follows."""
    columns = docs.columns
    hidden = {c: unused(columns, f"own{c}") for c in columns if c.lower().startswith("__secret_")}
    found = _with_spans(docs.withColumnsRenamed(hidden), train(id_text(docs)))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc, s):
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = F.struct(F.concat(acc["out"], gap, F.lit(mark)).alias("out"), s["end"].alias("at"))
        longer = F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))
        return F.when((s["start"] >= acc["at"]), fresh).otherwise(longer)

    clean = F.aggregate("__secret_spans", begin, step,
                        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))))
    out = found.withColumn("text", F.when(F.size("__secret_spans") > 0, clean).otherwise(F.col("text"))).select(
        *(F.col(f"`{hidden.get(c, c)}`").alias(c) for c in columns))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in columns else out
