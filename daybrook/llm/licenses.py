"""License scans: ordered signature rules behind a keyword prefilter.

All of it is DataFrame code. Texts are cut into words (digits, letters and everything beyond ASCII, A-Z lowered). Texts
without any gate word have no detections and are only counted. For the others the words, joined by blanks, are searched by
the rules whose keyword occurs: every license of ``LICENSES`` in each phrasing of ``PHRASINGS``, then the short names and the
sentences of license texts of ``license_texts``, besides the four base phrases. Ids as in SPDX count behind an announcement
(``CHAIN``), each operand of an expression by itself. A detection whose word interval lies inside one of higher
rank (priority, then length, then label) is suppressed. ``score`` is the highest confidence of the detections that stay,
0 without any.

Null and empty texts have no words. Texts are searched whole. Rows are judged one by one: repeated rows and equal ids
repeat their result, null ids stay null. Empty tables give empty results. Only the id and text columns are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from daybrook.llm.common import id_text
from daybrook.llm.license_texts import IDS, SHORT, TEXTS
from daybrook.llm.spans import find_spans

# fixed values: the base phrases and labels of the result definition
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # as defined, upper-case letters counted as letters
# what announces a license, and what may stand between the announcement and its name
GRANT = r"(?:licensed|released|distributed|available|published|covered|provided|governed) under (?:the |an? )?(?:terms of (?:the )?)?"
ANNOUNCED = rf"(?:{GRANT}|(?:spdx )?licen[sc]e (?:identifier |expression |id )?(?:the )?)"
NAMES = "|".join(sorted((regex for _, regex, *_ in IDS + SHORT), key=len, reverse=True))  # mit 0 before mit
# any number of operands; possessive, so that long expressions need no stack
CHAIN = rf" {ANNOUNCED}(?:(?:{NAMES})(?: with(?: \w+){{1,6}}?)? (?:or|and) (?:the )?(?=(?:{NAMES}) ))*+(?:{NAMES})(?= )"

# words or phrases (regexes over blank-separated words) one of which occurs wherever a rule matches
GATES = ["licen", "copyright", "copyleft", "copying", "spdx", "public domain", "all rights", "creative commons", "cc by", "cc zero", "cc 0", "cc attribution", "cc0",
         "gnu gpl", "mit no attribution"]
# where a word begins: what follows a short name, and the end of a sentence's phrase, are left open
_END = rf"(?=[0-9v]|{NOT_WORD[:-1]}|\Z)"
WORD_GATES = {gate: "" for _, _, gate in TEXTS if gate not in GATES} | {gate: _END for _, _, gate in SHORT}


def _raw(regex: str) -> str:
    """A regex over blank-separated words as one over the text."""
    return regex.replace(" ?", "\0").replace(" ", NOT_WORD).replace("\0", f"(?:{NOT_WORD})?")


def _trie(phrases: dict[str, str]) -> str:
    """Plain phrases, each with what must follow it, as one regex that branches at each character: most places fail at once."""
    if phrases.get("") == "":
        return ""
    heads: dict[str, dict[str, str]] = {}
    for phrase, tail in phrases.items():
        if phrase:
            heads.setdefault(phrase[0], {})[phrase[1:]] = tail
    parts = [_raw(head) + _trie(rest) for head, rest in sorted(heads.items())] + ([_raw(phrases[""])] if "" in phrases else [])
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


GATE = "(?i)" + _trie(dict.fromkeys(GATES, "")) + rf"|(?:\A|{NOT_WORD[:-1]})(?:{_trie(WORD_GATES)}|{_raw(GRANT)}(?:{_raw(NAMES)}){_END})"

# label: (keyword that must occur, name as a regex over blank-separated words)
LICENSES = {
    "gpl-1": ("gnu", r"gnu (?:general public licen[sc]e|gpl)(?: v| version)? ?1(?: 0)?"),
    "gpl-2": ("gnu", r"gnu (?:general public licen[sc]e|gpl)(?: v| version)? ?2(?: 0)?"),
    "gpl-3": ("gnu", r"gnu (?:general public licen[sc]e|gpl)(?: v| version)? ?3(?: 0)?"),
    "gpl": ("gnu", r"gnu (?:general public licen[sc]e|gpl)"),
    "lgpl-2.1": ("lesser", r"gnu lesser general public licen[sc]e(?: v| version)? ?2 1"),
    "lgpl-3": ("lesser", r"gnu lesser general public licen[sc]e(?: v| version)? ?3(?: 0)?"),
    "lgpl": ("gnu", r"gnu (?:lesser|library) general public licen[sc]e"),
    "agpl-3": ("affero", r"gnu affero general public licen[sc]e(?: v| version)? ?3(?: 0)?"),
    "agpl": ("affero", r"(?:gnu )?affero general public licen[sc]e"),
    "gfdl": ("documentation", r"gnu free documentation licen[sc]e"),
    "apache-1.1": ("apache", r"apache (?:software )?licen[sc]e(?: v| version)? 1 1"),
    "apache-2.0": ("apache", r"apache (?:software )?licen[sc]e(?: v| version)? ?2(?: 0)?"),
    "apache": ("apache", r"apache (?:software )?licen[sc]e"),
    "mit": ("mit", r"(?:the )?mit licen[sc]e"),
    "mit-0": ("mit", r"mit no attribution(?: licen[sc]e)?"),
    "x11": ("x11", r"x11 licen[sc]e"),
    "expat": ("expat", r"expat licen[sc]e"),
    "bsd-2-clause": ("bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd) licen[sc]e"),
    "bsd-3-clause": ("bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd) licen[sc]e"),
    "bsd-4-clause": ("bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd) licen[sc]e"),
    "bsd-0-clause": ("bsd", r"(?:zero clause bsd|bsd zero clause|0bsd) licen[sc]e"),
    "bsd": ("licen", r"(?:berkeley software distribution|bsd(?: style)?) licen[sc]e"),
    "isc": ("isc", r"isc licen[sc]e"),
    "mpl-1.1": ("mozilla", r"mozilla public licen[sc]e(?: v| version)? 1 1"),
    "mpl-2.0": ("mozilla", r"mozilla public licen[sc]e(?: v| version)? ?2(?: 0)?"),
    "mpl": ("mozilla", r"mozilla public licen[sc]e"),
    "epl-2.0": ("eclipse", r"eclipse public licen[sc]e(?: v| version)? ?2(?: 0)?"),
    "epl": ("eclipse", r"eclipse public licen[sc]e"),
    "edl": ("eclipse", r"eclipse distribution licen[sc]e"),
    "cddl": ("distribution", r"common development and distribution licen[sc]e"),
    "cpl": ("common", r"common public licen[sc]e"),
    "eupl": ("union", r"european union public licen[sc]e"),
    "artistic-2.0": ("artistic", r"artistic licen[sc]e(?: v| version)? ?2(?: 0)?"),
    "artistic": ("artistic", r"artistic licen[sc]e"),
    "boost": ("boost", r"boost software licen[sc]e"),
    "zlib": ("zlib", r"zlib(?: libpng)? licen[sc]e"),
    "libpng": ("libpng", r"libpng licen[sc]e"),
    "openssl": ("openssl", r"openssl licen[sc]e"),
    "python": ("python", r"python (?:software foundation )?licen[sc]e"),
    "php": ("php", r"php licen[sc]e"),
    "ruby": ("ruby", r"ruby licen[sc]e"),
    "postgresql": ("postgresql", r"postgresql licen[sc]e"),
    "ofl": ("sil", r"sil open font licen[sc]e"),
    "odbl": ("database", r"open (?:data commons )?database licen[sc]e"),
    "w3c": ("w3c", r"w3c (?:software notice and )?licen[sc]e"),
    "unlicense": ("unlicense", r"(?:the )?unlicense"),
    "wtfpl": ("fuck", r"do what the fuck you want to public licen[sc]e"),
    "cc0": ("c", r"(?:cc ?0|cc zero|creative commons zero)(?: 1 0)?"),
    "cc-by-nc-nd": ("nc", r"(?:cc|creative commons) (?:by nc nd|attribution noncommercial noderiv\w*)(?: [1-4] [05])?"),
    "cc-by-nc-sa": ("nc", r"(?:cc|creative commons) (?:by nc sa|attribution noncommercial sharealike)(?: [1-4] [05])?"),
    "cc-by-nc": ("nc", r"(?:cc by nc|creative commons attribution noncommercial)(?: [1-4] [05])?"),
    "cc-by-nd": ("c", r"(?:cc by nd|creative commons attribution noderiv\w*)(?: [1-4] [05])?"),
    "cc-by-sa": ("c", r"(?:cc by sa|creative commons attribution sharealike)(?: [1-4] [05])?"),
    "cc-by": ("by", r"cc by(?: [1-4] [05])?"),
    "cc-attribution": ("creative", r"creative commons attribution(?: [1-4] [05])?"),
    "ms-pl": ("microsoft", r"microsoft public licen[sc]e"),
    "ms-rl": ("microsoft", r"microsoft reciprocal licen[sc]e"),
    "ncsa": ("illinois", r"(?:university of )?illinois(?: ncsa)? open source licen[sc]e"),
    "afl": ("academic", r"academic free licen[sc]e"),
    "osl": ("open", r"open software licen[sc]e"),
    "public-domain": ("domain", r"public domain"),
    "proprietary": ("rights", r"all rights reserved"),
}
# priority, confidence, regex around a name: first come the phrasings that state a grant
PHRASINGS = [
    (6, 0.99, GRANT + "{}"),
    (5, 0.95, r"(?:spdx licen[sc]e identifier|licen[sc]e identifier|licen[sc]e) (?:the )?{}"),
    (4, 0.9, r"(?:under|subject to|according to|in accordance with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{}"),
    (3, 0.8, r"(?:copy|text|version|conditions|terms) of (?:the )?{}"),
    (2, 0.6, r"{}"),
]
BASE_PRIORITY, BASE_CONFIDENCE = 1, 0.5
TEXT_PRIORITY, TEXT_CONFIDENCE = 6, 0.98
CHAIN_PRIORITY, CHAIN_CONFIDENCE = 5, 0.95
SHORT_PRIORITY, SHORT_CONFIDENCE = 2, 0.6


def _keyword(regex: str) -> str:
    """The longest stretch of plain words in a regex without alternatives outside groups: it occurs in every match."""
    while (bare := re.sub(r"\([^()]*\)[?*+]?(?:\{[^}]*\}\??)?", "\n", regex)) != regex:
        regex = bare
    return max(re.split(r"\n|\[[^\]]*\]|\\\w[*+?]?|[a-z0-9 ]\?", regex), key=len)


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, regex, priority, confidence), highest priority first."""
    named = [(label, keyword, f" {phrase.format(name)}(?= )", priority, confidence)
             for priority, confidence, phrase in PHRASINGS for label, (keyword, name) in LICENSES.items()]
    texts = [(label, _keyword(regex), f" {regex}(?= )", TEXT_PRIORITY, TEXT_CONFIDENCE) for label, regex, _ in TEXTS]
    short = [(label, _keyword(regex), f" {regex}(?= )", SHORT_PRIORITY, SHORT_CONFIDENCE) for label, regex, _ in SHORT]
    return sorted(texts + named + short, key=lambda r: -r[3])


def _in_chains(line: Column) -> Column:
    """Detections of each id or short name of the announced expressions."""
    names = F.array(*(F.struct(F.lit(label).alias("label"), F.lit(f" (?:{regex})(?= )(?! exception)").alias("regex"))
                      for label, regex in IDS + [(label, regex) for label, regex, _ in SHORT]))

    def of(chain: Column) -> Column:
        inside = F.concat(chain["match"], F.lit(" "))
        return F.flatten(F.transform(names, lambda n: F.transform(
            _detections(find_spans(inside, n["regex"], _words), n["label"], F.lit(CHAIN_PRIORITY), F.lit(CHAIN_CONFIDENCE)),
            lambda d: d.withField("start", d["start"] + chain["start"]).withField("end", d["end"] + chain["start"]))))

    return F.flatten(F.transform(find_spans(line, CHAIN, _words), of))


def _rule_table() -> Column:
    fields = "label", "keyword", "regex", "priority", "confidence"
    return F.array(*(F.struct(*(F.lit(v).alias(f) for f, v in zip(fields, r))) for r in rules()))


def _words(piece: Column) -> Column:
    """Words of a piece of blank-led words: its blanks."""
    return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))


def _detections(spans: Column, label: Column, priority: Column, confidence: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), priority.alias("priority"),
        (s["end"] - s["start"]).alias("length"), label.alias("label"), confidence.alias("confidence")))


def _covers(e: Column, d: Column) -> Column:
    """Does ``e`` hold ``d``'s interval and outrank it?"""
    rank = lambda x: F.struct(x["priority"], x["length"], x["label"])
    return (e["start"] <= d["start"]) & (e["end"] >= d["end"]) & (rank(e) > rank(d))


def detect(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_words, ``base`` (start, end, label of every base phrase) and ``detections`` that survive suppression.

    Detections: start, end (words, end exclusive), priority, length, label, confidence.
    """
    slim = id_text(docs, id_col, text_col)
    gated = F.col("text").rlike(GATE)
    parts = F.split("text", NOT_WORD, -1)
    # delimiters at either end leave an empty part there
    split = slim.select("doc_id", "text", gated.alias("gated"), parts.alias("parts"))
    n_words = (F.size("parts") - F.when(F.element_at("parts", 1) == "", 1).otherwise(0)
               - F.when((F.size("parts") > 1) & (F.element_at("parts", -1) == ""), 1).otherwise(0)).cast("bigint")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    joined = F.concat(F.lit(" "), F.array_join(F.filter("parts", lambda w: w != ""), " "), F.lit(" "))
    line = split.select("doc_id", n_words.alias("n_words"),
                        F.when(F.col("gated"), F.translate(joined, upper, lower)).alias("line"))
    line_col = F.col("line")
    base = F.flatten(F.array(*(_detections(find_spans(line_col, f" {phrase}(?= )", _words), F.lit(label),
                                           F.lit(BASE_PRIORITY), F.lit(BASE_CONFIDENCE)) for phrase, label in BASE.items())))
    fired = F.filter(_rule_table(), lambda r: line_col.contains(r["keyword"]))
    by_rule = F.flatten(F.transform(fired, lambda r: _detections(
        find_spans(line_col, r["regex"], _words), r["label"], r["priority"], r["confidence"])))
    by_rule = F.concat(by_rule, _in_chains(line_col))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,priority:int,length:bigint,label:string,confidence:double>>")
    found = line.select("doc_id", "n_words", F.when(line_col.isNotNull(), base).otherwise(empty).alias("base"),
                        F.when(line_col.isNotNull(), by_rule).otherwise(empty).alias("by_rule"))
    every = found.withColumn("every", F.array_distinct(F.concat("base", "by_rule"))).drop("by_rule")
    kept = F.filter("every", lambda d: ~F.exists("every", lambda e: _covers(e, d)))
    return every.select("doc_id", "n_words", "base", F.when(F.size("every") > 0, kept).otherwise(empty).alias("detections"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    labels = lambda spans: F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"])))
    return detect(docs).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["start"])).alias("last_word"),
        F.array_join(labels(F.col("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels(F.col("base")), labels(F.col("detections")))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda s: s["confidence"])), F.lit(0.0)).alias("score"))
