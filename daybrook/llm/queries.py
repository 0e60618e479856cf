"""Registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os

from daybrook.llm import (ann, chunk_bpe, dialogue, jaccard, licenses, line_dedup, packing, quality, secrets, signatures,
                          spelling, suffix_dedup, token_files)
from daybrook.llm.common import documents, embeddings


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file: under ``$TOKENIZER_DIR``, or where the installed package keeps it."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"

QUERIES = {
    "op1_secret_scan": lambda spark, sf: secrets.digest(documents(spark, sf)),
    "op2_license_scan": lambda spark, sf: licenses.digest(documents(spark, sf)),
    "op3_bpe_encode_decode": lambda spark, sf: chunk_bpe.digest(documents(spark, sf), vocabulary(BYTES)),
    "op4_ngram_jaccard": lambda spark, sf: jaccard.assign(documents(spark, sf)),
    "op5_quality_rules": lambda spark, sf: quality.judge(documents(spark, sf)),
    "op6_suffix_dedup": lambda spark, sf: suffix_dedup.digest(documents(spark, sf)),
    "op7_nearest_neighbours": lambda spark, sf: ann.digest(embeddings(spark, sf)),
    "op8_token_files": lambda spark, sf: token_files.digest(documents(spark, sf), vocabulary(WORDS)),
    "op9_best_fit_packing": lambda spark, sf: packing.digest(documents(spark, sf), vocabulary(BYTES)),
    "op10_line_dedup": lambda spark, sf: line_dedup.digest(documents(spark, sf)),
    "op11_conversation_repair": lambda spark, sf: dialogue.digest(dialogue.conversations(spark, sf)),
    "op12_spelling_variants": lambda spark, sf: spelling.digest(documents(spark, sf)),
    "op13_minhash_dedup": lambda spark, sf: signatures.assign(documents(spark, sf)),
}

# fixed values: the character classes of the result definitions
_SPACE = r"\x20\x09-\x0D"

ORACLES = {
    "op10_line_dedup": rf"""
WITH split AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '^[{_SPACE}]+', ''), '[{_SPACE}]+$', '') AS k FROM split),
hot AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, hot.k IS NOT NULL AND hot.last <> doc_id AS gone FROM keyed LEFT JOIN hot ON keyed.k = hot.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
