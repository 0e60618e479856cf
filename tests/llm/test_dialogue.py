"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from daybrook.llm import dialogue, dialogue_blocks as B
from tests.llm.conftest import by_id

SCHEMA = "audit string, conv_id bigint, turn bigint, role string, text string, ck string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    """conv -> rows (turn, role, text) after damage, in order."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in found.items()}


def cheapest(turns):
    """(cost, audit, lines) by trying every edit; ``turns``: (initial, role, text, forced, truncated)."""
    goes = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    new = {"u": "user", "a": "assistant"}
    memo = {}

    def best(i, q, inserted):
        if (i, q, inserted) in memo:
            return memo[i, q, inserted]
        ways = [(0, "", ())] if i == len(turns) and q in (0, 3) else []
        if inserted < 3:
            for letter in "ua":
                if (q, letter) in goes:
                    c, audit, lines = best(i, goes[q, letter], inserted + 1)
                    ways.append((c + 5, "I" + audit, (f"{new[letter]}:", *lines)))
        if i < len(turns):
            initial, role, text, forced, cut = turns[i]
            c, audit, lines = best(i + 1, q, 0)
            ways.append((c + 2, "D" + audit, lines))
            if not forced:
                for mark, letter, name, price in (("K", initial, role, 0), ("R", "u", "user", 1), ("R", "a", "assistant", 1)):
                    if (q, letter) in goes:
                        c, audit, lines = best(i + 1, goes[q, letter], 0)
                        ways.append((c + price + 5 * cut, mark + audit, (f"{name}:{text}", *lines)))
        memo[i, q, inserted] = min(ways, default=(10 ** 9, "", ()))
        return memo[i, q, inserted]

    return best(0, 0, 0)


def plain(rows):
    out = []
    for conv, kept in damaged(rows).items():
        seen, turns, faults = set(), [], [0, 0, 0]
        for _, role, text in kept:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = 0 if not BLANK.search(text) else 1 if (role, text) in seen else 2 if last not in (".", "!", "?") else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            turns.append((role[:1], role, text, fault in (0, 1), fault == 2))
        cost, audit, lines = cheapest(turns)
        initials = [t[0] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(initials, initials[1:]))
        numbers = [t for t, _, _ in kept if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def build(spark, rows):
    return spark.createDataFrame([("x", *r, "y") for r in rows], SCHEMA).repartition(3)


def random_rows(seed, n=60, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why? ", "same.", None, "a.b", "é漢?", "! ", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "us", "User", "\n"]
    rows = []
    for conv in [None, *range(n)]:
        turn = rng.choice([0, 5, -2])
        for _ in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts)))
            turn += rng.choice([0, 1, 1, 1, 2])
    return rows


def test_block_tables_hold_every_short_sequence():
    rng = random.Random(3)
    for _ in range(400):
        size = rng.randrange(0, 12)
        turns = [(rng.choice("suax"), "r", "t", rng.random() < 0.15, rng.random() < 0.3) for _ in range(size)]
        symbols = bytes(B.symbol(i, forced, cut) for i, _, _, forced, cut in turns)
        pieces, _, state = B.trace(symbols)
        cost, audit, _ = cheapest(turns)
        assert ("".join(pieces) + B.tail(state), B.cost_of(symbols)) == (audit, cost)


def test_segments_compose():
    rng = random.Random(4)
    symbols = bytes(rng.randrange(B.SYMBOLS) for _ in range(501))
    whole, _, last = B.trace(symbols)
    for cut in (0, 1, 250, 501):
        behind = int(B.transition(symbols[cut:])[0])
        head, _, state = B.trace(symbols[:cut], behind)
        rest, _, end = B.trace(symbols[cut:], 0, state)
        assert head + rest == whole and end == last


@pytest.mark.parametrize("seed, long_rows", [(1, 10 ** 6), (2, 5), (3, 0)])
def test_digest_equals_search(spark, monkeypatch, seed, long_rows):
    monkeypatch.setattr(dialogue, "SEGMENT_BITS", 2)
    monkeypatch.setattr(dialogue, "ROWS_PER_TASK", 40)
    rows = random_rows(seed)
    assert by_id(dialogue.digest(build(spark, rows), long_rows=long_rows)) == plain(rows)


def test_real_rows(spark):
    table = dialogue.conversations(spark, "/root/testdata/sf0.01")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert by_id(dialogue.digest(table)) == plain(rows)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(7)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"turn {rng.randrange(300)}{rng.choice(['.', ''])}") for t in range(3000)]
    rows += [(None, None, "user", "again.")] * 2000 + [(9, 1, "user", "hi.")]
    got = by_id(dialogue.digest(build(spark, rows), long_rows=1000))
    assert got == plain_by_blocks(rows)


def plain_by_blocks(rows):
    """As ``plain``, with the edits from the tables (the search is recursive and needs short conversations)."""
    global cheapest
    kept, search = [], cheapest

    def by_tables(turns):
        symbols = bytes(B.symbol(i, forced, cut) for i, _, _, forced, cut in turns)
        pieces, states, state = B.trace(symbols)
        lines, new = [], {2: "user", 3: "assistant"}
        for (_, role, text, _, _), piece, q in zip(turns, pieces, states):
            for _ in piece[:-1]:
                q = B.AFTER_NEW[q]
                lines.append(f"{new[q]}:")
            if piece[-1] != "D":
                lines.append(f"{role if piece[-1] == 'K' else new[B.AFTER_NEW[q]]}:{text}")
        for _ in B.tail(state):
            state = B.AFTER_NEW[state]
            lines.append(f"{new[state]}:")
        return B.cost_of(symbols), "".join(pieces) + B.tail(state), tuple(lines)
    cheapest = by_tables
    try:
        kept = plain(rows)
    finally:
        cheapest = search
    return kept


def test_all_dropped_empty_and_clashing(spark):
    dropped = [(c, t, "user", "hi.") for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    empty = hashlib.sha256(b"").hexdigest()
    wanted = sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c in {c for c, *_ in dropped}), key=repr)
    for long_rows in (0, 100):
        assert by_id(dialogue.digest(build(spark, dropped), long_rows=long_rows)) == wanted
    assert dialogue.digest(build(spark, dropped).limit(0)).collect() == []
