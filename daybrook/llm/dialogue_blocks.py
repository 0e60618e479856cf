"""Block tables for the cheapest repair of a sequence of turns (the method of the Four Russians).

A repaired sequence of role initials has the form ``(s?(ua)+)?``. Its automaton has four states: 0 nothing yet, 1 after s,
2 after u, 3 after a; 0 and 3 accept. A turn is one of nine symbols: 0 must go, 1 + class + 4 * truncated otherwise, with
the classes s, u, a, anything else.

The *cost vector* before a turn holds, for each state, the least cost of finishing from there. Insertions keep all entries
within a few units of each other, so after subtracting the smallest entry only a small set of vectors occurs. For every
block of up to ``BLOCK`` symbols and every such vector behind it a table holds the vector before it and the cost in
between. A sequence is solved by one lookup a block, from its end to its start. The edits are then read from the start:
each block is expanded backward from the vector behind it, and of all edits that stay on a cheapest way the first in
ASCII order (D, I, K, R) is taken, so ties are resolved exactly. Expansions are remembered; there are finitely many.
"""

from __future__ import annotations

from functools import cache, lru_cache

import numpy as np

BLOCK = 4
SYMBOLS = 9
FORCED = 0
INSERT, DELETE, REROLE, CUT = 5, 2, 1, 5  # fixed values: costs of the edits and of an undeleted truncated turn

AFTER_NEW = (2, 2, 3, 2)  # the state after an inserted or renamed turn, which is whatever the automaton asks for
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by class: the states after a kept turn
CLASSES = {"s": 0, "u": 1, "a": 2}
END = (0, 10, 5, 0)  # nothing left: accept, or insert what is missing


def symbol(initial: str, forced: bool, truncated: bool) -> int:
    return FORCED if forced else 1 + CLASSES.get(initial, 3) + 4 * truncated


def before(sym: int, vector) -> tuple[int, ...]:
    """The cost vector before a turn, not normalised, from the one behind it."""
    out = [DELETE + c for c in vector]
    if sym != FORCED:
        kind, extra = (sym - 1) % 4, CUT * (sym > 4)
        for q in range(4):
            out[q] = min(out[q], REROLE + extra + vector[AFTER_NEW[q]])
            if q in KEPT[kind]:
                out[q] = min(out[q], extra + vector[KEPT[kind][q]])
    two, three = min(out[2], INSERT + out[3]), min(out[3], INSERT + out[2])
    return min(out[0], INSERT + two), min(out[1], INSERT + two), two, three


def _normal(vector) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(c - least for c in vector), least


@cache
def tables():
    """(vectors, ids, costs): ``ids[r][code, v]`` and ``costs[r][code, v]`` for blocks of r symbols, ``code`` in base 9."""
    vectors, place, waiting, steps = [END], {END: 0}, [END], {}
    while waiting:
        vector = waiting.pop()
        for sym in range(SYMBOLS):
            new, cost = _normal(before(sym, vector))
            if new not in place:
                place[new] = len(vectors)
                vectors.append(new)
                waiting.append(new)
            steps[sym, place[vector]] = place[new], cost
    one = np.array([[steps[s, v] for v in range(len(vectors))] for s in range(SYMBOLS)], np.int32)
    ids, costs = [np.arange(len(vectors), dtype=np.int32)[None, :]], [np.zeros((1, len(vectors)), np.int32)]
    for _ in range(BLOCK):  # a longer block: one more symbol in front
        ids.append(np.concatenate([one[s, ids[-1], 0] for s in range(SYMBOLS)]))
        costs.append(np.concatenate([costs[-1] + one[s, ids[-2], 1] for s in range(SYMBOLS)]))
    return vectors, ids, costs


@cache
def _scalars():
    _, ids, costs = tables()
    return [t.tolist() for t in ids], [t.tolist() for t in costs]


def blocks_of(symbols: bytes) -> list[tuple[int, int]]:
    """(length, code) of the blocks; the first one takes what is left over."""
    size, out = len(symbols), []
    start, end = 0, size % BLOCK or min(BLOCK, size)
    while start < size:
        code = 0
        for s in symbols[start:end]:
            code = code * SYMBOLS + s
        out.append((end - start, code))
        start, end = end, end + BLOCK
    return out


def transition(symbols: bytes) -> np.ndarray:
    """For every vector behind these turns, the vector before them."""
    vectors, ids, _ = tables()
    at = np.arange(len(vectors), dtype=np.int32)
    for length, code in reversed(blocks_of(symbols)):
        at = ids[length][code][at]
    return at


@lru_cache(maxsize=1 << 16)
def _expand(length: int, code: int, behind: int, state: int) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """Edits up to each turn of a block, ASCII-least among the cheapest, and the state before each turn and at the end."""
    symbols = [code // SYMBOLS ** (length - 1 - k) % SYMBOLS for k in range(length)]
    costs = [tables()[0][behind]]
    for sym in reversed(symbols):
        costs.append(before(sym, costs[-1]))
    costs.reverse()
    pieces, states = [], []
    for k, sym in enumerate(symbols):
        piece = ""
        states.append(state)
        while True:
            now, then = costs[k], costs[k + 1]
            extra, kept = CUT * (sym > 4), KEPT[(sym - 1) % 4] if sym else {}
            if now[state] == DELETE + then[state]:
                piece += "D"
                break
            if now[state] == INSERT + now[AFTER_NEW[state]]:
                piece, state = piece + "I", AFTER_NEW[state]
                continue
            if state in kept and now[state] == extra + then[kept[state]]:
                piece, state = piece + "K", kept[state]
            else:
                piece, state = piece + "R", AFTER_NEW[state]
            break
        pieces.append(piece)
    return tuple(pieces), (*states, state)


def trace(symbols: bytes, behind=0, state=0) -> tuple[list[str], list[int], int]:
    """Edits up to each turn, the states before the turns and the state at the end, given the vector behind the turns."""
    ids, _ = _scalars()
    blocks = blocks_of(symbols)
    vectors = []
    for length, code in reversed(blocks):
        vectors.append(behind)
        behind = ids[length][code][behind]
    pieces, states = [], []
    for (length, code), vector in zip(blocks, reversed(vectors)):
        some, through = _expand(length, code, vector, state)
        pieces += some
        states += through[:-1]
        state = through[-1]
    return pieces, states, state


def tail(state: int) -> str:
    """Insertions that finish from this state."""
    return {1: "II", 2: "I"}.get(state, "")


def cost_of(symbols: bytes) -> int:
    """Cheapest cost of a whole sequence, from the tables alone."""
    vectors, _, _ = tables()
    ids, costs = _scalars()
    at, total = 0, 0
    for length, code in reversed(blocks_of(symbols)):
        total, at = total + costs[length][code][at], ids[length][code][at]
    return total + vectors[at][0]
