"""Conversation structure repair with block tables (``dialogue_blocks``).

``damage`` alters rows by a hash of their key, ``digest`` judges each conversation's rows in the order (turn, nulls first;
role; text) and finds the cheapest edits that give it the form system?, (user, assistant)+, or nothing.

Conversations of at most ``LONG_ROWS`` rows and ``LONG_BYTES`` of text are sorted together on the conversation and solved
row by row as they stream past; a task holds one conversation at a time. Longer ones, whatever their length, are cut into
segments over many tasks:

1. equal rows are combined, the rest is ranged by (conversation, turn, role, text), numbered and written once;
2. an aggregate finds each (role, text)'s first row, which tells duplicates;
3. each segment looks up, for every possible cost vector behind it, the vector before it; one row a segment is composed
   from the end; each segment then tells for every state before it the state behind it, composed from the start;
4. with both ends known, segments read their edits. Only the audit and SHA-256 of a conversation, sequential by
   definition, pass through one task, as a stream.

Null roles, texts, turns and conversations count as one space (a null conversation is one conversation and comes back with
a null id); rows of equal turn, role and text are told apart by nothing and may stand in any order. Repeated rows are
duplicates. Empty texts are blank. Texts and conversations of any length are read whole. Extra columns are left behind. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybrook.llm import dialogue_blocks as B
from daybrook.llm.common import materialize, shards_for

LONG_ROWS, LONG_BYTES = 20_000, 16 << 20
SEGMENT_BITS = 16  # a segment has at most 2 ** 16 rows
ROWS_PER_TASK = 200_000

SPACE = " \t\n\x0b\x0c\r"  # fixed values: white space and the marks that end a sentence
ENDS = ".!?"
RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def damage(table: DataFrame) -> DataFrame:
    """(ck, conv_id, turn, role, text, copies): dropped rows stay with no copies, repeated ones have two.

    ``ck`` is the conversation as text, one space for null.
    """
    blank = F.lit(" ")
    ck, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    draw = F.crc32(F.concat(ck, F.lit(":"), turn)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    changed = F.when(draw <= 1, F.lit("")).when(draw == 2, F.translate(text, ENDS, "")).otherwise(text)
    return table.select(
        ck.alias("ck"), F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(draw == 4, F.lit("user")).when(draw == 0, F.lit("")).otherwise(role).alias("role"), changed.alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """Adds ``initial`` and ``own``: 2 blank, 1 truncated, 0 neither."""
    end = F.rtrim("text", F.lit(SPACE))
    last = F.substring(end, -1, 1)
    own = F.when(end == "", 2).when(last.isin(*ENDS), 0).otherwise(1)
    return rows.withColumns({"initial": F.substring("role", 1, 1), "own": own.cast("int")})


class Repair:
    """Collects one conversation's rows, in order, with their edits; holds no text."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.hash, self.first_line = conv_id, [], hashlib.sha256(), True
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.low = self.high = None
        self.turns, self.previous = 0, None

    def _line(self, role: bytes, text: bytes):
        self.hash.update(role + b":" + text if self.first_line else b"\n" + role + b":" + text)
        self.first_line = False

    def _insert(self, state):
        state = B.AFTER_NEW[state]
        self._line(_NEW_ROLE[state], b"")
        self.cost += B.INSERT
        return state

    def row(self, turn, initial, role, text, copies, own, seen, edits, state):
        if turn is not None and (self.high is None or turn != self.high):
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.illegal += self.previous is not None and (self.previous, initial) not in LEGAL
        self.illegal += copies - 1  # two equal initials are never legal
        self.previous = initial
        if own == 2:
            self.blank += copies
        else:
            self.duplicate += copies - (not seen)
            self.truncated += own == 1 and not seen
        for edit in edits[:-1]:
            state = self._insert(state)
        if edits[-1] == "D":
            self.cost += B.DELETE
        else:
            if edits[-1] == "R":
                self.cost += B.REROLE
                role = _NEW_ROLE[B.AFTER_NEW[state]]
            self.cost += B.CUT * (own == 1)
            self._line(role, text)
        self.cost += B.DELETE * (copies - 1)
        self.audit.append(edits if copies == 1 else edits + "D" * (copies - 1))

    def finish(self, state):
        for _ in B.tail(state):
            state = self._insert(state)
            self.audit.append("I")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


_NEW_ROLE = {2: b"user", 3: b"assistant"}


def _binary(batch, name):
    column = batch.column(name)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def _result_batch(found):
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [part.split()[0] for part in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], names=names)


def _order():
    return ["ck", F.col("turn").asc_nulls_first(), "role", "text"]


def solve_short(rows: DataFrame) -> DataFrame:
    """Result rows of conversations that fit into one task's memory."""
    def solved(conv_id, group):
        repair, seen, symbols, marks = Repair(conv_id), set(), bytearray(), []
        for turn, initial, role, text, copies, own in group:
            known = (role, text) in seen
            seen.add((role, text))
            marks.append(known)
            symbols.append(B.symbol(initial, known or own == 2, own == 1))
        pieces, states, state = B.trace(bytes(symbols))
        for row, known, edits, before in zip(group, marks, pieces, states):
            repair.row(*row, known, edits, before)
        return repair.finish(state)

    def run(batches):
        key, conv_id, group = None, None, []
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("ck", "conv_id", "turn", "initial")]
            for ck, conv, turn, initial, role, text, copies, own in zip(
                    *columns, _binary(batch, "role"), _binary(batch, "text"), batch.column("copies").to_pylist(),
                    batch.column("own").to_pylist()):
                if ck != key:
                    if key is not None:
                        found.append(solved(conv_id, group))
                    key, conv_id, group = ck, conv, []
                if copies:
                    group.append((turn, initial, role, text, copies, own))
            yield _result_batch(found)
        if key is not None:
            yield _result_batch([solved(conv_id, group)])

    return rows.repartition("ck").sortWithinPartitions(*_order()).mapInArrow(run, RESULT)


def _numbered(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows of long conversations with ``at``, a number that follows their order, and a digest of role and text."""
    def number(batches):
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(at, at + batch.num_rows))],
                                             names=[*batch.schema.names, "at"])
            at += batch.num_rows

    once = (rows.groupBy("ck", "conv_id", "turn", "role", "text", "initial", "own").agg(F.sum("copies").alias("copies"))
            .where("copies > 0"))
    ranged = once.repartitionByRange(tasks, *_order()).sortWithinPartitions(*_order())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in once.schema.fields)
    # a role may hold any character, its length tells where it ends
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return materialize(ranged.mapInArrow(number, f"{schema}, at bigint").withColumn("digest", digest), "long-turns")


def solve_long(rows: DataFrame, n_rows: int) -> DataFrame:
    """Result rows of conversations of any length; conversations without a row left after the damage are absent."""
    numbered = _numbered(rows, shards_for(n_rows, ROWS_PER_TASK))
    first = numbered.groupBy("ck", "digest").agg(F.min("at").alias("first"))
    marked = materialize(
        numbered.select("ck", "at", "digest", "initial", "own").join(first, ["ck", "digest"]).select(
            "ck", "at", F.shiftright("at", SEGMENT_BITS).alias("segment"), "initial", "own",
            (F.col("at") > F.col("first")).alias("seen")), "long-marks")

    def symbols_of(table):
        table = table.sort_by("at")
        parts = (table.column(c).to_pylist() for c in ("initial", "own", "seen"))
        return table, bytes(B.symbol(i, seen or own == 2, own == 1) for i, own, seen in zip(*parts))

    def vectors(key, table):
        return pa.table({"ck": [key[0].as_py()], "segment": [key[1].as_py()],
                         "vectors": [B.transition(symbols_of(table)[1]).tobytes()]})

    def compose_back(key, table):
        table, at = table.sort_by([("segment", "descending")]), 0
        behind = []
        for packed in table.column("vectors").to_pylist():
            behind.append(at)
            at = int(np.frombuffer(packed, np.int32)[at])
        return pa.table({"ck": table.column("ck"), "segment": table.column("segment"), "behind": pa.array(behind, pa.int32())})

    def states(key, table, ends):
        symbols, behind = symbols_of(table)[1], ends.column("behind")[0].as_py()
        out = [B.trace(symbols, behind, q)[2] for q in range(4)]
        return pa.table({"ck": [key[0].as_py()], "segment": [key[1].as_py()], "behind": pa.array([behind], pa.int32()),
                         "through": [bytes(out)]})

    def compose_on(key, table):
        table, at = table.sort_by("segment"), 0
        start = []
        for through in table.column("through").to_pylist():
            start.append(at)
            at = through[at]
        return pa.table({"ck": table.column("ck"), "segment": table.column("segment"), "behind": table.column("behind"),
                         "start": pa.array(start, pa.int32())})

    def edits(key, table, ends):
        table, symbols = symbols_of(table)
        pieces, before, state = B.trace(symbols, ends.column("behind")[0].as_py(), ends.column("start")[0].as_py())
        return pa.table({"ck": table.column("ck"), "at": table.column("at"), "seen": table.column("seen"),
                         "edits": pa.array(pieces, pa.string()), "state": pa.array(before, pa.int32()),
                         "next": pa.array([*before[1:], state], pa.int32())})

    segments = lambda df: df.groupBy("ck", "segment")
    key = "ck string, segment bigint"
    behind = materialize(segments(marked).applyInArrow(vectors, f"{key}, vectors binary").groupBy("ck")
                         .applyInArrow(compose_back, f"{key}, behind int"), "long-vectors")
    through = segments(marked).cogroup(segments(behind)).applyInArrow(states, f"{key}, behind int, through binary")
    ends = materialize(through.groupBy("ck").applyInArrow(compose_on, f"{key}, behind int, start int"), "long-states")
    found = segments(marked).cogroup(segments(ends)).applyInArrow(
        edits, "ck string, at bigint, seen boolean, edits string, state int, next int")
    whole = numbered.drop("digest").join(found, ["ck", "at"]).repartition("ck").sortWithinPartitions("ck", "at")

    def read(batches):
        ck, repair, state = None, None, 0
        for batch in batches:
            done = []
            plain = (batch.column(c).to_pylist() for c in ("ck", "conv_id", "turn", "initial", "copies", "own", "seen", "edits",
                                                           "state", "next"))
            for key, conv, turn, initial, copies, own, seen, piece, before, after, role, text in zip(
                    *plain, _binary(batch, "role"), _binary(batch, "text")):
                if key != ck:
                    if repair:
                        done.append(repair.finish(state))
                    ck, repair = key, Repair(conv)
                repair.row(turn, initial, role, text, copies, own, seen, piece, before)
                state = after
            yield _result_batch(done)
        if repair:
            yield _result_batch([repair.finish(state)])

    return whole.mapInArrow(read, RESULT)


def digest(table: DataFrame, long_rows=LONG_ROWS, long_bytes=LONG_BYTES) -> DataFrame:
    """One row per conversation: faults, cost, the cheapest edits (``audit``) and the hash of the repaired turns."""
    rows = judged(damage(table))
    sizes = rows.groupBy("ck", "conv_id").agg(F.sum(F.greatest("copies", F.lit(1))).alias("n"),
                                              F.sum(F.octet_length("text") + F.octet_length("role")).alias("bytes"))
    long = materialize(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)), "long-conversations")
    n_long = long.agg(F.sum("n")).first()[0]
    if not n_long:
        return solve_short(rows)
    short = rows.join(long.select("ck"), "ck", "left_anti")
    solved = solve_long(rows.join(long.select("ck"), "ck"), n_long)
    # a long conversation whose rows were all dropped
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    names = [part.split()[0] for part in RESULT.split(", ")]
    found = long.select("conv_id").join(solved.withColumnRenamed("conv_id", "found"), F.expr("conv_id <=> found"), "left").select(
        "conv_id", *(F.coalesce(c, empty.get(c, F.lit(0))).alias(c) for c in names[1:]))
    return solve_short(short).unionByName(found)
