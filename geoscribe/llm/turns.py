"""Conversation repair: cheapest edits by a run-length dynamic programme.

A conversation is the sequence of its rows by (turn, nulls first; role; digest of
role and text).  Each row has a symbol: the class of its role's initial (``s``,
``u``, ``a``, other) and its fault (``blank``, ``duplicate`` and ``truncated``;
the first that holds counts).  Edits are Keep (0), Rerole (3), Delete (4, the only
edit of blank and duplicate rows) and Insert (3); a truncated row that stays adds
3.  The repaired role initials match ``(s?(ua)+)?``: four states (start, after
``s``, after ``u``, after ``a``), so one symbol is a 4 x 4 min-plus transition of
cost and audit, inserts in front of the row included.  Of equal costs the
ASCII-least audit counts; that is a semiring, as audits of equal cost over the same
rows are never prefixes of one another.

Equal consecutive symbols are collapsed into runs, and a run of length L is
advanced by the powers 1, 2, 4 .. of its transition found in L's binary form;
powers are cached per symbol with their audits.  Costs go backwards over these
steps, then the choices are unrolled forwards, one power at a time.

On Spark: equal rows (conversation, turn, role, digest) are counted first, so a
row repeated a million times is one row and one run.  The first turn of a text in
its conversation is an aggregate joined back with heavy keys apart
(``operators.joins.hot_key_join``).  Rows without their texts are then range-sorted
by conversation and turn.  A conversation inside one partition is finished there;
one that spans partitions (however large) yields per partition its 4 x 4 costs and
audits, which a fold of at most one row a partition chains, so no task ever holds
a whole long conversation.  Only ``repaired_rows`` sends texts, once, sorted, and
streams them past the audits; a digest over one whole conversation needs that
order, so a conversation's texts pass one task there, row by row.

Null roles, texts and key parts count as one space; a null turn sorts first and
counts in no gap; null ids are one conversation.  Rows of equal turn are ordered by
role and digest.  A conversation whose rows all vanish in the damage, and an empty
table, yield zeros and nothing.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.llm import common
from geoscribe.operators.joins import hot_key_join
from geoscribe.sources.tables import table

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INF = 1 << 60

START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
#: State behind an inserted or reroled row: user where one is due, else assistant.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: What closes a conversation in each state, and its cost.
TAIL = ("", "II", "I", "")
TAIL_COST = (0, 2 * INSERT, INSERT, 0)

# Symbols: class of the role's initial (0 s, 1 u, 2 a, 3 other) + 4 * (0 sound, 1 truncated); 8 must go.
MUST_GO = 8
GRAMMAR_PAIRS = {(0, 1), (1, 2), (2, 1)}

#: An entry is (cost, audit); audits of unreachable entries are empty.
Matrix = list[list[tuple[int, str]]]


def _kept_state(state: int, role: int) -> int | None:
    if role == 0:
        return AFTER_S if state == START else None
    if role == 1:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if role == 2 and state == AFTER_U else None


def transition(symbol: int) -> Matrix:
    """Cheapest way over one row, inserts in front of it included."""
    out: Matrix = [[(INF, "")] * 4 for _ in STATES]
    for s in STATES:
        state, before, cost = s, "", 0
        # Three inserts lead back to a state that was met with fewer.
        for _ in range(4):
            edits = [(DELETE, "D", state)]
            if symbol != MUST_GO:
                extra = TRUNCATED if symbol >= 4 else 0
                kept = _kept_state(state, symbol % 4)
                if kept is not None:
                    edits.append((extra, "K", kept))
                edits.append((REROLE + extra, "R", NEXT[state]))
            for c, edit, t in edits:
                out[s][t] = min(out[s][t], (cost + c, before + edit))
            state, before, cost = NEXT[state], before + "I", cost + INSERT
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product of (cost, audit)."""
    return [[min((a[s][m][0] + b[m][t][0], a[s][m][1] + b[m][t][1]) if a[s][m][0] < INF and b[m][t][0] < INF
                 else (INF, "") for m in STATES) for t in STATES] for s in STATES]


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> Matrix:
    """The transition over ``2 ** k`` equal rows (nine symbols, k up to the binary length of a run)."""
    return transition(symbol) if k == 0 else times(power(symbol, k - 1), power(symbol, k - 1))


@lru_cache(maxsize=None)
def finite(symbol: int, k: int) -> list[list[tuple[int, int, str]]]:
    """Per state the reachable ``(next state, cost, audit)``."""
    return [[(t, c, w) for t, (c, w) in enumerate(row) if c < INF] for row in power(symbol, k)]


def steps_of(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs ``(symbol, length)`` as ``(symbol, k)`` for the binary digits of the length."""
    return [(symbol, k) for symbol, n in runs for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def costs_to_go(steps: list[tuple[int, int]], end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Least cost from each state in front of each step to ``end``."""
    out = [end]
    for symbol, k in reversed(steps):
        after = out[-1]
        out.append(tuple(min([c + after[t] for t, c, _ in row], default=INF) for row in finite(symbol, k)))
    out.reverse()
    return out


def unroll(steps: list[tuple[int, int]], ahead: list[tuple[int, ...]], state: int) -> tuple[str, int]:
    """The least audit among the cheapest, and the state it ends in."""
    audit = []
    for (symbol, k), after in zip(steps, ahead[1:]):
        _, word, state = min((c + after[t], w, t) for t, c, w in finite(symbol, k)[state])
        audit.append(word)
    return "".join(audit), state


def solve(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    steps = steps_of(runs)
    ahead = costs_to_go(steps, TAIL_COST)
    audit, state = unroll(steps, ahead, START)
    return ahead[0][START], audit + TAIL[state]


@lru_cache(maxsize=4096)
def _solve_short(runs: tuple[tuple[int, int], ...]) -> tuple[int, str]:
    return solve(list(runs))


def segment_matrix(runs: list[tuple[int, int]], starts=STATES) -> Matrix:
    """The (cost, audit) transition over the rows of one segment, for the given first states."""
    steps = steps_of(runs)
    out: Matrix = [[(INF, "")] * 4 for _ in STATES]
    for t in STATES:
        ahead = costs_to_go(steps, tuple(0 if x == t else INF for x in STATES))
        for s in starts:
            if ahead[0][s] < INF:
                out[s][t] = (ahead[0][s], unroll(steps, ahead, s)[0])
    return out


# ------------------------------------------------------------------ rows and symbols

def _spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``(conv, turn, role, text, copies)`` after a repeatable damage of a twentieth each:
    rows vanish, lose their text or their sentence ends, are doubled, or become the user's."""
    key = F.concat(_spaced(id_col), F.lit(":"), _spaced(turn_col))
    rows = df.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), _spaced(role_col).alias("role"),
                     _spaced(text_col).alias("text"), (F.crc32(key) % 20).alias("hit")).where(F.col("hit") != 0)
    text = (F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"),
                       F.when(F.col("hit") == 3, 2).otherwise(1).alias("copies"))


def _digest() -> Column:
    """Identity of a row's role and text (128 bits), also the order of rows of one turn and role."""
    return F.unhex(F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text"))))


def _ordered(first: list[str]) -> list[Column]:
    return [*[F.col(c) for c in first], F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def symbol_rows(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, digest, n, sound, first)``: distinct rows with their count; ``sound`` is
    0 blank, 1 truncated, 2 sound, and ``first`` tells whether the text was not seen at an earlier turn."""
    word = r"[^\x20\x09-\x0D]"
    sound = (F.when(~F.col("text").rlike(word), 0)
             .when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 2).otherwise(1))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    # A turn that sorts: nulls first.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    narrow = rows.select("conv", "turn", "role", _digest().alias("digest"), sound.alias("sound"), copies.alias("n"))
    distinct = common.materialize(
        narrow.groupBy("conv", "turn", "role", "digest").agg(F.sum("n").alias("n"), F.first("sound").alias("sound")),
        "conversation_rows").withColumn("place", place)
    # Texts of two or more turns; the others are their own first.
    repeated = (distinct.where(F.col("sound") > 0).groupBy("conv", "digest")
                .agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("turns")).where(F.col("turns") > 1)
                .select(F.col("conv").alias("r_conv"), F.col("digest").alias("r_digest"), "earliest"))
    joined = hot_key_join(distinct, repeated, [("conv", "r_conv"), ("digest", "r_digest")], "left")
    first = F.col("earliest").isNull() | F.col("earliest").eqNullSafe(F.col("place"))
    return joined.select("conv", "turn", "role", "digest", "n", "sound", first.alias("first"))


class _Segment:
    """What one partition knows of one conversation."""

    __slots__ = ("conv", "runs", "rows", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high",
                 "turns", "first_turn", "last_turn")

    def __init__(self, conv):
        self.conv, self.runs = conv, []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = self.first_turn = self.last_turn = None

    def _run(self, symbol: int, n: int) -> None:
        if n <= 0:
            return
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = (symbol, self.runs[-1][1] + n)
        else:
            self.runs.append((symbol, n))

    def add(self, turn, role: str, n: int, sound: int, is_first: bool) -> None:
        initial = "sua".find(role[:1]) if role else -1
        initial = 3 if initial < 0 else initial
        if sound == 0:
            self.blank += n
            self._run(MUST_GO, n)
        else:
            fresh = 1 if is_first else 0
            self.duplicate += n - fresh
            self.truncated += fresh if sound == 1 else 0
            self._run(initial + (4 if sound == 1 else 0), fresh)
            self._run(MUST_GO, n - fresh)
        # No pair of equal initials is legal.
        self.illegal += n - 1 + (self.rows > 0 and (self.last, initial) not in GRAMMAR_PAIRS)
        if self.rows == 0:
            self.first, self.first_turn = initial, turn
        if turn is not None and (self.rows == 0 or turn != self.last_turn):
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last, self.last_turn = initial, turn
        self.rows += n


_STATS = ("rows", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns", "first_turn", "last_turn")

_ENTRY = T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])


def _segments(rows: DataFrame) -> DataFrame:
    """One row per conversation and partition.  ``cells`` (16, row by row) where the conversation may go
    on in another partition, else ``cost`` and ``audit``."""
    schema = T.StructType([rows.schema["conv"], T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in _STATS],
                           T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                           T.StructField("cells", T.ArrayType(_ENTRY))])
    arrow = {"conv": None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        done: list[dict] = []
        segment, seq = None, 0

        def close(segment: _Segment, open_end: bool, seq: int) -> dict:
            row = {c: getattr(segment, c) for c in _STATS} | {
                "conv": segment.conv, "part": part, "seq": seq, "cost": None, "audit": None, "cells": None}
            if open_end or seq == 0:
                cells = segment_matrix(segment.runs)
                row["cells"] = [{"cost": c, "audit": w} for r in cells for c, w in r]
            else:
                runs = tuple(segment.runs)
                row["cost"], row["audit"] = _solve_short(runs) if len(runs) <= 32 and max(n for _, n in runs) < 64 else solve(segment.runs)
            return row

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(done, schema=_arrow_schema(schema, arrow["conv"]))
            done.clear()
            return out

        size = 0
        for batch in batches:
            arrow["conv"] = batch.schema.field("conv").type
            for conv, turn, role, n, sound, first in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "n", "sound", "first")]):
                if segment is None or conv != segment.conv:
                    if segment is not None:
                        done.append(close(segment, False, seq))
                        size += len(done[-1]["audit"] or "") + sum(len(c["audit"]) for c in done[-1]["cells"] or ())
                        seq += 1
                        if len(done) >= 4096 or size > 4 << 20:
                            size = 0
                            yield flush()
                    segment = _Segment(conv)
                segment.add(turn, role, n, sound, first)
        if segment is not None:
            done.append(close(segment, True, seq))
            yield flush()

    return rows.mapInArrow(run, schema)


def _arrow_schema(schema: T.StructType, conv: pa.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)
    return out.set(out.get_field_index("conv"), pa.field("conv", conv))


def _chain(key: tuple, table: pa.Table) -> pa.Table:
    """Fold the segments of one conversation (at most one a partition): statistics, cost, and the end
    states each segment goes through, as the position of its cell."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    total = dict(rows[0])
    for prev, cur in zip(rows, rows[1:]):
        for c in ("rows", "blank", "duplicate", "truncated", "illegal", "turns"):
            total[c] += cur[c]
        total["illegal"] += (prev["last"], cur["first"]) not in GRAMMAR_PAIRS
        total["turns"] -= cur["first_turn"] is not None and prev["last_turn"] == cur["first_turn"]
        total["low"] = cur["low"] if total["low"] is None else total["low"]
        total["high"] = total["high"] if cur["high"] is None else cur["high"]
    ahead = [TAIL_COST]
    for r in reversed(rows):
        ahead.append(tuple(min(r["costs"][4 * s + t] + ahead[-1][t] for t in STATES) for s in STATES))
    ahead.reverse()
    out, state = [], START
    for r, after in zip(rows, ahead[1:]):
        # Ranks order the audits of one first state as their texts do.
        _, _, end = min((r["costs"][4 * state + t] + after[t], r["ranks"][4 * state + t], t) for t in STATES)
        out.append({"part": r["part"], "cell": 4 * state + end, "tail": TAIL[end] if r is rows[-1] else ""})
        state = end
    first = out[0] | {c: total[c] for c in ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")}
    first["cost"] = ahead[0][START]
    names = ["part", "cell", "tail", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "cost"]
    kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 8]
    made = [first, *out[1:]]
    columns = [pa.array([m.get(n) for m in made], k) for n, k in zip(names, kinds)]
    conv = table.column("conv").combine_chunks()
    conv = conv.take(pa.array([0] * len(made)))
    return pa.Table.from_arrays([conv, *columns], ["conv", *names])


def repair_conversations(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` for ``(conv, turn, role, text[, copies])``.

    ``partitions`` is the number of range partitions (shuffle partitions if not given).
    """
    narrow = symbol_rows(rows)
    order = _ordered(["conv"])
    ranged = narrow.repartitionByRange(partitions, *order) if partitions else narrow.repartitionByRange(*order)
    segments = common.materialize(_segments(ranged.sortWithinPartitions(*order)), "conversation_segments")

    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    counts = ["blank", "duplicate", "truncated", "illegal"]
    whole = segments.where(F.col("cells").isNull()).select("conv", gaps, *counts, "cost", "audit")

    at_ends = segments.where(F.col("cells").isNotNull())
    costs = F.transform("cells", lambda c: c["cost"])
    # Rank of each audit among the four of its first state, so that the fold needs no texts.
    ranks = F.expr("transform(sequence(0, 15), i -> size(filter(slice(cells, int(i / 4) * 4 + 1, 4), "
                   "c -> c.audit < get(cells, i).audit)))")
    folded = at_ends.select("conv", "part", *_STATS, costs.alias("costs"), ranks.alias("ranks")).groupBy("conv").applyInArrow(
        _chain, T.StructType([segments.schema["conv"], T.StructField("part", T.IntegerType()), T.StructField("cell", T.IntegerType()),
                              T.StructField("tail", T.StringType()),
                              *[T.StructField(c, T.LongType()) for c in (*counts, "low", "high", "turns", "cost")]]))
    pieces = common.null_safe(at_ends.select("conv", "part", "cells"), folded, ["conv", "part"], "inner")
    piece = F.struct("part", F.concat(F.get("cells", F.col("cell"))["audit"], F.col("tail")).alias("audit"))
    spread = pieces.groupBy("conv").agg(
        *[F.max(c).alias(c) for c in (*counts, "low", "high", "turns", "cost")], F.array_sort(F.collect_list(piece)).alias("pieces"))
    audit = F.array_join(F.transform("pieces", lambda p: p["audit"]), "").alias("audit")
    return whole.unionByName(spread.select("conv", gaps, *counts, "cost", audit))


# ------------------------------------------------------------------ repaired rows

def repaired_rows(rows: DataFrame, repaired: DataFrame) -> DataFrame:
    """``(conv, position, edit, role, text)`` of the rows that stay or are inserted.

    Partitioned by conversation and sorted inside each partition; texts are streamed
    past their conversation's audit and never gathered.
    """
    texts = (rows.withColumn("digest", _digest())
             .select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text",
                     (F.col("copies") if "copies" in rows.columns else F.lit(1)).cast("long").alias("copies")))
    audits = repaired.select("conv", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                             F.lit("").alias("role"), F.lit(b"").alias("digest"), F.col("audit").alias("text"),
                             F.lit(1).cast("long").alias("copies"))
    mixed = texts.unionByName(audits).repartition("conv").sortWithinPartitions(*_ordered(["conv", "kind"]))
    schema = T.StructType([rows.schema["conv"], T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, position = "", 0, START, 0
        for batch in batches:
            take, out = [], ([], [], [], [])          # row of the batch, position, edit, role, text

            def put(row: int, edit: str, role: str, text: str) -> None:
                nonlocal position
                take.append(row)
                for column, value in zip(out, (position, edit, role, text)):
                    column.append(value)
                position += 1

            def inserts(row: int) -> None:
                nonlocal at, state
                while at < len(audit) and audit[at] == "I":
                    put(row, "I", "assistant" if state == AFTER_U else "user", "")
                    state, at = NEXT[state], at + 1

            columns = [batch.column(c).to_pylist() for c in ("kind", "role", "text", "copies")]
            for row, (kind, role, text, copies) in enumerate(zip(*columns)):
                if kind == 0:
                    audit, at, state, position = text, 0, START, 0
                    continue
                for _ in range(copies):
                    inserts(row)
                    edit, at = audit[at], at + 1
                    if edit == "K":
                        state = _kept_state(state, "sua".find(role[:1]))
                        put(row, edit, role, text)
                    elif edit == "R":
                        put(row, edit, "assistant" if state == AFTER_U else "user", text)
                        state = NEXT[state]
                # Inserts behind the last row; those in front of a next row give the same rows here.
                inserts(row)
            conv = batch.column("conv").take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [conv, pa.array(out[0], pa.int64()), *[pa.array(c, pa.string()) for c in out[1:]]],
                ["conv", "position", "edit", "role", "text"])

    return mixed.mapInArrow(run, schema)


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """``(conv, sha256)`` of the newline-joined ``role:text`` of rows as ``repaired_rows`` leaves them."""
    schema = T.StructType([repaired.schema["conv"], T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, current, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field("conv").type
            convs, shas = [], []
            for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")]):
                if digest is None or conv != current:
                    if digest is not None:
                        convs.append(current)
                        shas.append(digest.hexdigest())
                    digest, current = hashlib.sha256(), conv
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(shas, pa.string())], ["conv", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()], pa.string())],
                                             ["conv", "sha256"])

    return repaired.mapInArrow(run, schema)


def op12_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every damaged conversation."""
    return damage_and_repair(table(spark, sf_dir, "conversations"))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    rows = damage(conversations)
    repaired = common.materialize(repair_conversations(rows), "conversation_repairs")
    digests = conversation_digests(repaired_rows(rows, repaired))
    every = conversations.select(F.col("conv_id").alias("conv")).distinct()
    out = common.null_safe(common.null_safe(every, repaired, ["conv"], "left"), digests, ["conv"], "left")
    zero, empty = F.lit(0), hashlib.sha256(b"").hexdigest()
    return out.select(F.col("conv").alias("conv_id"),
                      *[F.coalesce(F.col(c), zero).cast("long").alias(c)
                        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))
