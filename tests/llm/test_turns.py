"""Conversation repair against a plain search over edits, whole results."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from geoscribe.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, n long, digest string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """Rows after damage, per conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        conv_rows = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if hit == 1:
            text = ""
        elif hit == 2:
            text = re.sub("[.!?]", "", text)
        elif hit == 4:
            role = "user"
        conv_rows += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    for conv_rows in out.values():
        conv_rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        letters = WORD.findall(text)
        out.append("blank" if not letters else "duplicate" if (role, text) in seen else
                   "truncated" if letters[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(roles, bad):
    """Cheapest (cost, audit, repaired roles) over all edits, row by row, on strings of initials."""
    @lru_cache(maxsize=None)
    def best(i, state):
        # state: initials so far, folded to what the grammar needs
        options = []
        if i == len(roles):
            if state in ("", "a"):
                return 0, ""
        else:
            options.append((4, "D", i + 1, state))
            if bad[i] not in ("blank", "duplicate"):
                extra = 3 if bad[i] == "truncated" else 0
                for edit, initial, cost in (("K", roles[i], 0), ("R", "u", 3), ("R", "a", 3)):
                    if follows(state, initial):
                        options.append((cost + extra, edit, i + 1, initial))
        found = [(c + x, e + w) for c, e, j, s in options for x, w in [best(j, s)]]
        return min(found + [insert(i, state)])

    def insert(i, state):
        # One or two inserts, then a row edit or the end.
        out, s, word = [], state, ""
        for n in (1, 2):
            s, word = ("u" if s != "u" else "a"), word + "I"
            if i == len(roles):
                if s == "a":
                    out.append((3 * n, word))
                continue
            out.append((3 * n + 4 + best(i + 1, s)[0], word + "D" + best(i + 1, s)[1]))
            if bad[i] not in ("blank", "duplicate"):
                extra = 3 if bad[i] == "truncated" else 0
                for edit, initial, cost in (("K", roles[i], 0), ("R", "u", 3), ("R", "a", 3)):
                    if follows(s, initial):
                        out.append((3 * n + cost + extra + best(i + 1, initial)[0], word + edit + best(i + 1, initial)[1]))
        return min(out, default=(10 ** 9, ""))

    def follows(state, initial):
        return (initial == "s" and state == "") or (initial == "u" and state != "u") or (initial == "a" and state == "u")

    return best(0, "")


def apply(rows, audit):
    out, i = [], 0
    for edit in audit:
        due = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((due, ""))
            continue
        role, text = rows[i][1:]
        i += 1
        if edit != "D":
            out.append((role if edit == "K" else due, text))
    assert i == len(rows) and GRAMMAR.fullmatch("".join(r[:1] for r, _ in out))
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def expected(table):
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in table}
    for conv, rows in damaged(table).items():
        if not rows:
            continue
        bad = faults(rows)
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = brute_repair(tuple(initials), tuple(bad))
        out[conv] = (gaps, *(bad.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, apply(rows, audit))
    return out


def awkward():
    rng = random.Random(5)
    texts = ["Yes.", "No", "", "  ", "Why?", "Fine! ", "a" * 50_000 + ".", None, "Yes."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts))
            for c in [None, *range(60)] for _ in range(rng.randrange(1, 9))]
    rows += [(700, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(300)]      # long and sound
    rows += [(701, 5, "user", "Again.")] * 40 + [(701, t, "assistant", "Again and again") for t in range(40)]
    rows += [(702, t, "user", f"Only questions {t}?") for t in range(100)]
    return rows + rows[:10]


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in awkward()], SCHEMA)


def collected(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in df.collect()}


def test_matches_search_over_all_edits(spark, conversations):
    got = turns.damage_and_repair(conversations)
    want = expected(awkward())
    assert got.count() == len(want)
    assert collected(got) == want


def test_conversations_across_partitions(spark, conversations):
    """Whole results do not depend on where the range partitions end."""
    rows = turns.damage(conversations)
    base = {r.conv: tuple(r) for r in turns.repair_conversations(rows, 1).collect()}
    for n in (7, 40):
        assert {r.conv: tuple(r) for r in turns.repair_conversations(rows, n).collect()} == base


def test_sf_table(spark):
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    assert collected(turns.op12_run_length_repair(spark, "/root/testdata/sf0.001")) == expected(table)


def test_powers_agree_with_single_steps():
    rng = random.Random(3)
    for _ in range(300):
        runs = [(rng.randrange(9), rng.randrange(1, 30)) for _ in range(rng.randrange(1, 6))]
        initials = tuple("suat"[s % 4] for s, n in runs for _ in range(n))
        bad = tuple("blank" if s == 8 else "truncated" if s >= 4 else "" for s, n in runs for _ in range(n))
        assert turns.solve(runs) == brute_repair(initials, bad)
        # Any cut into segments chains to the same.
        state = {turns.START: (0, "")}
        for run in runs:
            m = turns.segment_matrix([run])
            state = {t: min((c + m[s][t][0], w + m[s][t][1]) for s, (c, w) in state.items()) for t in turns.STATES}
        assert min((c + turns.TAIL_COST[t], w + turns.TAIL[t]) for t, (c, w) in state.items()) == turns.solve(runs)


def test_a_very_long_run_takes_few_steps():
    steps = turns.steps_of([(1, 1_000_000)])
    assert len(steps) < 21
    cost, audit = turns.solve([(1, 1_000_000)])
    assert len(audit.replace("I", "")) == 1_000_000 and cost == 3 * 500_000


def test_empty_and_vanished(spark, conversations):
    assert turns.damage_and_repair(conversations.limit(0)).count() == 0
    gone = next(c for c in itertools.count() if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello.", 1, "x")], SCHEMA)
    row = turns.damage_and_repair(df).collect()[0]
    assert (row.conv_id, row.audit, row.cost, row.repaired_sha256) == (gone, "", 0, hashlib.sha256(b"").hexdigest())


def test_repaired_rows_are_the_operators_output(spark, conversations):
    rows = turns.damage(conversations)
    repaired = turns.repair_conversations(rows)
    out = turns.repaired_rows(rows, repaired)
    assert out.columns == ["conv", "position", "edit", "role", "text"]
    edits = repaired.select(F.sum(F.length(F.translate("audit", "D", "")))).first()[0]
    assert out.count() == edits
