import functools
import hashlib
import random
import sys

import pytest

from growthlab.llm import repair

sys.setrecursionlimit(20_000)  # the plain version recurses per row
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = {2: "user", 3: "assistant"}


def plain(rows):
    """Cheapest edits by trying all of them, with (cost, audit, lines)."""
    rows = sorted(((t is not None, t or 0), r if r is not None else " ", x if x is not None else " ") for t, r, x in rows)
    seen, marked = set(), []
    for at, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))

    @functools.cache
    def best(i, state, inserted):
        ways = []
        if i == len(marked) and state in (0, 3):
            ways.append((0, "", ()))
        spoken = 3 if state == 2 else 2
        if inserted < 3:
            c, e, t = best(i, spoken, inserted + 1)
            ways.append((c + 2, "I" + e, (f"{NAMES[spoken]}:",) + t))
        if i < len(marked):
            role, text, fault = marked[i]
            c, e, t = best(i + 1, state, 0)
            ways.append((c + 3, "D" + e, t))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                c, e, t = best(i + 1, spoken, 0)
                ways.append((c + 2 + more, "R" + e, (f"{NAMES[spoken]}:{text}",) + t))
                to = 1 if role[:1] == "s" and state == 0 else spoken if role[:1] == "ua"[spoken - 2] else None
                if to is not None:
                    c, e, t = best(i + 1, to, 0)
                    ways.append((c + more, "K" + e, (f"{role}:{text}",) + t))
        return min(ways, default=(10**9, "", ()))

    cost, audit, lines = best(0, 0, 0)
    faults = [f for *_, f in marked]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    turns = {at[1] for at, *_ in rows if at[0]}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha


def check(spark, rows):
    got = {r[0]: tuple(r[1:]) for r in repair.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    wanted = {}
    for c, *rest in rows:
        wanted.setdefault(" " if c is None else str(c), []).append(rest)
    assert got == {c: plain(x) for c, x in wanted.items()}


def test_random_conversations_against_all_edits(spark):
    draw = random.Random(5)
    texts = ["Yes.", "No!", "and then", " \n", "", "What?", "Yes. \t", "é", None]
    rows = []
    for c in range(160):
        for t in range(draw.randrange(9)):
            turn = draw.choice([t, t, t, t + 3, None])
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((c if c else None, turn, role, draw.choice(texts) if draw.random() < 0.5 else f"Turn {t}."))
    check(spark, rows)


def test_ties_and_repeated_rows(spark):
    check(spark, [(1, 5, "user", "A."), (1, 5, "user", "A."), (1, 5, "assistant", "A."), (1, 5, "assistant", "B")] * 2)


def test_far_turn_numbers_stay_exact(spark):
    rows = [(2**62 + 1, 2**61, "user", "A."), (2**62 + 1, 2**61 + 3, "assistant", "B."), (2**62 + 1, None, "system", "C.")]
    got = repair.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.conv, r.gaps, r.audit) for r in got] == [(str(2**62 + 1), 2, "KKK")]


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = repair.ready
    repair.ready = lambda s: s.conf.set(name, "7")
    yield
    repair.ready = before


def test_one_giant_conversation_over_many_batches(spark, small_batches):
    draw = random.Random(7)
    rows = [(3, t, draw.choice(["user", "assistant", "system"]), f"{t}" + draw.choice([".", "", "?"])) for t in range(400)]
    check(spark, [*rows, (4, 0, "user", "Hi.")])


def test_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 1_000_000), (1, 1, "assistant", " " * 3_000_000), (1, 2, "assistant", "é" * 2_000_000 + ".")]
    check(spark, rows)


def test_steps_are_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "assistant", "Cut"), (1, 3, "user", "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", audit string, place int")
    steps = sorted((s.place, s.edit, s.turn, s.was, s.role, s.text, s.fault) for s in repair.repair_steps(df).collect())
    assert steps == [
        (0, "K", 0, "system", "system", "S.", None),
        (1, "R", 1, "assistant", "user", "A.", None),
        (2, "K", 2, "assistant", "assistant", "Cut", "truncated"),
        (3, "D", 3, "user", None, None, "blank"),
    ]


def test_empty_table(spark):
    assert repair.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []
