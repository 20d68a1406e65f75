"""Conversation structure repair by the cheapest edits, streamed in secondary-sorted order.

Rows are dealt by conversation and sorted by turn inside each task. A first pass runs from the last turn to the
first: a task carries, across Arrow batches, the cheapest cost of the rest of the conversation from each of four
states (nothing yet, after a system, a user, an assistant turn) and gives every row one byte, the best edit for
each state. These backpointers travel with their rows through Spark's external sort, which spills them to disk where
a conversation is large, and a second pass walks them from the first turn on. Both passes and both sorts share
one shuffle, and no task holds more of a conversation than one batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.llm.storage import ready

SPACE = " \t\n\x0b\x0c\r"
#: costs of edits; a truncated row that is not deleted costs one more
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: states: 0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an assistant turn (0 and 3 may end)
_SPOKEN = (2, 2, 3, 2)
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ENDS = (0, 2 * INSERT, INSERT, 0)
#: edits in ASCII order of their initials, two bits each in a backpointer
EDITS = "DIKR"
_NAMES = {2: "user", 3: "assistant"}

_STEP = "conv string, place long, edit string, turn long, was string, role string, text string, fault string"


def _marked(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversation key, place values and the first fault of every row, dealt by conversation."""
    rows = turns.select(
        F.coalesce(F.col(conv).cast("string"), F.lit(" ")).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("was"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    rows = rows.repartition("conv")
    # partitions by conversation serve this window too: no second shuffle
    same = W.partitionBy("conv", "was", "digest").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("digest", F.md5("text")).withColumn("copy", F.row_number().over(same) > 1)
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    fault = F.when(last == "", "blank").when(F.col("copy"), "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    return rows.select("conv", "turn", "was", "text", fault.alias("fault"), "copy")


def _kind(was: str, fault: str | None) -> tuple[str, int, bool]:
    """What the cheapest edits depend on: role initial, extra cost if not deleted, whether it must be deleted."""
    return was[:1], TRUNCATED if fault == "truncated" else 0, fault in ("blank", "duplicate")


def _back(rest: tuple[int, ...], kind: tuple[str, int, bool]) -> tuple[tuple[int, ...], int]:
    """Cheapest costs before a row, given those after it, and the row's backpointers."""
    initial, extra, gone = kind
    options = []
    for s in range(4):
        way = {"D": DELETE + rest[s]}
        if not gone:
            way["R"] = REROLE + extra + rest[_SPOKEN[s]]
            if initial in _KEPT[s]:
                way["K"] = extra + rest[_KEPT[s][initial]]
        options.append(way)
    best = [min(w.values()) for w in options]
    for _ in range(3):  # an inserted turn leads to another state before the same row
        best = [min(best[s], INSERT + best[_SPOKEN[s]]) for s in range(4)]
    code = 0
    for s in range(4):
        options[s]["I"] = INSERT + best[_SPOKEN[s]]
        letter = next(e for e in EDITS if options[s].get(e) == best[s])
        code |= EDITS.index(letter) << 2 * s
    return tuple(best), code


def _point(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Backpointers, from the last turn to the first. Costs are kept relative to the least of the four."""
    known: dict = {}
    conv, rest = None, _ENDS
    for batch in batches:
        codes = []
        for c, was, fault in zip(batch["conv"], batch["was"], batch["fault"]):
            if c != conv:
                conv, rest = c, _ENDS
            at = (rest, _kind(was, fault))
            if at not in known:
                costs, code = _back(*at)
                low = min(costs)
                known[at] = tuple(x - low for x in costs), code
            rest, code = known[at]
            codes.append(code)
        yield batch.assign(code=codes)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits from the first turn on, in order."""
    names = [f.split()[0] for f in _STEP.split(", ")]
    conv, state, place = None, 0, 0
    for batch in batches:
        out: list[tuple] = []

        def insert(state: int, place: int) -> int:
            out.append((conv, place, "I", None, None, _NAMES[_SPOKEN[state]], "", None))
            return _SPOKEN[state]

        turns = batch["turn"].astype(object).where(batch["has_turn"], None)
        for c, turn, was, text, fault, code in zip(
            batch["conv"], turns, batch["was"], batch["text"], batch["fault"], batch["code"]
        ):
            if c != conv:
                while state in (1, 2):
                    state, place = insert(state, place), place + 1
                conv, state, place = c, 0, 0
            while (letter := EDITS[code >> 2 * state & 3]) == "I":
                state, place = insert(state, place), place + 1
            role = None
            if letter == "K":
                state, role = _KEPT[state][was[:1]], was
            elif letter == "R":
                state = _SPOKEN[state]
                role = _NAMES[state]
            out.append((c, place, letter, turn, was, role, text if role is not None else None, fault))
            place += 1
        yield _frame(out, names)
    out = []
    while state in (1, 2):
        out.append((conv, place, "I", None, None, _NAMES[_SPOKEN[state]], "", None))
        state, place = _SPOKEN[state], place + 1
    yield _frame(out, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=names, dtype=object)
    return made.astype({"turn": "Int64", "place": "Int64"})


def repair_steps(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The cheapest edits that make every conversation's role initials `(s?(ua)+)?`, one row an edit: conv (the
    id as text, one space for NULL), place (from 0), edit (D delete, I insert, K keep, R rerole), turn and was (the
    row's own turn and role, NULL for an insert), role and text after the edit (NULL for a delete), fault (blank,
    duplicate, truncated or NULL: the row's first). Rows with place order and edit other than D are the repaired
    conversation. Of equally cheap repairs the one whose edits are least in ASCII order.

    Rows are ordered by turn (NULL first), ties by role and text. Blank and duplicate rows (equal role and text
    in an earlier row) are always deleted; a truncated row that stays costs 1. NULL role or text is one space, so a
    NULL or empty text is blank. Texts and conversations may be of any length: tasks stream them. An empty table
    gives no rows; other columns are ignored."""
    ready(turns.sparkSession)
    rows = _marked(turns, conv_col, turn_col, role_col, text_col)
    rows = rows.withColumn("has_turn", F.col("turn").isNotNull()).fillna({"turn": 0})
    # a NULL turn sorts by its flag from here on
    first = F.struct("has_turn", "turn").alias("at")
    rows = rows.select("conv", first, "was", "text", "fault", "copy")
    down = rows.sortWithinPartitions("conv", *[F.col(c).desc() for c in ("at", "was", "text", "copy")])
    down = down.select("conv", "at.has_turn", "at.turn", "was", "text", "fault", "copy")
    fields = "conv string, has_turn boolean, turn long, was string, text string, fault string, copy boolean, code int"
    coded = down.mapInPandas(_point, fields)
    up = coded.sortWithinPartitions("conv", "has_turn", "turn", "was", "text", "copy")
    return up.mapInPandas(_walk, _STEP)


_REPORT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class _Report:
    """Counts of one conversation, fed with its edits in order."""

    legal = ("su", "ua", "au")

    def __init__(self, conv: str) -> None:
        self.conv, self.first, self.last, self.turns = conv, None, None, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.cost, self.before = 0, 0, None
        self.audit: list[str] = []
        self.hash, self.begun = hashlib.sha256(), False

    def feed(self, edit: str, turn: int | None, was: str, role: str, text: str, fault: str | None) -> None:
        if edit != "I":
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1
            if fault is not None:
                self.faults[fault] += 1
            self.illegal += self.before is not None and self.before + was[:1] not in self.legal
            self.before = was[:1]
        self.cost += {"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[edit]
        self.cost += TRUNCATED if fault == "truncated" and edit != "D" else 0
        self.audit.append(edit)
        if edit != "D":
            self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (
            self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _REPORT.split(", ")]
    now: _Report | None = None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    for batch in batches:
        done = []
        columns = [batch[c].to_pylist() for c in ("conv", "edit", "turn", "was", "role", "text", "fault")]
        for conv, *step in zip(*columns):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Report(conv)
            now.feed(*step)
        yield made(done)
    if now is not None:
        yield made([now.row()])


def repair_report(turns: DataFrame, **columns: str) -> DataFrame:
    """One row per conversation that has rows: conv_id as text (`conv`), gaps (turn numbers missing between the
    least and the greatest; NULL turns do not count), blank, duplicate, truncated (rows by first fault), illegal
    (adjacent rows whose role initials are not su, ua or au), cost, audit (the edits' initials in order) and
    repaired_sha256 (of the repaired turns as role:text, newline-joined). Arguments as in repair_steps, whose edits
    it sums up in their order, without another shuffle."""
    return repair_steps(turns, **columns).mapInArrow(_summed, _REPORT)
