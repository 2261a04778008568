"""Operator 1: chat formatting with minimum-cost role repair.

Legal conversations are paths of a small automaton: an optional system turn first, then user and assistant in turn.
Dynamic programming over its states finds the cheapest repair of a conversation: a turn may be kept, merged
into the turn before it (same role), relabelled, or preceded by one empty inserted turn.  Ties go to the first of
keep, merge, insert, and to the earlier state, so the result is one and the same everywhere.

Scale: the cost of a run of turns is a matrix over the states, and matrices compose (least sums), so a conversation
need not fit a task.  Turns are sorted by range of (conv_id, turn, role, md5 of the text, row number); each task composes the
runs of its partition, and the driver sees only the first and last run of each partition (two rows each), over which
it picks the states at the cuts.  A second pass repairs every run between its fixed states and renders it.  Memory is
bounded by a partition, whatever the length of a conversation.

Result, one row per input turn: the repaired role, the action, the role of an empty turn inserted before it, and the
rendered piece.  The pieces of a conversation in order of position are its rendered text.  A text that holds a turn marker gets a
backslash into it (:func:`escaped`), so no text forges a turn, and :func:`unescaped` gives it back.

Defined results: roles are trimmed, lower-cased and freed of aliases; a null or unknown role must be relabelled.
A null text is empty.  Turns of equal number are ordered by role and md5 of the text, null first; repeated rows are turns of their
own.  A null conv_id is a conversation of its own.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import map_arrow
from rollcall.session import ensure_checkpoint_dir

START, ROLES = 0, ("", "system", "user", "assistant")
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "developer": "system"}
FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    insert: int = 2
    relabel: int = 3


def role_number(role: str | None) -> int:
    """The automaton's number of a role; -1 for none of its roles."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES[1:] else -1


def steps(costs: Costs = Costs()) -> dict[int, dict[tuple[int, int], tuple[int, str, int]]]:
    """For each role of a turn, by (state, next state): cost, action, inserted role (0: none) of the best way."""
    out: dict = {}
    for role in (-1, 1, 2, 3):
        table = out[role] = {}
        for s in range(4):
            for t in (1, 2, 3):
                same, extra = t == role, 0 if t == role else costs.relabel
                ways = []
                if t in LEGAL[s]:
                    ways.append((extra, "keep" if same else "relabel", 0))
                if t == s:
                    ways.append((extra + costs.merge, "merge" if same else "relabel+merge", 0))
                for x in LEGAL[s]:
                    if t in LEGAL[x]:
                        ways.append((extra + costs.insert, "keep" if same else "relabel", x))
                if ways:
                    table[s, t] = min(ways, key=lambda w: w[0])
    return out


def compose(left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
    return [[min(left[s][x] + right[x][t] for x in range(4)) for t in range(4)] for s in range(4)]


UNIT = [[0 if s == t else FAR for t in range(4)] for s in range(4)]


def matrix(step: dict) -> list[list[int]]:
    return [[step[s, t][0] if (s, t) in step else FAR for t in range(4)] for s in range(4)]


def repair(roles: list[int], table: dict, first: int = START, last: int | None = None) -> list[tuple[int, str, int, int]]:
    """(role, action, inserted, cost) for each turn of a run that begins in state ``first`` and ends in ``last``."""
    best, back = [FAR] * 4, []
    best[first] = 0
    for role in roles:
        step, now, way = table[role], [FAR] * 4, [0] * 4
        for (s, t), (cost, _, _) in step.items():
            if best[s] + cost < now[t]:
                now[t], way[t] = best[s] + cost, s
        best = now
        back.append(way)
    state = last if last is not None else min(range(4), key=lambda t: best[t])
    out = []
    for role, way in zip(reversed(roles), reversed(back)):
        before = way[state]
        cost, action, inserted = table[role][before, state]
        out.append((state, action, inserted, cost))
        state = before
    return out[::-1]


_MARKER = re.compile(r"<(\\*\|im_(?:start|end)\|>)")
_ESCAPED = re.compile(r"<\\(\\*\|im_(?:start|end)\|>)")


def escaped(text: str) -> str:
    """A turn's text with one more backslash in what would read as a turn marker, so that no text can begin or end a turn."""
    return _MARKER.sub(r"<\\\1", text)


def unescaped(text: str) -> str:
    """What :func:`escaped` was given."""
    return _ESCAPED.sub(r"<\1", text)


def piece(role: int, action: str, inserted: int, text: str, first: bool, final: bool) -> str:
    """What a turn adds to the rendered conversation."""
    text = escaped(text)
    if action.endswith("merge"):
        out = "\n" + text
    else:
        out = "" if first else "<|im_end|>\n"
        if inserted:
            out += f"<|im_start|>{ROLES[inserted]}\n<|im_end|>\n"
        out += f"<|im_start|>{ROLES[role]}\n{text}"
    return out + ("<|im_end|>\n" if final else "")


def _runs(batches):
    """The rows of a sorted partition, run by run of equal conv_id: (conv_id, rows)."""
    conv, rows, any_row = None, [], False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if any_row and row[0] != conv:
                yield conv, rows
                rows = []
            conv, any_row = row[0], True
            rows.append(row)
    if any_row:
        yield conv, rows


def formatted(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Repair and render all conversations; see the module's text for the result."""
    ensure_checkpoint_dir(turns.sparkSession)
    slim = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                        turns["role"].cast("string").alias("role"), turns["text"].cast("string").alias("text"))
    cuts = [*[F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text_md5")], "row"]
    rows = slim.withColumn("text_md5", F.md5(F.col("text").cast("binary"))).withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*cuts).sortWithinPartitions(*cuts)
    rows = rows.select("conv_id", "turn", "role", "text").checkpoint()
    table = steps(costs)

    def summarize(batches):
        part, found = TaskContext.get().partitionId(), []
        for conv, run in _runs(batches):
            total = UNIT
            for row in run:
                total = compose(total, matrix(table[role_number(row[2])]))
            found = [*found[:1], (part, conv, len(run), [x for line in total for x in line])]
        if found:
            columns = [[f[i] for f in found] for i in range(4)]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "conv_id", "n", "costs"])

    ends = map_arrow(rows, summarize, "part int, conv_id long, n long, costs array<long>").collect()  # two rows a partition
    fixed = turns.sparkSession.sparkContext.broadcast(cut_states(ends))

    def render(batches):
        part, out = TaskContext.get().partitionId(), []
        for conv, run in _runs(batches):
            first, last, before, final = fixed.value.get((part, conv), (START, None, 0, True))
            done = repair([role_number(r[2]) for r in run], table, first, last)
            for i, (row, (role, action, inserted, cost)) in enumerate(zip(run, done)):
                text = piece(role, action, inserted, row[3] or "", before + i == 0, final and i == len(run) - 1)
                out.append((conv, row[1], before + i, row[2], ROLES[role], action, ROLES[inserted] or None, cost, text))
                if len(out) >= 2000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string())
    names = ["conv_id", "turn", "position", "role_in", "role", "action", "inserted", "cost", "rendered"]

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    return map_arrow(rows, render, "conv_id long, turn long, position long, role_in string, role string, action string, "
                                   "inserted string, cost int, rendered string")


def cut_states(ends) -> dict[tuple, tuple[int, int | None, int, bool]]:
    """For each run at a partition's edge: entry state, exit state, turns before it, and whether it is the last."""
    by_conv: dict = defaultdict(list)
    for part, conv, n, costs in sorted(ends, key=lambda e: e[0]):
        by_conv[conv].append((part, n, [list(costs[4 * s:4 * s + 4]) for s in range(4)]))
    out = {}
    for conv, runs in by_conv.items():
        best, back = [0, FAR, FAR, FAR], []
        for _, _, m in runs:
            back.append([min(range(4), key=lambda s: best[s] + m[s][t]) for t in range(4)])
            best = [best[back[-1][t]] + m[back[-1][t]][t] for t in range(4)]
        state, states = min(range(4), key=lambda t: best[t]), []
        for way in reversed(back):
            states.append((way[state], state))
            state = way[state]
        before = 0
        for i, ((part, n, _), (first, last)) in enumerate(zip(runs, reversed(states))):
            out[part, conv] = (first, last, before, i == len(runs) - 1)
            before += n
    return out


def report(turns: DataFrame, **options) -> DataFrame:
    """The repaired and rendered turns."""
    return formatted(turns, **options)
