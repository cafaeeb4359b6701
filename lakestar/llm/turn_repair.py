"""Conversation structure repair: weighted CYK interval parsing of each conversation's rows.

A conversation's rows, in order, are edited at the least cost so that the initials of the roles read ``(s?(ua)+)?``: Keep a row (0), Rerole it
to user or assistant (2), Delete it (3; the only edit of a blank or repeated row), Insert an empty user or assistant turn anywhere (2). A
truncated row that is not deleted costs 1 more. Of equally cheap edits, the ASCII-least string of their initials (the audit) counts.

Grammar, in Chomsky normal form. A nonterminal X(p, q) derives the spans whose edits take the conversation from state p to state q; the states are what has
been said last: nothing, system, user or assistant. X(p, r) -> X(p, q) X(q, r); X(p, q) -> a row under one edit; and, by insertions, X(p, q) -> empty.
The start symbols are X(nothing, nothing) and X(nothing, assistant). A span's cell holds, for each nonterminal, the minimum (cost, audit); the cell of
one row is closed under insertions on either side. Cells are combined bottom-up by span length: 1, 2, 4, ... Each span is split in one place: the
nonterminals name the state on either side, so every derivation passes through every split and all splits give the same cell. Minimum audits are
minimum in any context: of two audits of one span and cost, neither begins with the other (what one has more could only be insertions, which
cost), so which is less is decided within the span.

1. Rows are numbered in their total order (``dense_key``), whatever the length of a conversation. Faults: blank; else repeated (role and text
   stand in an earlier row: a minimum per digest before the shuffle); else truncated.
2. A cell for each run of BLOCK rows of a conversation, in tasks; a run's cell depends on its tokens alone and is computed once for equal ones.
3. Conversations of several runs: neighbouring cells are combined level by level, two to a group.
4. Summary and rows of a conversation meet in one partition, in order, and stream through it: nothing of a conversation but its audit is held.

Defined results: rows are ordered by turn (nulls first), ties by role, then by a hash of the text; null roles and texts are empty; a role counts by its
first character; blank texts have nothing but white space (0x20, 0x09-0x0D); repeated rows are later ones of the same role and text; rows without a
conversation id form one conversation; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from .common import ship, written

#: Rows of a conversation that are parsed in one step.
BLOCK = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_BLANKS = " \t\n\x0b\x0c\r"

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a turn of a role's initial, by the state before.
_NEXT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NONTERMINALS = [(p, q) for p in range(4) for q in range(4) if q in {NOTHING: {0, 1, 2, 3}, SYSTEM: {1, 2, 3}, USER: {2, 3}, ASSISTANT: {2, 3}}[p]]
_NUMBER = {x: i for i, x in enumerate(NONTERMINALS)}
#: X(p, r) -> X(p, q) X(q, r), by numbers of the nonterminals.
RULES = [(_NUMBER[p, r], _NUMBER[p, q], _NUMBER[q, r]) for p, q in NONTERMINALS for r in range(4) if (q, r) in _NUMBER]

Cell = list  # for each nonterminal (cost, audit), or None


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans together."""
    out: Cell = [None] * len(NONTERMINALS)
    for to, a, b in RULES:
        one, two = left[a], right[b]
        if one is not None and two is not None:
            best, cost = out[to], one[0] + two[0]
            if best is None or cost <= best[0]:
                found = (cost, one[1] + two[1])
                if best is None or found < best:
                    out[to] = found
    return out


def _cell(entries: dict[tuple[int, int], tuple[int, str]]) -> Cell:
    return [entries.get(x) for x in NONTERMINALS]


def _insertions() -> Cell:
    """Closure of inserting nothing, a user or an assistant turn, ...: the cell of no rows."""
    none = _cell({(p, p): (0, "") for p in range(4)})
    one = _cell({(p, p): (0, "") for p in range(4)} | {(p, q): (INSERT, "I") for x in "ua" for p, q in _NEXT[x].items()})
    for _ in range(3):
        none = combine(none, one)
    return none


EMPTY = _insertions()


@lru_cache(maxsize=None)
def cell_of_row(token: str) -> Cell:
    """``token``: x for a row that must go; else the role's initial (o: another one than s, u, a), a capital if the row is truncated."""
    more = TRUNCATED if token.isupper() else 0
    entries = {(p, p): (DELETE, "D") for p in range(4)}
    if token != "x":
        entries |= {(p, q): (REROLE + more, "R") for x in "ua" for p, q in _NEXT[x].items()}
        entries |= {(p, q): (KEEP + more, "K") for p, q in _NEXT.get(token.lower(), {}).items()}
    return combine(combine(EMPTY, _cell(entries)), EMPTY)


@lru_cache(maxsize=1 << 14)
def parse(tokens: str) -> Cell:
    """The cell of a span of rows, bottom-up by span length."""
    cells = [cell_of_row(x) for x in tokens]
    while len(cells) > 1:
        cells = [combine(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the start symbols."""
    return min(x for x in (cell[_NUMBER[NOTHING, NOTHING]], cell[_NUMBER[NOTHING, ASSISTANT]]) if x is not None)


def _packed(cell: Cell) -> tuple[list, list]:
    return [x and x[0] for x in cell], [x and x[1] for x in cell]


_SPAN = ("conv bigint, no bigint, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
         "min_turn bigint, max_turn bigint, turns bigint, costs array<bigint>, audits array<string>")
_SPAN_TYPES = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.list_(pa.string())]
_SPAN_NAMES = [x.split()[0] for x in _SPAN.split(", ")]


def _illegal(initials: str) -> int:
    """Neighbours other than su, ua and au."""
    return max(0, len(initials) - 1) - sum(initials.count(x) for x in ("su", "ua", "au"))


def _span(conv, no, initials: str, faults: str, turns: list) -> tuple:
    tokens = "".join("x" if f in "bd" else i.upper() if f == "t" else i for i, f in zip(initials, faults))
    known = [t for t in turns if t is not None]
    return (conv, no, len(tokens), faults.count("b"), faults.count("d"), faults.count("t"), _illegal(initials), initials[0], initials[-1],
            known[0] if known else None, known[-1] if known else None, len(set(known)), *_packed(parse(tokens)))


def _table_of(spans: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*spans)) if spans else [[] for _ in _SPAN_NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SPAN_TYPES)], names=_SPAN_NAMES)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, block, turn, initial, fault, sorted by conv and place -> a row for each run of a conversation and block."""
    key, initials, faults, turns = None, [], [], []
    for batch in batches:
        out = []
        for conv, block, turn, initial, fault in zip(*[c.to_pylist() for c in batch.columns]):
            if (conv, block) != key:
                if key is not None:
                    out.append(_span(*key, "".join(initials), "".join(faults), turns))
                key, initials, faults, turns = (conv, block), [], [], []
            initials.append(initial)
            faults.append(fault)
            turns.append(turn)
        yield _table_of(out)
    if key is not None:
        yield _table_of([_span(*key, "".join(initials), "".join(faults), turns)])


def _join_spans(rows: pa.Table) -> pa.Table:
    """One or two neighbouring spans of a conversation as one."""
    found = sorted(rows.to_pylist(), key=lambda r: r["no"])
    if len(found) == 1:
        out = found[0]
    else:
        a, b = found
        out = {k: a[k] + b[k] for k in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")} | {"conv": a["conv"], "first": a["first"], "last": b["last"]}
        out["illegal"] += a["last"] + b["first"] not in ("su", "ua", "au")
        out["turns"] -= a["max_turn"] is not None and a["max_turn"] == b["min_turn"]
        out["min_turn"] = b["min_turn"] if a["min_turn"] is None else a["min_turn"]
        out["max_turn"] = a["max_turn"] if b["max_turn"] is None else b["max_turn"]
        cells = [[None if c is None else (c, t) for c, t in zip(x["costs"], x["audits"])] for x in found]
        out["costs"], out["audits"] = _packed(combine(*cells))
    out["no"] = found[0]["no"] >> 1
    return pa.Table.from_batches([_table_of([tuple(out[k] for k in _SPAN_NAMES)])])


def _whole(spans: DataFrame) -> DataFrame:
    """``spans`` combined to one for each conversation: two neighbours at a time, level by level."""
    spans = written(spans, "repair-spans")
    reach = spans.groupBy("conv").agg(F.min("no").alias("low"), F.max("no").alias("high"))
    long = written(reach.where("low < high").withColumnRenamed("conv", "long_conv"), "repair-long")
    widest = long.agg(F.max(F.col("high") - F.col("low") + 1)).first()[0]
    if widest is None:
        return spans
    same = F.col("conv").eqNullSafe(F.col("long_conv"))
    level = spans.join(long, same).withColumn("no", F.col("no") - F.col("low")).select(*_SPAN_NAMES)
    for _ in range((widest - 1).bit_length()):
        level = written(level.groupBy("conv", F.shiftright("no", 1)).applyInArrow(_join_spans, _SPAN), "repair-level")
    return spans.join(long, same, "left_anti").unionByName(level)


def _best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """costs, audits (last two columns) -> cost, audit."""
    for batch in batches:
        found = [best([None if c is None else (c, a) for c, a in zip(*x)]) for x in zip(batch.column(batch.num_columns - 2).to_pylist(),
                                                                                         batch.column(batch.num_columns - 1).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())],
                                         names=[*batch.schema.names[:-2], "cost", "audit"])


_COUNTS = "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_COUNT_NAMES = [x.split()[0] for x in _COUNTS.split(", ")]


def summaries(ordered: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit from rows (conv, turn, role, text, place): a row for each conversation."""
    end = F.rtrim(F.col("text"), F.lit(_BLANKS))
    facts = ordered.select("conv", "place", "turn", F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o").alias("initial"),
                           (end == "").alias("blank"), F.right(end, F.lit(1)).isin(".", "!", "?").alias("whole"))
    first = ordered.groupBy("conv", "role", F.sha2(F.col("text").cast("binary"), 256)).agg(F.min("place").alias("first"))
    told = facts.join(first.select("first"), F.col("place") == F.col("first"), "left")
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(~F.col("whole"), "t").otherwise("-")
    block = F.floor((F.col("place") - 1) / BLOCK).cast("bigint")
    tokens = told.select("conv", block.alias("block"), "turn", "initial", fault.alias("fault"), "place")
    tokens = tokens.repartition("conv", "block").sortWithinPartitions("conv", "block", "place").drop("place")
    whole = _whole(tokens.mapInArrow(_spans, _SPAN))
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0))
    counts = whole.select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "costs", "audits")
    return counts.mapInArrow(_best_of, _COUNTS)


_REPAIRED = f"{_COUNTS}, place bigint, edit string, role string, text string"
_REPAIRED_NAMES = [x.split()[0] for x in _REPAIRED.split(", ")]
_REPAIRED_TYPES = [pa.int64()] * 7 + [pa.string(), pa.int64()] + [pa.string()] * 3
_DIGEST_TYPES = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.string()]


class _Editor:
    """Applies a conversation's audit to its rows, one by one."""

    def __init__(self):
        self.begin("")

    def begin(self, audit: str) -> None:
        self.audit, self.at, self.place, self.last = audit, 0, 0, ""
        self.end = len(audit.rstrip("I"))  # after the last row's edit

    def _say(self, edit: str, role: str | None, text: str) -> tuple:
        self.place += 1
        role = role if edit == "K" else "assistant" if self.last == "u" else "user"
        self.last = role[:1]
        return self.place, edit, role, text

    def _inserted(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._say("I", None, "")

    def turns(self, role: str, text: str) -> Iterator[tuple]:
        """The repaired turns up to the next row, or to the end: place, edit, role, text."""
        yield from self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            yield self._say(edit, role, text)
        if self.at == self.end:
            yield from self._inserted()


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's summary (place 0) and then its rows -> the summary and then the repaired turns."""
    editor, nothing = _Editor(), (None,) * (len(_COUNT_NAMES) - 1)
    for batch in batches:
        out: list[tuple] = []
        for *counts, place, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if place == 0:
                editor.begin(counts[-1])
                out.append((*counts, 0, None, None, None))
            else:
                out += [(counts[0], *nothing, *turn) for turn in editor.turns(role, text)]
        columns = list(zip(*out)) if out else [[] for _ in _REPAIRED_TYPES]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _REPAIRED_TYPES)], names=_REPAIRED_NAMES)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations, each one's rows together and in order: its summary (place 0: gaps, blank, duplicate, truncated, illegal,
    cost, audit), then its turns (place from 1: edit K, R or I, role, text)."""
    ship(turns.sparkSession)
    rows = turns.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = written(dense_key(rows, ["conv", "turn", "role", F.xxhash64("text")], "place"), "repair-rows")
    heads = written(summaries(ordered), "repair-summaries")
    bare = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in _COUNTS.split(", ")[1:]]
    no = F.lit(None).cast("string")
    stream = heads.select(*_COUNT_NAMES, F.lit(0).cast("bigint").alias("place"), no.alias("role"), no.alias("text")).unionByName(
        ordered.select("conv", *bare, "place", "role", "text"))
    return stream.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(_apply, _REPAIRED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``repair`` -> the summaries, with the digest of the repaired turns."""
    head, turns, digest = None, 0, None

    def ended(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[] for _ in _DIGEST_TYPES]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _DIGEST_TYPES)], names=[*_COUNT_NAMES, "turns", "repaired_sha256"])

    for batch in batches:
        out = []
        for *counts, place, _, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if place == 0:
                if head is not None:
                    out.append((*head, turns, digest.hexdigest()))
                head, turns, digest = counts, 0, hashlib.sha256()
            else:
                digest.update(f"{chr(10) if turns else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                turns += 1
        yield ended(out)
    if head is not None:
        yield ended([(*head, turns, digest.hexdigest())])


def digests(repaired: DataFrame) -> DataFrame:
    """Summaries of ``repair``'s result with the number of repaired turns and the SHA-256 of their ``role:text`` lines, as a stream over its order."""
    return repaired.mapInArrow(_digest, f"{_COUNTS}, turns bigint, repaired_sha256 string")
