"""Operator 13: conversations whose structure is repaired at the least cost, by weighted CYK parsing.

A conversation should be nothing, or pairs of user and assistant turns behind at most one system turn. A nonterminal (p, q) of the
grammar stands for what leads from state p of such a conversation to state q; binary rules (p, r) -> (p, q) (q, r) put spans
together, so the grammar is in Chomsky normal form. The cell of a span has, for each nonterminal, the least (cost, audit) of
edits that make the span derivable: a row is kept, gets another role, or is deleted, and turns are inserted, which the closure of the empty span
adds on both sides of each row. Spans are combined bottom-up by length. Up to ``LEAF`` rows every split of every span is tried. As a
nonterminal of this grammar keeps all that its surroundings see of a span, every split of a span gives the same cell (a test
compares), so longer conversations are put together from such leaves by doubling, one split a span, and the work grows with
the rows and not with their cube. Equal audits of equal costs can't be prefixes of each other, so cells compose.

Conversations meet in one task up to ``LONG_ROWS`` rows and ``LONG_BYTES`` of text. Longer ones are cut into ranges of their order:
cells of the ranges are made where the rows are, only cells meet, and each range then applies its part of the audit.

Defined results: null roles, texts and ids stand for one space, and conversations without an id are one; rows of one turn go by role and text; null
turns come first; repeated rows are duplicates; other columns are ignored; empty tables give no rows. Whole texts are read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemill.functions.ordering import in_ranges
from tidemill.llm.blobs import tidy
from tidemill.llm.tables import checkpointed, read_table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: at the start, behind a system turn, behind a user turn, behind a pair; the first and the last are ends.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\v\f\r"

LEAF = 8
#: What one task takes as a whole; conversations beyond are cut into ranges of about this size.
LONG_ROWS, LONG_BYTES = 20_000, 32 << 20
#: The keys of long conversations are broadcast up to so many.
BROADCAST_ROWS = 1_000_000

Cell = dict[tuple[int, int], tuple[int, str]]


def _less(cell: Cell, pair: tuple[int, int], cost: int, audit: str) -> bool:
    """Whether it is new or less than what the cell has; then the cell has it."""
    old = cell.get(pair)
    if old is None or (cost, audit) < old:
        cell[pair] = (cost, audit)
        return True
    return False


def _closure() -> Cell:
    """The cell of the empty span: insertions alone."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    while any([_less(cell, (p, r), cost + INSERT, audit + "I") for (p, q), (cost, audit) in list(cell.items()) for (at, c), r in MOVES.items() if at == q and c in NAMES]):
        pass
    return cell


EMPTY = _closure()
#: (p, r) -> (p, q) (q, r), of nonterminals that some span can have.
_REACH = {*EMPTY, *((p, q) for (p, _), q in MOVES.items())}
NONTERMINALS = sorted(_REACH | {(p, r) for p, q in _REACH for at, r in _REACH if at == q})
RULES = [((p, r), (p, q), (at, r)) for p, q in NONTERMINALS for at, r in NONTERMINALS if at == q]


def combined(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """The cell of two spans side by side."""
    cell: Cell = {} if into is None else into
    for whole, a, b in RULES:
        x, y = left.get(a), right.get(b)
        if x is not None and y is not None:
            _less(cell, whole, x[0] + y[0], x[1] + y[1])
    return cell


def symbol(role: str, fault: str) -> str:
    """What the grammar sees of a row: "-" if it must go, else its role's initial ("x" for others), a capital if it is truncated."""
    if fault in ("blank", "duplicate"):
        return "-"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


@lru_cache(maxsize=64)
def row_cell(row: str) -> Cell:
    """The cell of a row, with insertions on both sides."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if row != "-":
        more = TRUNCATED if row.isupper() else 0
        for (p, c), q in MOVES.items():
            if c == row.lower():
                _less(cell, (p, q), KEEP + more, "K")
            elif c in NAMES:
                _less(cell, (p, q), REROLE + more, "R")
    return combined(combined(EMPTY, cell), EMPTY)


@lru_cache(maxsize=100_000)
def leaf_cell(rows: str) -> Cell:
    """The cell of a few rows: all spans bottom-up by length, each over all its splits."""
    n = len(rows)
    chart = {(i, i + 1): row_cell(rows[i]) for i in range(n)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cell: Cell = {}
            for k in range(i + 1, i + size):
                combined(chart[i, k], chart[k, i + size], cell)
            chart[i, i + size] = cell
    return chart.get((0, n), EMPTY)


def span_cell(rows: str) -> Cell:
    """The cell of any number of rows."""
    cells = [leaf_cell(rows[k : k + LEAF]) for k in range(0, len(rows), LEAF)]
    while len(cells) > 1:
        cells = [combined(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def cheapest(cell: Cell) -> tuple[int, str, int]:
    """Cost, audit and end state of the best repair of a whole conversation."""
    return min((*cell[0, end], end) for end in ENDS if (0, end) in cell)


def faults(roles: list[str], texts: list[str], again: list[bool] | None = None) -> list[str]:
    """Each row's first fault, or "". ``again``: whether its role and text were seen before, if it is known."""
    seen: set[tuple[str, str]] = set()
    out = []
    for k, (role, text) in enumerate(zip(roles, texts, strict=True)):
        end = text.rstrip(BLANKS)
        if again is None:
            known = (role, text) in seen
            seen.add((role, text))
        else:
            known = again[k]
        out.append("blank" if not end else "duplicate" if known else "" if end[-1] in ".!?" else "truncated")
    return out


def applied(audit: str, roles: list[str], texts: list[str], turns: list, state: int = 0) -> list[tuple]:
    """(turn, role, text, edit) of what the edits leave of some rows."""
    out, k = [], 0
    for edit in audit:
        if edit == "D":
            k += 1
            continue
        if edit == "K":
            role, state = roles[k], MOVES[state, roles[k][:1]]
        else:
            c = "a" if state == 2 else "u"
            role, state = NAMES[c], MOVES[state, c]
        out.append((None, role, "", edit) if edit == "I" else (turns[k], role, texts[k], edit))
        k += edit != "I"
    return out


class _Out:
    """Rows of repaired conversations, or of parts of them, as Arrow batches."""

    def __init__(self, conv: T.DataType, turn: T.DataType):
        self.turn = pa.struct([("turn", to_arrow_type(turn)), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        self.schema = pa.schema([("conv_id", to_arrow_type(conv)), ("part", pa.int64()), *((n, pa.int64()) for n in numbers), ("audit", pa.string()), ("turns", pa.list_(self.turn))])
        fields = ", ".join(f"{n} long" for n in ["part", *numbers])
        self.ddl = f"conv_id {conv.simpleString()}, {fields}, audit string, turns array<struct<turn: {turn.simpleString()}, role: string, text: string, edit: string>>"
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, conv, part: int, numbers: list[int], audit: str, turns: list[tuple]) -> None:
        self.rows.append((conv, part, *numbers, audit, turns))
        self.bytes += sum(len(t[2]) for t in turns) + 64

    def full(self) -> bool:
        return self.bytes > 16 << 20 or len(self.rows) >= 10_000

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [() for _ in self.schema]
        flat = [t for turns in columns[-1] for t in turns]
        ends = pa.array(np.cumsum([0, *(len(t) for t in columns[-1])]), pa.int32())
        fields = zip(*flat, strict=True) if flat else [()] * 4
        held = pa.StructArray.from_arrays([pa.array(list(x), f.type) for x, f in zip(fields, self.turn, strict=True)], fields=list(self.turn))
        made = [pa.array(list(x), f.type) for x, f in zip(columns[:-1], self.schema, strict=False)]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([*made, pa.ListArray.from_arrays(ends, held, type=self.schema.field("turns").type)], schema=self.schema)


def _gaps(turns: list) -> int:
    there = {t for t in turns if t is not None}
    return max(there) - min(there) + 1 - len(there) if there else 0


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """The columns of each run of rows with equal ``keys``, in a sorted partition."""
    key, held = None, {}
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        names = list(zip(*(columns[k] for k in keys), strict=True))
        first = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[first]:
                part = {n: x[first:i] for n, x in columns.items()}
                if names[first] == key:
                    for n, x in part.items():
                        held[n] += x
                else:
                    if held:
                        yield key, held
                    key, held = names[first], part
                first = i
    if held:
        yield key, held


def _rows(turns: DataFrame, present: str | None) -> DataFrame:
    """What the operator reads: ``key``, ``conv_id``, ``turn``, ``role``, ``text``, ``there``."""
    space = F.lit(" ")
    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    role, text = (F.when(there, F.coalesce(F.col(c), space)).otherwise("").alias(c) for c in ("role", "text"))
    return turns.select(F.coalesce(F.col("conv_id").cast("string"), space).alias("key"), "conv_id", "turn", role, text, there.alias("there"))


def _ordinary(rows: DataFrame) -> DataFrame:
    """Conversations that fit into a task, each a row of one part. One exchange, sorted by Spark."""
    conv, turn = (rows.schema[c].dataType for c in ("conv_id", "turn"))
    ddl = _Out(conv, turn).ddl

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(conv, turn)
        for _, x in _runs(batches, ["key"]):
            at = [k for k, there in enumerate(x["there"]) if there]
            roles, texts, numbers = ([x[c][k] for k in at] for c in ("role", "text", "turn"))
            found = faults(roles, texts)
            cost, audit, _ = cheapest(span_cell("".join(map(symbol, roles, found))))
            counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
            out.add(x["conv_id"][0], 0, [_gaps(numbers), *counts, _illegal(roles), cost], audit, applied(audit, roles, texts, numbers))
            if out.full():
                yield out.batch()
        if out.rows:
            yield out.batch()

    sorted_rows = rows.repartition("key").sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text", "there")
    return sorted_rows.mapInArrow(tidy(run), ddl)


_CELLS = "key string, part long, head string, tail string, n long, blank long, duplicate long, truncated long, illegal long, cells array<struct<cost: long, audit: string>>"


def _long(rows: DataFrame, parts: int) -> DataFrame:
    """Conversations too long for a task, as several parts each."""
    conv, turn = (rows.schema[c].dataType for c in ("conv_id", "turn"))
    ddl = _Out(conv, turn).ddl
    held = in_ranges(rows.where("there"), [F.col("key"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")], parts)
    place = F.struct("_range", "_at")
    held = held.withColumn("_name", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    firsts = held.groupBy("key", "_name").agg(F.min(place).alias("_first"))
    marked = checkpointed(held.join(firsts, ["key", "_name"]).select("key", "conv_id", "turn", "role", "text", F.col("_range").alias("part"), "_at", (place != F.col("_first")).alias("again")))
    sorted_rows = marked.repartition(parts, "key", "part").sortWithinPartitions("key", "part", "_at")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, part), x in _runs(batches, ["key", "part"]):
            found = faults(x["role"], x["text"], x["again"])
            cell = span_cell("".join(map(symbol, x["role"], found)))
            listed = [{"cost": cell[n][0], "audit": cell[n][1]} if n in cell else None for n in NONTERMINALS]
            counts = {f: found.count(f) for f in ("blank", "duplicate", "truncated")}
            row = {"key": key, "part": part, "head": x["role"][0][:1], "tail": x["role"][-1][:1], "n": len(found), **counts, "illegal": _illegal(x["role"]), "cells": listed}
            kinds = [("key", pa.string()), ("part", pa.int64()), ("head", pa.string()), ("tail", pa.string()), *((n, pa.int64()) for n in ("n", "blank", "duplicate", "truncated", "illegal"))]
            yield pa.RecordBatch.from_pylist([row], pa.schema([*kinds, ("cells", pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())])))]))

    made = checkpointed(sorted_rows.select("key", "part", "role", "text", "again").mapInArrow(tidy(cells), _CELLS))

    def path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A conversation's cells put together in order; then each part's own states and edits. A byte for each row and nonterminal."""
        for (key,), x in _runs(batches, ["key"]):
            own = [{n: (c["cost"], c["audit"]) for n, c in zip(NONTERMINALS, cs, strict=True) if c is not None} for cs in x["cells"]]
            before: list[dict[int, tuple]] = [{0: (0, "", 0)}]
            for cell in own:  # the best way to each state behind each part
                step: dict[int, tuple] = {}
                for (p, q), (cost, audit) in cell.items():
                    if p in before[-1]:
                        way = (before[-1][p][0] + cost, before[-1][p][1] + audit, p)
                        step[q] = min(step.get(q, way), way)
                before.append(step)
            state = min((end for end in ENDS if end in before[-1]), key=lambda e: before[-1][e][:2])
            rows = []
            for k in range(len(own) - 1, -1, -1):
                p = before[k + 1][state][2]
                crossing = k > 0 and x["tail"][k - 1] + x["head"][k] not in LEGAL
                rows.append({"key": key, "part": x["part"][k], "state": p, "cost": own[k][p, state][0], "audit": own[k][p, state][1], "illegal": x["illegal"][k] + crossing, **{f: x[f][k] for f in ("blank", "duplicate", "truncated")}, "lead": k == 0})
                state = p
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.string()), *((n, pa.int64()) for n in ("part", "state", "cost", "illegal", "blank", "duplicate", "truncated")), ("audit", pa.string()), ("lead", pa.bool_())]))

    ways = made.repartition("key").sortWithinPartitions("key", "part").mapInArrow(tidy(path), "key string, part long, state long, cost long, illegal long, blank long, duplicate long, truncated long, audit string, lead boolean")
    by_conv = marked.groupBy("key").agg((F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)) - F.count_distinct("turn")).cast("long").alias("gaps"))
    ways = checkpointed(ways.join(by_conv, "key").withColumn("gaps", F.when(F.col("lead"), F.col("gaps")).otherwise(0)))

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(conv, turn)
        for (_, part), x in _runs(batches, ["key", "part"]):
            left = applied(x["audit"][0], x["role"], x["text"], x["turn"], x["state"][0])
            out.add(x["conv_id"][0], part, [x[n][0] for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], x["audit"][0], left)
            yield out.batch()

    # A part's own edits stand at its first row only.
    first = F.row_number().over(Window.partitionBy("key", "part").orderBy("_at")) == 1
    both = marked.join(ways.withColumnRenamed("audit", "_audit"), ["key", "part"]).withColumn("audit", F.when(first, F.col("_audit"))).drop("_audit")
    return both.sortWithinPartitions("key", "part", "_at").mapInArrow(tidy(repair), ddl)


def _parted(turns: DataFrame, present: str | None) -> tuple[DataFrame, DataFrame | None]:
    """Conversations of one part, and those of several, if there are any."""
    rows = _rows(turns, present)
    sizes = rows.groupBy("key").agg(F.count("*").alias("_n"), F.sum(F.octet_length("text")).alias("_bytes")).where((F.col("_n") > LONG_ROWS) | (F.col("_bytes") > LONG_BYTES))
    long = checkpointed(sizes)
    many, n, size = long.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    if not many:
        return _ordinary(rows), None
    keys = F.broadcast(long.select("key")) if many <= BROADCAST_ROWS else long.select("key")
    return _ordinary(rows.join(keys, "key", "left_anti")), _long(rows.join(keys, "key", "left_semi"), 1 + n // LONG_ROWS + size // LONG_BYTES)


def repaired(turns: DataFrame, present: str | None = None) -> DataFrame:
    """Of each conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``), in one row or, if it is long, in several ``part``s: ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit`` (of the parts, to be added up or joined in order) and ``turns``,
    what is left of it: turn, role, text and edit. Rows whose column ``present`` is false only name their conversation."""
    short, long = _parted(turns, present)
    return short if long is None else short.unionByName(long)


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digests(short: DataFrame, long: DataFrame | None) -> DataFrame:
    """``conv_id``, the numbers, ``audit`` and ``repaired_sha256`` of each conversation. The digest of a long one goes through its parts in order."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = short.select("conv_id", *NUMBERS, "audit", F.sha2(said, 256).alias("repaired_sha256"))
    if long is None:
        return whole
    kind = long.schema["conv_id"].dataType
    arrow = pa.schema([("conv_id", to_arrow_type(kind)), *((n, pa.int64()) for n in NUMBERS), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row, sha, begun = None, None, hashlib.sha256(), False
        for batch in batches:
            for x in batch.to_pylist():
                if row is not None and x["key"] != key:
                    yield pa.RecordBatch.from_pylist([{**row, "audit": "".join(row["audit"]), "repaired_sha256": sha.hexdigest()}], arrow)
                if row is None or x["key"] != key:
                    key, sha, begun = x["key"], hashlib.sha256(), False
                    row = {"conv_id": x["conv_id"], **dict.fromkeys(NUMBERS, 0), "audit": []}
                for n in NUMBERS:
                    row[n] += x[n]
                row["audit"].append(x["audit"])
                for t in x["turns"]:
                    sha.update(("\n" * begun + f"{t['role']}:{t['text']}").encode())
                    begun = True
        if row is not None:
            yield pa.RecordBatch.from_pylist([{**row, "audit": "".join(row["audit"]), "repaired_sha256": sha.hexdigest()}], arrow)

    keyed = long.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    streamed = keyed.repartition("key").sortWithinPartitions("key", "part").mapInArrow(run, f"conv_id {kind.simpleString()}, {', '.join(f'{n} long' for n in NUMBERS)}, audit string, repaired_sha256 string")
    return whole.unionByName(streamed)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of conversations with faults put in by the checksum of conversation and turn; ``present`` is false for rows that are dropped."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name) % 20).alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.col("_kind") != 0, F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("present")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)


def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(*_parted(damaged(read_table(spark, sf_dir, "conversations")), "present"))


def _plus(state: str, cost: str, edit: str) -> str:
    """A state of the SQL below, nine digits of cost and the audit, with one more edit; null stays null."""
    return f"(lpad(CAST(CAST(left({state}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || {edit})"


def _inserted(s: list[str]) -> list[str]:
    two = f"least({s[2]}, {', '.join(_plus(s[p], "5", "'I'") for p in (0, 1, 3))})"
    three = f"least({s[3]}, {_plus(s[2], "5", "'I'")}, {', '.join(_plus(s[p], "10", "'II'") for p in (0, 1))})"
    return [s[0], s[1], two, three]


def _stepped() -> list[str]:
    s = [f"s{p}" for p in range(4)]
    said = {c: f"CASE WHEN initial = '{c}' THEN 'K' ELSE 'R' END" for c in "ua"}

    def moved(p: int, c: str) -> str:
        cost = f"(CASE WHEN initial = '{c}' THEN 0 ELSE 1 END + more)"
        return f"CASE WHEN NOT must_go THEN {_plus(s[p], cost, said[c])} END"

    gone = [_plus(x, "2", "'D'") for x in s]
    return [gone[0], f"least({gone[1]}, CASE WHEN NOT must_go AND initial = 's' THEN {_plus(s[0], "more", "'K'")} END)", f"least({gone[2]}, {moved(0, 'u')}, {moved(1, 'u')}, {moved(3, 'u')})", f"least({gone[3]}, {moved(2, 'a')})"]


#: A walk through the rows that keeps the best way to each state, where the operator parses spans.
OP13_SQL = f"""
WITH RECURSIVE polynomial AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS n))),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') AS key, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT)) AS bytes FROM conversations),
kinds AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM named, polynomial),
damaged AS (SELECT key, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM kinds, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
placed AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS k, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM damaged),
seen AS (SELECT *, said = '' AS blank, said <> '' AND row_number() OVER (PARTITION BY key, role, text ORDER BY k) > 1 AS duplicate, lag(initial) OVER (PARTITION BY key ORDER BY k) || initial AS pair FROM placed),
judged AS (SELECT *, blank OR duplicate AS must_go, NOT blank AND NOT duplicate AND right(said, 1) NOT IN ('.', '!', '?') AS truncated FROM seen),
fed AS (SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS more FROM judged),
walk AS (
  SELECT key, 0::BIGINT AS k, {", ".join(f"{x} AS s{p}" for p, x in enumerate(["'000000000'", "CAST(NULL AS VARCHAR)", "'000000005I'", "'000000010II'"]))} FROM (SELECT DISTINCT key FROM named)
  UNION ALL
  SELECT key, k, {", ".join(f"{x} AS s{p}" for p, x in enumerate(_inserted(["s0", "s1", "s2", "s3"])))} FROM (SELECT w.key, f.k, {", ".join(f"{x} AS s{p}" for p, x in enumerate(_stepped()))} FROM walk w JOIN fed f ON f.key = w.key AND f.k = w.k + 1)
),
best AS (SELECT key, least(s0, s3) AS way FROM walk QUALIFY row_number() OVER (PARTITION BY key ORDER BY k DESC) = 1),
edits AS (SELECT key, i, substr(way, 9 + i, 1) AS edit FROM (SELECT key, way, unnest(generate_series(1, len(way) - 9)) AS i FROM best)),
numbered AS (SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER w AS k, sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER w AS place FROM edits WINDOW w AS (PARTITION BY key ORDER BY i ROWS UNBOUNDED PRECEDING)),
left_over AS (SELECT n.key, n.i, n.edit, n.place, f.role, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text, max(CASE WHEN place = 1 AND edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.key) AS led FROM numbered n LEFT JOIN fed f ON f.key = n.key AND f.k = n.k WHERE edit <> 'D'),
said AS (SELECT key, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS said FROM left_over GROUP BY key),
counts AS (SELECT key, coalesce(max(turn) - min(turn) + 1, 0) - count(DISTINCT turn) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM fed GROUP BY key)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
CAST(left(way, 9) AS BIGINT) AS cost, substr(way, 10) AS audit, sha256(coalesce(said, '')) AS repaired_sha256 FROM (SELECT key, min(conv_id) AS conv_id FROM named GROUP BY key) LEFT JOIN counts USING (key) JOIN best USING (key) LEFT JOIN said USING (key)"""
