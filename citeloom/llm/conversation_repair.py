"""Conversation structure repair: the cheapest edits that give a conversation legal turns.

Legal are no rows at all, or an optional system row and then user and assistant in turns, which is
``(s?(ua)+)?`` in initials of roles. A row may be kept (cost 0), get the role user or assistant (3) or be deleted
(4); rows without text or said before must be deleted; rows with empty text and the role user or assistant may be
inserted anywhere (3). A truncated row that stays costs 3 more.

**Grammar.** In Chomsky normal form, with a nonterminal ``[p, q]`` for what leads from a last role ``p`` to a last role
``q``: ``[p, q] -> [p, r] [r, q]`` for all ``r``, ``[p, q] -> row`` with the cost and the letter of an edit, and ``[p, q] -> nothing``
with the cost of insertions. The cell of a span of rows has the least ``(cost, audit)`` of each nonterminal, the audit being the
edits' initials. Cells of one row are closed under insertions in front and behind; the chart is filled
bottom-up by span length. The language is regular, so all splits of a span give one cell and the chart needs spans
of 1, 2, 4, 8 rows and so on only, each from its two halves. Of equal costs the audit that is least in ASCII stays; audits of one span and
equal cost are never beginnings of each other, since further letters are insertions and cost, so the least of the parts are in
the least of the whole.

**On Spark.** Facts about rows are columns. Rows are sorted by conversation and order over range partitions, so
a conversation of any length is dealt over tasks; each gives one cell for each run of rows of a conversation, and the cells of its
runs are combined in order. A last pass streams rows behind their audit. That pass and the result have one string per
conversation, so one task holds the audit, a letter per row; texts pass one by one.

Rows are ordered by turn (nulls first), then role, then a digest of role and text, so equal rows are neighbours. Defined
cases: null roles and texts count as one blank; a null ``conv_id`` is a conversation; roles with other initials, or none,
can't be kept; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.graphs import written

#: Roles by initial that may follow a last role; the empty string is the start.
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}
#: Last roles of legal conversations.
ENDS = ("", "a")
#: Initials of roles that a row can be given.
GIVEN = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL_PAIRS = frozenset(p + q for p in FOLLOWS for q in FOLLOWS[p] if p)

#: ``{(p, q): (cost, audit)}``
Cell = dict[tuple[str, str], tuple[int, str]]

#: Spans up to this length are remembered by their symbols.
KEPT_SPAN, KEPT_CELLS = 8, 100_000
_BLANKS = " \t\n\v\f\r"


def _least(cell: Cell, at: tuple[str, str], value: tuple[int, str]) -> None:
    if at not in cell or value < cell[at]:
        cell[at] = value


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans, by the rules of two nonterminals."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in FOLLOWS:
            other = right.get((r, q))
            if other is not None:
                _least(out, (p, q), (cost + other[0], audit + other[1]))
    return out


def _insertions() -> Cell:
    """The cell of a span without rows: the cheapest insertions between any two roles."""
    one: Cell = {(p, p): (0, "") for p in FOLLOWS}
    for p, after in FOLLOWS.items():
        for q in after:
            if q in GIVEN:
                _least(one, (p, q), (INSERT, "I"))
    closed = one
    while (more := joined(closed, one)) != closed:
        closed = more
    return closed


EMPTY = _insertions()


def symbol(initial: str, deleted: bool, truncated: bool) -> str:
    """All that counts of a row, as one sign: ``d``, or the role's initial, upper-case if truncated."""
    if deleted:
        return "d"
    known = initial if initial and initial in "sua" else "x"
    return known.upper() if truncated else known


def _terminal(sign: str) -> Cell:
    cell: Cell = {}
    extra = TRUNCATED if sign.isupper() else 0
    for p, after in FOLLOWS.items():
        _least(cell, (p, p), (DELETE, "D"))
        for q in after if sign != "d" else "":
            if q == sign.lower():
                _least(cell, (p, q), (extra, "K"))
            if q in GIVEN:
                _least(cell, (p, q), (REROLE + extra, "R"))
    return joined(joined(EMPTY, cell), EMPTY)


TERMINALS = {s: _terminal(s) for s in "suaxSUAXd"}


class Chart:
    """Cells of spans, bottom-up by span length; short spans are remembered."""

    def __init__(self) -> None:
        self._kept: dict[str, Cell] = {}

    def cell(self, symbols: str) -> Cell:
        """Of a whole run of rows."""
        if not symbols:
            return EMPTY
        width = KEPT_SPAN
        level = [self._short(symbols[k : k + width]) for k in range(0, len(symbols), width)]
        while len(level) > 1:
            level = [joined(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0]

    def _short(self, symbols: str) -> Cell:
        if len(symbols) == 1:
            return TERMINALS[symbols]
        cell = self._kept.get(symbols)
        if cell is None:
            half = 1 << (len(symbols) - 1).bit_length() - 1
            cell = joined(self._short(symbols[:half]), self._short(symbols[half:]))
            if len(self._kept) >= KEPT_CELLS:
                self._kept.clear()
            self._kept[symbols] = cell
        return cell


def cheapest(cell: Cell) -> tuple[int, str]:
    """``(cost, audit)`` of a whole conversation."""
    return min(cell[at] for at in (("", q) for q in ENDS) if at in cell)


def output_role(place: int, n_out: int, edit: str, role: str) -> str:
    """The role of a repaired row; an odd number of rows begins with the system's."""
    return role if edit == "K" else "user" if (place - n_out % 2) % 2 == 0 else "assistant"


# --- on Spark -----------------------------------------------------------------

_OUT_ROWS = 20_000
_CELL = pa.list_(pa.struct([("p", pa.string()), ("q", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
_CELL_DDL = "array<struct<p:string,q:string,cost:long,audit:string>>"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _mark(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.length(role), role, text)))


def facts(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, mark, blank, truncated, later)``: what counts of each row but its neighbours.

    ``later`` says that the same role and text occur in an earlier turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    trimmed = F.rtrim(text, F.lit(_BLANKS))
    plain = written(rows.select(
        "conv_id", "turn", role.alias("role"), _mark(role, text).alias("mark"), (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated")), "rows")
    # Nulls are first in structs as well.
    when = F.struct(F.col("turn").isNotNull(), "turn")
    again = written(plain.where(~F.col("blank")).groupBy("conv_id", "mark").agg(
        F.min(when).alias("first"), F.max(when).alias("last")).where("first < last").select(
        F.col("conv_id").alias("__conv"), F.col("mark").alias("__mark"), "first"), "again")
    met = plain.join(again, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("mark") == F.col("__mark")), "left")
    return met.select(*plain.columns, F.coalesce(when > F.col("first"), F.lit(False)).alias("later"))


def _runs(conv_type: str, turn_type: str):
    """Sorted rows to one row per run of a conversation: its order, edges, counts and cell."""
    schema = (f"conv_id {conv_type}, turn {turn_type}, role string, mark binary, last_turn {turn_type}, first_initial string, "
              f"last_initial string, low {turn_type}, high {turn_type}, n_turns long, {', '.join(f'n_{c} long' for c in _COUNTS)}, cell {_CELL_DDL}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chart, types = Chart(), []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.schema.field(0).type, batch.schema.field(1).type]
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def made(done: list[tuple]) -> pa.RecordBatch:
            conv, turn = types
            kinds = [conv, turn, pa.string(), pa.binary(), turn, pa.string(), pa.string(), turn, turn, *[pa.int64()] * 5, _CELL]
            names = ["conv_id", "turn", "role", "mark", "last_turn", "first_initial", "last_initial", "low", "high", "n_turns",
                     *(f"n_{c}" for c in _COUNTS), "cell"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

        done = []
        for conv, group in groupby(rows(), key=lambda r: r[0]):
            signs, n, first, before = [], dict.fromkeys((*_COUNTS, "turns"), 0), None, None
            low = None
            for row in group:
                _, turn, role, mark, blank, truncated, later = row
                first = first or row
                same = before is not None and (before[1], before[2], before[3]) == (turn, role, mark)
                fault = "blank" if blank else "duplicate" if later or same else "truncated" if truncated else None
                if fault:
                    n[fault] += 1
                if before is not None and before[2][:1] + role[:1] not in LEGAL_PAIRS:
                    n["illegal"] += 1
                if turn is not None and (before is None or before[1] != turn):
                    n["turns"] += 1
                    low = turn if low is None else low
                signs.append(symbol(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
                before = row
            cell = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in chart.cell("".join(signs)).items()]
            done.append((conv, first[1], first[2], first[3], before[1], first[2][:1], before[2][:1], low, before[1],
                         n["turns"], *(n[c] for c in _COUNTS), cell))
            if len(done) >= _OUT_ROWS:
                yield made(done)
                done = []
        if done:
            yield made(done)

    return run, schema


def _combined(conv_type: str):
    """The runs of each conversation, in order, to its measures and cheapest edits."""
    measures = ("gaps", *_COUNTS, "cost")
    schema = f"conv_id {conv_type}, {', '.join(f'{m} long' for m in measures)}, audit string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def rows() -> Iterator[dict]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield from batch.to_pylist()

        def made(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:-1]), pa.array(columns[-1], pa.string())],
                names=["conv_id", *measures, "audit"])

        done = []
        for conv, runs in groupby(rows(), key=lambda r: r["conv_id"]):
            n, low, high, before, cells = dict.fromkeys((*_COUNTS, "turns"), 0), None, None, None, []
            for r in runs:
                for c in _COUNTS:
                    n[c] += r[f"n_{c}"]
                n["turns"] += r["n_turns"]
                if before is not None:
                    n["illegal"] += before["last_initial"] + r["first_initial"] not in LEGAL_PAIRS
                    n["turns"] -= r["turn"] is not None and before["last_turn"] == r["turn"]
                low = r["low"] if low is None else low
                high = r["high"] if r["high"] is not None else high
                before = r
                cells.append({(e["p"], e["q"]): (e["cost"], e["audit"]) for e in r["cell"]})
            while len(cells) > 1:
                cells = [joined(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
            gaps = 0 if low is None else high - low + 1 - n["turns"]
            done.append((conv, gaps, *(n[c] for c in _COUNTS), *cheapest(cells[0])))
            if len(done) >= _OUT_ROWS:
                yield made(done)
                done = []
        if done:
            yield made(done)

    return run, schema


def repair(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation in ``(conv_id, turn, role, text)``."""
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    order = ["conv_id", "turn", "role", "mark"]
    known = written(facts(rows), "facts")
    runs, runs_schema = _runs(conv, turn)
    # Equal keys share a partition, so only runs of different rows are parted.
    cells = known.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(runs, runs_schema)
    combined, schema = _combined(conv)
    return cells.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(combined, schema)


def _edited(conv_type: str):
    schema = f"conv_id {conv_type}, place long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def edits() -> Iterator[tuple]:
            for conv, group in groupby(rows(), key=lambda r: r[0]):
                audit = next(group)[1]
                n_out, place = len(audit) - audit.count("D"), 0
                for edit in audit:
                    _, _, role, text = (conv, None, None, "") if edit == "I" else next(group)
                    if edit != "D":
                        yield conv, place, output_role(place, n_out, edit, role), text
                        place += 1

        done, held = [], 0
        for row in edits():
            done.append(row)
            held += len(row[3]) + 64
            if held > 8 << 20:
                yield _batch(done, kind)
                done, held = [], 0
        if done:
            yield _batch(done, kind)

    def _batch(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (kind, pa.int64(), pa.string(), pa.string()), strict=True)],
            names=["conv_id", "place", "role", "text"])

    return run, schema


def repaired(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: ``rows`` after the edits of :func:`repair`.

    Rows of a conversation follow each other, in order, in one partition.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    plain = rows.select("conv_id", "turn", role, text)
    marked = plain.select("conv_id", F.lit(1).alias("kind"), "turn", F.lit(None).cast("string").alias("audit"), "role", "text",
                          _mark(F.col("role"), F.col("text")).alias("mark"))
    none = [F.lit(None).cast(marked.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "mark")]
    audits = repairs.select("conv_id", F.lit(0).alias("kind"), none[0], "audit", *none[1:])
    ordered = audits.unionByName(marked).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "mark")
    run, schema = _edited(rows.schema["conv_id"].dataType.simpleString())
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(run, schema)
