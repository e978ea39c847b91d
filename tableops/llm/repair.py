"""Conversation structure repair: the cheapest edits that make a conversation's roles ``(system? (user assistant)+)?``.

A conversation is its rows by turn (nulls first; rows of one turn by the digest of role and text, so that equal rows
stay together). Every row gets its first fault: blank, duplicate (role and text seen earlier), truncated. Edits are
Keep, Rerole, Delete, and Insert; of the cheapest edit sequences the one whose initials are ASCII-least is taken.

Within a block of ``BLOCK`` rows a dynamic program runs over the rows and the four states of the role pattern. Edit
prefixes are linked nodes that share their beginnings; each carries its binary-lifting ancestors and a rolling hash of
its letters. Of two prefixes of one cost and state the smaller is found by searching their longest common prefix from
the ancestors' hashes; equal hashes are verified along the links, and two prefixes that a collision confuses are
spelled out.

Long conversations are worked on in blocks that are combined, so no task holds one. A block is solved from each state
in which it may begin and summarised by its costs and the *order* of its edit strings; that is enough to combine
blocks: inserts stand before the row that follows them, so every string ends with a row's edit, strings of the same
rows from the same state into different states differ, and none continues another. Blocks of one range partition are
folded first, then a conversation's partitions; on the way back every block learns the states it lies between.

Nulls: a null role or text is one space, a null turn comes first, a null conversation is a conversation of its own.
A row whose role does not begin with s, u or a (the empty role too) cannot be kept as it is. Empty tables give empty
results; other columns are not read. The digest of a repaired conversation is sequential by nature: its blocks' texts
pass one task in order, a block at a time, and only the letters of the audit are held.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Stage, partitions

BLOCK, BLOCK_BYTES = 256, 4 << 20
#: Costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
CLASSES = {"s": 0, "u": 1, "a": 2}
OTHER = 3
BLANK, TRUNCATED = 4, 8
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: State after a kept row, by state and class.
KEEP = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
#: State after a row given the role that fits, and that role.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
FITTING = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Inserts that end a conversation well.
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}


# ---- edit prefixes ----------------------------------------------------------------------------------------------


class Prefix:
    """A string of edit initials: its last letter and the prefix before it."""

    __slots__ = ("letter", "depth", "hash", "up")
    BASE, PRIME = 0x1F3D5B79A2C4E687 % ((1 << 61) - 1), (1 << 61) - 1

    def __init__(self, parent: Prefix | None, letter: str):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, []
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * self.BASE + ord(letter)) % self.PRIME
        self.up = up = [parent]
        while len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])

    def add(self, letters: str) -> Prefix:
        node = self
        for letter in letters:
            node = Prefix(node, letter)
        return node

    def at(self, depth: int) -> Prefix:
        """The ancestor of that depth."""
        node = self
        while node.depth > depth:
            node = node.up[min((node.depth - depth).bit_length(), len(node.up)) - 1]
        return node

    def text(self) -> str:
        out, node = [], self
        while node.depth:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def _same(x: Prefix, y: Prefix) -> bool:
    """Whether prefixes of one depth and hash are equal: follows their links to where they are shared."""
    while x is not y and x.depth:
        if x.letter != y.letter:
            return False
        x, y = x.up[0], y.up[0]
    return True


def order(a: Prefix, b: Prefix) -> int:
    """-1, 0 or 1 as the string of ``a`` is below, equal to or above that of ``b``."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x is not y and x.hash != y.hash:
        for k in range(len(x.up) - 1, -1, -1):
            if k < len(x.up) and x.up[k] is not y.up[k] and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        if x.letter != y.letter and _same(x.up[0], y.up[0]):
            return -1 if x.letter < y.letter else 1
    elif _same(x, y):
        return (a.depth > b.depth) - (a.depth < b.depth)
    s, t = a.text(), b.text()  # a collision
    return (s > t) - (s < t)


# ---- blocks -----------------------------------------------------------------------------------------------------


class Summary(NamedTuple):
    """What combining needs of consecutive rows. ``cost`` and ``rank`` by (state before) * 4 + (state after);
    a cost of -1: not reachable. ``rank`` orders the edit strings from one state before."""

    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: int  # class of the first and the last row; -1: no row
    last: int
    turn_min: int | None
    turn_max: int | None
    turns: int
    cost: tuple
    rank: tuple


def solve(codes: bytes, duplicate: set[int], starts: Iterable[int]) -> tuple[list[int], list[int], list[str | None]]:
    """(cost, rank, audit) by state before and after, for the rows' codes (class, blank, truncated)."""
    cost, rank, audit = [-1] * 16, [0] * 16, [None] * 16
    root = Prefix(None, "")
    for start in starts:
        cells: dict[int, tuple[int, Prefix]] = {start: (0, root)}
        for i, code in enumerate(codes):
            ways: dict[int, list[tuple[int, Prefix, str]]] = {}
            for state, (spent, node) in cells.items():
                ways.setdefault(state, []).append((spent + DELETE, node, "D"))
                drop = code & BLANK or i in duplicate
                extra = CUT if code & TRUNCATED else 0
                at = state
                for inserts in range(3):
                    here, letters = spent + INSERT * inserts, "I" * inserts
                    if inserts:
                        ways.setdefault(at, []).append((here + DELETE, node, letters + "D"))
                    if not drop:
                        kept = KEEP.get((at, code & 3))
                        if kept is not None:
                            ways.setdefault(kept, []).append((here + extra, node, letters + "K"))
                        ways.setdefault(NEXT[at], []).append((here + REROLE + extra, node, letters + "R"))
                    at = NEXT[at]
            cells = {}
            for state, options in ways.items():
                least = min(o[0] for o in options)
                tied = [node.add(letters) for spent, node, letters in options if spent == least]
                cells[state] = least, functools.reduce(lambda a, b: b if order(b, a) < 0 else a, tied)
        ends = sorted(cells, key=functools.cmp_to_key(lambda e, f: order(cells[e][1], cells[f][1])))
        for r, end in enumerate(ends):
            k = start * 4 + end
            cost[k], rank[k], audit[k] = cells[end][0], r, cells[end][1].text()
    return cost, rank, audit


def _joined(a: Summary, b: Summary) -> tuple[dict[int, int], list[int]]:
    """For every (before, after) the best state in between, and the costs."""
    via, cost = {}, [-1] * 16
    for s in STATES:
        for e in STATES:
            ways = [
                (a.cost[s * 4 + m] + b.cost[m * 4 + e], a.rank[s * 4 + m], m)
                for m in STATES
                if a.cost[s * 4 + m] >= 0 and b.cost[m * 4 + e] >= 0
            ]
            if ways:
                cost[s * 4 + e], _, via[s * 4 + e] = min(ways)
    return via, cost


def combine(a: Summary, b: Summary) -> Summary:
    """The summary of ``a``'s rows followed by ``b``'s."""
    via, cost = _joined(a, b)
    rank = [0] * 16
    for s in STATES:
        ends = [e for e in STATES if s * 4 + e in via]
        ends.sort(key=lambda e: (a.rank[s * 4 + via[s * 4 + e]], b.rank[via[s * 4 + e] * 4 + e]))
        for r, e in enumerate(ends):
            rank[s * 4 + e] = r
    border = a.last >= 0 and b.first >= 0 and (a.last, b.first) not in LEGAL
    return Summary(
        a.blank + b.blank,
        a.duplicate + b.duplicate,
        a.truncated + b.truncated,
        a.illegal + b.illegal + border,
        a.first if a.first >= 0 else b.first,
        b.last if b.last >= 0 else a.last,
        a.turn_min if a.turn_min is not None else b.turn_min,
        b.turn_max if b.turn_max is not None else a.turn_max,
        a.turns + b.turns - (a.turn_max is not None and a.turn_max == b.turn_min),
        tuple(cost),
        tuple(rank),
    )


def path(parts: list[Summary], start: int, end: int) -> list[tuple[int, int]]:
    """(state before, state after) of every part on the best way from ``start`` to ``end``."""
    so_far = [parts[0]]
    for p in parts[1:]:
        so_far.append(combine(so_far[-1], p))
    out = []
    for i in range(len(parts) - 1, 0, -1):
        middle = _joined(so_far[i - 1], parts[i])[0][start * 4 + end]
        out.append((middle, end))
        end = middle
    out.append((start, end))
    return out[::-1]


def finish(whole: Summary) -> tuple[int, int]:
    """(state after the last row, cost with the inserts that follow) of the best end."""
    ways = [(whole.cost[e] + INSERT * TAIL[e], whole.rank[e], e) for e in STATES if whole.cost[e] >= 0]
    cost, _, end = min(ways)
    return end, cost


# ---- rows to blocks ---------------------------------------------------------------------------------------------


def _code(role: str, text: str) -> int:
    code = CLASSES.get(role[:1], OTHER)
    body = text.rstrip(WHITE)
    return code | (BLANK if not body else TRUNCATED if body[-1] not in ".!?" else 0)


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def _pack(schema: pa.Schema):
    """Sorted rows to blocks. ``block`` counts within the partition, so it orders a conversation's blocks; ``open``
    tells the blocks before which the conversation may have rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        current, opened, size, any_row = None, True, 0, False

        def close() -> tuple:
            live = [r for r in rows if r[1]]
            codes = bytes(_code(r[3], r[4]) for r in live)
            digests = [None if c & BLANK else _digest(r[3], r[4]) for c, r in zip(codes, live)]
            return current, block, opened, [r[2] for r in live], [r[3] for r in live], [r[4] for r in live], codes, digests

        lines, held = [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "live", "turn", "role", "text")]
            for row in zip(*columns):
                if any_row and (row[0] != current or len(rows) >= BLOCK or size >= BLOCK_BYTES):
                    lines.append(close())
                    held += size
                    block, opened, rows, size = block + 1, row[0] == current, [], 0
                    if held >= BLOCK_BYTES:
                        yield _batch(lines, schema)
                        lines, held = [], 0
                current, any_row = row[0], True
                rows.append(row)
                size += len(row[4]) * 2 + 64
        if any_row:
            yield _batch([*lines, close()], schema)

    return run


def _turns(turns: list) -> tuple:
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _solve(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv", "block", "open", "turns", "codes", "firsts")]
            for conv, block, opened, turns, codes, firsts in zip(*columns):
                firsts = set(firsts or ())
                duplicate = {i for i, c in enumerate(codes) if not c & BLANK and i not in firsts}
                cost, rank, audit = solve(codes, duplicate, STATES if opened else (START,))
                classes = [c & 3 for c in codes]
                summary = Summary(
                    sum(1 for c in codes if c & BLANK),
                    len(duplicate),
                    sum(1 for i, c in enumerate(codes) if c & TRUNCATED and i not in duplicate),
                    sum(1 for pair in zip(classes, classes[1:]) if pair not in LEGAL),
                    classes[0] if classes else -1,
                    classes[-1] if classes else -1,
                    *_turns(turns),
                    cost,
                    rank,
                )
                out.append((conv, block, block >> 32, *summary, audit))
            yield _batch(out, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


# ---- folding ----------------------------------------------------------------------------------------------------

SUMMARY = (
    "blank long, duplicate long, truncated long, illegal long, first int, last int, turn_min long, turn_max long, turns long, "
    "cost array<long>, rank array<int>"
)
FIELDS = len(Summary._fields)
FIGURES = ("gaps", "n_blank", "n_duplicate", "n_truncated", "n_illegal", "edits_cost")


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with equal first ``width`` values, as the rows come."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    return itertools.groupby(rows(), key=lambda r: r[:width])


def _fold_parts(schema: pa.Schema):
    """Rows (conv, part, block, summary) to one summary per (conv, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv, part), rows in _groups(batches, 2):
            out.append((conv, part, *functools.reduce(combine, (Summary(*r[3:]) for r in rows))))
            if len(out) == 4096:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run


def _fold_conversations(schema: pa.Schema):
    """Rows (conv, part, summary) to the states around every part, and the conversation's figures on its first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv,), rows in _groups(batches, 1):
            rows = list(rows)
            parts = [Summary(*r[2:]) for r in rows]
            whole = functools.reduce(combine, parts)
            end, cost = finish(whole)
            gaps = whole.turn_max - whole.turn_min + 1 - whole.turns if whole.turns else 0
            figures = (gaps, whole.blank, whole.duplicate, whole.truncated, whole.illegal, cost)
            for i, (row, (before, after)) in enumerate(zip(rows, path(parts, START, end))):
                out.append((conv, row[1], before, after, *(figures if not i else (None,) * 6), i == len(rows) - 1))
            if len(out) >= 4096:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run


def _choose(schema: pa.Schema):
    """Per (conv, part) its way (a row with states), then its blocks: the edits of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv, _), rows in _groups(batches, 2):
            way = next(rows)
            blocks = list(rows)
            parts = [Summary(*b[3 : 3 + FIELDS]) for b in blocks]
            before, after, *figures, ends = way[4 + FIELDS :]
            for i, (b, (s, e)) in enumerate(zip(blocks, path(parts, before, after))):
                audit = b[3 + FIELDS][s * 4 + e] + "I" * (TAIL[e] if ends and i == len(blocks) - 1 else 0)
                out.append((conv, b[2], audit, s, *(figures if not i else (None,) * 6)))
            if len(out) >= 4096:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run


def repaired(roles: list[str], texts: list[str], audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what the edits leave of the rows, begun in ``state``."""
    row = 0
    for letter in audit:
        if letter == "K":
            yield letter, roles[row], texts[row]
            state = KEEP[state, CLASSES[roles[row][0]]]
        elif letter in "RI":
            yield letter, FITTING[state], texts[row] if letter == "R" else ""
            state = NEXT[state]
        row += letter != "I"


def _apply(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for conv, block, roles, texts, audit, state, *figures in zip(*[c.to_pylist() for c in batch.columns]):
                rows = list(repaired(roles, texts, audit, state))
                out.append((conv, block, audit, [r[1] for r in rows], [r[2] for r in rows], *figures))
                held += sum(len(r[2]) for r in rows) + 256
                if held >= BLOCK_BYTES:
                    yield _batch(out, schema)
                    out, held = [], 0
            yield _batch(out, schema)

    return run


def _report(schema: pa.Schema):
    """Per conversation its repaired blocks in order: figures, audit, digest of the lines ``role:text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv,), blocks in _groups(batches, 1):
            digest, audit, figures, any_line = hashlib.sha256(), [], None, False
            for _, _, letters, roles, texts, *numbers in blocks:
                figures = figures or numbers
                audit.append(letters)
                for role, text in zip(roles, texts):
                    digest.update(f"{chr(10) if any_line else ''}{role}:{text}".encode())
                    any_line = True
            out.append((conv, *figures, "".join(audit), digest.hexdigest()))
            if len(out) >= 4096:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run


# ---- jobs -------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 is dropped (``live`` is false), 1 loses its
    text, 2 its ``.!?``, 3 is there twice, 4 becomes the user's. ``tie`` orders the rows of one turn."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(word("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(word("text"), ".!?", "")).otherwise(word("text")).alias("text"),
        (fault != 0).alias("live"),
        F.sha2(F.concat_ws(":", word("role"), word("text")), 256).alias("tie"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def repair_blocks(rows: DataFrame, live: Column | None = None, tie: Column | None = None) -> DataFrame:
    """The repaired conversations of ``rows(conv_id, turn, role, text)``, in blocks: ``conv, block, audit, roles, texts``
    and, on a conversation's first block, its figures (``FIGURES``). ``block`` orders the blocks of a conversation.

    Rows that are not ``live`` only name their conversation. ``tie`` orders rows of one turn, by default the digest of
    role and text.
    """
    spark = rows.sparkSession
    stage, n = Stage(spark, "repair"), partitions(spark)
    kind = f"conv {dict(rows.dtypes)['conv_id']}"
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    read = rows.select(
        F.col("conv_id").alias("conv"),
        (F.lit(True) if live is None else live).alias("live"),
        F.col("turn").cast("long").alias("turn"),
        word("role").alias("role"),
        word("text").alias("text"),
        (F.sha2(F.concat_ws(":", word("role"), word("text")), 256) if tie is None else tie).alias("tie"),
        F.monotonically_increasing_id().alias("salt"),  # equal rows may fall into different partitions
    )
    ordered = read.repartitionByRange(n, "conv", "turn", "tie", "salt").sortWithinPartitions("conv", "turn", "tie")

    def mapped(df: DataFrame, function, ddl: str, name: str | None) -> DataFrame:
        out = df.mapInArrow(function(to_arrow_schema(StructType.fromDDL(ddl))), ddl)
        return stage.write(out, name) if name else out

    ddl = f"{kind}, block long, open boolean, turns array<long>, roles array<string>, texts array<string>, codes binary, digests array<binary>"
    blocks = mapped(ordered.drop("tie", "salt"), _pack, ddl, "blocks")

    seen = blocks.select("conv", "block", F.posexplode("digests").alias("pos", "digest")).where("digest IS NOT NULL")
    seen = seen.groupBy("conv", "digest").agg(F.min(F.col("block") * BLOCK + F.col("pos")).alias("at"))
    firsts = seen.groupBy(F.expr(f"at div {BLOCK}").alias("block")).agg(F.collect_list((F.col("at") % BLOCK).cast("int")).alias("firsts"))
    marked = blocks.select("conv", "block", "open", "turns", "codes")
    marked = marked.repartition(n, "block").join(firsts, "block", "left")  # few bytes, much work: stays in n tasks
    summaries = mapped(marked, _solve, f"{kind}, block long, part long, {SUMMARY}, audits array<string>", "summaries")

    fold = summaries.select("conv", "part", "block", *Summary._fields).repartition(n, "conv", "part")
    parts = mapped(fold.sortWithinPartitions("conv", "part", "block"), _fold_parts, f"{kind}, part long, {SUMMARY}", "parts")
    fold = parts.repartition(n, "conv").sortWithinPartitions("conv", "part")
    figures = ", ".join(f"{f} long" for f in FIGURES)
    ways = mapped(fold, _fold_conversations, f"{kind}, part long, before int, after int, {figures}, ends boolean", "ways")

    down = summaries.select("conv", "part", "block", *Summary._fields, "audits").unionByName(ways, allowMissingColumns=True)
    down = down.repartition(n, "conv", "part").sortWithinPartitions("conv", "part", "block")  # the way first: its block is null
    chosen = mapped(down, _choose, f"{kind}, block long, audit string, state int, {figures}", "chosen")

    both = blocks.select("conv", "block", "roles", "texts").join(chosen.drop("conv"), "block")
    both = both.select("conv", "block", "roles", "texts", "audit", "state", *FIGURES)
    return mapped(both, _apply, f"{kind}, block long, audit string, roles array<string>, texts array<string>, {figures}", None)


def repaired_rows(blocks: DataFrame) -> DataFrame:
    """The rows of repaired blocks: ``conv_id, block, pos, role, text``; (block, pos) orders a conversation."""
    line = F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "line")
    return blocks.select(F.col("conv").alias("conv_id"), "block", line).select(
        "conv_id", "block", "pos", F.col("line.roles").alias("role"), F.col("line.texts").alias("text")
    )


def report(blocks: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    n = partitions(blocks.sparkSession)
    rows = blocks.select("conv", "block", "audit", "roles", "texts", *FIGURES)
    rows = rows.repartition(n, "conv").sortWithinPartitions("conv", "block")
    ddl = (
        f"conv_id {dict(blocks.dtypes)['conv']}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    return rows.mapInArrow(_report(to_arrow_schema(StructType.fromDDL(ddl))), ddl)
