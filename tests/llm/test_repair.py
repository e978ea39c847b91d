import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tableops.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, block string, live string, audit string"
CLASH = ("x",) * 4
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, lines) by plain strings; ``rows``: (role, text, must go, cut)."""
    cells = {0: (0, "", "")}
    for role, text, drop, cut in rows:
        new = {}
        for state, (cost, audit, lines) in cells.items():
            for inserts in range(3):
                ways = [(state, "D", 4, "")]
                if not drop:
                    c = {"s": 0, "u": 1, "a": 2}.get(role[:1])
                    if (state, c) in repair.KEEP:
                        ways.append((repair.KEEP[state, c], "K", 3 * cut, f"{role}:{text}\n"))
                    ways.append((repair.NEXT[state], "R", 3 + 3 * cut, f"{repair.FITTING[state]}:{text}\n"))
                for to, letter, price, line in ways:
                    way = (cost + price, audit + letter, lines + line)
                    new[to] = min(new.get(to, way), way)
                cost, audit, lines = cost + 3, audit + "I", lines + repair.FITTING[state] + ":\n"
                state = repair.NEXT[state]
        cells = new
    ends = []
    for state, (cost, audit, lines) in cells.items():
        for _ in range(repair.TAIL[state]):
            cost, audit, lines, state = cost + 3, audit + "I", lines + repair.FITTING[state] + ":\n", repair.NEXT[state]
        ends.append((cost, audit, lines))
    return min(ends)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        blank = not BLANK.search(text)
        dup = not blank and (role, text) in seen
        seen.add((role, text))
        cut = not blank and not dup and text.rstrip(" \t\n\v\f\r")[-1] not in ".!?"
        out.append((role, text, blank, dup, cut))
    return out


def brute(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        kept = out.setdefault(conv, [])
        word = lambda x: " " if x is None else str(x)
        f = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        tie = hashlib.sha256(f"{word(role)}:{word(text)}".encode()).hexdigest()
        role, text = word(role), word(text)
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        kept += [(turn is not None, turn or 0, tie, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    result = []
    for conv, kept in out.items():
        kept.sort()
        marked = faults([k[3:] for k in kept])
        turns = [k[1] for k in kept if k[0]]
        cost, audit, lines = cheapest([(r, t, b or d, c) for r, t, b, d, c in marked])
        first = [r[0][:1] for r in marked]
        result.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                sum(m[2] for m in marked),
                sum(m[3] for m in marked),
                sum(m[4] for m in marked),
                sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
                cost,
                audit,
                hashlib.sha256(lines[:-1].encode()).hexdigest(),
            )
        )
    return sorted(result, key=str)


def conversations(seed=5, n=120):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "agent", "User"]
    texts = ["Yes.", "No", "", " \t", None, "What?", "a b", "Well!  ", "Fine.\n", "é…", "x" * 5000 + "."]
    rows = []
    for conv in range(n):
        turns = rng.choice([1, 2, 3, 6, 11])
        for t in range(turns):
            turn = rng.choice([t, t, t, t + 2, None])
            role = roles[t % 2] if rng.random() < 0.6 else rng.choice(roles)
            text = f"{rng.randrange(99)} words." if rng.random() < 0.5 else rng.choice(texts)
            rows.append((conv, turn, role, text, *CLASH))
    rows += [(None, None, None, None, *CLASH), (None, 1, "user", "Hi.", *CLASH), rows[0], rows[0], rows[5]]
    return rows


def long_conversation(conv, n, seed=9):
    rng = random.Random(seed)
    return [
        (conv, i, rng.choice(["user", "assistant", "user", "assistant", "tool"]), rng.choice([f"{i}.", f"{i}", "Again.", "", "ok"]), *CLASH)
        for i in range(n)
    ]


def got(spark, rows, parts=3):
    df = repair.damaged(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    out = repair.report(repair.repair_blocks(df, live=F.col("live"), tie=F.col("tie"))).collect()
    return sorted((tuple(r) for r in out), key=str)


def test_equals_brute_force_with_messy_rows(spark):
    assert got(spark, conversations()) == brute(conversations())


def test_long_conversations_in_blocks_and_partitions(spark):
    """Several blocks in a partition, and one conversation over all partitions."""
    rows = long_conversation(1, 2500) + long_conversation(2, 700, 4) + conversations(n=10) + [(77, 3, "user", "Same.", *CLASH)] * 900
    assert got(spark, rows) == brute(rows)


def test_empty_table_and_conversation_of_dropped_rows(spark):
    assert got(spark, []) == []
    dropped = next(i for i in range(99) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert got(spark, [(dropped, 0, "user", "Hi.", *CLASH)]) == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)]


def test_rows_of_the_repair_follow_the_pattern(spark):
    df = spark.createDataFrame(conversations(8), SCHEMA)
    rows = repair.repaired_rows(repair.repair_blocks(df)).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r["block"], r["pos"])):
        by.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert by and all(re.fullmatch("s?(ua)+", "".join(v)) for v in by.values())


@pytest.mark.parametrize("prime", [repair.Prefix.PRIME, 3, 1])
def test_order_of_prefixes_whatever_the_hash(monkeypatch, prime):
    monkeypatch.setattr(repair.Prefix, "PRIME", prime)  # a small one makes nearly all hashes collide
    rng = random.Random(1)
    root = repair.Prefix(None, "")
    nodes = [root]
    for _ in range(400):
        nodes.append(rng.choice(nodes[-40:]).add(rng.choice("DIKR")))
    for _ in range(1500):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert repair.order(a, b) == (a.text() > b.text()) - (a.text() < b.text())
        assert a.at(a.depth // 2).text() == a.text()[: a.depth // 2]


def test_blocks_combine_as_one_block():
    rng = random.Random(2)
    for _ in range(60):
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3, 9, 10]) for _ in range(rng.randrange(1, 9)))
        cut = rng.randrange(len(codes) + 1)

        def summary(part):
            cost, rank, _ = repair.solve(part, set(), repair.STATES)
            return repair.Summary(0, 0, 0, 0, -1, -1, None, None, 0, tuple(cost), tuple(rank))

        whole, joined = summary(codes), repair.combine(summary(codes[:cut]), summary(codes[cut:]))
        assert whole.cost == joined.cost and whole.rank == joined.rank
