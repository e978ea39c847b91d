"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns give candidate spans. Every candidate's value is hashed, and the hashes are counted over the corpus
by distinct repositories and owners: a value that many owners or many repositories have is a widely copied example,
one that a single owner has in few repositories is owner-specific, and live-looking if its characters vary enough. The
counts also add spans: a bare token whose value was found as an owner-specific live-looking secret elsewhere is a span
of kind ``reuse``. Bare tokens are runs of six or more characters that a value can have, such runs cut at ``=`` and
``/``, and both without full stops at their end; whether one is a secret is for the join with the owned values to say. A
filter of two bits a value, ``BITS`` bits at most, keeps most tokens out of that join; a false hit costs work only.

Places of matches come from the pieces of the text between them, in blocks of ``BLOCK``: the blocks' lengths are summed
up by a window over the document, and the pieces' lengths only in blocks where one counts, so a text with many matches
costs in proportion to its length. A value found in a
third of all documents is pre-aggregated per (value, owner, repository) before it is exchanged, and the lookup of the
counts is salted by document. Nulls and ties: a null text is empty; a null owner or repository is one of its own;
repeated rows count as one document and each get the full result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, text_of


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: kind -> (pattern whose matches are taken leftmost and non-overlapping, least length of the value). Fixed values.
ASSIGN = (
    "(" + "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + f"|{_either('api')}_?{_either('key')})"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"
#: Bare tokens: runs of a value's characters, the same cut at ``=`` and ``/``, and both up to the last that is no full stop.
BARE = ("[A-Za-z0-9+/_.=-]{6,}", "[A-Za-z0-9+/_.=-]{5,}[A-Za-z0-9+/_=-]", "[A-Za-z0-9+_.-]{6,}", "[A-Za-z0-9+_.-]{5,}[A-Za-z0-9+_-]")
KINDS = ("assign", "access", "hex", "reuse")
REUSE = KINDS.index("reuse")

#: A value with this many distinct owners is a widely copied example.
WIDE_OWNERS = 3
#: So is one in this many distinct repositories, of one owner or more.
WIDE_REPOS = 3
#: A live-looking value has at least this many different characters.
LIVE_CHARS = 6
SALTS = 8
#: Most bits of the filter of owned values; there are 64 a value up to that.
BITS = 1 << 22
#: Pieces of a text that are looked at, and exchanged, together.
BLOCK = 256


def _digest(values: Column) -> Column:
    """A value's two hashes and whether it looks live: ``h`` for counting, ``x`` for the filter."""
    return F.struct(
        F.sha2(values, 256).alias("h"),
        F.xxhash64(values).alias("x"),
        (F.size(F.array_distinct(F.split(values, ""))) >= LIVE_CHARS).alias("live"),
    )


def _blocks(kind: int, pattern: str, value, keep) -> Column:
    """A kind's pieces of the text ``t`` -- what stands before each match, the match, its digest if it counts -- in blocks
    of ``BLOCK`` pieces: a block's length, and its pieces where one counts. Null without a match. No value is kept in the
    clear."""
    found = F.arrays_zip(F.split("t", pattern, -1).alias("p"), F.regexp_extract_all("t", F.lit(pattern), F.lit(0)).alias("m"))
    gap = lambda x: F.length(x["p"]).cast("long")
    size = lambda x: F.coalesce(F.length(x["m"]), F.lit(0)).cast("long")
    counts = lambda x: x["m"].isNotNull() & keep(x["m"])

    def piece(x: Column, i: Column) -> Column:
        return F.struct(i.alias("i"), gap(x).alias("gap"), size(x).alias("size"), F.when(counts(x), _digest(value(x["m"]))).alias("d"))

    def block(x: Column, b: Column) -> Column:
        total = F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + gap(y) + size(y))
        return F.struct(
            F.lit(kind).alias("kind"), b.alias("b"), total.alias("total"), F.when(F.exists(x, counts), F.transform(x, piece)).alias("pieces")
        )

    def blocks(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda b: F.transform(F.array(F.slice(all_, b * BLOCK + 1, BLOCK)), lambda x: block(x, b))[0])

    # arrays of one element: what the inner function needs more than once is worked out once
    return F.when(F.col("t").rlike(pattern), F.transform(F.array(found), blocks)[0])


def _placed(blocks: DataFrame) -> DataFrame:
    """``k1, k2, kind, start, stop, d`` of the pieces that count, from ``k1, k2, s``: places by running sums over a
    document's blocks and over a block's pieces."""
    key = ["k1", "k2", "kind"]
    rows = blocks.select("k1", "k2", "s.*").dropDuplicates([*key, "b"])  # repeated rows
    upto = Window.partitionBy(*key).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("before", F.sum("total").over(upto) - F.col("total")).where("pieces IS NOT NULL")
    rows = rows.select(*key, "b", "before", F.explode("pieces").alias("x"))
    upto = Window.partitionBy(*key, "b").orderBy("x.i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.col("before") + F.sum(F.col("x.gap") + F.col("x.size")).over(upto)
    rows = rows.select(*key, stop.alias("stop"), F.col("x.size").alias("size"), F.col("x.d").alias("d")).where("d IS NOT NULL")
    return rows.select(*key, (F.col("stop") - F.col("size")).alias("start"), "stop", "d")


def _probes(x: Column, bits: int) -> list[Column]:
    """The two bits of a hash."""
    return [F.pmod(x, F.lit(bits)).cast("int"), F.pmod(F.shiftright(x, 32), F.lit(bits)).cast("int")]


def _filter(owned: DataFrame):
    """A test of hashes that all owned values pass and few others; None without owned values. The driver holds ``BITS``
    bits at most."""
    n = owned.count()
    if not n:
        return None
    bits = min(BITS, max(1 << 20, 1 << (64 * n - 1).bit_length()))
    one = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)))
    words = owned.select(F.explode(F.array(*_probes(F.col("x"), bits))).alias("at"))
    found = dict(words.groupBy(F.shiftright("at", 6)).agg(F.bit_or(one(F.col("at")))).collect())
    text = ",".join(str(found.get(w, 0)) for w in range(bits >> 6))
    table = F.split(F.lit(text), ",").cast("array<bigint>")  # folded into one literal
    return lambda m: functools.reduce(
        lambda a, b: a & b, [F.get(table, F.shiftright(at, 6)).bitwiseAND(one(at)) != 0 for at in _probes(F.xxhash64(m), bits)]
    )


def _joined(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the order of the array."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def _of_kind(kind: int):
    return lambda s: s["kind"] == kind


def _outside(spans: DataFrame) -> DataFrame:
    """The spans without the bare tokens that meet a base span: a pass over a document's spans in either order."""
    cols = ("start", "kind", "stop")
    earlier = Window.partitionBy("k1", "k2").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    # the rows that follow, as those before in falling order: a frame that ends with the last row is worked out anew for each
    later = Window.partitionBy("k1", "k2").orderBy(*[F.col(c).desc() for c in cols]).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") < REUSE
    before = F.max(F.when(base, F.col("stop"))).over(earlier)
    after = F.min(F.when(base, F.col("start"))).over(later)
    judged = spans.withColumns({"_before": before, "_after": after})
    meets = (F.col("_before") > F.col("start")) | (F.col("_after") < F.col("stop"))
    return judged.where(base | ~F.coalesce(meets, F.lit(False))).drop("_before", "_after")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None
) -> DataFrame:
    """One row per row: ``id_col, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_copied, span_owners, span_repos``.

    ``n_owned``: base spans whose value is owner-specific and live-looking; ``n_copied``: base spans whose value has
    ``WIDE_OWNERS`` owners or ``WIDE_REPOS`` repositories or more; ``span_owners``, ``span_repos``: in the order of
    ``spans``, how many distinct owners and repositories have the value, joined by commas.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", F.col("source"), F.col("lang")) if repo is None else repo
    stage = Stage(docs.sparkSession, "secrets")
    texts = docs.select(
        F.col(id_col).alias("id"),
        text_of(text_col).alias("t"),
        owner.cast("string").alias("owner"),
        repo.cast("string").alias("repo"),
    ).withColumns({"k1": F.xxhash64(F.lit(1), "id", "t"), "k2": F.xxhash64(F.lit(2), "id", "t")})
    assign_value = lambda m: F.regexp_extract(m, ASSIGN, 2)
    whole = lambda m: m
    base_kinds = F.array_compact(
        F.array(
            _blocks(0, ASSIGN, assign_value, lambda m: F.length(assign_value(m)) >= 6),
            _blocks(1, ACCESS, whole, lambda m: F.length(m) >= 20),
            _blocks(2, HEX, whole, lambda m: F.lit(True)),
        )
    )
    base = stage.write(texts.select("k1", "k2", "owner", "repo", F.explode(F.flatten(base_kinds)).alias("s")), "base")

    # who has each value: distinct (value, owner, repository) first, so a common value is one row per task
    seen = base.where("s.pieces IS NOT NULL").select("owner", "repo", F.explode("s.pieces").alias("x"))
    seen = seen.where("x.d IS NOT NULL").select("owner", "repo", "x.d.*")
    by_repo = seen.groupBy("h", "owner", "repo").agg(F.max("live").alias("live"), F.max("x").alias("x"))
    by_owner = by_repo.groupBy("h", "owner").agg(F.count(F.lit(1)).alias("repos"), F.max("live").alias("live"), F.max("x").alias("x"))
    values = by_owner.groupBy("h").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.max("live").alias("live"), F.max("x").alias("x")
    )
    values = stage.write(
        values.select(
            "h",
            "x",
            ((F.col("owners") == 1) & (F.col("repos") < WIDE_REPOS) & F.col("live")).alias("owned"),
            ((F.col("owners") >= WIDE_OWNERS) | (F.col("repos") >= WIDE_REPOS)).alias("copied"),
            "owners",
            "repos",
        ),
        "values",
    )

    placed = _placed(base.select("k1", "k2", "s"))
    hit = _filter(values.where("owned"))
    if hit is not None:
        placed = placed.unionByName(_bare(texts, hit, stage))
    spans = placed.select("k1", "k2", "kind", "start", "stop", F.col("d.h").alias("h"), F.pmod("k1", F.lit(SALTS)).alias("salt"))
    salted = values.drop("x").withColumn("salt", F.explode(F.array(*[F.lit(k).cast("long") for k in range(SALTS)])))
    # the table of values grows with the corpus and is smaller on disk than in memory: never broadcast
    judged = spans.join(salted.hint("merge"), ["h", "salt"]).where((F.col("kind") < REUSE) | F.col("owned")).drop("h", "salt").distinct()
    per_doc = _outside(judged).groupBy("k1", "k2").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "owned", "copied", "owners", "repos"))).alias("spans")
    )
    joined = texts.select("id", "k1", "k2").join(per_doc, ["k1", "k2"], "left")
    span = "struct<start:bigint,kind:int,stop:bigint,owned:boolean,copied:boolean,owners:bigint,repos:bigint>"
    spans = F.coalesce("spans", F.array().cast(f"array<{span}>"))
    count = lambda test: F.size(F.filter(spans, test)).cast("long")
    return joined.select(
        F.col("id").alias(id_col),
        *[count(_of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] < REUSE)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        count(lambda s: s["owned"] & (s["kind"] < REUSE)).alias("n_owned"),
        count(lambda s: s["copied"] & (s["kind"] < REUSE)).alias("n_copied"),
        *[F.array_join(spans.getField(c), ",").alias(f"span_{c}") for c in ("owners", "repos")],
    )


def _bare(texts: DataFrame, hit, stage: Stage) -> DataFrame:
    """Places of the bare tokens that pass ``hit``, in texts that have such a token."""
    kinds = [
        F.when(F.exists(F.regexp_extract_all("t", F.lit(p), F.lit(0)), hit), _blocks(REUSE + k, p, lambda m: m, hit))
        for k, p in enumerate(BARE)
    ]
    blocks = texts.select("k1", "k2", F.explode(F.flatten(F.array_compact(F.array(*kinds)))).alias("s"))
    return _placed(stage.write(blocks, "bare")).withColumn("kind", F.lit(REUSE)).distinct()
