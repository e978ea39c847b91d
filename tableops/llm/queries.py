"""The registered queries of the training-data operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import centroids, embedding_dedup, exact_dedup, maxent, minhash, mixing, pieces, pii, quality, repair, repeats, secrets, warczip
from .common import Stage, documents


PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, checked against the library, and the text they decode to, as digests."""
    return pieces.encode_digests(documents(spark, sf_dir), PIECE_MODEL)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, with the owner-specific and the widely copied ones counted."""
    return secrets.scan(documents(spark, sf_dir))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links by cosine >= 0.95 between all vectors: how many each has, its component, and the one that stays."""
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op4_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance weight of every document and whether the Gumbel top-k selects it."""
    return quality.Resampler(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")).judged()


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups over all documents: one row per document with its group and the id that stays."""
    return minhash.near_groups(documents(spark, sf_dir)).drop("rid", "k1", "k2")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents: one row per document with the id that stays."""
    return exact_dedup.exact_groups(documents(spark, sf_dir)).drop("rid")


PSEUDONYM_KEY = "pseudonyms-1"


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses replaced by format-preserving pseudonyms."""
    return pii.pseudonymise(documents(spark, sf_dir), PSEUDONYM_KEY)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document: sizes in words, sources weighted 5, 2, 1, at most three epochs."""
    return mixing.mix(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under the maximum-entropy model and under smoothed counts, a fifth held out."""
    docs = documents(spark, sf_dir)
    return maxent.LanguageModel(docs).score(docs)


def op10_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 200 bytes that occur elsewhere too."""
    kept = repeats.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into ZIP packages and read back by ranges: its payload and record type."""
    stage = Stage(spark, "warc")
    packages = warczip.write_packages(warczip.page_records(read_table(spark, sf_dir, "pages"), stage), stage)
    return warczip.page_report(warczip.read_packages(packages, payloads=False))


def _warc_sql() -> str:
    """Payloads, types and references for DuckDB; base32 is spelled out in groups of 20 bits."""
    letter = lambda g, k: f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {15 - 5 * k}) & 31)::INTEGER, 1)"
    base32 = " || ".join(letter(g, k) for g in range(8) for k in range(4))
    return f"""
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
        r AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS best FROM p
              WINDOW w AS (PARTITION BY t ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST))
        SELECT page_id, strlen(t)::BIGINT AS payload_bytes, {base32} AS payload_digest,
               CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN best END AS refers_to FROM r
    """


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of 16 centroids for every usable vector after three exact rounds, with the inertia."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired text of every conversation, after planted damage."""
    rows = repair.damaged(read_table(spark, sf_dir, "conversations"))
    return repair.report(repair.repair_blocks(rows, live=F.col("live"), tie=F.col("tie")))


def _repair_sql() -> str:
    """The repair for DuckDB: edit strings carried whole through a recursive query, one row of a conversation a step."""
    ways = []
    for state in repair.STATES:
        at, before = state, ""
        for inserts in range(3):
            cost, letters = repair.INSERT * inserts, "I" * inserts
            ways.append((state, letters + "D", cost + repair.DELETE, -1, at, before, "", False))
            for c in range(3):
                if (at, c) in repair.KEEP:
                    ways.append((state, letters + "K", cost, c, repair.KEEP[at, c], before, "", True))
            ways.append((state, letters + "R", cost + repair.REROLE, -1, repair.NEXT[at], before, repair.FITTING[at], True))
            before += repair.FITTING[at] + ":|"
            at = repair.NEXT[at]
    tails = []
    for state, inserts in repair.TAIL.items():
        at, lines = state, ""
        for _ in range(inserts):
            lines, at = lines + repair.FITTING[at] + ":|", repair.NEXT[at]
        tails.append((state, "I" * inserts, repair.INSERT * inserts, lines))
    values = lambda rows: ", ".join(str(r) for r in rows)
    white = r"\x20\x09-\x0D"
    return rf"""
        WITH RECURSIVE
        w(state, letters, cost, cls, nxt, lines, role, stays) AS (VALUES {values(ways)}),
        z(state, letters, cost, lines) AS (VALUES {values(tails)}),
        raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
                xor(4294967295, list_reduce([ascii(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
                    lambda h, b: list_reduce(range(0, 8), lambda g, i: CASE WHEN g & 1 = 1 THEN xor(g >> 1, 3988292384) ELSE g >> 1 END, xor(h, b)),
                    4294967295)) % 20 AS f FROM conversations),
        d AS (SELECT c, turn, CASE f WHEN 4 THEN 'user' ELSE r END AS role, sha256(r || ':' || t) AS tie,
                CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS text,
                unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM raw),
        o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, tie, copy) AS i,
                coalesce(CASE substr(role, 1, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 END, 3) AS cls,
                NOT regexp_matches(text, '[^{white}]') AS blank, regexp_matches(text, '[.!?][{white}]*$') AS whole FROM d),
        q AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS dup FROM o),
        s AS MATERIALIZED (SELECT *, NOT blank AND NOT dup AND NOT whole AS cut, lag(cls) OVER (PARTITION BY c ORDER BY i) AS prev FROM q),
        p(c, i, m) AS (
            SELECT DISTINCT c, 0::BIGINT, struct_pack(state := 0, cost := 0, audit := '', lines := '') FROM raw
            UNION ALL
            SELECT c, i, unnest([struct_pack(state := state, cost := b.cost, audit := b.audit, lines := b.lines)]) FROM (
                SELECT s.c, s.i, w.nxt AS state, min(struct_pack(
                    cost := p.m.cost + w.cost + CASE WHEN s.cut AND w.stays THEN {repair.CUT} ELSE 0 END,
                    audit := p.m.audit || w.letters,
                    lines := p.m.lines || replace(w.lines, '|', chr(10))
                             || CASE WHEN w.stays THEN CASE w.role WHEN '' THEN s.role ELSE w.role END || ':' || s.text || chr(10) ELSE '' END)) AS b
                FROM p JOIN s ON s.c = p.c AND s.i = p.i + 1
                JOIN w ON w.state = p.m.state AND (w.cls = -1 OR w.cls = s.cls) AND NOT (w.stays AND (s.blank OR s.dup))
                GROUP BY s.c, s.i, w.nxt)),
        n AS (SELECT c, max(i) AS i FROM p GROUP BY c),
        e AS (SELECT p.c, min(struct_pack(cost := p.m.cost + z.cost, audit := p.m.audit || z.letters,
                     lines := p.m.lines || replace(z.lines, '|', chr(10)))) AS b
              FROM p JOIN n USING (c, i) JOIN z ON z.state = p.m.state GROUP BY p.c),
        g AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
                     count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
                     count(*) FILTER (WHERE prev IS NOT NULL AND (prev, cls) NOT IN ((0, 1), (1, 2), (2, 1))) AS illegal FROM s GROUP BY c)
        SELECT any_value(conv_id) AS conv_id, coalesce(any_value(gaps), 0)::BIGINT AS gaps, coalesce(any_value(blank), 0) AS blank,
               coalesce(any_value(duplicate), 0) AS duplicate, coalesce(any_value(truncated), 0) AS truncated,
               coalesce(any_value(illegal), 0) AS illegal, any_value(b.cost)::BIGINT AS cost, any_value(b.audit) AS audit,
               sha256(any_value(CASE b.lines WHEN '' THEN '' ELSE left(b.lines, length(b.lines) - 1) END)) AS repaired_sha256
        FROM raw JOIN e USING (c) LEFT JOIN g USING (c) GROUP BY c
    """


def _centroid_sql(k: int = centroids.K, rounds: int = centroids.ROUNDS) -> str:
    """The clustering for DuckDB: one pair of tables a round."""
    parts = [
        """e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE len(embedding) = 64),
        v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(x, lambda y: floor(64 * y)::BIGINT) AS v FROM e
              WHERE len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM
              (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, 'null')) AS h, v FROM v ORDER BY h, v LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, k := k)) AS m FROM (
              SELECT r, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{r}) GROUP BY r)"""
        )
        if r < rounds:
            parts.append(
                f"""s{r} AS (SELECT k, j, sum(x)::BIGINT AS s, count(*) AS n FROM (
              SELECT m.k AS k, unnest(v) AS x, unnest(range(64)) AS j FROM a{r} JOIN v USING (r)) GROUP BY k, j),
            m{r} AS (SELECT k, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END ORDER BY j) AS c FROM s{r} GROUP BY k),
            c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))"""
            )
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, m.k::INTEGER AS cluster, m.d AS distance, sum(m.d) OVER (PARTITION BY m.k)::BIGINT AS cluster_inertia,
               sum(m.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.k = m.k"""


def _secret_sql() -> str:
    """The secret scan for DuckDB, from the operator's patterns."""
    sql = lambda p: p.replace("'", "''")
    kinds = [
        (0, secrets.ASSIGN, f"regexp_extract(m, '{sql(secrets.ASSIGN)}', 2)", "length(v) >= 6"),
        (1, secrets.ACCESS, "m", "length(v) >= 20"),
        (2, secrets.HEX, "m", "true"),
        *[(secrets.REUSE, p, "m", "true") for p in secrets.BARE],
    ]
    spans = " UNION ALL ".join(
        f"""SELECT doc_id, owner, repo, kind, start, start + length(m) AS stop, v FROM (
                SELECT doc_id, owner, repo, {k} AS kind, m, {value} AS v,
                       sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i)::BIGINT - length(m) AS start
                FROM (SELECT r, doc_id, owner, repo, unnest(string_split_regex(t, '{sql(pattern)}')) AS p, unnest(ms) AS m,
                             unnest(range(1, len(ms) + 1)) AS i
                      FROM (SELECT *, regexp_extract_all(t, '{sql(pattern)}', 0) AS ms FROM d WHERE regexp_matches(t, '{sql(pattern)}'))))
            WHERE m IS NOT NULL AND {test}"""
        for k, pattern, value, test in kinds
    )
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source AS owner, concat_ws('/', source, lang) AS repo
                   FROM documents),
        s AS MATERIALIZED ({spans}),
        b AS (SELECT *, length(array_to_string(list_distinct(string_split(v, '')), '')) >= {secrets.LIVE_CHARS} AS live FROM s WHERE kind < 3),
        c AS (SELECT v, count(DISTINCT coalesce(owner, chr(1))) AS owners, count(DISTINCT (coalesce(owner, chr(1)), coalesce(repo, chr(1)))) AS repos,
                     bool_or(live) AS live FROM b GROUP BY v),
        f AS (SELECT *, owners = 1 AND repos < {secrets.WIDE_REPOS} AND live AS owned,
                     owners >= {secrets.WIDE_OWNERS} OR repos >= {secrets.WIDE_REPOS} AS copied FROM c),
        j AS (SELECT DISTINCT doc_id, kind, start, stop, owned, copied, owners, repos FROM s JOIN f USING (v)
              WHERE kind < 3 OR owned AND NOT EXISTS (FROM b WHERE b.doc_id = s.doc_id AND b.start < s.stop AND s.start < b.stop)),
        n AS (SELECT *, ['assign', 'access', 'hex', 'reuse'][kind + 1] || ':' || start || ':' || stop AS name FROM j),
        g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS k, count(*) FILTER (WHERE kind = 2) AS h,
                     string_agg(name, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3) AS base,
                     string_agg(name, ',' ORDER BY start, kind, stop) AS spans,
                     string_agg(owners::VARCHAR, ',' ORDER BY start, kind, stop) AS span_owners,
                     string_agg(repos::VARCHAR, ',' ORDER BY start, kind, stop) AS span_repos,
                     count(*) FILTER (WHERE kind < 3 AND owned) AS n_owned, count(*) FILTER (WHERE kind < 3 AND copied) AS n_copied
              FROM n GROUP BY doc_id)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
               coalesce(n_owned, 0) AS n_owned, coalesce(n_copied, 0) AS n_copied,
               coalesce(span_owners, '') AS span_owners, coalesce(span_repos, '') AS span_repos
        FROM d LEFT JOIN g USING (doc_id)
    """


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op") and callable(fn)}

ORACLE = {
    "op2_secret_scan": _secret_sql(),
    "op11_warc_zip": _warc_sql(),
    "op12_centroids": _centroid_sql(),
    "op13_repair": _repair_sql(),
    "op3_embedding_dedup": """
        WITH RECURSIVE u AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS s FROM u),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_dot_product(a.e, b.e) / (a.s * b.s) >= 0.95),
        r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c
    """,
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, s AS text_sha256
        FROM d WINDOW w AS (PARTITION BY s)
    """,
    "op8_mix_sources": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          ('0x' || substr(md5('17:' || doc_id), 1, 8))::BIGINT AS u
                   FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS size,
                     CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
              FROM d GROUP BY source),
        r AS (SELECT *, sum(size) OVER () AS total, coalesce(sum(3 * size) OVER (ORDER BY 3.0 * size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
                     sum(weight) OVER (ORDER BY 3.0 * size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
              FROM s),
        f AS (SELECT max((total - clamped)::DOUBLE / open_weight::DOUBLE) AS lvl FROM r),
        t AS (SELECT source, size AS source_size, least((3 * size)::DOUBLE, lvl * weight) AS target FROM s, f),
        p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
        c AS (SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS wanted,
                     sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
                     sum(d.size) OVER (PARTITION BY d.source, d.u) AS peers
              FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
        k AS (SELECT *, (whole + CASE WHEN wanted > 0 AND (upto <= wanted OR (upto - peers / 2.0 <= wanted)) THEN 1 ELSE 0 END)::BIGINT AS copies FROM c)
        SELECT doc_id, source, size, source_size, target, copies, size * copies AS taken FROM k
    """,
}
