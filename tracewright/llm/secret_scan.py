"""Secret scans: candidates by pattern, judged by how many owners hold them.

Patterns find candidates in whole texts.  Their hashes are counted over the
whole corpus by distinct repository and owner: a value that many owners hold is
a copied example, one that stays with few owners looks live.  Text is read once;
everything after works on the few candidate rows, in DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settle, small, table

#: Fixed patterns: (kind, pattern, group that is the secret, least length of that group).
#: A run of one class is matched whole, so its least length may stand in the pattern.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Bare tokens that become spans only where they are live: letters of both cases and digits.
BARE = ("bare", r"[A-Za-z0-9_-]{20,}", 0, 20)
PLACEHOLDER = r"(?i)(example|sample|changeme|placeholder|dummy|your|xxxx|\*\*\*\*|abcdef|123456)"
#: A candidate is live if at most so many owners hold it, in however many repositories of theirs, and it has so many
#: different characters, or two thirds of its length if that is less.
MAX_OWNERS, MIN_DISTINCT = 2, 8
REDACTED = "[SECRET]"
_LIVE = "_tracewright_live"
KINDS = tuple(k for k, *_ in (*BASE, BARE))


def _found(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Per match in order: length of the text before it since the last, its own length, the secret in it."""
    one = F.struct(F.lit(0).alias("gap"), F.lit(0).alias("len"), F.lit("").alias("value"))
    zipped = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))),
        F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"),
        ),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["m"]).alias("len"), m["v"].alias("value")),
    )
    return F.when(text.rlike(pattern), zipped).otherwise(F.slice(F.array(one), 1, 0))


def candidates(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", id_col: str = "doc_id") -> DataFrame:
    """One settled row per row of ``docs``: its identity and its matches by kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(repo_col).cast("string").alias("repo"),
        F.xxhash64(text, F.length(text)).alias("text_hash"),
        *[_found(text, kind, pattern, group).alias(kind) for kind, pattern, group, _ in (*BASE, BARE)],
    )
    return settle(rows)


_KEY = ["doc_id", "owner", "repo", "text_hash"]


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & a["owner"].eqNullSafe(b["owner"]) & a["repo"].eqNullSafe(b["repo"]) & (a["text_hash"] == b["text_hash"])


def spans(found: DataFrame) -> DataFrame:
    """One row per span: key of its text, kind, start, end (code points), live.

    Base spans all stay, live or not.  A bare token is a span only if it is live
    and touches no base span.
    """
    every = None
    for rank, (kind, _, _, least) in enumerate((*BASE, BARE)):
        part = found.where(F.size(kind) > 0).select(*_KEY, F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), F.lit(least).alias("least"), F.posexplode(kind).alias("i", "m"))
        every = part if every is None else every.unionByName(part)
    flat = every.select(*_KEY, "kind", "rank", "least", "i", F.col("m.gap").alias("gap"), F.col("m.len").alias("len"), F.col("m.value").alias("value"))
    flat = flat.dropDuplicates([*_KEY, "rank", "i"])  # repeated rows of the table have the same spans
    so_far = Window.partitionBy(*_KEY, "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flat = flat.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(so_far)).withColumn("start", F.col("end") - F.col("len"))
    mixed = F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[0-9]")
    flat = flat.where((F.length("value") >= F.col("least")) & ((F.col("kind") != BARE[0]) | mixed))
    flat = settle(flat.select(*_KEY, "kind", "rank", "start", "end", F.sha2("value", 256).alias("hash"), _looks_real(F.col("value")).alias("real")))

    held = flat.groupBy("hash", "owner", "repo").agg(F.max("real").alias("real"))
    owners = held.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.max("real").alias("real"))
    judged = owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.max("real").alias("real"))
    judged = judged.select("hash", (F.col("real") & (F.col("n_owners") <= MAX_OWNERS)).alias("live"), "n_repos")
    out = flat.join(judged, "hash", "left")

    base = F.col("kind") != BARE[0]
    before = Window.partitionBy(*_KEY).orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*_KEY).orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("_left", F.max(F.when(base, F.col("end"))).over(before)).withColumn("_right", F.min(F.when(base, F.col("start"))).over(after))
    apart = F.coalesce(F.col("_left") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("_right") >= F.col("end"), F.lit(True))
    return out.where(base | (F.col("live") & apart)).drop("_left", "_right", "real")


def _looks_real(value: Column) -> Column:
    least = F.least(F.lit(MIN_DISTINCT), F.floor(F.length(value) * 2 / 3))
    return (F.size(F.array_distinct(F.split(value, ""))) >= least) & ~value.rlike(PLACEHOLDER)


def secret_scan(docs: DataFrame, **columns) -> DataFrame:
    """One row per row of ``docs``: counts, digest of the base spans, all spans, live and copied ones.

    A null or empty text has no spans: counts 0, the digest of the empty string.
    Null ids, owners and repositories are values of their own; repeated rows get
    the same result each; an empty table gives an empty one.
    """
    found = candidates(docs, **columns)
    word = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    by_row = (
        spans(found)
        .groupBy(*_KEY)
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end", "live"))).alias("all"),
            *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS],
            F.count(F.when(F.col("live"), 1)).alias("n_live"),
            F.count(F.when(~F.col("live"), 1)).alias("n_copied"),
        )
    )
    joined = found.join(by_row, _same_row(found, by_row), "left")
    text = lambda a: F.coalesce(F.array_join(F.transform(a, word), ","), F.lit(""))
    return joined.select(
        found["doc_id"],
        *[F.coalesce(by_row[n], F.lit(0)).cast("long").alias(n) for n in (*[f"n_{k}" for k in KINDS], "n_live", "n_copied")],
        F.sha2(text(F.filter(by_row["all"], lambda x: x["kind"] != BARE[0])), 256).alias("base_sha256"),
        text(by_row["all"]).alias("spans"),
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every live secret in the text replaced by ``[SECRET]``; copied examples stay.

    All rows and columns are kept, whatever their names.  Null and empty texts
    stay; repeated rows change alike; an empty table gives an empty one.  Where ``n_chars`` is a column it follows the new text.
    """
    found = candidates(docs, text_col, owner_col, repo_col, id_col)
    live = spans(found).where("live").groupBy(*_KEY).agg(F.collect_set("hash").alias("_live"))
    # the few rows to change go by their keys to where the texts are, which are not shuffled while those can be broadcast
    live = small(settle(live.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(_KEY)], "_live")))
    text = F.coalesce(docs[text_col], F.lit(""))
    same = docs[id_col].eqNullSafe(live["_k0"]) & docs[owner_col].cast("string").eqNullSafe(live["_k1"]) & docs[repo_col].cast("string").eqNullSafe(live["_k2"])
    joined = docs.join(live, same & (F.xxhash64(text, F.length(text)) == live["_k3"]), "left")
    out = joined.select(*[docs[c].alias(c) for c in docs.columns], live["_live"].alias(_LIVE)).withColumn(f"{_LIVE}_0", F.coalesce(F.col(text_col), F.lit("")))
    mine = F.col(_LIVE)
    for k, (_, pattern, group, _) in enumerate((*BASE, BARE)):  # a projection for each kind, so that no expression holds the one before it several times
        old = F.col(f"{_LIVE}_{k}")
        parts, hits = F.split(old, pattern, -1), F.regexp_extract_all(old, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(old, F.lit(pattern), F.lit(group))
        changed = F.zip_with(hits, values, lambda m, v: F.when(F.array_contains(mine, F.sha2(v, 256)), F.replace(m, v, F.lit(REDACTED))).otherwise(m))
        new = F.array_join(F.zip_with(parts, F.concat(changed, F.array(F.lit(""))), lambda p, m: F.concat(p, m)), "")
        out = out.withColumn(f"{_LIVE}_{k + 1}", F.when(mine.isNull(), old).when(old.rlike(pattern), new).otherwise(old))
    last = f"{_LIVE}_{len(BASE) + 1}"
    out = out.withColumn(text_col, F.when(mine.isNull(), F.col(text_col)).otherwise(F.col(last)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(mine.isNull(), F.col("n_chars")).otherwise(F.length(last).cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets, judged against the whole corpus."""
    out = secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied")


def _sql_kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''").replace("(?i)", "")
    for word in ("password", "passwd", "secret", "token", "api_?key"):
        either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
        quoted = quoted.replace(f"({word}|", f"({either}|").replace(f"|{word}|", f"|{either}|").replace(f"|{word})", f"|{either})")
    return f"""
  SELECT rid, '{kind}' AS kind, {rank} AS rank, {least} AS least, i, length(p[i]) AS gap, length(m[i]) AS len, v[i] AS value
  FROM (SELECT rid, p, m, v, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT rid, string_split_regex(t, '{quoted}') AS p, regexp_extract_all(t, '{quoted}', 0) AS m, regexp_extract_all(t, '{quoted}', {group}) AS v FROM d))"""


OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_sql_kind(r, *k) for r, k in enumerate((*BASE, BARE)))}),
e AS (SELECT *, sum(gap + len) OVER (PARTITION BY rid, rank ORDER BY i) AS stop FROM f),
s AS (
  SELECT e.*, (stop - len)::BIGINT AS start, doc_id, source, sha256(value) AS hash,
         len(list_distinct(string_split(value, ''))) >= least({MIN_DISTINCT}, length(value) * 2 // 3) AND NOT regexp_matches(value, '{PLACEHOLDER}') AS real
  FROM e JOIN d USING (rid)
  WHERE length(value) >= least AND (kind <> 'bare' OR (regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')))
), j AS (
  SELECT hash, count(DISTINCT coalesce(source, chr(0))) <= {MAX_OWNERS} AND bool_or(real) AS live FROM s GROUP BY hash
), a AS (
  SELECT s.*, live FROM s JOIN j USING (hash)
), k AS (
  SELECT * FROM a WHERE kind <> 'bare' OR (live AND NOT EXISTS (
    SELECT 1 FROM a b WHERE b.rid = a.rid AND b.kind <> 'bare' AND b.start < a.stop AND a.start < b.stop))
), r AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind <> 'bare') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM k GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied
FROM d LEFT JOIN r USING (rid)
"""
