"""Secret scans over an incremental blob ledger [native].

Every historical version of a path is content-addressed (SHA-256 of its
text).  The ledger stores one row per scanned (blob, rule version) pair with
the spans found.  A push scans only blobs that lack some rule version, and
only for the versions they lack, appends the pairs, and findings are joined
back to all paths that hold the blob.  Everything runs as built-in
expressions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import clean_text, finished_folders, register, table


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts, and the least length; spans
    are the leftmost non-overlapping matches that are long enough."""
    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base kinds, in the order in which equal starts are listed.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
LEDGER_SCHEMA = "blob string, rule string, spans array<struct<start:int,end:int>>"


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans in code points.  ``split`` and ``regexp_extract_all`` walk the
    same matches, so the k-th match starts after the first k + 1 pieces and k
    matches.  The arrays are built only where the pattern occurs."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    counted = whole if rule.group == 0 else F.transform(
        F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    zipped = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(whole)).alias("gap"),
                          whole.alias("len"), counted.alias("got"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, x):
        s = acc["at"] + x["gap"]
        span = F.array(F.struct(s.alias("start"), (s + x["len"]).alias("end")))
        return F.struct((s + x["len"]).alias("at"),
                        F.when(x["got"] >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.regexp_like(text, pattern),
                  F.aggregate(zipped, start, step, lambda acc: acc["out"])).otherwise(none)


class BlobLedger:
    """Ledger of scanned (blob, rule version) pairs under ``path``.

    Opening a folder goes on with the pushes that it holds; one that died half
    written is not among them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.pushes = finished_folders(spark, self.path)

    def rows(self) -> DataFrame:
        if not self.pushes:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(*[f"{self.path}/{p}" for p in self.pushes])

    def push(self, texts: DataFrame, rules: Sequence[Rule] = RULES) -> None:
        """Scan the unseen pairs of ``texts`` (blob, text) and record them."""
        blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))
        if self.pushes:
            seen = self.rows().groupBy("blob").agg(F.collect_set("rule").alias("done"))
            blobs = blobs.join(seen, "blob", "left")
        else:
            blobs = blobs.withColumn("done", F.lit(None).cast("array<string>"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        done = F.coalesce("done", F.array().cast("array<string>"))
        todo = blobs.withColumn("todo", F.array_except(wanted, done)).where(F.size("todo") > 0)
        found = [F.when(F.array_contains("todo", r.key),
                        F.struct(F.lit(r.key).alias("rule"), spans_of(F.col("text"), r).alias("spans")))
                 for r in rules]
        scanned = (todo.select("blob", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f"))
                   .select("blob", "f.rule", "f.spans"))
        push = f"push={len(self.pushes) + 1:06d}-{uuid.uuid4().hex[:8]}"
        scanned.write.option("compression", "zstd").mode("errorifexists").parquet(f"{self.path}/{push}")
        self.pushes.append(push)


def scan_history(versions: DataFrame, rules: Sequence[Rule] = RULES, pushes: int = 2,
                 id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Scan all versions in ``pushes`` successive pushes (id ranges) and join
    the findings back: doc_id, blob, found (array of kind, start, end by start,
    then in the order of the rules).

    NULL text is the empty blob.  A text held by many rows is scanned once,
    however hot it is: blobs are pre-aggregated before the shuffle, and the
    join back splits a hot blob.  NULL ids go with the first push; repeated
    rows each get the findings; an empty table gives an empty result; other
    columns are ignored."""
    spark = versions.sparkSession
    rows = versions.select(F.col(id_col).alias("doc_id"), clean_text(text_col).alias("text"))
    rows = rows.withColumn("blob", F.sha2(F.encode("text", "UTF-8"), 256))
    low, high = versions.agg(F.min(id_col), F.max(id_col)).first()
    low, high = low or 0, high or 0
    width = max(1, -(-(high - low + 1) // pushes))
    ledger = BlobLedger(spark, path or scratch_path(spark, "ledger"))
    for p in range(pushes):
        start = low + p * width
        mine = F.col("doc_id") < start + width if p < pushes - 1 else F.col("doc_id").isNotNull()
        if p:
            mine = mine & (F.col("doc_id") >= start)
        else:
            mine = mine | F.col("doc_id").isNull()
        ledger.push(rows.where(mine), rules)
    order = {r.key: i for i, r in enumerate(rules)}
    rank = F.element_at(F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))]), F.col("rule"))
    hits = (ledger.rows().where(F.size("spans") > 0)
            .select("blob", rank.alias("nth"), F.split("rule", "@")[0].alias("kind"), F.explode("spans").alias("s"))
            .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
                F.col("s.start").alias("start"), "nth", "kind", F.col("s.end").alias("end")))).alias("found")))
    return (rows.select("doc_id", "blob").join(hits, "blob", "left")
            .select("doc_id", "blob", F.coalesce("found", F.array().cast(hits.schema["found"].dataType)).alias("found")))


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The assign pattern with its letters spelled out, as a SQL string.
ASSIGN_SQL = ("(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
              + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
# The leftmost match is also the first place of its own string in the rest.
OP5_SQL = r"""
WITH RECURSIVE kinds(nth, kind, pattern) AS (
  VALUES (0, 'assign', '@assign@'), (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]{32,}')),
blobs AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
m AS (
  SELECT text, nth, kind, pattern, text AS rest, CAST(0 AS BIGINT) AS base, regexp_extract(text, pattern, 0) AS hit
  FROM blobs, kinds WHERE regexp_matches(text, pattern)
  UNION ALL
  SELECT text, nth, kind, pattern, rest, base, regexp_extract(rest, pattern, 0)
  FROM (SELECT text, nth, kind, pattern, substr(rest, strpos(rest, hit) + length(hit)) AS rest,
               base + strpos(rest, hit) - 1 + length(hit) AS base FROM m)
  WHERE regexp_matches(rest, pattern)),
spans AS (SELECT text, nth, kind, base + strpos(rest, hit) - 1 AS s, base + strpos(rest, hit) - 1 + length(hit) AS e
          FROM m WHERE CASE nth WHEN 0 THEN length(regexp_extract(hit, '@assign@', 2)) >= 8
                                WHEN 1 THEN length(hit) >= 16 ELSE length(hit) >= 32 END),
found AS (SELECT text, count(*) FILTER (nth = 0) AS n_assign, count(*) FILTER (nth = 1) AS n_access,
                 count(*) FILTER (nth = 2) AS n_hex,
                 string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nth) AS spans
          FROM spans GROUP BY text)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN found ON coalesce(d.text, '') = found.text
""".replace("@assign@", ASSIGN_SQL)


@register("op5_secrets", OP5_SQL)
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_history(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return (out.select("doc_id", count("assign"), count("access"), count("hex"), spans.alias("spans"))
            .select("doc_id", "n_assign", "n_access", "n_hex",
                    F.sha2(F.encode("spans", "UTF-8"), 256).alias("base_sha256"), "spans"))
