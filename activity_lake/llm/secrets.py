"""Secret scans with an incremental ledger of blobs.

Every version of every path is content-addressed: its blob is the SHA-256 of its bytes. The ledger remembers which rule, in
which version, has been run over which blob, and what it found there. An update scans only the pairs that the ledger does
not have, each blob once however many paths or versions hold it, and the findings are joined back to all of them.

A ledger is a folder of runs. A run is written whole or, without its ``_SUCCESS`` marker, not read: what an interrupted
update has left behind is scanned again by the next one. Pairs that two runs happen to share are counted once.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.llm.common import cut, join_spread, shared_folder
from activity_lake.sinks.hadoop import HadoopFiles


@dataclass(frozen=True)
class Rule:
    """Matches of a pattern, leftmost and non-overlapping; those whose group is shorter than ``least`` don't count.

    ``fold``: letters A-Z match in either case. A rule that changes gets a new version.
    """

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0
    fold: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns and least lengths of the base kinds, in the order that ties are listed in.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 20),
    Rule("hex", 1, r"[0-9a-f]+", 24),
)
#: Beyond the base: private key blocks, hosting tokens and signed web tokens.
RULES = (
    *BASE_RULES,
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 27),
    Rule("hosting", 1, r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("signed", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
)
#: So many unseen blobs at most are sent to all tasks (about 150 bytes each); with more, both sides are dealt by blob.
BROADCAST_BLOBS = 100_000
FINDING = "array<struct<rule: string, start: long, end: long>>"
LEDGER = f"blob string, rules array<string>, findings {FINDING}"


def address(content: Column) -> Column:
    """The blob of a text: hexadecimal SHA-256 of its UTF-8 bytes; null is the empty text."""
    return F.sha2(F.coalesce(content.cast("string"), F.lit("")).cast("binary"), 256)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """blob, rules (names that have been run over it), findings: of all complete runs; no rows where there is no ledger."""
    files = HadoopFiles(spark, path)
    runs = [f"{path}/{name}" for name in files.names(path) if files.exists(f"{path}/{name}/_SUCCESS")]
    return spark.read.schema(LEDGER).parquet(*runs) if runs else spark.createDataFrame([], LEDGER)


def scanner(rules: tuple[Rule, ...]):
    # a run of one class needs no leftmost bookkeeping: too short runs can be skipped by the pattern itself
    compiled = [(rule, re.compile(re.sub(r"^(\[[^]]*\])\+$", rf"\1{{{rule.least},}}", rule.pattern))) for rule in rules]

    @F.pandas_udf(FINDING)
    def scan(contents: pd.Series, wanted: pd.Series) -> pd.Series:
        made = []
        for text, names in zip(contents, wanted):
            text = text or ""
            # lower-casing ASCII alone keeps every offset
            folded = text.encode().lower().decode()
            found = []
            for rule, pattern in compiled:
                if rule.name in names:
                    found += [{"rule": rule.name, "start": m.start(), "end": m.end()}
                              for m in pattern.finditer(folded if rule.fold else text) if m.end(rule.group) - m.start(rule.group) >= rule.least]
            made.append(found)
        return pd.Series(made, dtype=object)

    return scan


def update(versions: DataFrame, path: str, content: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger at ``path`` lacks of the versions' blobs, and add it as one run.

    Repeated rows and equal texts are one blob. Copies are dropped before they travel, so a text that a third of all rows
    share is one row a task. An empty table adds nothing.
    """
    spark = versions.sparkSession
    names = F.array(*(F.lit(rule.name) for rule in rules))
    blobs = versions.select(address(F.col(content)).alias("blob"), F.col(content).cast("string").alias("content"))
    known = ledger(spark, path)
    if known.isEmpty():
        todo = blobs.groupBy("blob").agg(F.first("content").alias("content")).withColumn("wanted", names)
    else:
        seen = known.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        # addresses alone decide what is left; texts travel only after that
        left = (blobs.select("blob").distinct().join(seen, "blob", "left")
                .select("blob", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("wanted"))
                .filter(F.size("wanted") > 0))
        left = cut(left, "unseen-blobs")
        n = left.count()
        if not n:
            return
        if n <= BROADCAST_BLOBS:
            todo = blobs.join(F.broadcast(left), "blob").groupBy("blob").agg(
                F.first("content").alias("content"), F.first("wanted").alias("wanted"))
        else:
            todo = blobs.groupBy("blob").agg(F.first("content").alias("content")).join(left, "blob")
    (todo.select("blob", F.col("wanted").alias("rules"), scanner(rules)("content", "wanted").alias("findings"))
     .write.parquet(f"{path}/run-{uuid.uuid4().hex}"))


def spans_by_blob(known: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans: the findings of these rules in these versions, by start, then kind in the order of the rules."""
    place = F.array(*(F.lit(rule.name) for rule in rules))
    merged = known.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("all"))
    current = F.filter("all", lambda x: F.array_contains(place, x["rule"]))
    listed = F.transform(current, lambda x: F.struct(
        x["start"].alias("start"), F.array_position(place, x["rule"]).alias("place"), x["end"].alias("end"),
        F.split_part(x["rule"], F.lit("@"), F.lit(1)).alias("kind")))
    return merged.select("blob", F.sort_array(F.array_distinct(listed)).alias("spans"))


def back_to_paths(versions: DataFrame, spans: DataFrame, content: str = "text") -> DataFrame:
    """Every row of the versions without its content, with blob and the columns that ``spans`` has of it.

    One blob may be that of a third of all rows: the rows of such blobs are spread, and their findings repeated, in as many
    parts as keep a part below a thousandth of the rows. ``blob`` and the other added columns replace those of their name.
    """
    added = [c for c in spans.columns]
    taken = {c.lower() for c in added}
    kept = [F.col(f"`{c}`") for c in versions.columns if c != content and c.lower() not in taken]
    return join_spread(cut(versions.select(*kept, address(F.col(content)).alias("blob")), "blob-refs"), spans, ["blob"])


def find_secrets(versions: DataFrame, path: str, content: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date and return all rows of the versions (path, content, ...) with blob and spans.

    Null contents are empty texts; null paths and repeated rows are rows like others; empty tables give no rows.
    """
    update(versions, path, content, rules)
    return back_to_paths(versions, spans_by_blob(ledger(versions.sparkSession, path), rules), content)


def listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op11_secrets(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/secret-ledger-{uuid.uuid4().hex}"
    lean = docs.select("doc_id", "text")
    update(lean, path)
    kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter("spans", lambda x: x["kind"].isin(kinds))
    digests = spans_by_blob(ledger(spark, path)).select(
        "blob", *(F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(listing(base).cast("binary"), 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))
    return back_to_paths(lean, digests).select("doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans")


ORACLE = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
rules AS (
    SELECT * FROM (VALUES
        (1, 'assign', '(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[a-z0-9+/_.=-]+',
            '^(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([a-z0-9+/_.=-]+)$', 1, 6),
        (2, 'access', 'AKIA[A-Z0-9]+', '', 0, 20), (3, 'hex', '[0-9a-f]+', '', 0, 24),
        (4, 'pem', '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----', '', 0, 27), (5, 'hosting', 'gh[pousr]_[A-Za-z0-9]+', '', 0, 40),
        (6, 'signed', 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', '', 0, 40)) AS t(place, kind, pattern, whole, grp, least)),
scanned AS (
    SELECT row, place, kind, whole, grp, least, regexp_extract_all(CASE WHEN place = 1 THEN low ELSE text END, pattern) AS found,
        string_split_regex(CASE WHEN place = 1 THEN low ELSE text END, pattern) AS gaps FROM texts, rules),
counted AS (
    SELECT *, unnest(range(1, len(found) + 1)) AS i FROM scanned WHERE len(found) > 0),
spans AS (
    SELECT row, place, kind, found[i] AS s,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
    FROM counted
    WHERE CASE WHEN grp = 1 THEN length(regexp_extract(found[i], whole, 1)) ELSE length(found[i]) END >= least),
listed AS (
    SELECT row, count(*) FILTER (place = 1) AS n_assign, count(*) FILTER (place = 2) AS n_access, count(*) FILTER (place = 3) AS n_hex,
        string_agg(kind || ':' || start::BIGINT || ':' || (start + length(s))::BIGINT, ',' ORDER BY start, place) FILTER (place <= 3) AS base,
        string_agg(kind || ':' || start::BIGINT || ':' || (start + length(s))::BIGINT, ',' ORDER BY start, place) AS spans
    FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row)
"""
