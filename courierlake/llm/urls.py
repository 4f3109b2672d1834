"""Operator 10: URLs judged by a broadcast trie over reversed host labels and path segments.

A rule (action, host, path) fits its host and all subdomains where the URL's path starts with the rule's. The trie
leads from the last host label to the first, then along whole path segments; the last piece of a rule's path may be
part of a segment. The deepest host with a fitting path decides, and under it the longest path; of equal rules the
last one given counts.

The trie is broadcast up to `most_rules` rules. A larger list is a table and is joined by host suffix instead, with
the same results.

Defined results: a URL that is null or without `://` has empty host and path and gets the default verdict, as does any
URL that no rule fits; repeated rows are judged each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

Rule = tuple[str, str, str]  # action, host, path
MOST_RULES = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nodes: labels by name, "paths" (a node of segments); there "parts" by name, "tails": {piece: (rule, action)}."""
    top: dict = {"labels": {}}
    for action, host, path in rules:
        node = top
        for label in reversed(host.split(".")):
            node = node["labels"].setdefault(label, {"labels": {}})
        at = node.setdefault("paths", {"parts": {}, "tails": {}})
        *whole, tail = path.split("/")
        for part in whole:
            at = at["parts"].setdefault(part, {"parts": {}, "tails": {}})
        at["tails"][tail] = (host + path, action)
    return top


def match_path(node: dict, parts: list[str]) -> tuple[str, str] | None:
    found = None
    for part in parts:
        fitting = [t for t in node["tails"] if part.startswith(t)]
        if fitting:
            found = node["tails"][max(fitting, key=len)]
        node = node["parts"].get(part)
        if node is None:
            break
    return found


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, action) of the longest match."""
    node, parts, found = trie, None, None
    for label in reversed(host.split(".")):
        node = node["labels"].get(label)
        if node is None:
            break
        if "paths" in node:
            parts = path.split("/") if parts is None else parts
            found = match_path(node["paths"], parts) or found
    return found


def by_trie(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    trie = rows.sparkSession.sparkContext.broadcast(build_trie(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [match(trie.value, h, p) or (None, None)
                      for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([j[0] for j in judged], pa.string()),
                 pa.array([j[1] for j in judged], pa.string())], names=[*batch.schema.names, "rule", "action"])

    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, action string")


def by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for a table of rules (action, host, path, position), of any size; of equal rules the last position counts.

    A table without `position` has no order, so there the larger action counts.
    """
    last = F.max_by("action", "position") if "position" in rules.columns else F.max("action")
    table = rules.groupBy(F.col("host").alias("suffix"), F.col("path").alias("start")).agg(last.alias("action"))
    labels = F.split("host", r"\.")
    keyed = rows.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "suffix", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
            F.slice(labels, i, F.size(labels)), "."))))
    hits = keyed.join(table, "suffix").filter(F.startswith("path", "start"))
    spare = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"), F.lit(None).cast("string").alias("rule"),
                     F.lit(None).cast("string").alias("action"))
    none = keyed.select("row", "page_id", "host", "path", spare.alias("hit"))
    every = hits.select("row", "page_id", "host", "path", F.struct(
        F.size(F.split("suffix", r"\.")).alias("depth"), F.length("start").alias("length"),
        F.concat("suffix", "start").alias("rule"), "action").alias("hit")).unionAll(none)
    return every.groupBy("row", "page_id", "host", "path").agg(F.max("hit").alias("hit")).select(
        "page_id", "host", "path", "hit.rule", "hit.action")


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | DataFrame, default: str = "allow",
               most_rules: int = MOST_RULES) -> DataFrame:
    """page_id, host, path, rule (the one that decided, or null) and verdict of every page."""
    ship(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    if not isinstance(rules, DataFrame) and len(rules) > most_rules:
        rules = pages.sparkSession.createDataFrame([(*r, n) for n, r in enumerate(rules)],
                                                   "action string, host string, path string, position long")
    judged = by_join(rows, rules) if isinstance(rules, DataFrame) else by_trie(rows, rules)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
