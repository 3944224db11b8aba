"""URL filters: a trie over reversed host labels and path segments, longest match first.

Rules are (action, host, path).  A rule fits its host and every subdomain of
it, if the URL's path starts with the rule's path.  Of the rules that fit, the
one with the most host labels wins, then the one with the longest path; an
allow and a block rule of the same host and path leave the block.  Where no
rule fits, the verdict is the `default`.

Edge cases: a null URL, or one without "://", has an empty host and path, which
fit no rule that names a host.  Repeated rows are judged one by one and all
returned; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str, str]

#: A trie of at most this many rules is broadcast (about 200 bytes each); more are joined.
BROADCAST_RULES = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a URL; both empty without a "://"."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


class HostPathTrie:
    """Nested dicts: host labels from the last to the first, then path segments.

    At the end of a rule's whole segments, the beginning of its last, partial
    segment is kept as a prefix ("" for a rule that ends in "/").
    """

    def __init__(self, rules: Iterable[Rule]):
        self.hosts: dict = {}
        for action, host, path in sorted(rules):  # "allow" before "block": the later one stays
            node = self.hosts
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            *whole, partial = path.split("/")
            paths = node.setdefault(None, {})
            for segment in whole:
                paths = paths.setdefault(segment, {})
            paths.setdefault(None, {})[partial] = (action, host + path)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(action, rule) of the longest rule that fits."""
        chain, node = [self.hosts], self.hosts
        for label in reversed(host.split(".")) if host else ():
            node = node.get(label)
            if node is None:
                break
            chain.append(node)
        segments = path.split("/")
        for node in reversed(chain):
            if None in node and (found := self._path(node[None], segments)):
                return found
        return None

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            if None in node:
                fitting = [p for p in node[None] if segment.startswith(p)]
                if fitting:
                    best = node[None][max(fitting, key=len)]
            node = node.get(segment)
            if node is None:
                break
        return best


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """id, host, path, rule (null where none fits) and verdict of every URL.

    The trie is broadcast while there are at most `broadcast_rules` rules;
    beyond that the rules stay a table and are joined on the host's suffixes.
    """
    for action, _, _ in rules:
        if action not in ("allow", "block"):
            raise ValueError(f"unknown action {action!r}")
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("__id"), host.alias("host"), path.alias("path"))
    found = _by_trie(split, rules) if len(rules) <= broadcast_rules else _by_join(split, rules)
    return found.select(F.col("__id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _by_trie(split: DataFrame, rules: list[Rule]) -> DataFrame:
    trie = split.sparkSession.sparkContext.broadcast(HostPathTrie(rules))
    id_type = split.schema["__id"].dataType.simpleString()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie.value
        for batch in batches:
            found = [known.match(h, p) or (None, None) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            action = pa.array([a for a, _ in found], pa.string())
            rule = pa.array([r for _, r in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, action], ["__id", "host", "path", "rule", "verdict"])

    return split.mapInArrow(match, f"__id {id_type}, host string, path string, rule string, verdict string")


def _by_join(split: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same through joins: distinct (host, path) pairs against the rules of each suffix of the host."""
    spark = split.sparkSession
    table = spark.createDataFrame([(*r, len(r[1].split(".")) if r[1] else 0) for r in rules], "action string, __host string, __path string, labels int")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    pairs = split.select("host", "path").distinct()
    fitting = pairs.withColumn("__host", F.explode(F.array_union(suffixes, F.array(F.lit(""))))).join(table, "__host").filter(F.col("path").startswith(F.col("__path")))
    order = F.struct("labels", F.length("__path"), F.col("action") == "block")
    best = fitting.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("__host", "__path").alias("rule"), F.col("action").alias("verdict")), order).alias("b"))
    return split.join(best, ["host", "path"], "left").select("__id", "host", "path", "b.rule", "b.verdict")
