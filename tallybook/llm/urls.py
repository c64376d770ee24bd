"""URL filter: a trie over reversed host labels and path segments.

A rule is (host, path, verdict). It fits its host and every subdomain when the url's path starts with the rule's path.
The longest fitting rule wins: the longest host first, then the longest path; block wins over allow for the same
host and path. The trie is broadcast while the rules are proven small; a larger rule table is joined by
(host, folder of the path), the same result without a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import filled, slices, strings

#: Rules of more characters are joined instead of broadcast.
TRIE_CHARS = 16 << 20
DEFAULT = "allow"
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST, _PATH, _REST = 0, 1, 2


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a url; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    stops = [i for i in map(rest.find, "/?#") if i >= 0]
    host = rest[: min(stops, default=len(rest))]
    path = rest[len(host) :].partition("#")[0].partition("?")[0]
    return host.translate(_LOWER), path


def _node():
    return [{}, {}, {}]  # labels to the left, next path segments, partial last segments with their rules


def build_trie(rules: Sequence[tuple[str, str, str]]):
    """Nodes of host labels from the right; below a host, whole path segments, then the rest of the rule's path."""
    root = _node()
    for host, path, verdict in sorted(rules, key=lambda r: r[2] == "block"):
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node[_HOST].setdefault(label, _node())
        *folders, rest = path.split("/")
        for folder in folders:
            node = node[_PATH].setdefault(folder, _node())
        node[_REST][rest] = (host.translate(_LOWER) + path, verdict)
    return root


def _best_path(node, segments: list[str]):
    """The rule with the longest path below a host."""
    best = None
    for depth, segment in enumerate(segments):
        rests = node[_REST]
        if rests:
            fits = [r for r in rests if segment.startswith(r)] if len(rests) < len(segment) else [
                segment[:i] for i in range(len(segment) + 1) if segment[:i] in rests]
            if fits:
                best = rests[max(fits, key=len)]
        if depth == len(segments) - 1 or segment not in node[_PATH]:
            break
        node = node[_PATH][segment]
    return best


def match(root, host: str, path: str):
    """(rule, verdict) of the longest rule that fits, or None."""
    best, node, segments = None, root, path.split("/")
    for label in reversed(host.split(".")):
        node = node[_HOST].get(label)
        if node is None:
            break
        best = _best_path(node, segments) or best
    return best


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, key: str = "page_id",
    url: str = "url", default: str = DEFAULT,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` for every row.

    ``rules`` is a list, or a table with columns host, path, verdict. A null url, or one without ``://``, has an empty
    host and path and gets the default. Repeated rows and null ids each give a row; no rows give no rows; no rules give
    the default everywhere. Other columns are not carried, so their names cannot clash.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"))
    if isinstance(rules, DataFrame):
        size = rules.select(F.sum(F.length("host") + F.length("path"))).first()[0] or 0
        if size > TRIE_CHARS:
            return judge_by_join(rows, rules, default)
        rules = [tuple(r) for r in rules.select("host", "path", "verdict").dropna().collect()]
    elif sum(len(h) + len(p) for h, p, _ in rules) > TRIE_CHARS:
        return judge_by_join(rows, spark.createDataFrame(rules, "host string, path string, verdict string"), default)
    trie = spark.sparkContext.broadcast(build_trie(rules))

    def run(batches):
        root = trie.value
        for batch in slices(batches, "url"):
            split = [split_url(u) for u in strings(filled(batch.column("url")))]
            found = [match(root, *parts) or (None, default) for parts in split]
            columns = [[h for h, _ in split], [p for _, p in split], [r for r, _ in found], [v for _, v in found]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *[pa.array(c, pa.string()) for c in columns]],
                ["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def judge_by_join(rows: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """The same verdicts for any number of rules.

    Distinct (host, path) pairs meet the rules by host suffix and folder, so a frequent url costs one pair; the best rule
    of a pair is an aggregate.
    """
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    # Only ASCII letters are lowered, as the contract of hosts says.
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    urls = rows.select("page_id", host.alias("host"), path.alias("path"))
    pairs = urls.select("host", "path").distinct()
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    folders = F.transform(F.sequence(F.lit(0), F.size(segments) - 1), lambda i: F.when(
        i > 0, F.concat(F.array_join(F.slice(segments, 1, i), "/"), F.lit("/"))).otherwise(""))
    wanted = pairs.withColumn("rule_host", F.explode(suffixes)).withColumn("folder", F.explode(folders))
    given = rules.dropna().select(
        F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("rule_host"),
        F.regexp_extract(F.col("path"), r"^(.*/)?", 0).alias("folder"), F.col("path").alias("rule_path"),
        F.col("verdict").alias("given"))
    fits = wanted.join(given, ["rule_host", "folder"]).filter(F.col("path").startswith(F.col("rule_path")))
    order = F.struct(F.length("rule_host"), F.length("rule_path"), F.col("given") == "block")
    best = fits.groupBy("host", "path").agg(F.max_by(
        F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("given")), order).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.given", F.lit(default)).alias("verdict"))
