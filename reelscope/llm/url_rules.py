"""URL filters by host-suffix and path-prefix expressions.

Method: every distinct (host, path) is expanded into the expressions that a
rule could have for it (the host's suffixes at label borders times the
path's prefixes), each expression is hashed, expressions and rules meet in an
equi-join on the first 8 hex digits of the digest, the full SHA-256 digests
confirm, and the longest confirmed rule wins.  Built-in functions only.

Only shapes that some rule has are expanded: host suffixes with as many
labels, and path prefixes as long as a rule path; a prefix whose length only
rules ending in ``/`` have must itself end in ``/``.  A URL of a megabyte
therefore yields no more expressions than the rules have shapes.  Rows meet
on (host, path), not on the host, and repeated pairs are reduced before they
travel.  The verdicts are written to the shared folder and joined from there,
a plain join that adaptive execution splits where one URL has many rows.

Defined cases: a null URL or one without ``://`` has empty host and path; an
empty host matches no rule.  Rules with a null or empty host are ignored, a
null path is empty.  Of rules of equal length the one with the longer host
wins, of equal rules with both verdicts ``block``.  Without a rule the
verdict is ``default`` ("allow").  Repeated rows are all returned; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.llm.staging import Staging

HASH_PREFIX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*+", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*+([^?#]*+)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _shapes(rules: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """Label counts of rule hosts, lengths of rule paths ending in ``/``, lengths of the others.

    One row of three sets; they are bounded by the longest rule, not by the number of rules.
    """
    labels = F.size(F.split("host", r"\."))
    row = rules.agg(
        F.collect_set(labels).alias("labels"),
        F.collect_set(F.when(F.col("path").endswith("/"), F.length("path"))).alias("closed"),
        F.collect_set(F.when(~F.col("path").endswith("/"), F.length("path"))).alias("open"),
    ).first()
    return sorted(row.labels), sorted(row.closed), sorted(row.open)


def _ints(values: list[int]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<int>")


def _expressions(host: Column, path: Column, shapes: tuple[list[int], list[int], list[int]]) -> Column:
    labels, closed, open_ = shapes
    parts = F.split(host, r"\.")
    count = F.size(parts)
    hosts = F.transform(
        F.filter(_ints(labels), lambda k: k <= count),
        lambda k: F.array_join(F.slice(parts, count - k + 1, k), "."),
    )
    closed_paths = F.filter(
        F.transform(F.filter(_ints(closed), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n)),
        lambda p: p.endswith("/"),
    )
    open_paths = F.transform(F.filter(_ints(open_), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    paths = F.array_distinct(F.concat(closed_paths, open_paths))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("host"), p.alias("path")))))


def _digest(host: Column, path: Column) -> Column:
    # a separator that no host holds keeps "a.b" + "/c" apart from other splits
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id``, ``url``).

    ``rules``: ``host``, ``path``, ``verdict`` ("allow" or "block").
    """
    rules = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).where("host is not null and host <> ''")
    shapes = _shapes(rules)
    hashed = (
        rules.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block over allow
        .select(
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("host_length"),
            "verdict",
            _digest(F.col("host"), F.col("path")).alias("digest"),
        )
        .withColumn("prefix", F.substring("digest", 1, HASH_PREFIX))
    )
    urls = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    urls = urls.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    expanded = (
        urls.where("host <> ''")
        .select("host", "path")
        .distinct()
        .select("host", "path", F.explode(_expressions(F.col("host"), F.col("path"), shapes)).alias("e"))
        .select("host", "path", _digest(F.col("e.host"), F.col("e.path")).alias("own"))
        .withColumn("prefix", F.substring("own", 1, HASH_PREFIX))
    )
    stage = Staging(pages.sparkSession, "url-rules")
    best = (
        expanded.join(hashed, "prefix")
        .where("own = digest")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "host_length", "rule", "verdict")).alias("best"))
    )
    verdicts = stage.write(best.select("host", "path", "best.rule", "best.verdict"), "verdicts")
    return urls.join(verdicts, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
