"""URL filters by hashed host-suffix and path-prefix expressions.

Each URL is expanded into the expressions that a rule could have been written as: a
suffix of its host's labels followed by a prefix of its path that ends in ``/`` (or is
empty). Expressions meet rules in an equi-join on the first 32 bits of their SHA-256;
the full digest and the rest of the rule's path then confirm, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.session import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules (two short strings and two digests each) that are marked for broadcast at most;
#: a longer list is joined by a shuffle, where Spark splits skewed expressions.
BROADCAST_RULES = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``, up to ``/``, ``?`` or ``#``, and the path after it.

    A-Z in the host are lower-cased. Both are empty for null and for a URL without ``://``.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _directory(path: Column) -> Column:
    """The path up to and with its last ``/``; empty if it has none."""
    return F.regexp_extract(path, "^(?s:.*/)?", 0)


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _expression(host: Column, directory: Column) -> list[Column]:
    digest = F.sha2(F.concat(host, directory), 256)
    return [digest.alias("digest"), F.substring(digest, 1, 8).alias("short")]


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their expressions.

    A rule without host or verdict fits nothing; a null path is an empty one, which fits
    every path. Of equal rules with different verdicts, ``block`` stays.
    """
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    directory = _directory(path)
    return (
        rules.filter(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .groupBy(host.alias("rule_host"), path.alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .select(
            "rule_path",
            "rule_verdict",
            F.concat("rule_host", "rule_path").alias("rule"),
            F.length("rule_host").alias("host_length"),
            F.size(F.split("rule_host", "\\.", -1)).alias("labels"),
            _slashes(F.col("rule_path")).alias("depth"),
            *_expression(F.col("rule_host"), _directory(F.col("rule_path"))),
        )
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row (key, host, path, rule, verdict) per row of ``pages``.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains if the
    path starts with the rule's; the longest rule wins (then the longer host). A URL that
    no rule fits has a null rule and the ``default`` verdict; so has a null URL and one
    without host. Repeated rows are judged each; other columns of ``pages`` are left out.
    An empty table gives no rows, and without rules every verdict is the default.

    Only different (host, path) pairs are expanded and joined, so a hot URL costs one
    row. Expressions of a shape (labels, path depth) that no rule has are not made. The
    shapes are the one thing taken to the driver: a few numbers, however many the rules.
    """
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"))
    ready = prepared_rules(rules)
    shapes = [(r.labels, r.depth) for r in ready.select("labels", "depth").distinct().collect()]
    if not shapes:
        return parsed.select(
            F.col("_key").alias(key), "host", "path",
            F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
        )
    labels = F.split("host", "\\.", -1)
    at = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("depth")) for a, b in shapes])
    fitting = F.filter(
        at, lambda s: (s["labels"] <= F.col("n_labels")) & (s["depth"] <= F.col("n_slashes"))
    )
    expressions = (
        parsed.filter(F.col("host") != "")
        .select("host", "path")
        .distinct()
        .withColumns({"labels": labels, "n_labels": F.size(labels), "n_slashes": _slashes(F.col("path"))})
        .select("host", "path", "labels", F.explode(fitting).alias("shape"))
        .select(
            "host",
            "path",
            *_expression(
                F.array_join(F.slice("labels", -F.col("shape.labels"), F.col("shape.labels")), "."),
                F.when(F.col("shape.depth") == 0, F.lit("")).otherwise(
                    F.concat(F.expr("substring_index(path, '/', shape.depth)"), F.lit("/"))
                ),
            ),
        )
    )
    few = ready.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    listed = ready.withColumnRenamed("digest", "rule_digest")
    found = (
        expressions.join(F.broadcast(listed) if few else listed, "short")
        .filter((F.col("digest") == F.col("rule_digest")) & F.expr("startswith(path, rule_path)"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(F.length("rule").alias("size"), "host_length", "rule", "rule_verdict")
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.rule_verdict")
    )
    # Staged, so that the join below has two plain shuffles and a hot URL can be split.
    judged = stage(found, "judged-urls")
    return parsed.join(judged, ["host", "path"], "left").select(
        F.col("_key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
    )
