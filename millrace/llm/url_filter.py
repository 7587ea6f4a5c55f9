"""URL rules by a sorted sweep over reversed-host keys.

A rule (host, path) fits a URL if the URL's host is the rule's host or one of
its subdomains and the URL's path starts with the rule's path. The key of a
host and path is ``com.example.www#/path``: reversed labels, a sign that neither
part can hold, the path. A URL is looked up under each of its host's suffixes, so
that for every key the rules that fit are the prefixes of the key: nested
intervals. The sweep sorts rule starts, rule ends and URL keys together. A
running sum gives the depth of the stack of active rules, and the top of the
stack at depth d is the last rule that started at depth d. The longest rule
(host and path together) over all suffixes wins; of equally long ones the one
with the longer host.

Only DataFrame functions are used. Hosts with many URLs, and URLs that occur
often, are reduced to distinct keys before the sweep; the sweep's slots cut
the whole key order, so that a hot host is spread over tasks.

Defined results: a null URL or one without ``://`` has an empty host and path,
and the default verdict; a rule stated twice counts once, and blocks if either
does; null rule parts count as empty; rows that repeat are judged alike; other
columns stay, and one named like a result column is replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import forward_fill, running_sum
from millrace.storage import land

RESULT = ("host", "path", "rule", "verdict")
_SIGN = "#"
_AFTER_ALL = "G"  # sorts after every hexadecimal digit


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _labels(host: str) -> Column:
    return F.reverse(F.split(F.col(host), r"\."))


def _key(labels: Column, path: str) -> Column:
    """Hexadecimal, so that keys sort as their bytes do."""
    return F.hex(F.encode(F.concat(F.array_join(labels, "."), F.lit(_SIGN), F.col(path)), "UTF-8"))


def _sweep(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """``key`` and ``top`` (the longest rule that is a prefix) of the keys that have one."""
    start = rules.select("key", F.lit(0).alias("kind"), F.lit(1).alias("step"), F.struct("rule", "verdict", "reach", "host_reach").alias("top"))
    none = F.lit(None).cast(start.schema["top"].dataType)
    end = rules.select(F.concat("key", F.lit(_AFTER_ALL)).alias("key"), F.lit(2).alias("kind"), F.lit(-1).alias("step"), none.alias("top"))
    urls = keys.select("key", F.lit(1).alias("kind"), F.lit(0).alias("step"), none.alias("top"))
    events = land(start.unionByName(end).unionByName(urls), "url-events")
    depth = land(running_sum(events, "step", ["key", "kind"], out="depth"), "url-depth")
    on_stack = depth.filter((F.col("depth") > 0) & (F.col("kind") < 2))
    tops = forward_fill(on_stack, "top", ["key", "kind"], by=["depth"], fill_head=False, out="top_here")
    return tops.filter("kind = 1").select("key", F.col("top_here").alias("top"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).
    """
    kept = [c for c in pages.columns if c not in RESULT]
    named = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    given = (
        rules.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")], "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("labels", _labels("host"))
        .select(
            _key(F.col("labels"), "path").alias("key"),
            F.concat("host", "path").alias("rule"),
            "verdict",
            (F.char_length("host") + F.char_length("path")).alias("reach"),
            F.char_length("host").alias("host_reach"),
            F.size("labels").alias("n_labels"),
        )
    )
    given = land(given, "url-rules")
    most = given.agg(F.max("n_labels")).first()[0] or 0  # one number
    spelled = land(
        named.select("host", "path").distinct().withColumn("labels", _labels("host"))
        .withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(1, most))))))
        .select("host", "path", _key(F.slice("labels", F.lit(1), F.col("n")), "path").alias("key")),
        "url-keys",
    )
    found = _sweep(spelled.select("key").distinct(), given)
    best = (
        spelled.join(found, "key")
        .groupBy("host", "path")
        .agg(F.max_by("top", F.struct("top.reach", "top.host_reach")).alias("top"))
    )
    return named.join(best, ["host", "path"], "left").select(
        *[named[c] for c in kept],
        "host",
        "path",
        F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )
