"""URL filters as a sort-merge range join. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.sources.scratch import Scratch

# Verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DEFAULT = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    there = F.contains(url, F.lit("://"))
    rest = F.substr(url, F.locate("://", url) + 3)
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return (
        F.when(there, F.translate(host, upper, lower)).otherwise(""),
        F.when(there, path).otherwise(""),
    )


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot.

    A host and its subdomains are exactly the keys that begin with the host's key, which is the
    interval from the key up to the same text with a slash (the character after the dot) as its
    last character.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_boundaries(rules: DataFrame) -> DataFrame:
    """Where the stack of active rules changes: key, and the stack from there on.

    ``rules`` has verdict, host and path. Intervals of hosts nest or are apart, so the stack
    after an interval opens is its host's and all enclosing hosts' rules, and after it closes the
    enclosing hosts' alone.
    """
    rules = rules.select(
        host_key(F.col("host")).alias("key"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            "path",
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("entry"),
    ).distinct()
    labels = F.split(F.rtrim("key", F.lit(".")), r"\.", -1)
    hosts = rules.select("key").distinct()
    around = hosts.withColumn("labels", labels).select(
        "key",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("labels")),
                lambda n: F.concat(F.array_join(F.slice("labels", 1, n), "."), F.lit(".")),
            )
        ).alias("outer"),
    )
    chains = (
        around.join(rules.withColumnRenamed("key", "outer"), "outer")
        .groupBy("key")
        .agg(
            F.collect_list("entry").alias("opened"),
            F.collect_list(F.when(F.col("outer") != F.col("key"), F.col("entry"))).alias("closed"),
        )
    )
    closing = F.concat(F.substr("key", F.lit(1), F.length("key") - 1), F.lit("/"))
    return chains.select(
        F.explode(
            F.array(
                F.struct(F.col("key"), F.col("opened").alias("stack")),
                F.struct(closing.alias("key"), F.col("closed").alias("stack")),
            )
        ).alias("x")
    ).select("x.key", "x.stack")


def judge_urls(
    pages: DataFrame,
    scratch: Scratch,
    rules: Sequence[tuple[str, str, str]] | DataFrame = RULES,
    default: str = DEFAULT,
) -> DataFrame:
    """page_id, host, path, the rule that decides, and its verdict.

    Urls and interval bounds are sorted together by reversed host, in ranges of about equal size
    (path and id break ties, so a host with a third of all urls is spread over many ranges). A
    sweep over each range carries the stack of active rules along; what is open at the start of
    a range comes from the ranges before it, of which there are as many as shuffle partitions.
    Among the stack's rules whose path begins the url's, the longest wins, then the one with the
    longer host.

    Needs page_id and url. A null url or one without ``://`` has an empty host and path, no
    rule, and the default verdict. Repeated rows are judged one by one.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    host, path = split_url(F.coalesce("url", F.lit("")))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    bounds = rule_boundaries(rules)
    events = urls.select(
        host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path"
    ).unionByName(
        bounds.select("key", F.lit(0).alias("kind"), "stack"), allowMissingColumns=True
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = scratch.save(
        "url_ranges",
        events.repartitionByRange(ranges, "key", "kind", "path", "page_id").withColumn(
            "range", F.spark_partition_id()
        ),
    )

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy("range")
        .agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
        .select("range", F.last("last", ignorenulls=True).over(before).alias("carried"))
    )
    sweep = (
        Window.partitionBy("range")
        .orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    active = F.coalesce(F.last("stack", ignorenulls=True).over(sweep), "carried")
    # One row per range, so this broadcast is bounded by the number of shuffle partitions.
    swept = ranged.join(F.broadcast(carried), "range").withColumn("active", active)
    fitting = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    winner = F.array_max(fitting)
    return swept.filter("kind = 1").select(
        "page_id",
        "host",
        "path",
        winner["rule"].alias("rule"),
        F.coalesce(winner["verdict"], F.lit(default)).alias("verdict"),
    )
