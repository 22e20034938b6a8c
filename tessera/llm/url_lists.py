"""Temporal list join: captures against the list entries active at fetch time.

A list is a history of dated entries: on some day a URL, a host or a domain
is added or removed. The entries of a key become validity intervals, and
each capture is joined as of its fetch day with the intervals of its keys: its
URL, its host and every domain above it.

A key's history is one row, an array of disjoint intervals in order (at most one for each
day), so the join with the captures is on equality alone and never multiplies
rows; a host that holds a large part of all captures is a skewed
partition of an inner side that Spark splits at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of keys, the most specific last.
KINDS = ("domain", "host", "url")
OPEN = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a trailing dot; empty if none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(F.regexp_replace(authority, "^.*@|:[0-9]*$", "")), r"\.$", "")


def url_key(url: Column) -> Column:
    """Host and path: no scheme, user, port, query or fragment."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(path))


def domains_of(host: Column) -> Column:
    """The host and every domain above it that has a dot, from the top down."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    above = F.transform(F.sequence(F.lit(2), n), lambda k: F.concat_ws(".", F.slice(parts, n - k + 1, k)))
    return F.when(n >= 2, above).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, key, spells array<struct<since date, until date>>) of entries
    (kind, key, day, added boolean), one row for each kind and key.

    A key is active from a day it is added to the day it is removed, exclusive.
    On a day with both, the removal counts. Repeated entries count
    once; an entry with a null in any of the four columns is left out.
    """
    known = entries.where("kind is not null and key is not null and day is not null and added is not null")
    daily = known.groupBy("kind", "key", "day").agg(F.min("added").alias("added"))
    # days of one key: at most one row each, however many entries a list has
    history = daily.groupBy("kind", "key").agg(F.array_sort(F.collect_list(F.struct("day", "added"))).alias("h"))
    nxt = lambda i: F.get("h", i + 1)
    last = lambda i: F.get("h", i - 1)
    # a run of adds is one interval: it starts where the entry before is no add and ends at the next removal
    starts = F.transform(F.filter(F.transform("h", lambda e, i: F.struct(e["day"].alias("day"), (e["added"] & ~F.coalesce(last(i)["added"], F.lit(False))).alias("on"))), lambda x: x["on"]), lambda x: x["day"])
    ends = F.transform(F.filter(F.transform("h", lambda e, i: F.struct(F.coalesce(nxt(i)["day"], F.lit(OPEN).cast("date")).alias("day"), (e["added"] & ~F.coalesce(nxt(i)["added"], F.lit(False))).alias("on"))), lambda x: x["on"]), lambda x: x["day"])
    spells = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("since"), b.alias("until")))
    return history.select("kind", "key", spells.alias("spells")).where(F.size("spells") > 0)


def evaluated(captures: DataFrame, lists: DataFrame, capture_id: str = "page_id", url: str = "url", day: str = "fetched_on") -> DataFrame:
    """One row per capture: its id and day, blocked, n_active, and kind, key and
    first day of the most specific entry active on its day (the longest of domains).

    A null or malformed URL has no host and matches nothing, as a null day does;
    repeated captures get a row each; other columns are not read. No captures
    give no rows, and without entries nothing is blocked. Rows are numbered in the
    order in which they are read, so ``captures`` has to come from files, not from a shuffle
    that a lost executor could repeat in another order.
    """
    link = F.col("__url")
    rows = captures.select(F.col(capture_id).alias("__id"), F.col(url).alias("__url"), F.col(day).cast("date").alias("__day"))
    rows = rows.select(F.monotonically_increasing_id().alias("__row"), "__id", "__day", "__url", host_of(link).alias("__host"))
    of = lambda kind, key: F.struct(F.lit(kind).cast("string").alias("kind"), key.alias("key"))
    keys = F.concat(F.array(of("url", url_key(link)), of("host", F.col("__host"))), F.transform(domains_of(F.col("__host")), lambda d: of("domain", d)))
    # matches nothing, as its kind is null; the row's number keeps rows without a host apart in the shuffle
    nowhere = of(None, F.col("__row").cast("string"))
    asked = rows.select("__row", "__id", "__day", F.explode(F.when(F.col("__host") != "", keys).otherwise(F.array(nowhere))).alias("k"))
    asked = asked.select("__row", "__id", "__day", F.col("k.kind").alias("kind"), F.col("k.key").alias("key"))
    found = asked.join(lists, ["kind", "key"], "left")
    spell = F.get(F.filter("spells", lambda s: (s["since"] <= F.col("__day")) & (F.col("__day") < s["until"])), F.lit(0))
    found = found.withColumn("spell", spell)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    hit = F.when(F.col("spell").isNotNull(), F.struct(rank.alias("rank"), F.length("key").alias("size"), "kind", "key", F.col("spell.since").alias("since")))
    best = found.groupBy("__row").agg(F.first("__id").alias("id"), F.first("__day").alias("day"), F.count("spell").alias("n"), F.max(hit).alias("best"))
    return best.select(
        F.col("id").alias(capture_id), F.col("day").alias(day), (F.col("n") > 0).alias("blocked"), F.col("n").alias("n_active"),
        F.col("best.kind").alias("matched_kind"), F.col("best.key").alias("matched_key"), F.col("best.since").alias("active_since"),
    )
