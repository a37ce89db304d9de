"""URL filters by dated lists, in DataFrame operations only.

List entries are dated events (add, remove) and become validity intervals; an
as-of join evaluates each capture against the entries active on its day.

1. A capture's URL yields its keys, most specific first: exact URL, path
   prefixes, host, parent domains.
2. Distinct (key, day) pairs are built before anything is shuffled by key, so a
   host with a third of all captures is at most one row per day.
3. The as-of join puts probes and intervals into one ordered window per list
   and key and carries the last interval forward: linear however often an entry
   was listed and taken off again, and no range join.
4. The most specific active entry decides for the (URL, day), an allowing list
   wins a tie, and captures take the decision by an equi-join, whose hot keys
   the skew join splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.batches import col

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
RANK = {"url": 3, "prefix": 2, "host": 1, "domain": 0}


def host_of(url: Column) -> Column:
    """Lower-cased host without a leading www. or a final dot; empty without a scheme."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"^www\.|\.$", "")


def keys_of(url: Column) -> Column:
    """Array of (kind, pattern) that can match the URL.

    ``url``: the whole URL up to the fragment; ``prefix``: host and leading path
    segments; ``host``: the host; ``domain``: the host and each parent of at
    least two labels.
    """
    host = host_of(url)
    labels = F.split(host, r"\.")
    segments = F.array_remove(F.split(F.regexp_extract(url, PATH, 1), "/"), "")
    key = lambda kind, pattern: F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: key("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.when(F.size(segments) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(segments), F.lit(1))),
        lambda i: key("prefix", F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/"))))).otherwise(
        F.array().cast("array<struct<kind:string,pattern:string>>"))
    whole = F.array(key("url", F.regexp_replace(url, "#.*$", "")), key("host", host))
    return F.when(url.isNotNull() & (host != ""), F.concat(whole, prefixes, domains)).otherwise(
        F.array().cast("array<struct<kind:string,pattern:string>>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, verdict, kind, pattern, valid_from, valid_to): one interval per ``add`` up to the entry's next event.

    Entries are (list, verdict, kind, pattern, action, effective), effective a
    time (a date is its first moment); several events of one entry at one time count as one, and a removal wins.  Events
    with a null among list, kind, pattern, action or effective are passed over.
    valid_to is null while the entry is still listed.
    """
    entry = ["list", "kind", "pattern"]
    times = (entries.filter(" and ".join(f"{c} is not null" for c in [*entry, "action", "effective"]))
             .groupBy(*entry, F.col("effective").cast("timestamp_ntz").alias("at"))
             .agg(F.max(F.col("action") == "remove").alias("removed"), F.max("verdict").alias("verdict")))
    following = F.lead("at").over(Window.partitionBy(*entry).orderBy("at"))
    return (times.withColumn("valid_to", following).filter("not removed")
            .select(*entry, "verdict", F.col("at").alias("valid_from"), "valid_to"))


def active_at(probes: DataFrame, valid: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """The probes (list, kind, pattern, at) at whose time their entry is listed, with its verdict: an as-of join.

    Probes and intervals meet in one ordered window for each entry and time bucket, so an entry asked by a
    large part of all captures spreads over its buckets; a row for each entry and
    bucket carries the last interval begun before it.
    """
    entry = ["list", "kind", "pattern"]
    held = F.struct("verdict", F.col("valid_to").alias("to"))
    opened = valid.select(*entry, F.col("valid_from").alias("at"), F.lit(0).alias("probe"), held.alias("v"))
    nothing = F.lit(None).cast(opened.schema["v"].dataType)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    bucket = F.floor(F.timestamp_diff("SECOND", epoch, F.col("at")) / bucket_seconds)
    both = probes.select(*entry, "at", F.lit(1).alias("probe"), nothing.alias("v")).union(opened).withColumn("bucket", bucket)
    earlier = Window.partitionBy(*entry).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (both.groupBy(*entry, "bucket").agg(F.max_by("v", F.when(F.col("probe") == 0, F.col("at"))).alias("last"))
               .withColumn("v", F.last("last", ignorenulls=True).over(earlier)).filter("v is not null")
               .select(*entry, F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(-1).alias("probe"), "v", "bucket"))
    latest = F.last("v", ignorenulls=True).over(Window.partitionBy(*entry, "bucket").orderBy(F.asc_nulls_first("at"), "probe"))
    return (both.union(carried).withColumn("v", latest).filter("probe = 1 and v is not null and (v.to is null or at < v.to)")
            .select(*entry, "at", "v.verdict"))


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched",
             id_col: str = "page_id", bucket_seconds: int = 3600) -> DataFrame:
    """(id, url, time, verdict, list, kind, pattern, n_active) for every capture.

    An entry is active from the moment its listing takes effect up to, not at, its removal.  verdict: that of the deciding entry ('allow' or 'block'), 'none' without an
    active entry.  The most specific entry decides (url, then longest prefix,
    host, longest domain); 'allow' wins a tie, then the list's name.  n_active
    counts the active entries that match.  A null or malformed URL and a null
    time match nothing; a date is its first moment; repeated captures give a row each; empty captures or
    entries give no rows, or 'none' throughout; other columns are not read.
    """
    valid = intervals(entries)
    asked = captures.select(col(id_col).alias("id"), col(url_col).cast("string").alias("url"), col(time_col).alias("time"),
                            col(time_col).cast("timestamp_ntz").alias("at"))
    keyed = asked.select("url", "at").filter("at is not null").distinct().select("url", "at", F.explode(keys_of(F.col("url"))).alias("k")) \
        .select("url", "at", "k.kind", "k.pattern")

    listed = valid.select("list", "kind", "pattern").distinct()
    probes = keyed.select("kind", "pattern", "at").distinct().join(listed, ["kind", "pattern"])
    active = active_at(probes, valid, bucket_seconds)

    rank = F.create_map(*[F.lit(x) for kv in RANK.items() for x in kv])[F.col("kind")]
    order = F.struct(rank.alias("rank"), F.length("pattern").alias("size"), (F.col("verdict") == "allow").alias("allow"))
    picked = (keyed.join(active, ["kind", "pattern", "at"])
              .select("url", "at", order.alias("o"), F.struct("verdict", "list", "kind", "pattern").alias("e"))
              .groupBy("url", "at", "o").agg(F.min("e").alias("e"), F.count("*").alias("n"))
              .groupBy("url", "at").agg(F.max(F.struct("o", "e")).alias("best"), F.sum("n").alias("n_active")))
    got = picked.select(F.col("url").alias("u"), F.col("at").alias("d"), "best.e.*", "n_active")
    return (asked.join(got, (F.col("url") == F.col("u")) & (F.col("at") == F.col("d")), "left")
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("time").alias(time_col),
                    F.coalesce("verdict", F.lit("none")).alias("verdict"), "list", "kind", "pattern",
                    F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active")))
