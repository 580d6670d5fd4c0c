"""URL filtering by dated lists: validity intervals and an as-of join, native Spark throughout (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import cut_lineage

#: Days of a bucket in which captures and intervals meet.
BUCKET = 64


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and a final dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//([^/?#\\]*)", 1)
    return F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@", "")), r"\.?(:[0-9]*)?$", "")


def path_of(url: Column) -> Column:
    """The path, empty if there is none."""
    return F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#\\]*([^?#]*)", 1)


def keys_of(url: Column, deepest: int = 64) -> Column:
    """What list entries may call a capture: its host and each parent domain, alone and with each prefix of the path.

    A prefix ends before a slash or with the path, has no slash at its end and has ``deepest`` parts at most.
    """
    host, path = host_of(url), path_of(url)
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(deepest + 1))), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    prefixes = F.filter(prefixes, lambda p: ~p.endswith("/"))
    return F.when(host != "", F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.concat(d, p)))))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals [``from_day``, ``to_day``) of dated list entries; ``to_day`` null: still valid.

    ``entries``: ``list``, ``key``, ``action`` (``add`` or ``remove``) and ``day`` (date). An entry is valid from
    an addition to the next removal; a second addition or removal in between changes nothing, and a day with both
    leaves the entry valid. Entries with a null or another action are left out; repeated rows count once.
    """
    rows = entries.filter("list is not null and key is not null and day is not null and action in ('add', 'remove')")
    days = rows.groupBy("list", "key", "day").agg(F.bool_or(F.col("action") == "add").alias("valid"))
    order = Window.partitionBy("list", "key").orderBy("day")
    turns = days.withColumn("was", F.coalesce(F.lag("valid").over(order), F.lit(False))).filter("valid <> was")
    return turns.withColumn("to_day", F.lead("day").over(order)).filter("valid").select("list", "key", F.col("day").alias("from_day"), "to_day")


def verdicts(captures: DataFrame, entries: DataFrame, allow: str = "allow", max_bytes: int = 1 << 25, url_col: str = "url", day_col: str = "day", id_col: str = "page_id") -> DataFrame:
    """Each capture judged by the list entries that were valid on the day of its fetch.

    ``captures`` has an id, a URL and a day. Rows: ``page_id``, ``url``, ``day``, ``copies`` (equal captures are
    judged once), ``n_active`` (valid entries that name the capture), ``matched_list`` and ``matched_key`` (the
    longest key that names it, at ties the list ``allow`` and then the last list by name; else null) and
    ``blocked``: whether that list is another than ``allow``.

    An entry's key is a host in lower case or a domain above it, and may go on with folders or a whole path:
    ``org``, ``h.org``, ``h.org/a`` and ``h.org/a/b`` all name ``http://www.h.org/a/b?q``. It names whole labels and
    whole parts of the path; slashes at its end don't count, and a key with a scheme, a port or a query names
    nothing.

    Intervals are dealt to the buckets of ``BUCKET`` days that they touch, up to the last capture's, so captures
    and intervals meet by key and bucket and then by day: a capture finds one interval of a list and key at most.
    Prefixes of a path go as deep as the deepest entry. Keys that no list has, such as most top domains, are dropped
    before that join, by a broadcast of the lists' keys while these have ``max_bytes`` at most; beyond that they are
    dropped in the join. A hot key makes one side of it skewed, which adaptive execution splits.

    Captures with a null URL or day, or no host, match nothing and are not blocked; no captures give no rows, and
    an empty list blocks nothing. Entries with a null or another action are left out, repeated ones count once.
    Further columns of either table are ignored, whatever their names.
    """
    seen = captures.groupBy(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(day_col).alias("day")).agg(F.count("*").alias("copies"))
    entries = entries.select("list", F.regexp_replace("key", "/+$", "").alias("key"), "action", "day")
    last = captures.agg(F.max(day_col)).first()[0]
    known = cut_lineage(entries.select(F.col("key").alias("known")).filter("known <> ''").distinct())
    deepest, size = known.agg(F.coalesce(F.max(F.size(F.split("known", "/")) - 1), F.lit(0)), F.coalesce(F.sum(F.octet_length("known") + 16), F.lit(0))).first()
    bucket = lambda day: F.floor(F.unix_date(day) / BUCKET)
    listed = intervals(entries)
    if last is not None:
        until = F.least(F.coalesce(F.date_sub("to_day", 1), F.lit(last)), F.lit(last))
        listed = listed.filter(F.col("from_day") <= F.lit(last)).withColumn("bucket", F.explode(F.sequence(bucket("from_day"), bucket(until))))
    else:
        listed = listed.withColumn("bucket", F.lit(0).cast("long")).limit(0)
    named = seen.filter("day is not null").select("page_id", "url", "day", F.explode(keys_of(F.col("url"), deepest)).alias("key"), bucket("day").alias("bucket"))
    if size <= max_bytes:
        named = named.join(F.broadcast(known), F.col("key") == F.col("known"), "left_semi")
    listed = listed.select("list", F.col("key").alias("entry"), "from_day", "to_day", F.col("bucket").alias("of"))
    valid = (F.col("day") >= F.col("from_day")) & (F.col("to_day").isNull() | (F.col("day") < F.col("to_day")))
    met = named.join(listed, (F.col("key") == F.col("entry")) & (F.col("bucket") == F.col("of")) & valid)
    rank = F.struct(F.length("entry").alias("size"), (F.col("list") == allow).alias("allows"), "list", F.col("entry").alias("key"))
    judged = met.groupBy(F.col("page_id").alias("of_page"), F.col("url").alias("of_url"), F.col("day").alias("of_day")).agg(F.count("*").alias("n_active"), F.max(rank).alias("top"))
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("url") == F.col("of_url")) & (F.col("day") == F.col("of_day"))
    found = seen.join(judged, same, "left")
    return found.select("page_id", "url", "day", "copies", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("top.list").alias("matched_list"), F.col("top.key").alias("matched_key"), F.coalesce(F.col("top.list") != allow, F.lit(False)).alias("blocked"))
