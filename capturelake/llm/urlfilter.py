"""URL filters by dated lists: a temporal join of captures with validity intervals.

Method. A list has dated entries (pattern, action, at): from ``at`` on the pattern is
``block``-ed, ``allow``-ed or ``lift``-ed. A pattern is a host (``example.com``, which also
covers its subdomains) or a host with a path prefix (``example.com/ads``, which covers the
path itself and paths below it). The entries of a pattern become disjoint validity intervals
[at, next at). A capture has one key for each suffix of its host and each prefix of its path;
each key meets the intervals of its pattern, and the one that holds at fetch time counts: an
as-of join. Of the entries active for one capture the most specific decides, that with the
longest host, then the longest path; if none is active the capture is allowed.

A pattern's intervals are one sorted array, so a key joins at most one row and a hot host
makes no more rows than captures have keys. The intervals are written once. Lists of at most
``SMALL`` patterns are broadcast; longer ones are joined by shuffled keys, where captures are
first reduced to the distinct (key, fetch time) and every key is dealt to ``SALTS`` tasks by
its times, so that a hot host or ``com`` is not one task. A capture has keys only as deep as
some pattern is, so long urls cost no more.

Cases. Entries with a null or empty pattern, an unknown action or a null date are left out.
Entries of one pattern at one time: block wins over allow, allow over lift. Captures with a
null url or without a host, or with a null time, match nothing and are allowed. Repeated
captures are judged alike. Extra columns are ignored; empty tables give empty results or
allow everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capturelake.scratch import Scratch

SMALL = 50_000
SALTS = 32


def host(url: Column) -> Column:
    """The lower-case host of a url, null if there is none."""
    h = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(h, r"\.$", ""), F.lit(""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def _parts(of_path: Column) -> Column:
    return F.filter(F.split(of_path, "/"), lambda x: x != "")


def keys(url: Column, most_labels: int, most_parts: int, least_labels: int = 1) -> Column:
    """Patterns of so many labels and at most so many path parts that cover a url: array<struct<key, host_length, path_length>>."""
    labels = F.split(host(url), r"\.")
    labels = F.slice(labels, F.greatest(F.size(labels) - most_labels + 1, F.lit(1)), most_labels)
    parts = F.slice(_parts(path(url)), 1, most_parts)
    fewest = F.size(labels) - least_labels + 1
    hosts = F.when(fewest > 0, F.transform(F.sequence(F.lit(1), F.greatest(fewest, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).otherwise(F.array().cast("array<string>"))
    paths = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.when(i == 0, "").otherwise(F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    every = F.flatten(
        F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(F.concat(h, p).alias("key"), F.length(h).alias("host_length"), F.length(p).alias("path_length"))))
    )
    return F.when(host(url).isNotNull(), every)


def intervals(entries: DataFrame) -> DataFrame:
    """(key, spans): for each pattern its intervals, sorted: array<struct<since, until, action>>."""
    strength = F.expr("case action when 'block' then 2 when 'allow' then 1 when 'lift' then 0 end")
    rows = entries.select(F.regexp_replace(F.lower(F.trim("pattern")), "/+$", "").alias("key"), "action", F.col("at").cast("timestamp_ntz").alias("since"))
    rows = rows.withColumn("strength", strength).where("key <> '' and since is not null and strength is not null")
    rows = rows.groupBy("key", "since").agg(F.max_by("action", "strength").alias("action"))
    rows = rows.withColumn("until", F.lead("since").over(Window.partitionBy("key").orderBy("since")))
    return rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("since", "until", "action"))).alias("spans"))


def _active(spans: Column, at: Column) -> Column:
    held = F.filter(spans, lambda s: (s["since"] <= at) & (s["until"].isNull() | (at < s["until"])))
    return F.get(held, F.lit(0))


def judge(captures: DataFrame, entries: DataFrame, id_col="page_id", url_col="url", time_col="fetched_at") -> DataFrame:
    """(id, blocked, pattern, since) for every capture; pattern and since of the entry that decides, if any."""
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).cast("timestamp_ntz").alias("at"))
    spans = Scratch(captures.sparkSession, "urlfilter").save(intervals(entries), "spans")
    labels = F.size(F.split(F.substring_index("key", "/", 1), r"\."))
    # keys that the list can't have, as a top domain alone, are made of no capture, so that they are no hot key of the join
    n, most_labels, least_labels, most_parts = spans.agg(F.count("*"), F.coalesce(F.max(labels), F.lit(1)), F.coalesce(F.min(labels), F.lit(1)), F.coalesce(F.max(F.size(_parts(F.col("key"))) - 1), F.lit(0))).first()
    # one row for each distinct url and time carries the keys
    wanted = rows.where("url is not null and at is not null").select("url", "at").distinct()
    wanted = wanted.select("url", "at", F.explode(keys(F.col("url"), max(most_labels, 1), max(most_parts, 0), max(least_labels, 1))).alias("k")).select("url", "at", "k.*")
    if n <= SMALL:
        met = wanted.join(F.broadcast(spans), "key").select("url", "at", "key", "host_length", "path_length", _active(F.col("spans"), F.col("at")).alias("span"))
    else:
        salted = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        asked = wanted.select("key", "at", F.pmod(F.xxhash64("at"), F.lit(SALTS)).cast("int").alias("salt")).distinct()
        found = asked.join(salted, ["key", "salt"]).select("key", "at", _active(F.col("spans"), F.col("at")).alias("span")).where("span is not null")
        met = wanted.join(found, ["key", "at"])
    met = met.where("span.action in ('block', 'allow')")
    best = met.groupBy("url", "at").agg(F.max_by(F.struct("key", "span"), F.struct("host_length", "path_length")).alias("best"))
    out = rows.join(best, ["url", "at"], "left")
    return out.select("id", F.coalesce(F.col("best.span.action") == "block", F.lit(False)).alias("blocked"), F.col("best.key").alias("pattern"), F.col("best.span.since").alias("since"))


def dated_list(pages: DataFrame) -> DataFrame:
    """The list of op7's query: hosts and first path parts of the pages, chosen and dated by digests.

    pages has neither fetch times nor a list, so both follow from page_id and url by a rule that SQL can repeat.
    """
    h, first = host(F.col("url")), F.regexp_extract(F.col("url"), r"^[a-z]+://[^/?#]*(/[^/?#]+)", 1)
    domain = F.regexp_extract(h, r"([^.]+\.[^.]+)$", 1)
    every = pages.select(F.explode(F.array(h, F.concat(h, first), domain)).alias("pattern")).where("pattern is not null and pattern <> ''").distinct()
    digit = lambda i: F.conv(F.substr(F.md5("pattern"), F.lit(i), F.lit(2)), 16, 10).cast("int")
    day = lambda n: F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(days=n)
    dated = lambda action, n: F.struct(action.alias("action"), day(n).alias("at"))
    first = dated(F.when(digit(3) % 3 == 0, "allow").otherwise("block"), digit(5))
    again = F.when(digit(9) % 2 == 0, dated(F.lit("block"), digit(5) + 100))
    chosen = every.where(digit(1) % 4 == 0).select("pattern", F.explode(F.array(first, dated(F.lit("lift"), digit(5) + 1 + digit(7) % 60), again)).alias("x"))
    return chosen.where("x is not null").select("pattern", "x.action", "x.at")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(days=(F.col("page_id") * 37 % 366).cast("int"))
    out = judge(pages.select("page_id", "url", at.alias("fetched_at")), dated_list(pages.select("url")))
    return out.select(F.col("id").alias("page_id"), "blocked", "pattern", "since")


OP7_SQL = r"""
with p as (
  select page_id, url, timestamp '2024-01-01' + to_days(cast(page_id * 37 % 366 as integer)) as fetched,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path
  from pages
), c as (
  select distinct pattern from (
    select host as pattern from p
    union all select host || regexp_extract(url, '^[a-z]+://[^/?#]*(/[^/?#]+)', 1) from p
    union all select regexp_extract(host, '([^.]+\.[^.]+)$', 1) from p)
  where pattern is not null and pattern <> ''
), d as (
  select pattern, list_transform([1, 3, 5, 7, 9], lambda i: ('0x' || substr(md5(pattern), i, 2))::integer) as g from c
), l as (
  select pattern, case when g[2] % 3 = 0 then 'allow' else 'block' end as action, g[3] as day from d where g[1] % 4 = 0
  union all select pattern, 'lift', g[3] + 1 + g[4] % 60 from d where g[1] % 4 = 0
  union all select pattern, 'block', g[3] + 100 from d where g[1] % 4 = 0 and g[5] % 2 = 0
), e as (
  select lower(pattern) as key, timestamp '2024-01-01' + to_days(cast(day as integer)) as since,
         max_by(action, case action when 'block' then 2 when 'allow' then 1 else 0 end) as action
  from l group by all
), s as (
  select key, since, action, lead(since) over (partition by key order by since) as until from e
), h as (
  select page_id, fetched, path, array_to_string(list_slice(labels, i, len(labels)), '.') as h
  from (select page_id, fetched, path, string_split(host, '.') as labels, unnest(generate_series(1, len(string_split(host, '.')))) as i from p where host <> '')
), k as (
  select page_id, fetched, h, case when j = 0 then '' else '/' || array_to_string(list_slice(parts, 1, j), '/') end as pre
  from (select *, unnest(generate_series(0, len(parts))) as j from (select *, list_filter(string_split(path, '/'), lambda x: x <> '') as parts from h))
), m as (
  select page_id, key, action, since,
         row_number() over (partition by page_id order by length(h) desc, length(pre) desc) as r
  from k join s on s.key = h || pre and since <= fetched and (until is null or fetched < until) and action in ('block', 'allow')
)
select p.page_id, coalesce(action = 'block', false) as blocked, key as pattern, since
from p left join m on p.page_id = m.page_id and r = 1
"""
