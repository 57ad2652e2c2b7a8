"""URL filters over time: dated list entries become validity intervals, and every capture is judged by the entries
active when it was fetched. DataFrame functions only.

An entry (list_name, pattern, action, day) adds a pattern to a list or removes it, from that day on. A pattern is a
host, which also covers its subdomains, or a host with a path prefix. The entries of one (list, pattern), in order of
days, become intervals [from, until). Each capture offers the patterns that could cover it as join keys: the suffixes
of its host and, for its host, the prefixes of its path that end at a slash, of the depths that occur in the lists. The as-of join is an equality join on the
pattern and the calendar month with a check of the interval: intervals are exploded over the months they touch, so the
captures of a hot host are dealt over months, and the rows of both sides stay in proportion to the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, store

FOREVER = "9999-12-31"


def url_host(url: Column) -> Column:
    """Host in lower case without port, user and trailing dot; null for anything but http and https."""
    found = F.regexp_extract(F.lower(url), r"^https?://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.rtrim(found, F.lit(".")), F.lit(""))


def url_path(url: Column) -> Column:
    """Path from its first slash, without query and fragment; '/' where there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*(/[^?#]*)", 1)
    return F.when(found == "", F.lit("/")).otherwise(found)


def labels_of(pattern: Column) -> Column:
    """Number of labels of a host pattern; null for a pattern with a path."""
    return F.when(~pattern.contains("/"), F.size(F.split(pattern, r"\.")))


def slashes_of(pattern: Column) -> Column:
    """Number of slashes of a pattern with a path; null for a host."""
    n = F.length(pattern) - F.length(F.replace(pattern, F.lit("/")))
    return F.when(n > 0, n)


def patterns(host: Column, path: Column, labels: list[int], slashes: list[int]) -> Column:
    """The patterns that could cover a capture: host suffixes of the given numbers of labels, and host with the path prefixes
    that end at the given slashes. Only depths that occur in the lists are asked for, so a long url offers no more than
    a short one."""
    parts, steps = F.split(host, r"\."), F.split(path, "/")
    suffix = lambda p, n: F.when(F.size(p) >= n, F.array_join(F.slice(p, F.size(p) - n + 1, n), "."))
    prefix = lambda s, n: F.when(F.size(s) > n, F.concat(host, F.array_join(F.slice(s, F.lit(1), n), "/"), F.lit("/")))
    none = F.array().cast("array<string>")
    # the parts are cut once a row and bound to the lambdas
    of_host = F.flatten(F.transform(F.array(parts), lambda p: F.transform(F.array(*map(F.lit, labels)), lambda n: suffix(p, n)))) if labels else none
    of_path = F.flatten(F.transform(F.array(steps), lambda s: F.transform(F.array(*map(F.lit, slashes)), lambda n: prefix(s, n)))) if slashes else none
    return F.array_distinct(F.filter(F.concat(of_host, of_path), lambda x: x.isNotNull()))


def intervals(entries: DataFrame) -> DataFrame:
    """(list_name, pattern, valid_from, valid_until) from dated entries (list_name, pattern, action, day).

    Of the entries of one day the removal counts last. An entry without list, pattern or day, or with an action other
    than add and remove, is ignored; adding what is active, or removing what is not, changes nothing."""
    usable = entries.select("list_name", "pattern", "action", F.col("day").cast("date").alias("day")).where(
        "list_name is not null and pattern is not null and day is not null and action in ('add', 'remove')")
    # one row a day: the entries of a pattern that meet in the window are at most its days
    days = usable.groupBy("list_name", "pattern", "day").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list_name", "pattern").orderBy("day")
    turns = (days.withColumn("was", F.lag("action", 1, "remove").over(order)).where("action <> was")
             .withColumn("valid_until", F.coalesce(F.lead("day").over(order), F.to_date(F.lit(FOREVER)))))
    return turns.where("action = 'add'").select("list_name", "pattern", F.col("day").alias("valid_from"), "valid_until")


def judge(captures: DataFrame, entries: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, host, fetched, lists, n_entries, kept) for each row of ``captures`` (key, url, fetched): the sorted names
    of the lists with an entry that covers the url and is active on the day ``fetched``, the number of such entries,
    and whether there is none.

    A url that is null, empty or not http, and a capture without day, is covered by nothing and kept, with a null host
    in the first case; a url may be of any length. Rows that tie in key, url and day are judged alike, once each; a null key is a key. Other
    columns are ignored. Empty captures give an empty result; without entries all are kept."""
    rows = captures.select(F.col(key), "url", F.col("fetched").cast("date").alias("fetched"))
    host = url_host(F.col("url"))
    # Each distinct (host, path) is matched once a day, so repeated captures do not multiply the join.
    rows = rows.withColumn("host", host).withColumn("path", F.when(F.col("host").isNotNull(), url_path(F.col("url"))))
    valid = intervals(entries)
    lo, hi = (F.lit(d).cast("date") for d in rows.agg(F.min("fetched"), F.max("fetched")).first())
    months = F.sequence(F.trunc(F.greatest("valid_from", lo), "month"), F.trunc(F.least("valid_until", hi), "month"),
                        F.expr("interval 1 month"))
    dated = store(valid.where((F.col("valid_from") <= hi) & (F.col("valid_until") > lo))
             .withColumn("month", F.explode(months)).select("list_name", "pattern", "valid_from", "valid_until", "month"), "url-lists")
    asked = rows.where("host is not null and fetched is not null").select("host", "path", "fetched").distinct()
    # one number for each depth that occurs in the lists
    depths = lambda c: sorted(r[0] for r in dated.select(c.alias("n")).where("n is not null").distinct().collect())
    pattern = F.col("pattern")
    probes = (asked.withColumn("pattern", F.explode(patterns(F.col("host"), F.col("path"), depths(labels_of(pattern)), depths(slashes_of(pattern)))))
              .withColumn("month", F.trunc("fetched", "month")))
    if dated.count() <= BROADCAST_IDS // 10:  # about 100 bytes a row
        dated = F.broadcast(dated)
    active = (probes.join(dated, ["pattern", "month"]).where("valid_from <= fetched and fetched < valid_until")
              .groupBy("host", "path", "fetched")
              .agg(F.array_join(F.array_sort(F.collect_set("list_name")), ",").alias("lists"),
                   F.count("*").alias("n_entries")))
    return (rows.join(active, ["host", "path", "fetched"], "left")
            .select(F.col(key), "host", "fetched", F.coalesce("lists", F.lit("")).alias("lists"),
                    F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
                    F.col("n_entries").isNull().alias("kept")))


# ------------------------------------------------- lists and days from the tables

def table_captures(pages: DataFrame) -> DataFrame:
    """``pages`` with a fetch day: page_id counts through the days of 2024 in steps of 7."""
    return pages.select("page_id", "url", F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("page_id") * 7 % 366).cast("int"))
                        .alias("fetched"))


def table_entries(pages: DataFrame) -> DataFrame:
    """Dated entries that Spark derives from the urls of ``pages``: hosts by the number of their captures go on and off
    the list 'spam', second-level names with few hosts on 'parked', and first path parts on 'section'."""
    host = url_host(F.col("url"))
    hosts = (pages.select(host.alias("host"), "page_id").where("host is not null").groupBy("host")
             .agg(F.count("*").alias("n"), F.min("page_id").alias("first")))
    day = lambda c: F.date_add(F.to_date(F.lit("2024-01-01")), c.cast("int"))
    entry = lambda df, name, pattern, action, d: df.select(
        F.lit(name).alias("list_name"), pattern.alias("pattern"), F.lit(action).alias("action"), day(d).alias("day"))
    n, first = F.col("n"), F.col("first")
    spam = hosts.where("first % 3 = 0")
    out = entry(spam, "spam", F.col("host"), "add", n * 11 % 300)
    out = out.unionByName(entry(spam.where("first % 2 = 0"), "spam", F.col("host"), "remove", n * 11 % 300 + first % 60 + 1))
    out = out.unionByName(entry(spam.where("first % 4 = 0"), "spam", F.col("host"), "add", n * 11 % 300 + first % 60 + 30))
    second = (hosts.withColumn("name", F.substring_index("host", ".", -3)).where("size(split(host, '[.]')) > 2")
              .groupBy("name").agg(F.count("*").alias("n"), F.min("first").alias("first")).where("n <= 2"))
    out = out.unionByName(entry(second, "parked", F.col("name"), "add", first % 200))
    out = out.unionByName(entry(second.where("first % 5 = 0"), "parked", F.col("name"), "remove", first % 200 + 90))
    part = F.regexp_extract("url", r"^https?://[^/?#]*/([^/?#]+)/", 1)
    sections = (pages.select(host.alias("host"), part.alias("part"), "page_id").where("host is not null and part <> ''")
                .groupBy("host", "part").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("first % 4 = 1"))
    return out.unionByName(entry(sections, "section", F.concat("host", F.lit("/"), "part", F.lit("/")), "add", n * 5 % 250))


#: DuckDB SQL of judge(table_captures(pages), table_entries(pages)).
SQL = r"""
WITH base AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7 % 366 AS INTEGER) AS fetched,
         nullif(rtrim(regexp_extract(lower(url), '^https?://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.'), '') AS host,
         regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^?#]*)', 1) AS raw_path FROM pages),
rows_ AS (SELECT *, CASE WHEN host IS NULL THEN NULL WHEN raw_path = '' THEN '/' ELSE raw_path END AS path FROM base),
hosts AS (SELECT host, count(*) AS n, min(page_id) AS first FROM rows_ WHERE host IS NOT NULL GROUP BY host),
second AS (SELECT name, count(*) AS n, min(first) AS first FROM (
    SELECT array_to_string(string_split(host, '.')[-3:], '.') AS name, first FROM hosts WHERE len(string_split(host, '.')) > 2)
  GROUP BY name HAVING count(*) <= 2),
sections AS (SELECT host, part, count(*) AS n, min(page_id) AS first FROM (
    SELECT host, page_id, regexp_extract(url, '^https?://[^/?#]*/([^/?#]+)/', 1) AS part FROM rows_ WHERE host IS NOT NULL)
  WHERE part <> '' GROUP BY host, part HAVING min(page_id) % 4 = 1),
entries AS (
  SELECT 'spam' AS list_name, host AS pattern, 'add' AS action, n * 11 % 300 AS d FROM hosts WHERE first % 3 = 0
  UNION ALL SELECT 'spam', host, 'remove', n * 11 % 300 + first % 60 + 1 FROM hosts WHERE first % 3 = 0 AND first % 2 = 0
  UNION ALL SELECT 'spam', host, 'add', n * 11 % 300 + first % 60 + 30 FROM hosts WHERE first % 3 = 0 AND first % 4 = 0
  UNION ALL SELECT 'parked', name, 'add', first % 200 FROM second
  UNION ALL SELECT 'parked', name, 'remove', first % 200 + 90 FROM second WHERE first % 5 = 0
  UNION ALL SELECT 'section', concat(host, '/', part, '/'), 'add', n * 5 % 250 FROM sections),
days AS (SELECT list_name, pattern, DATE '2024-01-01' + CAST(d AS INTEGER) AS day, max(action) AS action
         FROM entries GROUP BY ALL),
states AS (SELECT list_name, pattern, action, day AS valid_from,
    coalesce(lead(day) OVER (PARTITION BY list_name, pattern ORDER BY day), DATE '9999-12-31') AS valid_until FROM days),
active AS (
  SELECT DISTINCT r.host, r.path, r.fetched, s.list_name, s.pattern FROM (SELECT DISTINCT host, path, fetched FROM rows_) r
  JOIN states s ON s.action = 'add' AND s.valid_from <= r.fetched AND r.fetched < s.valid_until
   AND split_part(s.pattern, '/', 1) = CASE WHEN contains(s.pattern, '/') THEN r.host ELSE split_part(s.pattern, '/', 1) END
   AND CASE WHEN contains(s.pattern, '/') THEN starts_with(concat(r.host, r.path), s.pattern)
            ELSE ends_with(concat('.', r.host), concat('.', s.pattern)) END),
summed AS (SELECT host, path, fetched, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS lists, count(*) AS n_entries
           FROM active GROUP BY ALL)
SELECT page_id, r.host AS host, r.fetched AS fetched, coalesce(lists, '') AS lists, coalesce(n_entries, 0) AS n_entries,
       n_entries IS NULL AS kept
FROM rows_ r LEFT JOIN summed s ON r.host = s.host AND r.path = s.path AND r.fetched = s.fetched
"""
