"""Captures and dated list entries that Spark derives from ``pages``, and the same in SQL.

The tables name no fetch day and no list: the day follows from the page id, and the events
of a domain from the digits of its MD5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.url_lists import domains, host

_START = "DATE '2024-01-01'"


def captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.expr(f"date_add({_START}, CAST(pmod(page_id, 366) AS INT))").alias("fetched_on"))


def entries(pages: DataFrame) -> DataFrame:
    """One to three events for about half of all hosts and parent domains."""
    hosts = pages.select(host(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    names = hosts.select(F.explode(domains(F.col("host"))).alias("domain")).distinct()
    digits = F.md5(F.col("domain"))
    number = lambda at: F.conv(F.substring(digits, at, 2), 16, 10).cast("int")
    first = number(1)
    second = first + 1 + number(3)
    third = second + 1 + number(5)

    def event(action: str, day: Column) -> Column:
        return F.struct(F.lit(action).alias("action"), F.date_add(F.expr(_START), day).alias("listed_on"))

    events = F.slice(F.array(event("add", first), event("remove", second), event("add", third)), 1, F.lit(1) + number(7) % 3)
    which = F.when(number(9) % 2 == 0, "adult").otherwise("phishing")
    return names.where(number(11) % 2 == 0).select(which.alias("list"), "domain", F.inline(events))


ORACLE = """
WITH captures AS (
  SELECT page_id, url, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\\[[^\\]/?#]*\\]|[^/?#:\\[\\]]+)', 1), '\\.+$', ''), '') AS host,
         CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS fetched_on
  FROM pages),
suffixes AS (
  SELECT host, array_to_string(labels[i:], '.') AS domain
  FROM (SELECT host, labels, unnest(range(1, greatest(len(labels), 2))) AS i
        FROM (SELECT DISTINCT host, CASE WHEN regexp_matches(host, '^([0-9]+\\.){3}[0-9]+$|^\\[') THEN [host] ELSE string_split(host, '.') END AS labels
              FROM captures WHERE host IS NOT NULL))),
numbers AS (
  SELECT domain, [CAST('0x' || substr(md5(domain), i, 2) AS INTEGER) FOR i IN [1, 3, 5, 7, 9, 11]] AS d FROM (SELECT DISTINCT domain FROM suffixes)),
events AS (
  SELECT CASE WHEN d[5] % 2 = 0 THEN 'adult' ELSE 'phishing' END AS list, domain, unnest([0, 1, 2][:1 + d[4] % 3]) AS k,
         d[1] AS a, d[1] + 1 + d[2] AS b, d[1] + 2 + d[2] + d[3] AS c
  FROM numbers WHERE d[6] % 2 = 0),
intervals AS (
  SELECT *, lead(listed_on) OVER (PARTITION BY list, domain ORDER BY listed_on) AS valid_to
  FROM (SELECT list, domain, k, CAST(DATE '2024-01-01' + CASE k WHEN 0 THEN a WHEN 1 THEN b ELSE c END AS DATE) AS listed_on FROM events)),
active AS (
  SELECT c.host, c.fetched_on, i.list, i.domain AS entry, i.listed_on AS valid_from,
         row_number() OVER (PARTITION BY c.host, c.fetched_on ORDER BY length(i.domain) DESC, i.list, i.domain, i.listed_on) AS place,
         count(*) OVER (PARTITION BY c.host, c.fetched_on) AS n_active
  FROM (SELECT DISTINCT host, fetched_on FROM captures WHERE host IS NOT NULL AND fetched_on IS NOT NULL) c
  JOIN suffixes s USING (host)
  JOIN intervals i ON i.domain = s.domain AND i.k <> 1 AND c.fetched_on >= i.listed_on AND (i.valid_to IS NULL OR c.fetched_on < i.valid_to))
SELECT c.page_id, c.url, c.host, c.fetched_on, a.host IS NOT NULL AS blocked, coalesce(a.n_active, 0) AS n_active, a.entry, a.list, a.valid_from
FROM captures c LEFT JOIN active a ON a.host = c.host AND a.fetched_on = c.fetched_on AND a.place = 1
"""
