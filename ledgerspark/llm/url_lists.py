"""URL filters: temporal join of captures with dated domain lists. DataFrame functions only.

Dated list entries (``add`` or ``remove`` of a domain) become validity intervals, each from
one event to the next of the same list and domain. A capture is evaluated against the
entries of its host and every parent domain that are active on the day of its fetch. The
as-of join meets intervals by (domain, month), so neither a host with very many captures nor
a domain with a long history comes together in one task, and each distinct (host, day) is
evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.llm.shared import store

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[\]]+)"
# Hosts that are addresses: four numbers, or an address in brackets. They have no parents.
_ADDRESS = r"^([0-9]+\.){3}[0-9]+$|^\["


def host(url: Column) -> Column:
    """Lower-case host of a URL without a last dot; null if there is none."""
    found = F.regexp_extract(F.lower(url), _HOST, 1)
    return F.nullif(F.regexp_replace(found, r"\.+$", ""), F.lit(""))


def domains(name: Column) -> Column:
    """A host and its parent domains of two labels or more; the host alone if it has one or is
    an address."""
    labels = F.when(F.rlike(name, F.lit(_ADDRESS)), F.array(name)).otherwise(F.split(name, r"\."))
    count = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, count), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``list``, ``domain``, ``valid_from`` and ``valid_to`` (exclusive, null if open).

    ``entries``: ``list``, ``domain``, ``action`` and ``listed_on``. Of several events of one
    day an ``add`` counts. Entries with a null in any of these, or another action, are void.
    """
    known = entries.where(F.col("list").isNotNull() & F.col("domain").isNotNull() & F.col("listed_on").isNotNull() & F.col("action").isin("add", "remove"))
    days = known.groupBy("list", F.lower("domain").alias("domain"), "listed_on").agg(F.min("action").alias("action"))
    order = Window.partitionBy("list", "domain").orderBy("listed_on")
    return (
        days.withColumn("valid_to", F.lead("listed_on").over(order))
        .where("action = 'add'")
        .select("list", "domain", F.col("listed_on").alias("valid_from"), "valid_to")
    )


def evaluated(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per capture: ``page_id``, ``url``, ``host``, ``fetched_on``, ``blocked``,
    ``n_active``, and of the most specific active entry (ties: first list by name, then the
    latest start) ``entry``, ``list`` and ``valid_from``.

    ``captures``: ``page_id``, ``url`` and ``fetched_on``. A capture without a host or a day
    is not blocked. Repeated rows stay; other columns are ignored.
    """
    rows = captures.select("page_id", "url", "fetched_on", host(F.col("url")).alias("host"))
    keys = store(rows.select("host", "fetched_on").where("host IS NOT NULL AND fetched_on IS NOT NULL").distinct(), "keys")
    span = keys.agg(F.trunc(F.min("fetched_on"), "month").alias("first"), F.trunc(F.max("fetched_on"), "month").alias("last")).first()
    month = lambda day: F.trunc(day, "month")
    begin = F.greatest(month(F.col("valid_from")), F.lit(span["first"]).cast("date"))
    end = F.least(month(F.coalesce(F.date_sub("valid_to", 1), F.lit(span["last"]).cast("date"))), F.lit(span["last"]).cast("date"))
    months = F.when(begin <= end, F.sequence(begin, end, F.expr("INTERVAL 1 MONTH")))
    listed = store(intervals(entries).select("*", F.explode(months).alias("month")), "intervals")
    asked = keys.select("host", "fetched_on", F.explode(domains(F.col("host"))).alias("domain"), month(F.col("fetched_on")).alias("month"))
    active = (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    found = asked.join(listed, ["domain", "month"]).where(active)
    rank = F.struct((-F.length("domain")).alias("size"), F.col("list"), F.col("domain").alias("entry"), F.col("valid_from"))
    verdicts = store(found.groupBy("host", "fetched_on").agg(F.count("*").alias("n"), F.min(rank).alias("best")), "verdicts")
    joined = rows.join(verdicts, ["host", "fetched_on"], "left")
    return joined.select(
        *("page_id url host fetched_on".split()),
        F.col("n").isNotNull().alias("blocked"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
        F.col("best.entry").alias("entry"),
        F.col("best.list").alias("list"),
        F.col("best.valid_from").alias("valid_from"),
    )
