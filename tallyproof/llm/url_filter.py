"""URL filters by a temporal list join, with DataFrame functions only.

Dated list entries become validity intervals; every capture is judged by the entries that were
active on the day it was fetched. The longest matching domain wins; on one domain ``allow`` beats
``block``.

Defined results: a URL without a host (null, empty, no ``scheme://``) is not blocked. Several
actions of one list on one domain on one day count as ``remove`` if any of them is. Entries without
domain, date, list or a known action are ignored. Repeated captures are judged each by itself. Empty
lists block nothing. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyproof.llm.common import table, without

FIRST_DAY = "2024-01-01"
DAYS = 365
# Dated entries per domain in the adapter of the test tables.
ENTRIES = 4
VERDICT = ["host", "blocked", "matched_domain", "list", "valid_from", "valid_to"]


def host_of(url: Column) -> Column:
    """Lower-case host without user, port or final dots; null where there is none."""
    rest = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#\\]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, r"^.*@", ""), r":[0-9]*$", ""), r"\.+$", "")
    return F.when(host != "", host)


def suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def validity(entries: DataFrame) -> DataFrame:
    """Intervals [valid_from, valid_to) in which a list holds a domain; an open end is null."""
    state = (
        entries.where(F.col("action").isin("add", "remove") & F.col("list").isin("allow", "block"))
        .where("domain IS NOT NULL AND listed IS NOT NULL")
        .groupBy("list", F.lower("domain").alias("domain"), "listed")
        .agg(F.min(F.col("action") == "add").alias("active"))
    )
    following = F.lead("listed").over(Window.partitionBy("list", "domain").orderBy("listed"))
    return (
        state.withColumn("valid_to", following)
        .where("active")
        .select("list", "domain", F.col("listed").alias("valid_from"), "valid_to")
    )


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with host and verdict. Copies of a host on a day are judged once, so a frequent
    host weighs no more than a rare one; only the verdicts go back to the captures."""
    rows = captures.select(
        F.struct(*without(captures, *VERDICT)).alias("doc"),
        host_of(F.col(f"`{url}`")).alias("host"),
        F.col(f"`{fetched}`").cast("date").alias("day"),
    )
    asked = rows.where("host IS NOT NULL AND day IS NOT NULL").select("host", "day").distinct()
    active = (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    best = F.max(
        F.struct(F.length("domain").alias("n"), (F.col("list") == "allow").alias("a"), "valid_from", "domain", "list", "valid_to")
    )
    verdicts = (
        asked.select("host", "day", F.explode(suffixes(F.col("host"))).alias("domain"))
        .join(validity(entries), "domain")
        .where(active)
        .groupBy("host", "day")
        .agg(best.alias("best"))
    )
    return rows.join(verdicts, ["host", "day"], "left").select(
        "doc.*",
        "host",
        F.coalesce(F.col("best.list") == "block", F.lit(False)).alias("blocked"),
        F.col("best.domain").alias("matched_domain"),
        F.col("best.list").alias("list"),
        F.col("best.valid_from").alias("valid_from"),
        F.col("best.valid_to").alias("valid_to"),
    )


def number(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def day(n: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (n % DAYS).cast("int"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Test adapter: the pages carry no fetch date, so a hash of the id gives one."""
    return pages.select("page_id", "url", day(number(F.col("page_id").cast("string"))).alias("fetched"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Test adapter: dated entries for every host of the pages and its parent of three labels."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    parent = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    domains = hosts.select(F.explode(F.array("host", parent)).alias("domain")).where("domain <> ''").distinct()
    of = lambda what: number(F.col("domain"), F.col("i").cast("string"), F.lit(what))
    return domains.select("domain", F.explode(F.sequence(F.lit(1), F.lit(ENTRIES))).alias("i")).select(
        "domain",
        day(of("day")).alias("listed"),
        F.when(of("action") % 3 == 0, "remove").otherwise("add").alias("action"),
        F.when(of("list") % 4 == 0, "allow").otherwise("block").alias("list"),
    )


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judged(captures_of(pages), entries_of(pages))


HOST = r"regexp_replace(regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#\\]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\.+$', '')"
NUMBER = "('0x' || md5({})[1:8])::BIGINT"
ORACLE = f"""
WITH captures AS (
  SELECT page_id, url, DATE '{FIRST_DAY}' + ({NUMBER.format("page_id::VARCHAR")} % {DAYS})::INT AS fetched,
    nullif({HOST}, '') AS host FROM pages),
domains AS (
  SELECT host AS domain FROM captures WHERE host IS NOT NULL
  UNION SELECT regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) FROM captures WHERE host IS NOT NULL),
entries AS (
  SELECT domain, DATE '{FIRST_DAY}' + ({NUMBER.format("domain || '|' || i || '|day'")} % {DAYS})::INT AS listed,
    CASE WHEN {NUMBER.format("domain || '|' || i || '|action'")} % 3 = 0 THEN 'remove' ELSE 'add' END AS action,
    CASE WHEN {NUMBER.format("domain || '|' || i || '|list'")} % 4 = 0 THEN 'allow' ELSE 'block' END AS list
  FROM domains, range(1, {ENTRIES + 1}) r(i) WHERE domain <> ''),
seen AS (
  SELECT c.page_id, c.url, e.list, e.domain, e.listed, e.action
  FROM captures c JOIN entries e ON (e.domain = c.host OR ends_with(c.host, '.' || e.domain)) AND e.listed <= c.fetched),
latest AS (
  SELECT page_id, url, list, domain, max(listed) AS listed,
    bool_and(action = 'add') FILTER (listed = newest) AS active
  FROM (SELECT *, max(listed) OVER (PARTITION BY page_id, url, list, domain) AS newest FROM seen)
  GROUP BY page_id, url, list, domain),
winner AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY length(domain) DESC, list = 'allow' DESC) AS place
  FROM latest WHERE active)
SELECT c.page_id, c.url, c.fetched, c.host, coalesce(w.list = 'block', false) AS blocked,
  w.domain AS matched_domain, w.list, w.listed AS valid_from,
  (SELECT min(e.listed) FROM entries e WHERE e.list = w.list AND e.domain = w.domain AND e.listed > w.listed) AS valid_to
FROM captures c LEFT JOIN winner w ON w.page_id = c.page_id AND w.url = c.url AND w.place = 1
"""
