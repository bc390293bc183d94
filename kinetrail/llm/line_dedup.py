"""Line dedup by site-relative frequency.

A line's boilerplate ratio on a site is the number of the site's pages that hold it, divided by the number
of the site's pages. Lines above ``RATIO`` on their site leave every page of it. Lines are compared without
white space at their ends; blank lines stay and are never counted.

Only DataFrame operations: a page's distinct lines are hashed (64 bits), partial counts by (site, line) are
combined before the shuffle, so neither a line on every page nor a site with a third of all pages meets in one
task; sites' totals are as many rows as there are sites. The lines to drop are at most 1 / RATIO times the
mean number of lines a page for each site; they are gathered by site into one row each, and a page meets its
site's row.

Defined cases: a null site is a site of its own; a null text stays null, an empty one empty; a page whose
lines all go becomes empty; a site of fewer than ``PAGES`` pages loses nothing, as its ratios say little; a
line also has to stand on at least ``HOLDERS`` pages. Repeated rows count as pages each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: A line on more than this share of its site's pages is boilerplate.
RATIO = 0.05
PAGES, HOLDERS = 10, 3
#: Boilerplate lines (8 bytes each) that are sent to all tasks; more are joined by shuffle.
SENT_MOST = 1_000_000


def host_of(url: str = "url"):
    """The lower-cased host of a URL column."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


#: What of a page's HTML is no text, and what ends a line of it.
_HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
_ENDS = r"(?i)<br[^>]*>|</(?:p|div|li|h[1-6]|title|nav|header|footer|article)>"
_TAG = r"<[^>]*>"


def page_text(html: str = "html"):
    """The text of a page, one block of its HTML a line; null for a null page."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _HIDDEN, ""), _ENDS, "\n"), _TAG, "")


def _lines(text: str):
    return F.split(F.col(text), "\n", -1)


def _hash(line):
    """Of a line without its outer white space; null for a blank one."""
    bare = F.regexp_replace(line, r"^\s+|\s+$", "")
    return F.when(bare != "", F.xxhash64(bare))


def line_ratios(pages: DataFrame, site: str = "source", text: str = "text") -> DataFrame:
    """site, line (hash), n_pages, site_pages of every line of every site."""
    base = pages.select(F.col(site).alias("site"), F.array_distinct(F.filter(F.transform(_lines(text), _hash), lambda h: h.isNotNull())).alias("lines"))
    totals = base.groupBy("site").agg(F.count("*").alias("site_pages"))
    held = base.select("site", F.explode("lines").alias("line")).groupBy("site", "line").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= HOLDERS)
    t = totals.withColumnRenamed("site", "own")
    return held.join(t, held.site.eqNullSafe(t.own)).drop("own")


def boilerplate(pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO) -> DataFrame:
    r = line_ratios(pages, site, text)
    return r.where((F.col("site_pages") >= PAGES) & (F.col("n_pages") > ratio * F.col("site_pages")))


def drop_lines(pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO) -> DataFrame:
    """pages with ``text`` without its site's boilerplate lines, and n_dropped (instead of a column of that name): how many lines went."""
    lines = C.Scratch(pages.sparkSession, "lines").keep(boilerplate(pages, site, text, ratio).select("site", "line"), "gone")
    own, went, least = C.free_names(pages, "own_site", "gone_lines", "n_dropped_here")
    gone = lines.groupBy(F.col("site").alias(own)).agg(F.collect_set("line").alias(went))
    if lines.count() <= SENT_MOST:
        gone = F.broadcast(gone)
    met = pages.join(gone, pages[site].eqNullSafe(gone[own]), "left")
    lines = _lines(text)
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(went), _hash(x)), F.lit(False)))
    n = F.coalesce(F.size(lines) - F.size(kept), F.lit(0))
    met = met.withColumn(least, F.when(F.col(went).isNull() | F.col(text).isNull(), 0).otherwise(n))
    met = met.withColumn(text, F.when(F.col(least) > 0, F.array_join(kept, "\n")).otherwise(F.col(text)))
    return met.select(*[F.col(f"`{c}`") for c in pages.columns if c != "n_dropped"], F.col(least).alias("n_dropped"))


#: The same for DuckDB over a table with doc_id, source and text, named in the first place; then the ratio.
ORACLE = """
with d as (select doc_id, source, text, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) as bare from %s),
t as (select source, count(*) as site_pages from d group by source),
l as (select distinct doc_id, source, unnest(bare) as line from d),
r as (select l.source, l.line from l join t on l.source is not distinct from t.source where line <> ''
      group by l.source, l.line, site_pages having count(*) >= 3 and site_pages >= 10 and count(*) > %s * site_pages),
g as (select source, list(line) as gone from r group by source),
k as (select d.doc_id, d.text, string_split(d.text, chr(10)) as lines,
             list_filter(range(1, len(d.bare) + 1), lambda i: not coalesce(list_contains(g.gone, d.bare[i]), false)) as keep
      from d left join g on d.source is not distinct from g.source)
select doc_id, cast(coalesce(len(lines) - len(keep), 0) as int) as n_dropped,
       case when coalesce(len(lines) - len(keep), 0) > 0 then coalesce(array_to_string(list_transform(keep, lambda i: lines[i]), chr(10)), '') else text end as text
from k
"""
