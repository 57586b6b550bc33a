"""RSS 2.0 / Atom feeds -> news items, with ``from_xml`` and declared schemas.

A page that is not well formed has no items (``from_xml`` alone would give those before the fault), and
is never an exception.  Feed kind
is decided from the root start tag: the Atom namespace there means Atom,
anything else is read as RSS.  Mixed landings are parsed once per page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import trimmed_or_empty, url_netloc
from tidemark.functions.time import rfc822_timestamp
from tidemark.functions.xml import well_formed

# The Atom namespace and the declared payload schemas.
ATOM_NS = "http://www.w3.org/2005/Atom"
RSS_ITEM = "struct<title:string,link:string,description:string,pubDate:string>"
RSS_SCHEMA = f"channel struct<item:array<{RSS_ITEM}>>, item array<{RSS_ITEM}>"
ATOM_SCHEMA = ("entry array<struct<title:string,link:array<struct<_href:string>>,"
               "published:string,updated:string,summary:string>>")
_ROOT_TAG = r"<([A-Za-z_][^\s>/]*)[^>]*>"
# keep element text as landed (summaries are stored raw); titles/links are trimmed explicitly
XML_OPTIONS = {"ignoreSurroundingSpaces": "false"}


def root_tag(xml: Column) -> Column:
    """The first element start tag (after any declaration/comments)."""
    body = F.regexp_replace(xml, r"(?s)^\s*(<\?.*?\?>\s*)?(<!--.*?-->\s*)*(<!DOCTYPE[^>]*>\s*)?", "")
    return F.regexp_extract(body, _ROOT_TAG, 0)


def is_atom(xml: Column) -> Column:
    return root_tag(xml).contains(ATOM_NS)


def _sound(xml: str) -> Column:
    """The page, null if it is not well formed."""
    return F.when(well_formed(F.col(xml)), F.col(xml))


def _items(df: DataFrame, keep: tuple[str, ...], node: Column) -> DataFrame:
    return df.select(*keep, F.posexplode(node).alias("item_pos", "it"))


def rss_items(df: DataFrame, xml: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of RSS feeds (under ``channel`` or the root); items without a link are dropped."""
    parsed = F.from_xml(_sound(xml), RSS_SCHEMA, XML_OPTIONS)
    node = F.concat(F.coalesce(parsed.getField("channel").getField("item"), F.array()),
                    F.coalesce(parsed.getField("item"), F.array()))
    items = _items(df, keep, node)
    url = trimmed_or_empty(F.col("it.link"))
    return items.select(
        *keep, "item_pos",
        url.alias("url"),
        trimmed_or_empty(F.col("it.title")).alias("title"),
        F.col("it.description").alias("summary"),
        url_netloc(url).alias("source_domain"),
        rfc822_timestamp(F.col("it.pubDate")).alias("published_at"),
    ).filter(F.length("url") > 0)


def atom_items(df: DataFrame, xml: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Direct ``entry`` children; first ``link@href``; ``published`` else ``updated``."""
    parsed = F.from_xml(_sound(xml), ATOM_SCHEMA, XML_OPTIONS)
    items = _items(df, keep, parsed.getField("entry"))
    url = F.coalesce(F.get(F.col("it.link"), 0).getField("_href"), F.lit(""))
    published = F.coalesce(F.nullif(F.col("it.published"), F.lit("")), F.col("it.updated"))
    return items.select(
        *keep, "item_pos",
        url.alias("url"),
        trimmed_or_empty(F.col("it.title")).alias("title"),
        F.col("it.summary").alias("summary"),
        url_netloc(url).alias("source_domain"),
        rfc822_timestamp(published).alias("published_at"),
    ).filter(F.length("url") > 0)


ANY_FEED_SCHEMA = f"{RSS_SCHEMA}, {ATOM_SCHEMA}"
_COMMON = "struct<link:string,title:string,summary:string,date:string>"


def feed_items(df: DataFrame, xml: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of RSS and Atom feeds in one pass: each page is parsed once with a
    schema covering both kinds, and its kind (Atom namespace on the root tag)
    picks which part becomes items.  RSS links are trimmed, Atom links are not."""
    parsed = F.from_xml(_sound(xml), ANY_FEED_SCHEMA, XML_OPTIONS)
    atom = is_atom(F.col(xml))
    rss_nodes = F.concat(F.coalesce(parsed.getField("channel").getField("item"), F.array()),
                         F.coalesce(parsed.getField("item"), F.array()))
    as_rss = F.transform(rss_nodes, lambda it: F.struct(
        trimmed_or_empty(it["link"]).alias("link"), it["title"].alias("title"), it["description"].alias("summary"),
        it["pubDate"].alias("date")))
    as_atom = F.transform(F.coalesce(parsed.getField("entry"), F.array()), lambda e: F.struct(
        F.coalesce(F.get(e["link"], 0).getField("_href"), F.lit("")).alias("link"), e["title"].alias("title"),
        e["summary"].alias("summary"), F.coalesce(F.nullif(e["published"], F.lit("")), e["updated"]).alias("date")))
    nodes = F.when(atom, as_atom).otherwise(as_rss).cast(f"array<{_COMMON}>")
    items = _items(df, keep, nodes)
    url = F.col("it.link")
    return items.select(
        *keep, "item_pos",
        url.alias("url"),
        trimmed_or_empty(F.col("it.title")).alias("title"),
        F.col("it.summary").alias("summary"),
        url_netloc(url).alias("source_domain"),
        rfc822_timestamp(F.col("it.date")).alias("published_at"),
    ).filter(F.length("url") > 0)
