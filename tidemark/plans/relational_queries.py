"""Filter, join, aggregate, dedup and scalar queries over the driver tables."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators.conform import no_bad_rows
from tidemark.functions import numbers as N
from tidemark.functions import text as X
from tidemark.functions import time as TM
from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.operators import windows as W
from tidemark.operators.dedup import first_wins
from tidemark.plans import landed, normalize
from tidemark.plans.registry import AS_OF, SOURCE_UPDATED_AT, finish, load, register
from tidemark.session import checkpoint_root

# ---- S11/P2/P3/J8/F20: config enrichment ----------------------------------------------------

# Feed configuration rows (region key, feed name, feed type, reliability tier).
FEED_CONFIG = (
    (0, "Africa Desk", "rss", 3),
    (1, "Americas Wire", "atom", 1),
    (2, "Asia Markets", "rss", 2),
    (3, "Europe Daily", "atom", 1),
    (4, "Mideast Brief", "rss", 3),
)
_FEED_VALUES = ", ".join(f"({k}, '{n}', '{t}', {r})" for k, n, t, r in FEED_CONFIG)


@register("config_broadcast_enrich", f"""
SELECT c.c_custkey, upper(n.n_name) || 'USDT' AS symbol, 'USDT' AS counterpart,
       f.source_name, f.source_type, CAST(f.reliability_tier AS BIGINT) AS reliability_tier,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN (VALUES {_FEED_VALUES}) f(regionkey, source_name, source_type, reliability_tier)
  ON n.n_regionkey = f.regionkey
""")
def config_broadcast_enrich(spark: SparkSession, sf_dir: str):
    """Rows stamped with constants and enriched from bounded config (literal feed
    list, nation dimension size-checked before broadcast)."""
    customer = load(spark, sf_dir, "customer")
    nation = J.broadcast_if_small(load(spark, sf_dir, "nation"))
    config = spark.createDataFrame(list(FEED_CONFIG),
                                   "n_regionkey int, source_name string, source_type string, reliability_tier long")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner")
    rows = J.config_join(rows, config, "n_regionkey")
    return finish(rows.select(
        "c_custkey", X.symbol(F.upper("n_name"), F.lit("USDT")).alias("symbol"), F.lit("USDT").alias("counterpart"),
        "source_name", "source_type", "reliability_tier",
        F.lit(SOURCE_UPDATED_AT).cast("timestamp").alias("source_updated_at")))


# ---- P4-P10 window filters ---------------------------------------------------------------------

@register("window_inclusive", """
SELECT event_id, ts FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
""")
def window_inclusive(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events").select("event_id", landed.utc("ts").alias("ts"))
    start, end = datetime(2024, 1, 10, tzinfo=timezone.utc), datetime(2024, 1, 20, tzinfo=timezone.utc)
    return finish(W.window_inclusive(ev, "ts", start, end))


@register("window_half_open", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) < DATE '1997-01-01'
""")
def window_half_open(spark: SparkSession, sf_dir: str):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return W.window_half_open(o, "d", date(1996, 1, 1), date(1997, 1, 1))


@register("lookback_window", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-07-03' AND DATE '1998-08-02'
""")
def lookback_window(spark: SparkSession, sf_dir: str):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return W.lookback_window(o, "d", date(1998, 8, 2), 30)


@register("run_day_rows", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-08-02'
""")
def run_day_rows(spark: SparkSession, sf_dir: str):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return W.run_day_rows(o, "d", date(1998, 8, 2))


@register("like_since_filter", """
SELECT p_partkey, p_type, p_size, 'since' AS variant FROM part WHERE p_type LIKE 'S%' AND p_size >= 25
UNION ALL
SELECT p_partkey, p_type, p_size, 'all' AS variant FROM part WHERE p_type LIKE 'S%'
""")
def like_since_filter(spark: SparkSession, sf_dir: str):
    """Source pushdown predicate (prefix LIKE + lower bound) and the optional bound
    omitted when ``since`` is None."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    pref = part.filter(F.col("p_type").like("S%"))
    with_since = W.since_filter(pref, "p_size", 25).withColumn("variant", F.lit("since"))
    without = W.since_filter(pref, "p_size", None).withColumn("variant", F.lit("all"))
    return with_since.unionByName(without)


# ---- J1 exact-key ratio, A5 last value per day, J5 history else snapshot ------------------------

DOMINANCE_HOURLY_SQL = """
WITH p AS (SELECT date_trunc('hour', ts) AS h, round(sum(value), 2) AS cap FROM events
           WHERE event_type = 'purchase' GROUP BY 1),
     t AS (SELECT date_trunc('hour', ts) AS h, round(sum(value), 2) AS total FROM events GROUP BY 1)
SELECT p.h AS ts, round(p.cap / t.total * 100, 6) AS btc_dominance_pct
FROM p JOIN t ON p.h = t.h WHERE t.total > 0
"""


def dominance_pages(spark: SparkSession, sf_dir: str):
    """Landed pages of a day's hourly points: the asset's cap (purchases) and the total; each total is
    landed twice, a stale value first, so that the last one has to win."""
    hourly = (load(spark, sf_dir, "events").groupBy(F.date_trunc("hour", landed.utc("ts")).alias("h"))
              .agg(F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), 2).alias("cap"),
                   F.round(F.sum("value"), 2).alias("total")))
    ms = F.unix_millis("h").cast("string")
    point = lambda v: F.concat(F.lit("["), ms, F.lit(","), v.cast("string"), F.lit("]"))

    def pages(rows, item, prefix, suffix):
        return (rows.groupBy(F.to_date("h").alias("day")).agg(F.array_sort(F.collect_list(F.struct("h", item.alias("p")))).alias("xs"))
                .select(F.concat(F.lit(prefix), F.array_join(F.transform("xs", lambda x: x["p"]), ","), F.lit(suffix)).alias("payload")))

    asset = pages(hourly.filter("cap is not null"), point(F.col("cap")), '{"market_caps": [', "]}")
    total = pages(hourly, F.concat(point(F.col("total") + 1), F.lit(","), point(F.col("total"))), '{"market_cap_chart": {"market_cap": [', "]}}")
    return asset, total


def dominance_hourly(spark: SparkSession, sf_dir: str):
    history = normalize.dominance_history(*dominance_pages(spark, sf_dir))
    return history.select("ts", F.round("btc_dominance_pct", 6).alias("btc_dominance_pct"))


@register("dominance_ratio", DOMINANCE_HOURLY_SQL)
def dominance_ratio(spark: SparkSession, sf_dir: str):
    return finish(dominance_hourly(spark, sf_dir))


@register("history_else_snapshot", f"""
WITH hourly AS ({DOMINANCE_HOURLY_SQL}),
     daily AS (SELECT CAST(ts AS DATE) AS date, arg_max(btc_dominance_pct, ts) AS pct FROM hourly GROUP BY 1),
     snap AS (SELECT arg_max(btc_dominance_pct, ts) AS pct FROM hourly),
     days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(
                (SELECT min(CAST(ts AS DATE)) FROM hourly),
                (SELECT max(CAST(ts AS DATE)) FROM hourly) + INTERVAL 3 DAY, INTERVAL 1 DAY) g(d))
SELECT days.date, coalesce(daily.pct, snap.pct) AS btc_dominance_pct,
       CASE WHEN daily.pct IS NOT NULL THEN CAST(days.date AS TIMESTAMP)
            ELSE TIMESTAMP '2024-01-15 12:30:00' END AS source_updated_at
FROM days LEFT JOIN daily ON days.date = daily.date, snap
""")
def history_else_snapshot(spark: SparkSession, sf_dir: str):
    """Requested days (event range plus three later days) take the day's last
    historical value, else the snapshot (latest value) stamped with its time."""
    checkpoint_root(spark)
    hourly = dominance_hourly(spark, sf_dir).checkpoint()        # a row per hour, read for the days and for the bounds
    one = hourly.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"),
                     F.max_by("btc_dominance_pct", "ts").alias("snap_pct"))
    requested = one.select(F.explode(F.sequence("lo", F.date_add("hi", 3))).alias("date"), "snap_pct")
    return finish(normalize.market_metric_rows(hourly, requested, F.col("snap_pct"), AS_OF))


@register("last_value_per_day", """
SELECT event_type, CAST(ts AS DATE) AS date, arg_max(value, ts) AS value FROM events GROUP BY 1, 2
""")
def last_value_per_day(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events").select("event_type", landed.utc("ts").alias("ts"), "value")
    return A.last_value_per_day(ev, "ts", "value", keys=("event_type",))


@register("latest_in_window", """
SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value, max(ts) AS ts
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
GROUP BY user_id
""")
def latest_in_window(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "value", landed.utc("ts").alias("ts"))
    win = W.window_inclusive(ev, "ts", datetime(2024, 1, 10, tzinfo=timezone.utc),
                             datetime(2024, 1, 20, tzinfo=timezone.utc))
    return finish(A.latest_by(win, ["user_id"], "ts", ["event_id", "value", "ts"]))


# ---- J4 full assembly of a day from three sources (R4 day loop) ----------------------------------

@register("assemble_day_metrics", """
WITH e AS (SELECT CAST(ts AS DATE) AS date, dayofweek(ts) AS d, event_type, ts, value FROM events),
     oi AS (SELECT date, arg_max(value, ts) AS open_interest FROM e WHERE event_type IN ('click', 'signup') AND d <> 0 GROUP BY 1),
     bs AS (SELECT date, arg_max(value, ts) AS basis FROM e WHERE event_type IN ('view', 'error') AND d NOT IN (0, 6) GROUP BY 1),
     pm AS (SELECT date, arg_max(value, ts) AS premium_index FROM e WHERE event_type = 'purchase' AND d NOT IN (0, 5, 6) GROUP BY 1)
SELECT 'BTC' AS instrument, 'USDT' AS counterpart, coalesce(oi.date, bs.date, pm.date) AS date,
       open_interest, basis, premium_index
FROM oi FULL JOIN bs ON oi.date = bs.date FULL JOIN pm ON coalesce(oi.date, bs.date) = pm.date
""")
def assemble_day_metrics(spark: SparkSession, sf_dir: str):
    """Per day, the latest point of each of three sources, to which all event types are dealt; each rests on
    some days of the week, all of them on Sundays (then there is no row)."""
    ev = load(spark, sf_dir, "events").select("event_type", landed.utc("ts").alias("ts"), "value")

    def latest(kinds: tuple[str, ...], resting: tuple[int, ...], name: str):
        src = ev.filter(F.col("event_type").isin(*kinds) & ~F.dayofweek("ts").isin(*resting))
        return A.last_value_per_day(src, "ts", "value").withColumnRenamed("value", name)

    parts = [latest(("click", "signup"), (1,), "open_interest"), latest(("view", "error"), (1, 7), "basis"),
             latest(("purchase",), (1, 6, 7), "premium_index")]
    out = J.full_assembly(parts, "date")
    return out.select(F.lit("BTC").alias("instrument"), F.lit("USDT").alias("counterpart"), "date",
                      "open_interest", "basis", "premium_index")


# ---- N14/P13 placeholder rows per configured chart and day ------------------------------------------

# Chart names and the event types feeding each.
CHARTS = {"miners-revenue": ("purchase", "click", "signup"), "transaction-fees-usd": ("error", "view")}


@register("chart_placeholder_rows", """
WITH pts AS (
  SELECT CASE WHEN event_type IN ('error', 'view') THEN 'transaction-fees-usd' ELSE 'miners-revenue' END AS chart_name,
         CAST(ts AS DATE) AS date, arg_min(value, event_id) AS value
  FROM events WHERE dayofweek(ts) <> 0 GROUP BY 1, 2),
days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(
           (SELECT min(CAST(ts AS DATE)) FROM events),
           (SELECT max(CAST(ts AS DATE)) FROM events) + INTERVAL 2 DAY, INTERVAL 1 DAY) g(d)),
charts AS (SELECT * FROM (VALUES ('miners-revenue'), ('transaction-fees-usd')) c(chart_name))
SELECT charts.chart_name, days.date, CASE WHEN dayofweek(days.date) <> 6 THEN pts.value END AS value,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM charts CROSS JOIN days LEFT JOIN pts ON pts.chart_name = charts.chart_name AND pts.date = days.date
""")
def chart_placeholder_rows(spark: SparkSession, sf_dir: str):
    """One row per configured chart and requested day: the first value of the day's first page, or a null
    row where no page landed (Sundays, later days) or its page cannot be read (Saturdays)."""
    kind = F.coalesce(*(F.when(F.col("event_type").isin(*kinds), F.lit(name)) for name, kinds in CHARTS.items()))
    ev = load(spark, sf_dir, "events").withColumn("chart_name", kind).withColumn("date", F.to_date("ts"))
    item = F.to_json(F.struct(F.unix_seconds(landed.utc("ts")).alias("x"), F.col("value").alias("y")))
    pages = landed.event_pages(ev.filter(F.dayofweek("date") != 1), item, by=("chart_name", "date"), prefix='{"values": [', suffix="]}")
    pages = pages.withColumn("payload", F.when(F.dayofweek("date") == 7, F.expr("left(payload, length(payload) - 3)")).otherwise(F.col("payload")))
    bounds = ev.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    requested = (bounds.select(F.explode(F.array(*map(F.lit, CHARTS))).alias("chart_name"), "lo", "hi")
                 .select("chart_name", F.explode(F.sequence("lo", F.date_add("hi", 2))).alias("date")))
    return finish(normalize.chart_first_values(requested, pages, source_updated_at=SOURCE_UPDATED_AT))


# ---- J6/A3 two-source combine with null-safe total ------------------------------------------------

@register("null_safe_total", """
WITH a AS (SELECT c_nationkey AS nationkey, round(sum(c_acctbal), 2) AS usdt FROM customer
           GROUP BY 1 HAVING sum(c_acctbal) <= 30000 OR count(*) % 2 = 0),
     b AS (SELECT s_nationkey AS nationkey, round(sum(s_acctbal), 2) AS usdc FROM supplier
           GROUP BY 1 HAVING sum(s_acctbal) > 15000)
SELECT coalesce(a.nationkey, b.nationkey) AS nationkey, a.usdt AS usdt_market_cap_usd,
       b.usdc AS usdc_market_cap_usd,
       nullif(coalesce(a.usdt, 0) + coalesce(b.usdc, 0), 0) AS total_stablecoin_market_cap_usd
FROM a FULL JOIN b ON a.nationkey = b.nationkey
""")
def null_safe_total(spark: SparkSession, sf_dir: str):
    """Balances by nation over all customers and all suppliers; a side has no row for some nations."""
    def side(table: str, prefix: str, name: str, has):
        rows = load(spark, sf_dir, table).groupBy(F.col(f"{prefix}_nationkey").alias("nationkey")).agg(
            F.sum(f"{prefix}_acctbal").alias("s"), F.count("*").alias("n"))
        return rows.filter(has).select("nationkey", F.round("s", 2).alias(name))

    a = side("customer", "c", "usdt", (F.col("s") <= 30000) | (F.col("n") % 2 == 0))
    b = side("supplier", "s", "usdc", F.col("s") > 15000)
    both = J.full_assembly([a, b], "nationkey")
    return both.select("nationkey", F.col("usdt").alias("usdt_market_cap_usd"),
                       F.col("usdc").alias("usdc_market_cap_usd"),
                       N.null_safe_total(F.col("usdt"), F.col("usdc")).alias("total_stablecoin_market_cap_usd"))


# ---- A1/A2 conditional sums and guarded ratio -----------------------------------------------------

@register("put_call_ratio", """
WITH m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         sum(CASE WHEN o_orderpriority LIKE '%-U%' THEN o_totalprice ELSE 0 END) AS put_oi,
         sum(CASE WHEN o_orderpriority LIKE '%-H%' THEN o_totalprice ELSE 0 END) AS call_oi
  FROM orders GROUP BY 1)
SELECT month, round(nullif(put_oi, 0), 2) AS put_oi, round(nullif(call_oi, 0), 2) AS call_oi,
       CASE WHEN call_oi > 0 THEN round(put_oi / call_oi, 6) END AS put_call_ratio
FROM m
""")
def put_call_ratio(spark: SparkSession, sf_dir: str):
    """Option book per month from all orders: urgent ones are puts, high ones calls."""
    side = F.when(F.col("o_orderpriority").contains("-U"), "BTC-P").when(F.col("o_orderpriority").contains("-H"), "BTC-C").otherwise("BTC")
    book = load(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"),
                                                side.alias("instrument_name"), F.col("o_totalprice").alias("open_interest"))
    found = normalize.put_call(book, keys=("month",))
    return found.select("month", *(F.round(c, d).alias(c) for c, d in (("put_oi", 2), ("call_oi", 2), ("put_call_ratio", 6))))


# ---- U1/J3/F17: first-wins dedup and stored-hash anti-join -----------------------------------------

def document_items(spark: SparkSession, sf_dir: str):
    """Documents as news items: url = lang, title = '', summary = text (copies collide)."""
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", "text",
                       X.content_hash(F.col("lang"), F.lit(""), F.col("text")).alias("content_hash"))


@register("content_hash", """
SELECT doc_id, sha256(lang || chr(10) || chr(10) || text) AS content_hash FROM documents
""")
def content_hash(spark: SparkSession, sf_dir: str):
    return document_items(spark, sf_dir).select("doc_id", "content_hash")


@register("hash_dedup_new", """
WITH h AS (SELECT doc_id, lang, sha256(lang || chr(10) || chr(10) || text) AS content_hash FROM documents),
     firsts AS (SELECT content_hash, min(doc_id) AS doc_id FROM h GROUP BY 1),
     known AS (SELECT DISTINCT content_hash FROM h WHERE lang = 'de')
SELECT content_hash, doc_id FROM firsts WHERE content_hash NOT IN (SELECT content_hash FROM known)
""")
def hash_dedup_new(spark: SparkSession, sf_dir: str):
    """Stored items are the German documents (upserted into the news table); the
    batch is every document, first-wins by id, minus the stored hashes (projected read)."""
    from tidemark.plans.store_queries import news_store
    items = document_items(spark, sf_dir)
    store = news_store(spark, items.filter(F.col("lang") == "de"))
    stored = store.read("raw.market_news_items", columns=["content_hash"])
    batch = first_wins(items.select("content_hash", "doc_id"), "content_hash", ["doc_id"])
    return J.anti_by_hash(batch, stored)


@register("hash_membership_new", """
WITH h AS (SELECT doc_id, lang, sha256(lang || chr(10) || chr(10) || text) AS content_hash FROM documents),
     firsts AS (SELECT content_hash, min(doc_id) AS doc_id FROM h GROUP BY 1)
SELECT content_hash, doc_id FROM firsts WHERE content_hash NOT IN (SELECT content_hash FROM h WHERE lang IN ('de', 'fr'))
""")
def hash_membership_new(spark: SparkSession, sf_dir: str):
    """The rows of the plain anti-join through membership filters: German and French documents were stored
    by a write each, and only writes whose filter says maybe are read."""
    from tidemark.plans.store_queries import append_news, news_store
    items = document_items(spark, sf_dir)
    store = news_store(spark, items.filter(F.col("lang") == "de"))
    append_news(store, items.filter(F.col("lang") == "fr"))
    batch = first_wins(items.select("content_hash", "doc_id"), "content_hash", ["doc_id"]).persist()
    return store.unseen("raw.market_news_items", batch)


# ---- F18 URL host, F26 redaction ---------------------------------------------------------------------

@register("url_netloc", "SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS source_domain FROM pages")
def url_netloc(spark: SparkSession, sf_dir: str):
    return load(spark, sf_dir, "pages").select("page_id", X.url_netloc(F.col("url")).alias("source_domain"))


@register("redact_text", r"""
SELECT page_id,
       regexp_replace(regexp_replace(url || '&token=' || page_id || '&api_key=k' || page_id || ' Authorization: Bearer abc.' || page_id,
         '(?i)\b(api[_-]?key|access[_-]?token|token|secret|signature|password|key)=([^&\s"''<>]+)', '\1=***', 'g'),
         '(?i)(bearer\s+)[A-Za-z0-9._\-]+', '\1***', 'g') AS redacted
FROM pages
""")
def redact_text(spark: SparkSession, sf_dir: str):
    pages = load(spark, sf_dir, "pages")
    text = F.concat(F.col("url"), F.lit("&token="), F.col("page_id").cast("string"), F.lit("&api_key=k"),
                    F.col("page_id").cast("string"), F.lit(" Authorization: Bearer abc."), F.col("page_id").cast("string"))
    return pages.select("page_id", X.redact(text).alias("redacted"))


# ---- F1-F11, F19, N8, N9, U2 --------------------------------------------------------------------------

@register("epoch_conversions", """
SELECT event_id, epoch_ms(date_trunc('millisecond', ts)) AS ms, date_trunc('millisecond', ts) AS ts_ms,
       CAST(ts AS DATE) AS day_from_ms, CAST(date_trunc('second', ts) AS DATE) AS day_from_seconds,
       CASE WHEN epoch_ms(date_trunc('millisecond', ts)) % 1000 = 0 THEN strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S+00:00')
            ELSE strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS iso
FROM events
""")
def epoch_conversions(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events").select("event_id", landed.utc("ts").alias("ts"))
    ms = TM.timestamp_to_ms(F.col("ts"))
    return finish(ev.select("event_id", ms.alias("ms"), TM.ms_to_timestamp(ms).alias("ts_ms"),
                            TM.ms_to_date(ms).alias("day_from_ms"),
                            TM.seconds_to_date(F.unix_seconds("ts")).alias("day_from_seconds"),
                            TM.iso_from_ms(ms).alias("iso")))


@register("iso_parse", """
SELECT event_id, CAST(ts + INTERVAL 5 HOUR AS DATE) AS utc_date, CAST(ts AS DATE) AS wall_date,
       CAST(ts AS DATE) AS leading_date
FROM events
""")
def iso_parse(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events").select("event_id", landed.utc("ts").alias("ts"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    return ev.select("event_id", TM.iso_to_utc_date(text).alias("utc_date"), TM.iso_wall_date(text).alias("wall_date"),
                     TM.leading_date(text).alias("leading_date"))


# Release config (release id, order priority feeding it, release name; one has no name).
RELEASES = (
    (10, "1-URGENT", "Consumer Price Index"),
    (11, "2-HIGH", "Employment Situation"),
    (12, "3-MEDIUM", "Gross Domestic Product"),
    (13, "4-NOT SPECIFIED", None),
    (14, "5-LOW", "Retail Sales"),
)
_RELEASE_VALUES = ", ".join(f"({r}, '{p}', {repr(n) if n else 'NULL'})" for r, p, n in RELEASES)


@register("event_id_midnight", f"""
SELECT CAST(cfg.rid AS VARCHAR) || ':' || strftime(o_orderdate, '%Y-%m-%d') AS event_id,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS event_time_utc, coalesce(cfg.name, '') AS title,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM orders JOIN (VALUES {_RELEASE_VALUES}) cfg(rid, prio, name) ON orders.o_orderpriority = cfg.prio
""")
def event_id_midnight(spark: SparkSession, sf_dir: str):
    """Release-date pages per release -> ``<release>:<date>`` events at midnight UTC."""
    orders = load(spark, sf_dir, "orders")
    cfg = spark.createDataFrame([(r, p, n) for r, p, n in RELEASES], "release_id long, prio string, name string")
    tagged = orders.join(F.broadcast(cfg.select("release_id", "prio")), orders.o_orderpriority == cfg.prio)
    item = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")))
    pages = landed.event_pages(tagged, item, by=("release_id",), order="o_orderkey",
                               prefix='{"release_dates": [', suffix="]}")
    rows = normalize.macro_calendar(pages, cfg.select("release_id", "name"), source_updated_at=SOURCE_UPDATED_AT)
    return finish(no_bad_rows(rows))


# Series id per event type.
SERIES = (("click", "DTWEXBGS"), ("view", "M2SL"), ("purchase", "FEDFUNDS"), ("signup", "DGS10"), ("error", "T10YIE"))
_SERIES_VALUES = ", ".join(f"('{t}', '{s}')" for t, s in SERIES)


@register("series_union", f"""
SELECT cfg.series_id, CAST(ts AS DATE) AS date, CASE WHEN value < 1 THEN NULL ELSE value END AS value,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events JOIN (VALUES {_SERIES_VALUES}) cfg(event_type, series_id) ON events.event_type = cfg.event_type
""")
def series_union(spark: SparkSession, sf_dir: str):
    """All series' observation pages read as one dataset; the series id comes from
    the bounded config join (no per-series loop)."""
    ev = load(spark, sf_dir, "events")
    cfg = spark.createDataFrame(list(SERIES), "event_type string, series_id string")
    value = F.when(F.col("value") < 1, F.lit(".")).otherwise(F.col("value").cast("string"))
    item = F.to_json(F.struct(F.date_format(landed.utc("ts"), "yyyy-MM-dd").alias("date"), value.alias("value")))
    pages = landed.event_pages(ev, item, prefix='{"observations": [', suffix="]}")
    pages = J.config_join(pages, cfg, "event_type")
    rows = normalize.macro_series(pages, series_id=F.col("series_id"), source_updated_at=SOURCE_UPDATED_AT)
    return finish(no_bad_rows(rows))


# ---- A6/A7 run metrics -------------------------------------------------------------------------------

@register("run_metrics", """
WITH b AS (SELECT date_trunc('hour', ts) AS open_time FROM events GROUP BY event_type, 1)
SELECT count(*) AS raw_rows,
       count(*) FILTER (WHERE open_time + INTERVAL 3599999 MILLISECOND < TIMESTAMP '2024-01-15 12:30:00') AS kept_rows,
       max(open_time + INTERVAL 3599999 MILLISECOND) FILTER (
         WHERE open_time + INTERVAL 3599999 MILLISECOND < TIMESTAMP '2024-01-15 12:30:00') AS latest_close_time
FROM b
""")
def run_metrics(spark: SparkSession, sf_dir: str):
    """Raw klines vs closed bars kept and the latest kept close time, in one aggregate."""
    from tidemark.plans.payload_queries import candle_rows
    rows = candle_rows(spark, sf_dir)
    kept = F.col("close_time") < F.lit(AS_OF).cast("timestamp")
    return finish(A.run_counters(rows, kept=kept, latest_of=("close_time",)))
