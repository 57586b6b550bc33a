"""Keyed table I/O queries: every one writes through :class:`TableStore` into a
fresh folder under the shared checkpoint root and reads the result back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.conform import conform
from tidemark.operators.joins import select_new
from tidemark.plans.registry import SOURCE_UPDATED_AT, finish, load, register
from tidemark.session import scratch_path
from tidemark.spec import table_spec
from tidemark.store import TableStore
from tidemark.tables import MARKET_NEWS_ITEMS

ORDERS = table_spec(
    "raw.orders",
    {"o_orderkey": int, "o_custkey": int, "o_orderstatus": str, "o_totalprice": float,
     "o_orderdate": datetime, "o_orderpriority": str},
    identity=("o_orderkey",),
    partition=("years(o_orderdate)",),
    sort=("o_orderdate", "o_orderkey"),
)
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def orders_store(spark: SparkSession, purpose: str, spec=ORDERS) -> TableStore:
    return TableStore(spark, scratch_path(spark, purpose), {spec.identifier: spec})


def orders_rows(spark: SparkSession, sf_dir: str, spec=ORDERS) -> DataFrame:
    return conform(load(spark, sf_dir, "orders"), spec.schema)


@register("table_read_projected", "SELECT o_orderkey, o_totalprice FROM orders")
def table_read_projected(spark: SparkSession, sf_dir: str):
    """Projected scan (only two columns read); a table never written reads as an
    empty frame with the declared projected schema."""
    store = orders_store(spark, "read-projected")
    missing = store.read(ORDERS.identifier, columns=["o_orderkey", "o_totalprice"])
    store.append(ORDERS.identifier, orders_rows(spark, sf_dir))
    return store.read(ORDERS.identifier, columns=["o_orderkey", "o_totalprice"]).unionByName(missing)


@register("table_read_window", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1994-11-15 00:00:00' AND o_orderdate < TIMESTAMP '1995-03-01 00:00:00'
""")
def table_read_window(spark: SparkSession, sf_dir: str):
    """A window of the table by years: its bounds reach the scan as a filter on the partition column, so
    the folders of other years are not read."""
    store = orders_store(spark, "read-window")
    store.append(ORDERS.identifier, orders_rows(spark, sf_dir))
    rows = store.read_window(ORDERS.identifier, "o_orderdate", datetime(1994, 11, 15, tzinfo=timezone.utc), datetime(1995, 3, 1, tzinfo=timezone.utc),
                             include_high=False, columns=["o_orderkey", "o_totalprice", "o_orderdate"])
    return finish(rows)


@register("append_rows", f"""
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
UNION ALL
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
""")
def append_rows(spark: SparkSession, sf_dir: str):
    """Two appends of the same batch keep both copies (append never merges)."""
    store = orders_store(spark, "append")
    rows = orders_rows(spark, sf_dir)
    store.append(ORDERS.identifier, rows)
    store.append(ORDERS.identifier, rows)
    return finish(store.read(ORDERS.identifier, columns=["o_orderkey", "o_totalprice", "o_orderdate"]))


@register("sorted_write", f"SELECT {ORDER_COLUMNS}, true AS in_file_order FROM orders")
def sorted_write(spark: SparkSession, sf_dir: str):
    """Rows come back whole, and every data file is in table sort order."""
    store = orders_store(spark, "sorted")
    store.append(ORDERS.identifier, orders_rows(spark, sf_dir))
    data = (store.read_storage(ORDERS.identifier).select(*ORDERS.columns)
            .withColumn("_file", F.input_file_name()).withColumn("_seq", F.monotonically_increasing_id()))
    w = Window.partitionBy("_file").orderBy("_seq")
    prev = F.struct(F.lag("o_orderdate").over(w).alias("d"), F.lag("o_orderkey").over(w).alias("k"))
    cur = F.struct(F.col("o_orderdate").alias("d"), F.col("o_orderkey").alias("k"))
    ordered = data.withColumn("in_file_order", prev.isNull() | (F.lag("o_orderkey").over(w).isNull()) | (prev <= cur))
    return finish(ordered.drop("_file", "_seq"))


@register("relayout_rows", f"SELECT {ORDER_COLUMNS}, strftime(o_orderdate, '%Y-%m') AS o_orderdate_months FROM orders")
def relayout_rows(spark: SparkSession, sf_dir: str):
    """Stored by year, re-laid out by month: layout drift detected, rows rewritten."""
    store = orders_store(spark, "relayout")
    store.append(ORDERS.identifier, orders_rows(spark, sf_dir))
    store.relayout(ORDERS.identifier, partition=("months(o_orderdate)",))
    part_ok, sort_ok = store.layout_drift(ORDERS.identifier)
    assert part_ok and sort_ok
    return finish(store.read_storage(ORDERS.identifier))


def _partition_counts(spark: SparkSession, sf_dir: str, transform: str):
    spec = ORDERS.with_layout((f"{transform}(o_orderdate)",), ("o_orderdate", "o_orderkey"))
    store = orders_store(spark, f"part-{transform}", spec)
    store.append(spec.identifier, orders_rows(spark, sf_dir, spec))
    name = spec.partition_columns[0]
    return store.read_storage(spec.identifier).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


@register("partition_years", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_years, count(*) AS n FROM orders GROUP BY 1
""")
def partition_years(spark: SparkSession, sf_dir: str):
    return _partition_counts(spark, sf_dir, "years")


@register("partition_months", """
SELECT strftime(o_orderdate, '%Y-%m') AS o_orderdate_months, count(*) AS n FROM orders GROUP BY 1
""")
def partition_months(spark: SparkSession, sf_dir: str):
    return _partition_counts(spark, sf_dir, "months")


@register("partition_days", """
SELECT CAST(o_orderdate AS DATE) AS o_orderdate_days, count(*) AS n FROM orders GROUP BY 1
""")
def partition_days(spark: SparkSession, sf_dir: str):
    return _partition_counts(spark, sf_dir, "days")


# The upsert batch: every open order (urgent/high ones repriced) plus the
# pending orders re-keyed as new orders.
UPSERT_BATCH_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'P'
"""


def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders_rows(spark, sf_dir)
    changed = o.filter(F.col("o_orderstatus") == "O").withColumn(
        "o_totalprice", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")))
    new = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    return changed.unionByName(new)


def upserted(spark: SparkSession, sf_dir: str, purpose: str):
    """Table seeded with every order (append), then the batch upserted."""
    store = orders_store(spark, purpose)
    store.append(ORDERS.identifier, orders_rows(spark, sf_dir))
    result = store.upsert(ORDERS.identifier, upsert_batch(spark, sf_dir))
    return store, result


@register("upsert_merge", f"""
WITH batch AS ({UPSERT_BATCH_SQL})
SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM orders t FULL JOIN batch b ON t.o_orderkey = b.o_orderkey
""")
def upsert_merge(spark: SparkSession, sf_dir: str):
    """All orders stored, then an upsert of repriced + new orders; the table read back."""
    store, _ = upserted(spark, sf_dir, "upsert")
    return finish(store.read(ORDERS.identifier))


MERGED_SQL = """
SELECT o.o_orderkey, coalesce(b.o_custkey, o.o_custkey) AS o_custkey, coalesce(b.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
       coalesce(b.o_totalprice, o.o_totalprice) AS o_totalprice, coalesce(b.o_orderdate, o.o_orderdate) AS o_orderdate,
       coalesce(b.o_orderpriority, o.o_orderpriority) AS o_orderpriority
FROM stored o LEFT JOIN batch b ON o.o_orderkey = b.o_orderkey
UNION ALL
SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored o WHERE o.o_orderkey = b.o_orderkey)
"""


@register("upsert_duplicate_target", f"""
WITH batch AS ({UPSERT_BATCH_SQL}), stored AS (SELECT {ORDER_COLUMNS} FROM orders UNION ALL SELECT {ORDER_COLUMNS} FROM orders)
{MERGED_SQL}
""")
def upsert_duplicate_target(spark: SparkSession, sf_dir: str):
    """Every order stored twice (two appends), then the upsert: both rows of a key take the batch's values,
    new keys go in once."""
    store = orders_store(spark, "upsert-twice")
    for _ in range(2):
        store.append(ORDERS.identifier, orders_rows(spark, sf_dir))
    store.upsert(ORDERS.identifier, upsert_batch(spark, sf_dir))
    return finish(store.read(ORDERS.identifier))


@register("upsert_moving_partition", f"""
WITH batch AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 1 YEAR AS o_orderdate, o_orderpriority
               FROM orders WHERE o_orderstatus = 'O'), stored AS (SELECT {ORDER_COLUMNS} FROM orders)
{MERGED_SQL}
""")
def upsert_moving_partition(spark: SparkSession, sf_dir: str):
    """Open orders put off by a year: their keys stay, their partition (by year) does not."""
    store = orders_store(spark, "upsert-moving")
    rows = orders_rows(spark, sf_dir)
    store.append(ORDERS.identifier, rows)
    moved = rows.filter(F.col("o_orderstatus") == "O").withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 1 YEAR"))
    store.upsert(ORDERS.identifier, moved)
    return finish(store.read(ORDERS.identifier))


@register("upsert_large_batch", f"""
WITH batch AS ({UPSERT_BATCH_SQL}), stored AS (SELECT {ORDER_COLUMNS} FROM orders)
{MERGED_SQL}
""")
def upsert_large_batch(spark: SparkSession, sf_dir: str):
    """The upsert with no side small enough to be broadcast: both are shuffled."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        store, _ = upserted(spark, sf_dir, "upsert-large")
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return finish(store.read(ORDERS.identifier))


@register("upsert_counts", f"""
WITH batch AS ({UPSERT_BATCH_SQL})
SELECT count(*) FILTER (WHERE t.o_orderkey IS NULL) AS rows_inserted,
       count(*) FILTER (WHERE t.o_orderkey IS NOT NULL AND (
         t.o_custkey IS DISTINCT FROM b.o_custkey OR t.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR
         t.o_totalprice IS DISTINCT FROM b.o_totalprice OR t.o_orderdate IS DISTINCT FROM b.o_orderdate OR
         t.o_orderpriority IS DISTINCT FROM b.o_orderpriority)) AS rows_updated
FROM batch b LEFT JOIN orders t ON t.o_orderkey = b.o_orderkey
""")
def upsert_counts(spark: SparkSession, sf_dir: str):
    """Inserted / updated counts of the upsert (unchanged matches are not counted)."""
    _, result = upserted(spark, sf_dir, "upsert-counts")
    return spark.range(1).select(F.lit(result.rows_inserted).cast("long").alias("rows_inserted"),
                                 F.lit(result.rows_updated).cast("long").alias("rows_updated"))


@register("schema_conform", """
SELECT CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_returnflag, l_extendedprice
FROM lineitem
""")
def schema_conform(spark: SparkSession, sf_dir: str):
    """Reorder by name and cast (int -> bigint, whole doubles -> bigint with a
    lossless check, timestamp_ntz -> timestamp)."""
    target = table_spec("raw.lineitem_conformed", {
        "l_shipdate": datetime, "l_linenumber": int, "l_orderkey": int, "l_quantity": int,
        "l_returnflag": str, "l_extendedprice": float}).schema
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                "l_returnflag", "l_shipdate")
    return finish(conform(li, target))


@register("select_new", f"""
SELECT {ORDER_COLUMNS} FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderpriority = '1-URGENT' AND e.o_orderkey = o.o_orderkey)
""")
def select_new_query(spark: SparkSession, sf_dir: str):
    """Backfill: urgent orders are stored; the batch is every order; only rows
    whose identity is not stored are appended (read back from the table)."""
    from tidemark.plans.jobs import backfill_job
    from tidemark.quality import not_empty, time_in_window, unique
    store = orders_store(spark, "select-new")
    rows = orders_rows(spark, sf_dir)
    existing = rows.filter(F.col("o_orderpriority") == "1-URGENT")
    store.append(ORDERS.identifier, existing)
    checks = [not_empty(), time_in_window("o_orderdate", datetime(1990, 1, 1), datetime(2010, 1, 1)),
              unique("o_orderkey")]
    backfill_job(store, ORDERS.identifier, rows, ORDERS.identity, checks=checks)
    stored = store.read(ORDERS.identifier)
    return finish(select_new(stored, existing.select("o_orderkey"), ORDERS.identity))


def news_store(spark: SparkSession, items: DataFrame) -> TableStore:
    """Store document-derived news items (first per hash, so keys are unique) in
    ``raw.market_news_items``."""
    store = TableStore(spark, scratch_path(spark, "news"), {MARKET_NEWS_ITEMS.identifier: MARKET_NEWS_ITEMS})
    append_news(store, items)
    return store


def append_news(store: TableStore, items: DataFrame) -> None:
    from tidemark.operators.dedup import first_wins
    firsts = items.join(first_wins(items.select("content_hash", "doc_id"), "content_hash", ["doc_id"]), ["content_hash", "doc_id"], "left_semi")
    rows = firsts.select(
        F.col("lang").alias("source_url"), "content_hash", F.col("source").alias("source_name"),
        F.lit(None).cast("string").alias("source_domain"), F.lit("document").alias("source_type"),
        F.lit(None).cast("long").alias("reliability_tier"), F.lit(None).cast("timestamp").alias("published_at"),
        F.lit(None).cast("timestamp").alias("fetched_at"), F.lit("").alias("title"),
        F.col("text").alias("summary_raw"), F.lit(None).cast("string").alias("content_raw"),
        F.lit(SOURCE_UPDATED_AT).cast("timestamp").alias("source_updated_at"))
    store.append(MARKET_NEWS_ITEMS.identifier, rows)
