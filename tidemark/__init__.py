"""tidemark: a Spark-native engine for ingesting, checking and storing daily
market and macro time series.

Layout:
    session      - SparkSession settings and the shared scratch/checkpoint folder
    spec         - typed table specifications (schema, identity, partition, sort)
    tables       - the seventeen table specifications
    functions/   - Column -> Column scalar helpers (time, numbers, text)
    sources/     - payload readers: JSON pages, positional arrays, HTML tables, feeds
    operators/   - windows, joins, aggregates, dedup, conform, run metrics
    quality/     - declarative checks, one-pass validation, reports, write gates
    store/       - keyed table I/O: projected read, append, upsert, re-layout
    plans/       - normaliser jobs, run and backfill jobs, driver-table queries
    streaming/   - Structured Streaming forms of the batch jobs
"""

__version__ = "0.1.0"
