"""Landed JSON payloads -> rows.

Payloads are landed as files (one page per file) and read with
``sources.registry.read_landed`` (whole-file text, ``dt`` pruning); the parsing below is
pure Column logic (``from_json`` with a declared schema, ``explode``), so it runs
in whole-stage codegen on the executors and scales with the number of pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import try_cast
from tidemark.operators.conform import bad_row_flag


def payload_rows(df: DataFrame, payload: str | Column, schema: T.DataType | str, path: Sequence[str] = (),
                 *, keep: Sequence[str] = (), position: str | None = "pos") -> DataFrame:
    """Parse ``payload`` with ``schema`` and explode the array found under ``path``.

    A missing path gives no rows.  A page that is there but is no JSON (cut off, an error page) gives
    one row whose ``item`` is null, so that whatever the source requires of an item is missing and the
    strict test sees the page; sources that forgive drop it by ``item is not null``.  The element
    position is kept (payload order matters for "latest" rules)."""
    payload_col = F.col(payload) if isinstance(payload, str) else payload
    node = F.from_json(payload_col, schema)
    for step in path:
        node = node.getField(step)
    node = F.when(broken(payload_col), F.array(F.get(node, F.lit(0)))).otherwise(node)
    keep_cols = [F.col(k) for k in keep]
    if position:
        return df.select(*keep_cols, F.posexplode(node).alias(position, "item"))
    return df.select(*keep_cols, F.explode(node).alias("item"))


def broken(payload: Column) -> Column:
    """True for a page that is there but cannot be read as JSON."""
    return payload.isNotNull() & F.try_parse_json(payload).isNull()


def element(arr: Column, i: int) -> Column:
    """0-based positional element; null past the end."""
    return F.get(arr, i)


def last_element(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


# Positional kline layout (index, name, type); index 11 is ignored.
KLINE_FIELDS = (
    (0, "open_time_ms", "long"),
    (1, "open", "double"),
    (2, "high", "double"),
    (3, "low", "double"),
    (4, "close", "double"),
    (5, "volume", "double"),
    (6, "close_time_ms", "long"),
    (7, "quote_asset_volume", "double"),
    (8, "number_of_trades", "long"),
    (9, "taker_buy_base_asset_volume", "double"),
    (10, "taker_buy_quote_asset_volume", "double"),
)
KLINE_LENGTH = 12
KLINE_SCHEMA = "array<array<string>>"


def kline_fields(arr: Column, flag: str = "_bad") -> list[Column]:
    """Typed columns of one positional kline plus a strict bad-row flag
    (wrong length or any unparsable field)."""
    cols = [try_cast(element(arr, i), t).alias(name) for i, name, t in KLINE_FIELDS]
    parsed = [try_cast(element(arr, i), t) for i, _, t in KLINE_FIELDS]
    bad = (F.size(arr) != KLINE_LENGTH) | bad_row_flag(parsed)
    return cols + [F.coalesce(bad, F.lit(True)).alias(flag)]
