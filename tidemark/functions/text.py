"""Text scalars: content hash, URL host, ids, slugs, secret redaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Secret redaction patterns and parameters.
ASSIGN_PATTERN = r"(?i)\b(api[_-]?key|access[_-]?token|token|secret|signature|password|key)=([^&\s\"'<>]+)"
BEARER_PATTERN = r"(?i)(bearer\s+)[A-Za-z0-9._\-]+"
REDACTED = "***"
MIN_SECRET_LEN = 8


def content_hash(url: Column, title: Column, summary: Column) -> Column:
    """sha256 hex of ``url \\n title \\n coalesce(summary, '')``."""
    return F.sha2(F.concat(url, F.lit("\n"), title, F.lit("\n"), F.coalesce(summary, F.lit(""))), 256)


def url_netloc(url: Column) -> Column:
    """Authority part of a URL (with user and port) or null."""
    host = F.try_parse_url(url, F.lit("AUTHORITY"))
    return F.when(F.length(host) > 0, host)


def composite_id(*parts: Column, sep: str = ":") -> Column:
    return F.concat_ws(sep, *parts)


def symbol(instrument: Column, counterpart: Column) -> Column:
    return F.concat(instrument, counterpart)


def strip_ws(c: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(c, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def trimmed_or_empty(c: Column) -> Column:
    return strip_ws(F.coalesce(c, F.lit("")))


def _java_quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def redact(text: Column, secret_values: Sequence[str] = ()) -> Column:
    """Mask ``key=value`` secrets, bearer tokens and known literal values (longest first)."""
    out = F.regexp_replace(text, ASSIGN_PATTERN, f"$1={REDACTED}")
    out = F.regexp_replace(out, BEARER_PATTERN, f"$1{REDACTED}")
    secrets = sorted({s for s in secret_values if len(s) >= MIN_SECRET_LEN}, key=len, reverse=True)
    if secrets:
        out = F.regexp_replace(out, "|".join(_java_quote(s) for s in secrets), REDACTED)
    return out
