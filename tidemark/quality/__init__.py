from tidemark.quality.checks import (
    Check,
    QualityError,
    Severity,
    accepted_values,
    aggregate_check,
    expression,
    frame_check,
    from_spec,
    in_range,
    matches_regex,
    not_empty,
    not_null,
    row_count_between,
    time_in_window,
    unique,
)
from tidemark.quality.report import (
    Finding,
    Report,
    report_ids,
    report_metrics,
    slug_col,
    subjects_catalog,
    with_check_ids,
)
from tidemark.quality.runner import check_frame, log_failures, report_frame, stats_frame, validate

__all__ = [
    "Check", "Finding", "QualityError", "Report", "Severity", "accepted_values", "aggregate_check", "check_frame",
    "expression", "frame_check", "from_spec", "in_range", "log_failures", "matches_regex", "not_empty",
    "not_null", "report_frame", "report_ids", "report_metrics", "row_count_between", "slug_col", "stats_frame", "subjects_catalog",
    "time_in_window", "unique", "validate", "with_check_ids",
]
