from curate.operators.analytics import (
    count_by,
    enrich,
    mean_and_sum_by,
    mean_by,
    running_max,
    top_k,
    top_n_per_group,
)
from curate.operators.changes import (
    as_of,
    classify_changes,
    history,
    merge_history,
    new_rows,
    upsert,
    write_upsert,
)
from curate.operators.clean import (
    apply_types,
    clamp_negative,
    fill_defaults,
    fill_with_mean,
    sentinel_to_null,
    with_audit_time,
    with_flag,
)
from curate.operators.contracts import check_layout, in_order, schema_report
from curate.operators.dedup import (
    keep_one,
    repeated_keys,
    rows_with_repeated_keys,
    split_duplicates,
)
from curate.operators.drift import drift, drift_rules, histograms, merge_histograms
from curate.operators.profile import profile_columns, profile_stages, stage_counts
from curate.operators.rules import (
    check_rules,
    log_rules,
    rule_in_set,
    rule_matches,
    rule_not_null,
    rule_range,
    rule_references,
    rule_unique,
)
from curate.operators.ranges import last_known
from curate.operators.skew import HotLimits, fits_broadcast, join_unique

__all__ = [
    "HotLimits",
    "apply_types",
    "as_of",
    "check_layout",
    "check_rules",
    "clamp_negative",
    "classify_changes",
    "count_by",
    "drift",
    "drift_rules",
    "enrich",
    "fill_defaults",
    "fill_with_mean",
    "fits_broadcast",
    "histograms",
    "history",
    "in_order",
    "join_unique",
    "keep_one",
    "last_known",
    "log_rules",
    "mean_and_sum_by",
    "mean_by",
    "merge_histograms",
    "merge_history",
    "new_rows",
    "profile_columns",
    "profile_stages",
    "repeated_keys",
    "rows_with_repeated_keys",
    "rule_in_set",
    "rule_matches",
    "rule_not_null",
    "rule_range",
    "rule_references",
    "rule_unique",
    "running_max",
    "schema_report",
    "sentinel_to_null",
    "split_duplicates",
    "stage_counts",
    "top_k",
    "top_n_per_group",
    "upsert",
    "with_audit_time",
    "with_flag",
    "write_upsert",
]
