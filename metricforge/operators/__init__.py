from metricforge.operators.aggregates import (
    value_counts, with_share, topk, mode_by_group, null_profile, duplicate_summary,
    duplicate_rows, distinct_values, wide_totals, describe,
)
from metricforge.operators.audit import join_audit, lost_by_key
from metricforge.operators.distinct_cube import build_cube, count_cube, numbered, roll_up
from metricforge.operators.heavy import top_values
from metricforge.operators.percentiles import (
    Limit, limit_scalars, quantile_scalars, quantiles, quantiles_long, trim_percentile,
    with_quantiles,
)
from metricforge.operators.outliers import (
    iqr_fences, flag_outliers, outlier_share, box_stats, histogram,
)
from metricforge.operators.stats import safe_corr, corr_long, category_codes, chi_square, cramers_v
from metricforge.operators.phi import phi_matrix
from metricforge.operators.profile import file_states, merged_profile
from metricforge.operators.steps import Steps
from metricforge.operators.retention import day_pairs, first_dates, retention, retention_from_activity
from metricforge.operators.impute import fill_group_mean, drop_null, fill_const
from metricforge.operators.joins import join_null_safe

__all__ = [
    "value_counts", "with_share", "topk", "mode_by_group", "null_profile", "duplicate_summary",
    "duplicate_rows", "distinct_values", "wide_totals", "describe",
    "Limit", "limit_scalars", "quantile_scalars", "quantiles", "quantiles_long",
    "trim_percentile", "with_quantiles",
    "iqr_fences", "flag_outliers", "outlier_share", "box_stats", "histogram",
    "safe_corr", "corr_long", "category_codes", "chi_square", "cramers_v",
    "day_pairs", "first_dates", "retention", "retention_from_activity",
    "fill_group_mean", "drop_null", "fill_const",
    "join_null_safe",
    "join_audit", "lost_by_key", "build_cube", "count_cube", "numbered", "roll_up", "top_values", "phi_matrix",
    "file_states", "merged_profile", "Steps",
]
