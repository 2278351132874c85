"""All operators, re-exported.  Each takes DataFrames and parameters and
returns a DataFrame; see the family modules for the plan notes."""

from quarry.operators.aggregates import (
    children_threshold,
    count_threshold,
    exact_length_count,
    two_entity_daily_diff,
    weekday_weekend_pivot,
)
from quarry.operators.graph import k_hop
from quarry.operators.prefix import dense_index, prefix_sums, top_values
from quarry.operators.ranking import (
    daily_max_ties,
    day_counts,
    max_above_max_avg,
    max_per_group_ties,
    percent_rank_of,
    percent_rank_totals,
    top_n_per_day,
    top_two_values_global,
    top_with_ties,
    traffic_percent_rank,
    traffic_top,
    two_sided_totals,
    two_sided_traffic_top1,
)
from quarry.operators.roles import (
    argmin_per_entity,
    match_points,
    semi_any_role,
    union_distinct_roles,
)
from quarry.operators.segments import sequence_scan
from quarry.operators.sequences import (
    consecutive_days,
    first_last_same,
    largest_gap,
    nth_exceeds_prior,
    strictly_increasing,
)
from quarry.operators.sets import (
    basket_intersect_except,
    basket_intersect_except_sets,
    rolling_dense_sum,
)
from quarry.operators.stars import (
    anti_join_spend,
    distinct_count_and_list,
    percentage_bonus,
    star_revenue_filtered,
    weekday_totals,
)

__all__ = [
    "anti_join_spend", "argmin_per_entity", "basket_intersect_except",
    "basket_intersect_except_sets", "children_threshold", "consecutive_days",
    "count_threshold", "daily_max_ties", "day_counts", "dense_index", "distinct_count_and_list",
    "exact_length_count", "first_last_same", "k_hop", "largest_gap",
    "match_points", "max_above_max_avg", "max_per_group_ties", "nth_exceeds_prior",
    "percent_rank_of", "percent_rank_totals", "percentage_bonus", "prefix_sums", "rolling_dense_sum", "semi_any_role",
    "sequence_scan", "star_revenue_filtered", "strictly_increasing", "top_n_per_day",
    "top_two_values_global", "top_values", "top_with_ties", "traffic_percent_rank", "traffic_top",
    "two_entity_daily_diff", "two_sided_totals", "two_sided_traffic_top1", "union_distinct_roles",
    "weekday_totals", "weekday_weekend_pivot",
]
