"""Relational building blocks: every function maps DataFrames to a DataFrame."""

from metricfold.operators.aggregates import (
    column_totals,
    count_by,
    count_non_null,
    mean_from_parts,
    mean_parts,
    merge_sums,
    share_of_total,
    sum_by,
    union_parts,
)
from metricfold.operators.increment import after, as_of, bounds, bounds_frame
from metricfold.operators.joins import (
    attach,
    attach_where,
    limit_then_join,
    merge_join,
    roll_up,
    side_by_side,
    with_dimension,
)
from metricfold.operators.projections import drop_incomplete, only_zero, project, rename_all
from metricfold.operators.ranking import (
    position_within,
    rank_spread,
    rank_within,
    sort_all,
    top_n,
    top_per_group,
)
from metricfold.operators.reductions import Reduction, reduced, reduced_together, unpacked
from metricfold.operators.skew import attach_spread, hot_keys
from metricfold.operators.validate import MissingColumnsError, require_columns, require_tables

__all__ = [
    "MissingColumnsError", "Reduction", "after", "as_of", "attach", "attach_spread", "attach_where", "bounds", "bounds_frame", "column_totals",
    "count_by", "count_non_null", "drop_incomplete", "limit_then_join", "mean_from_parts",
    "mean_parts", "merge_join", "merge_sums", "only_zero", "position_within",
    "hot_keys", "project", "rank_spread", "rank_within", "reduced", "reduced_together", "rename_all", "require_columns", "require_tables",
    "roll_up", "share_of_total", "side_by_side", "sort_all", "sum_by", "top_n", "top_per_group", "union_parts",
    "unpacked", "with_dimension",
]
