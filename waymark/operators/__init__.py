from .aggregate import (
    averages_long,
    column_stats,
    count_by,
    group_avg,
    group_count,
    row_count,
    table_summary,
    window_sum,
)
from .clean import (
    drop_columns,
    drop_incomplete_rows,
    extend_rows,
    fill_and_cast,
    keep_null,
    keep_where,
    numeric_columns,
    project,
    rename_all,
    rename_columns,
    select_exprs,
    with_parsed_timestamp,
    with_random_int,
    with_ratio,
    with_split_field,
)
from .model import fit_fare_model, load_model, score, store_model, trip_features
from .pairing import full_outer_pair, full_outer_stored, prepare_pair
from .profile import (
    column_list,
    correlation_matrix,
    describe_long,
    describe_text,
    histogram,
    null_profile,
    table_shape,
)
from .ranking import (
    both_ends,
    end_groups,
    extreme_groups,
    extremes_union,
    merged_counts,
    sorted_projection,
    top_k,
    top_k_series,
)
from .sampling import hash_sample, point_set, seeded_sample
from .synth import (
    extend_cities,
    extract_columns,
    extract_packed_places,
    synth_cities,
    synth_names,
    with_city_attributes,
)
from .trips import TripColumns, trip_endpoints, trip_legs

__all__ = [
    "TripColumns",
    "averages_long",
    "both_ends",
    "column_list",
    "column_stats",
    "correlation_matrix",
    "count_by",
    "describe_long",
    "describe_text",
    "drop_columns",
    "drop_incomplete_rows",
    "end_groups",
    "extend_cities",
    "extend_rows",
    "extract_columns",
    "extract_packed_places",
    "extreme_groups",
    "extremes_union",
    "fill_and_cast",
    "fit_fare_model",
    "full_outer_pair",
    "full_outer_stored",
    "group_avg",
    "group_count",
    "hash_sample",
    "histogram",
    "keep_null",
    "keep_where",
    "load_model",
    "merged_counts",
    "null_profile",
    "numeric_columns",
    "point_set",
    "prepare_pair",
    "project",
    "rename_all",
    "rename_columns",
    "row_count",
    "score",
    "seeded_sample",
    "select_exprs",
    "sorted_projection",
    "store_model",
    "synth_cities",
    "synth_names",
    "table_shape",
    "table_summary",
    "top_k",
    "top_k_series",
    "trip_endpoints",
    "trip_features",
    "trip_legs",
    "window_sum",
    "with_city_attributes",
    "with_parsed_timestamp",
    "with_random_int",
    "with_ratio",
    "with_split_field",
]
