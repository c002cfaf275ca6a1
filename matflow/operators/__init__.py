from matflow.operators.frames import (
    clean_names,
    clean_name_list,
    infer_types,
    inferred_types,
    ordinal_rename,
    project_drop,
    project_positional,
    relocate_cols,
    rename_cols,
    union_by_name,
)
from matflow.operators.grouping import distinct_rows, group_sum_strict
from matflow.operators.inference import TYPES, cast_columns, merge_masks, type_masks, types_of
from matflow.operators.lookups import (
    broadcast_if_small,
    duplicate_keys,
    fits_broadcast,
    join_bom_forecast,
    join_campus_numeric,
    join_campus_text,
    join_mfg_map,
    label_items,
    lookup_join,
    manufacturer_keys,
    semi_join_labels,
)
from matflow.operators.reshape import (
    month_names,
    month_positions,
    pivot_all_months,
    pivot_months,
    scale_month_vector,
    unpivot_hold_status,
)

__all__ = [
    "TYPES",
    "broadcast_if_small",
    "cast_columns",
    "clean_name_list",
    "clean_names",
    "distinct_rows",
    "duplicate_keys",
    "fits_broadcast",
    "group_sum_strict",
    "infer_types",
    "inferred_types",
    "join_bom_forecast",
    "join_campus_numeric",
    "join_campus_text",
    "join_mfg_map",
    "label_items",
    "lookup_join",
    "manufacturer_keys",
    "merge_masks",
    "month_names",
    "month_positions",
    "ordinal_rename",
    "pivot_all_months",
    "pivot_months",
    "project_drop",
    "project_positional",
    "relocate_cols",
    "rename_cols",
    "scale_month_vector",
    "semi_join_labels",
    "type_masks",
    "types_of",
    "union_by_name",
    "unpivot_hold_status",
]
