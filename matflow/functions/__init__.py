from matflow.functions.aggregates import exact_total, fraction, strict_sum, whole_part
from matflow.functions.casts import blank_to_null, code_to_text, tolerant_date, tolerant_double
from matflow.functions.keys import (
    composite_key,
    dash_key,
    remove_char,
    replace_char,
    split_fixed,
    split_regex,
    strip_leading_zeros,
)
from matflow.functions.nulls import null_propagating_max, null_to_zero
from matflow.functions.predicates import (
    has_excluded_prefix,
    is_castable,
    is_finished_good,
    is_raw_material,
    keeps_description,
)

__all__ = [
    "blank_to_null",
    "code_to_text",
    "composite_key",
    "dash_key",
    "exact_total",
    "fraction",
    "has_excluded_prefix",
    "is_castable",
    "is_finished_good",
    "is_raw_material",
    "keeps_description",
    "null_propagating_max",
    "null_to_zero",
    "remove_char",
    "replace_char",
    "split_fixed",
    "split_regex",
    "strict_sum",
    "strip_leading_zeros",
    "tolerant_date",
    "tolerant_double",
    "whole_part",
]
