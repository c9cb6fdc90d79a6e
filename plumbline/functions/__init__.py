from plumbline.functions.dates import DATE_MACROS, register_date_macros
from plumbline.functions.params import bind_conditions, condition_parameters, register_filter
from plumbline.functions.scalars import canonical_json, minutes_between, parse_timestamp, slug, split_list

__all__ = [
    "DATE_MACROS",
    "bind_conditions",
    "canonical_json",
    "condition_parameters",
    "minutes_between",
    "parse_timestamp",
    "register_date_macros",
    "register_filter",
    "slug",
    "split_list",
]
