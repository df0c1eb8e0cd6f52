from lawloom.functions.dates import may_be_between, parse_iso_date, parse_timestamp
from lawloom.functions.structs import flatten
from lawloom.functions.text import (
    blank_if_null,
    drop_leaders,
    fold_case,
    is_annex_title,
    is_boilerplate,
    is_page_number,
    normalize_line,
    null_if_blank,
    split_collapsed_lines,
    split_lines,
    strip,
    tokenize,
)

__all__ = [
    "blank_if_null",
    "drop_leaders",
    "flatten",
    "fold_case",
    "is_annex_title",
    "is_boilerplate",
    "is_page_number",
    "may_be_between",
    "normalize_line",
    "null_if_blank",
    "parse_iso_date",
    "parse_timestamp",
    "split_collapsed_lines",
    "split_lines",
    "strip",
    "tokenize",
]
