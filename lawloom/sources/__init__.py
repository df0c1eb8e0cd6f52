from lawloom.sources.json_root import (
    explode_root,
    explode_root_text,
    read_bills,
    read_root_json,
    read_staged_json,
    root_elements,
    root_schema,
    stage_root_json,
)
from lawloom.sources.split_json import read_split_json
from lawloom.sources.tables import texts_to_classify

__all__ = [
    "explode_root",
    "explode_root_text",
    "read_bills",
    "read_root_json",
    "read_split_json",
    "read_staged_json",
    "root_elements",
    "root_schema",
    "stage_root_json",
    "texts_to_classify",
]
