from lawloom.sinks.commits import CommitLog, LostRaceError
from lawloom.sinks.files import remove, shared_dir, write_json, write_parquet
from lawloom.sinks.prepared import read_prepared, write_prepared
from lawloom.sinks.responses import read_responses, store_responses
from lawloom.sinks.snapshots import bucket_folders, compact, create_tables, latest_version, read_table, upsert, vacuum
from lawloom.sinks.streams import upsert_stream

__all__ = [
    "CommitLog",
    "LostRaceError",
    "bucket_folders",
    "compact",
    "create_tables",
    "latest_version",
    "read_prepared",
    "read_responses",
    "read_table",
    "remove",
    "shared_dir",
    "store_responses",
    "upsert",
    "upsert_stream",
    "vacuum",
    "write_json",
    "write_parquet",
    "write_prepared",
]
