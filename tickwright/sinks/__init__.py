from tickwright.sinks.labelled import load_labelled, read_labelled
from tickwright.sinks.lines import change_lines, feature_fields, write_change_lines, write_day_lines, write_feature_csv
from tickwright.sinks.tables import (
    append_rows,
    jdbc_write_options,
    print_rows,
    print_stream,
    write_jdbc,
    write_new_version,
)
from tickwright.sinks.versions import VersionTaken, create_versions, forget_before, read_version, update_version

__all__ = [
    "VersionTaken",
    "append_rows",
    "change_lines",
    "create_versions",
    "feature_fields",
    "forget_before",
    "jdbc_write_options",
    "load_labelled",
    "print_rows",
    "print_stream",
    "read_labelled",
    "read_version",
    "update_version",
    "write_change_lines",
    "write_day_lines",
    "write_feature_csv",
    "write_jdbc",
    "write_new_version",
]
