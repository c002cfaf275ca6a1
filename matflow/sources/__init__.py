from matflow.sources.grid import (
    detect_headers,
    drop_leading_rows,
    header_scores,
    named_sheet,
    promote_header,
    promote_header_per_run,
)
from matflow.sources.manifests import drop_unused, publish_set, read_manifest, read_set, read_tables_of_set
from matflow.sources.published import publish, publish_tables, read_published, read_tables
from matflow.sources.records import (
    ACCEPTED,
    REJECTED,
    as_of_from_path,
    checked_records,
    publish_checked,
    read_checked,
    read_numbered_lines,
    read_record_lines,
)
from matflow.sources.schemas import SOURCES, TABLES, enforce
from matflow.sources.snapshots import select_snapshot
from matflow.sources.workbooks import WorkbookSource, read_workbooks, write_workbooks

__all__ = [
    "ACCEPTED",
    "REJECTED",
    "SOURCES",
    "TABLES",
    "WorkbookSource",
    "as_of_from_path",
    "checked_records",
    "detect_headers",
    "drop_leading_rows",
    "drop_unused",
    "enforce",
    "header_scores",
    "named_sheet",
    "promote_header",
    "promote_header_per_run",
    "publish",
    "publish_checked",
    "publish_set",
    "publish_tables",
    "read_checked",
    "read_manifest",
    "read_numbered_lines",
    "read_published",
    "read_record_lines",
    "read_set",
    "read_tables",
    "read_tables_of_set",
    "read_workbooks",
    "select_snapshot",
    "write_workbooks",
]
