"""Writing results: tables, incremental appends and delivered CSV files."""
from adspark.sinks.export import (
    export_csv, export_paged, page_of, report_path, route, with_placeholder)
from adspark.sinks.tables import append_changed, append_new, current, reading, refresh_table, rows_to_append, vacuum
