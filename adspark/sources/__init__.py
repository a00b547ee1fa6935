"""Reading tables, files and parameters into DataFrames."""
from adspark.sources.files import BadRowsError, read_csv, read_csv_tolerant, report_manifest
from adspark.sources.relations import map_rows, numbers, one_row, split_column, split_to_rows
from adspark.sources.scan import read_jdbc, read_table, scan_between_dim, scan_events
