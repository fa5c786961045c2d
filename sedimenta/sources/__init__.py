from sedimenta.sources.delimited import csv_columns, read_csv, source_exists, source_files
from sedimenta.sources.report_store import REPORT_SCHEMA, read_reports, write_report
from sedimenta.sources.snapshots import ConflictError
from sedimenta.sources.staging import staged
from sedimenta.sources.warehouse import Warehouse

__all__ = [
    "REPORT_SCHEMA",
    "ConflictError",
    "Warehouse",
    "csv_columns",
    "read_csv",
    "read_reports",
    "source_exists",
    "source_files",
    "staged",
    "write_report",
]
