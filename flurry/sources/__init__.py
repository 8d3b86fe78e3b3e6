from flurry.sources.catalog import (append_metrics, describe_table, list_tables, read_table,
                                   read_table_or_csv, save_once, save_table_if_absent)
from flurry.sources.files import read_binary, read_csv, read_parquet, write_csv
from flurry.sources.records import from_json_records, to_json_records
from flurry.sources.schemas import CHURN_SCHEMA, METRIC_LOG_SCHEMA
from flurry.sources.tables import TABLES, table

__all__ = [
    "append_metrics", "describe_table", "list_tables", "read_table", "read_table_or_csv",
    "save_once", "save_table_if_absent", "read_binary", "read_csv", "read_parquet",
    "write_csv", "from_json_records", "to_json_records", "CHURN_SCHEMA",
    "METRIC_LOG_SCHEMA", "TABLES", "table",
]
