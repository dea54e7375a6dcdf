"""User-facing pipelines, each one Spark job (or one per configured table)."""

from tidelake.plans.cleansed import raw_to_cleansed, repair_raw
from tidelake.plans.ingest import ingest_tables
from tidelake.plans.landing import land_files, pickup_files
from tidelake.plans.query import query_table

__all__ = ["raw_to_cleansed", "repair_raw", "ingest_tables", "land_files", "pickup_files",
           "query_table"]
