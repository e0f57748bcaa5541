"""Readers and writers: landed JSON, seeds, the test-table adapter, table writes."""

from casewatch.sources.adapter import ADAPTER_LABELS, ADAPTER_STATES, raw_from_lineitem
from casewatch.sources.landing import flatten, land_raw, read_landed
from casewatch.sources.seeds import disease_list, load_seeds, us_holidays
from casewatch.sources.tables import append_raw, materialise, table_exists, write_table

__all__ = [
    "ADAPTER_LABELS", "ADAPTER_STATES", "append_raw", "disease_list", "flatten", "land_raw",
    "load_seeds", "materialise", "raw_from_lineitem", "read_landed", "table_exists",
    "us_holidays", "write_table",
]
