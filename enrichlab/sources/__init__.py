"""Sources: parquet tables, fixture views over the driver tables, and parameterised scans."""

from enrichlab.sources.fixtures import fx_attribute, fx_funnel, fx_predictions, fx_scored, fixture_views
from enrichlab.sources.scans import (
    ExtractParams,
    cache_result,
    load_leads,
    scan_attribute,
    scan_funnel,
    scan_predictions,
    write_parquet,
)
from enrichlab.sources.tables import read_table

__all__ = [
    "ExtractParams", "cache_result", "fixture_views", "fx_attribute", "fx_funnel", "fx_predictions",
    "fx_scored", "load_leads", "read_table", "scan_attribute", "scan_funnel", "scan_predictions",
    "write_parquet",
]
