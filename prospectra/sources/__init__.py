from prospectra.schemas import CUSTOMERS, NONCUSTOMERS, REQUESTS, TABLE_SPECS, USAGE, TableSpec
from prospectra.sources.readers import (
    read_csv_table,
    read_customers,
    read_noncustomers,
    read_usage,
    scan_order,
)
from prospectra.sources.scratch import materialize, new_scratch_path, scratch_run
from prospectra.sources.writers import (
    append_metrics,
    write_importance,
    write_predictions,
    write_quarantine,
    write_removed_rows,
    write_splits,
)

__all__ = [
    "CUSTOMERS",
    "NONCUSTOMERS",
    "REQUESTS",
    "TABLE_SPECS",
    "TableSpec",
    "USAGE",
    "append_metrics",
    "materialize",
    "new_scratch_path",
    "read_csv_table",
    "read_customers",
    "read_noncustomers",
    "read_usage",
    "scan_order",
    "scratch_run",
    "write_importance",
    "write_predictions",
    "write_quarantine",
    "write_removed_rows",
    "write_splits",
]
