"""Reading raw files, storing tables, and cutting lineage."""
