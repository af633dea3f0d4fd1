from termtide.sinks.writers import (
    observe_records,
    output_name,
    preprocessed_output,
    record_counts,
    run_summary,
    write_csv,
    write_json,
    write_parquet,
)

__all__ = [
    "observe_records",
    "output_name",
    "preprocessed_output",
    "record_counts",
    "run_summary",
    "write_csv",
    "write_json",
    "write_parquet",
]
