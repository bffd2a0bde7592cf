"""Sources and sinks: weekly CSV folders in, Parquet tables in and out."""
