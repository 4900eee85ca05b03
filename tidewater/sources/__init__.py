"""Sources: message streams, paced generator, Parquet lake, CSV, object listings."""
