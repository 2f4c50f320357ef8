"""Writers: Parquet, CSV and Avro datasets in the chunk layout, and run metrics."""
