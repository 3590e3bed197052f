"""Reading and writing: CSV in and out, parquet tables of a data folder."""
