from millwright.sources.files import CODEC, read_csv, read_csv_with_rejects, read_parquet, reject_reason, write_csv, write_parquet

__all__ = ["CODEC", "read_csv", "read_csv_with_rejects", "read_parquet", "reject_reason", "write_csv", "write_parquet"]
