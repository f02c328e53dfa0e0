"""Table and stream operators for data that changes, written on the DataFrame API."""
