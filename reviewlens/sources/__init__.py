"""Sources and sinks: driver tables, review views over them, CSV in, Parquet out."""

from reviewlens.sources.csv import land_parquet, read_reviews_csv, write_reviews_csv
from reviewlens.sources.fixtures import reviews_scale, reviews_view
from reviewlens.sources.tables import read_table

__all__ = [
    "land_parquet",
    "read_reviews_csv",
    "write_reviews_csv",
    "reviews_scale",
    "reviews_view",
    "read_table",
]
