"""Sources and sinks: raw table readers and the star-schema holder."""

from revlens.sources.raw import read_jdbc, read_table, table_path
from revlens.sources.star import PL_ROWS, Star

__all__ = ["PL_ROWS", "Star", "read_jdbc", "read_table", "table_path"]
