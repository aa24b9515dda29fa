from metricforge.sources.tables import TABLES, load, loader, register_views
from metricforge.sources.files import read_csv, read_jdbc, normalize_headers
from metricforge.sources.layout import bucketed, lookup, sorted_copy
from metricforge.sources.sinks import write_table
from metricforge.sources.zipped import read_zip

__all__ = ["TABLES", "load", "loader", "register_views", "read_csv", "read_jdbc", "normalize_headers", "write_table",
           "bucketed", "lookup", "sorted_copy", "read_zip"]
