from shelfcast.sources.readers import canonicalise, read_dimension, read_promotions, read_sales
from shelfcast.sources.sinks import publish_tables, replace_file, write_csv, write_jdbc
from shelfcast.sources.star import promotions_from_star, sales_from_star

__all__ = [
    "canonicalise",
    "promotions_from_star",
    "publish_tables",
    "read_dimension",
    "read_promotions",
    "read_sales",
    "replace_file",
    "sales_from_star",
    "write_csv",
    "write_jdbc",
]
