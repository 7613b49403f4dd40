from skyfold.sinks.tables import (
    BucketedTable,
    Layout,
    bucketed_table,
    clustered,
    create_view,
    register_view,
    replace_years,
    write_dimension,
    write_table,
)

__all__ = [
    "BucketedTable",
    "Layout",
    "bucketed_table",
    "clustered",
    "create_view",
    "register_view",
    "replace_years",
    "write_dimension",
    "write_table",
]
