from skyfold.operators.lookup import BROADCAST_LIMIT_BYTES, Lookup
from skyfold.operators.quality import (
    Check,
    QualityError,
    column_set,
    gate,
    no_rows_where,
    not_null,
    run_suite,
    unique,
)
from skyfold.operators.rollup import merge_partials, roll_up
from skyfold.operators.staging import (
    pivot_elements,
    rename_to_stored,
    sample,
    stage_countries,
    stage_stations,
    station_countries,
    union_years,
)

__all__ = [
    "BROADCAST_LIMIT_BYTES",
    "Check",
    "Lookup",
    "QualityError",
    "column_set",
    "gate",
    "merge_partials",
    "no_rows_where",
    "not_null",
    "pivot_elements",
    "rename_to_stored",
    "roll_up",
    "run_suite",
    "sample",
    "stage_countries",
    "stage_stations",
    "station_countries",
    "union_years",
    "unique",
]
