from skyfold.sources.inference import inferred_types, read_inferred_csv
from skyfold.sources.observations import (
    read_observations_csv,
    read_raw_csv,
    read_year_files,
    read_years,
    stored_years,
)
from skyfold.sources.stations import read_countries_txt, read_fixed_width, read_stations_txt
from skyfold.sources.tables import read_dimension, read_table, register_external

__all__ = [
    "inferred_types",
    "read_countries_txt",
    "read_dimension",
    "read_fixed_width",
    "read_inferred_csv",
    "read_observations_csv",
    "read_raw_csv",
    "read_stations_txt",
    "read_table",
    "read_year_files",
    "read_years",
    "register_external",
    "stored_years",
]
