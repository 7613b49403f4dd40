from skyfold.plans.bounds import Earlier, last_passed, run_bounded
from skyfold.plans.facts import (
    FACTS,
    VARIANTS,
    Dimensions,
    fact_from_observations,
    fact_from_partials,
)
from skyfold.plans.jobs import (
    backfill_years,
    build_facts,
    built_tables,
    check_facts,
    check_sources,
    check_tables,
    ingest_dimensions,
    ingest_year,
    read_fact,
    read_facts,
    store_results,
)
from skyfold.plans.ledger import catch_up, mark_built, pending_years
from skyfold.plans.models import Model, Models, fact_models
from skyfold.plans.suites import MODEL_CHECKS, fact_checks, monthly_invariants, raw_checks

__all__ = [
    "FACTS",
    "MODEL_CHECKS",
    "VARIANTS",
    "Dimensions",
    "Earlier",
    "Model",
    "Models",
    "backfill_years",
    "build_facts",
    "built_tables",
    "catch_up",
    "check_facts",
    "check_sources",
    "check_tables",
    "fact_checks",
    "fact_models",
    "fact_from_observations",
    "fact_from_partials",
    "ingest_dimensions",
    "ingest_year",
    "last_passed",
    "mark_built",
    "monthly_invariants",
    "pending_years",
    "raw_checks",
    "read_fact",
    "read_facts",
    "run_bounded",
    "store_results",
]
