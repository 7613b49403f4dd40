"""Tables declared by what they are made of.

A model names its inputs, sources or other models, and says how it is computed from them. Building some models builds what depends
on them too, inputs first, reads the rest as it is published, and publishes one new version once all checks hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from skyfold.operators.quality import Check, gate, run_suite
from skyfold.operators.rollup import merge_partials, roll_up
from skyfold.plans.facts import FACTS, Dimensions, fact_from_partials
from skyfold.plans.suites import declared_checks
from skyfold.sinks.publish import Files, aside
from skyfold.sinks.tables import Layout, write_table
from skyfold.sinks.versions import Snapshot, Staged, current, publish


@dataclass(frozen=True)
class Model:
    """``compute`` gets a frame for each input, in order. Without a layout the model is a view: computed where it is read, never stored.

    ``arrange`` is that of ``write_table``: a model whose rows lie spread over many tasks already need not be shuffled once more.
    """

    name: str
    inputs: tuple[str, ...]
    compute: Callable[..., DataFrame]
    layout: Layout | None = None
    checks: tuple[Check, ...] = ()
    arrange: str = "spread"


class Models:
    """Declared models over named sources. Cycles, doubled names and inputs that nothing declares are refused."""

    def __init__(self, sources: Iterable[str], models: Iterable[Model]) -> None:
        declared = list(models)
        self.sources = tuple(sources)
        self.by_name = {m.name: m for m in declared}
        names = [*self.sources, *(m.name for m in declared)]
        if twice := sorted({n for n in names if names.count(n) > 1}):
            raise ValueError(f"declared more than once: {twice}")
        if unknown := sorted({i for m in declared for i in m.inputs} - set(names)):
            raise ValueError(f"inputs that nothing declares: {unknown}")
        sorter = TopologicalSorter({m.name: m.inputs for m in declared})
        try:
            sorter.prepare()
        except CycleError as cycle:
            raise ValueError(f"models depend on each other: {' -> '.join(cycle.args[1])}") from None
        #: Models by the longest way to them from the sources: those of one wave need nothing of each other.
        self.waves: list[list[str]] = []
        while sorter.is_active():
            ready = sorter.get_ready()
            sorter.done(*ready)
            if wave := [n for n in ready if n in self.by_name]:
                self.waves.append(wave)
        self.order = [n for wave in self.waves for n in wave]

    def with_dependents(self, names: Iterable[str]) -> list[str]:
        """The models that are, or are made from, any of ``names``, sources among them; inputs first."""
        reached = set(names)
        if unknown := sorted(reached - set(self.by_name) - set(self.sources)):
            raise ValueError(f"unknown: {unknown}")
        for name in self.order:
            if reached & set(self.by_name[name].inputs):
                reached.add(name)
        return [n for n in self.order if n in reached]

    def build(self, spark: SparkSession, base: str, sources: dict[str, DataFrame], changed: Iterable[str] | None = None) -> Snapshot:
        """Build all models, or those that ``changed`` ones and sources reach, into the set of tables at ``base``.

        Stored models are written aside and read from there by those made from them. Models that need nothing of each other are
        built side by side, so that small ones do not wait for the last tasks of large ones. Readers see all new tables or none.
        """
        if missing := sorted(set(self.sources) - set(sources)):
            raise ValueError(f"sources without a frame: {missing}")
        began, new = current(spark, base), aside(base)
        wanted = self.order if changed is None else self.with_dependents(changed)
        frames, staged, checked = dict(sources), {}, []

        def make(name: str) -> DataFrame:
            model = self.by_name[name]
            if model.layout is not None and name not in wanted:
                if name not in began.tables:
                    raise ValueError(f"{name} is not built yet; build all models first")
                return began.read(name)
            frame = model.compute(*[frames[i] for i in model.inputs])
            if model.layout is None:
                return frame
            path, schema = f"{new}/{name}", frame.schema
            write_table(frame, path, model.layout, arrange=model.arrange)
            if model.layout.by_year and "year" not in schema.names:
                schema = StructType([*schema, StructField("year", IntegerType())])
            staged[name] = Staged(path, schema, model.layout.by_year)
            return spark.read.schema(schema).parquet(path)

        try:
            for wave in self.waves:
                with ThreadPoolExecutor(max_workers=len(wave)) as pool:
                    frames |= zip(wave, pool.map(make, wave), strict=True)
            for name in self.order:
                if self.by_name[name].checks and name in wanted:
                    checked.append(run_suite(frames[name], self.by_name[name].checks, name))
            if checked:
                gate(reduce(DataFrame.unionAll, checked))
            return publish(began, staged)
        finally:
            Files(spark).delete(new)

    def read(self, spark: SparkSession, base: str, name: str) -> DataFrame:
        """A published model, with the column ``year`` of its folders if it is stored by year."""
        return current(spark, base).read(name)


def fact_models(variant: str = "exact") -> Models:
    """The partials and the five facts, from ``observations``, ``stations`` and ``countries``.

    ``build_facts`` makes the same tables for long histories: in batches of years, bucketed, with refreshes of single years.
    """
    partials = Layout(cluster=("id", "date"))
    per_input = {"stations_daily": "partials/daily", "stations_monthly": "partials/monthly"}

    def fact(name: str) -> Model:
        def compute(rows: DataFrame, stations: DataFrame, countries: DataFrame) -> DataFrame:
            return fact_from_partials(name, rows, Dimensions.of(stations, countries), variant, at_grain=name in per_input)

        inputs = (per_input.get(name, "partials/monthly"), "stations", "countries")
        # Facts at the partials' grain come in the order of their files, and a year's facts from tasks of all stations.
        arrange = "spread" if FACTS[name].per_country else "keep"
        return Model(name, inputs, compute, FACTS[name].layout(variant), tuple(declared_checks(name, variant)), arrange)

    return Models(
        ("observations", "stations", "countries"),
        [
            # Grouping has spread the rows evenly by id and date: a second shuffle, by year, would only make fewer files.
            Model("partials/daily", ("observations",), lambda rows: roll_up(rows, ["id"], "day"), partials, arrange="keep"),
            Model("partials/monthly", ("partials/daily",), lambda rows: merge_partials(rows, ["id"], "month"), partials, arrange="keep"),
            *[fact(name) for name in FACTS],
        ],
    )
