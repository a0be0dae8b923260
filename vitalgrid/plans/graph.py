"""The model graph: names, what each model reads, and building them in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions.cleaning import filter_items
from vitalgrid.functions.time import DAY, block, index
from vitalgrid.operators.chunks import width_for
from vitalgrid.operators.grid import as_runs
from vitalgrid.operators.pivot import codes_of
from vitalgrid.plans import charted, fluids, infection, items, labs, respiratory, scores, stays
from vitalgrid.session import freed_shuffles, own_broadcasts, scratch_dir, settings, small_broadcasts

# name -> (plan, tables it reads)
MODELS: dict[str, tuple[Callable, tuple[str, ...]]] = {
    "icustay_times": (stays.icustay_times, ("icustays", "chartevents")),
    "icustay_hourly": (stays.icustay_hourly, ("icustay_times",)),
    "weight_durations": (stays.weight_durations, ("chartevents", "icustays")),
    "vitalsign": (charted.vitalsign, ("chartevents",)),
    "ventilator_setting": (charted.ventilator_setting, ("chartevents",)),
    "oxygen_delivery": (charted.oxygen_delivery, ("chartevents",)),
    "gcs": (charted.gcs, ("chartevents",)),
    "bg": (labs.bg, ("labevents", "chartevents")),
    "chemistry": (labs.chemistry, ("labevents",)),
    "enzyme": (labs.enzyme, ("labevents",)),
    "complete_blood_count": (labs.complete_blood_count, ("labevents",)),
    "urine_output": (fluids.urine_output, ("outputevents",)),
    "urine_output_rate": (
        fluids.urine_output_rate,
        ("icustays", "chartevents", "urine_output", "weight_durations"),
    ),
    "epinephrine": (fluids.epinephrine, ("inputevents",)),
    "norepinephrine": (fluids.norepinephrine, ("inputevents",)),
    "dopamine": (fluids.dopamine, ("inputevents",)),
    "dobutamine": (fluids.dobutamine, ("inputevents",)),
    "antibiotic": (infection.antibiotic, ("prescriptions", "icustays")),
    "ventilation": (respiratory.ventilation, ("ventilator_setting", "oxygen_delivery")),
    "suspicion_of_infection": (
        infection.suspicion_of_infection,
        ("antibiotic", "microbiologyevents"),
    ),
    "sofa": (
        scores.sofa,
        (
            "icustays", "icustay_times", "icustay_hourly", "bg", "ventilation", "vitalsign",
            "gcs", "enzyme", "chemistry", "complete_blood_count", "urine_output_rate",
            "epinephrine", "norepinephrine", "dopamine", "dobutamine",
        ),
    ),
    "sepsis3": (scores.sepsis3, ("sofa", "suspicion_of_infection")),
}

# Models read more than once, by several models or inside one plan.
SHARED = {
    "icustay_times",
    "ventilator_setting",
    "oxygen_delivery",
    "antibiotic",
    "suspicion_of_infection",
    # Long plans of their own: cut here so that each is optimised alone.
    "weight_durations",
    "urine_output_rate",
    "ventilation",
    "bg",
}


# Stored tables are read a few times and take room until the work is done: packed tight.
PACKED = "zstd"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
ROW_GROUP = 16 * 1024 * 1024  # of the files of one part: a task holds one for each part it writes


# What each model reads of the two event tables. The scores take one vital sign only.
READINGS: dict[str, dict[str, Callable[[], Iterable[int]]]] = {
    "chartevents": {
        "icustay_times": lambda: [items.HEART_RATE],
        "urine_output_rate": lambda: [items.HEART_RATE],
        "weight_durations": lambda: [items.WEIGHT_ADMIT, items.WEIGHT_DAILY],
        "vitalsign": charted.vital_codes,
        "sofa": lambda: charted.vital_codes(scores.VITALS_READ),
        "ventilator_setting": lambda: codes_of(items.VENTILATOR_SETTINGS),
        "oxygen_delivery": lambda: [*items.O2_FLOW_ITEMS, items.O2_DEVICE],
        "gcs": lambda: [items.GCS_MOTOR, items.GCS_VERBAL, items.GCS_EYES],
        "bg": lambda: [items.FIO2_CHARTED],
    },
    "labevents": {
        "bg": lambda: codes_of(items.BLOOD_GAS),
        "chemistry": lambda: codes_of(items.CHEMISTRY),
        "enzyme": lambda: codes_of(items.ENZYMES),
        "complete_blood_count": lambda: codes_of(items.BLOOD_COUNT),
    },
}


def item_groups(table: str, models: Iterable[str]) -> dict[int, int]:
    """Group number of every item of ``table`` that two or more of ``models`` between them read:
    items read by the same models share a group."""
    readers = {m: set(codes()) for m, codes in READINGS[table].items() if m in set(models)}
    if len(readers) < 2:
        return {}
    by_code = {c: tuple(sorted(m for m in readers if c in readers[m])) for c in set().union(*readers.values())}
    numbers = {group: n for n, group in enumerate(sorted(set(by_code.values())))}
    return {code: numbers[group] for code, group in by_code.items()}


class Parted:
    """A copy of an event table that holds one folder for each group of items read together."""

    def __init__(self, table: DataFrame, groups: Mapping[int, int], path: str):
        self._groups = dict(groups)
        pairs = [F.lit(x) for pair in sorted(self._groups.items()) for x in pair]
        tagged = filter_items(table, "itemid", self._groups).withColumn(
            "item_group", F.element_at(F.create_map(*pairs), F.col("itemid"))
        )
        # One pass over the table, without a shuffle or a sort of it: each task writes all groups at once.
        packed = tagged.write.option("compression", PACKED).option("parquet.block.size", ROW_GROUP)
        packed.partitionBy("item_group").parquet(path)
        schema = tagged.select(*table.columns, "item_group").schema
        self._frame = table.sparkSession.read.schema(schema).parquet(path)

    def holds(self, codes: Iterable[int]) -> bool:
        return set(codes) <= self._groups.keys()

    def rows(self, codes: Iterable[int]) -> DataFrame:
        groups = sorted({self._groups[c] for c in codes})
        rows = self._frame.where(F.col("item_group").isin(groups)).drop("item_group")
        return filter_items(rows, "itemid", codes)


class Tables(Mapping):
    """Bronze tables by name, and models derived from them on first use.

    With a ``store`` folder, tables several plans read are written there once and read back: they
    are not computed per reader, and losing an executor does not reach behind them. Without one
    every model is a single lazy plan.
    """

    def __init__(
        self,
        bronze: Mapping[str, DataFrame],
        store: str | None = None,
        parted: Mapping[str, Parted] | None = None,
    ):
        self._frames = dict(bronze)
        self._store = store
        self._parted = dict(parted or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            plan, _ = MODELS[name]
            frame = plan(self)
            self._frames[name] = self.keep(name, frame) if name in SHARED else frame
        return self._frames[name]

    def keep(self, name: str, frame: DataFrame) -> DataFrame:
        """A stage boundary: the same rows, read back from the store when there is one."""
        if self._store is None:
            return frame
        path = f"{self._store}/{name}"
        frame.write.mode("overwrite").option("compression", PACKED).parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path)

    def width(self, frame: DataFrame, keys: Iterable[str], t: str) -> int | None:
        """Block width for ordered work on a kept table: measured there, a day for lazy plans."""
        return DAY if self._store is None else width_for(frame, list(keys), t)

    def rows(self, frame: DataFrame) -> int | None:
        """Rows of a kept table, from the footers of its files; not known for lazy plans."""
        return None if self._store is None else frame.count()

    def narrow(self, name: str, columns: tuple[str, ...]) -> DataFrame:
        """A wide table restricted to some measures; reads only their items if not built yet."""
        if name in self._frames:
            return self._frames[name]
        plan, _ = MODELS[name]
        return plan(self, columns)

    def hourly_runs(self, width: int, reach: int) -> DataFrame:
        """The hourly grid by blocks: before it grows, or from its rows where it is built."""
        if "icustay_hourly" in self._frames:
            return as_runs(self["icustay_hourly"], "stay_id", width, reach)
        return MODELS["icustay_hourly"][0](self, width, reach)

    def scored_hours(self, width: int) -> DataFrame:
        """Hourly scores with the block of ``width`` hours (``_block``) they lie in, by which they are dealt
        if they are not built yet."""
        if "sofa" in self._frames:
            return self["sofa"].withColumn("_block", block(index("endtime", "hour"), width))
        return MODELS["sofa"][0](self, blocks=True)

    def hours(self, runs: DataFrame) -> int | None:
        """Hours of runs that rest on a kept table; not known for lazy plans."""
        return None if self._store is None else runs.agg(F.sum(F.col("_last") - F.col("_first") + 1)).first()[0] or 0

    def readings(self, table: str, codes: Iterable[int]) -> DataFrame:
        """Rows of some items of an event table, from the copy parted by items where there is one."""
        codes = list(codes)
        if table in self._parted and self._parted[table].holds(codes):
            return self._parted[table].rows(codes)
        return filter_items(self[table], "itemid", codes)

    def part(self, models: Iterable[str], workers: int = 2) -> dict[str, Parted]:
        """Read each event table once for all of ``models`` and write it by what they read together."""
        if self._store is None:
            return {}
        models = list(models)

        def write(table: str) -> tuple[str, Parted | None]:
            groups = item_groups(table, models)
            known = table in self._frames and groups
            return table, Parted(self[table], groups, f"{self._store}/{table}_by_item") if known else None

        most = max(len(set(item_groups(table, models).values())) for table in READINGS)
        spark = next(iter(self._frames.values())).sparkSession
        with settings(spark, {WRITERS: str(most)}), ThreadPoolExecutor(workers) as pool:
            self._parted |= {table: parted for table, parted in pool.map(write, READINGS) if parted}
        return self._parted

    def built(self) -> dict[str, DataFrame]:
        """The models derived so far."""
        return {name: frame for name, frame in self._frames.items() if name in MODELS}

    def prepare(self, name: str, workers: int = 4) -> None:
        """Write the shared tables below a model, independent ones side by side."""

        def build(n: str) -> None:
            if n in SHARED:
                self[n]

        order = build_order([name])
        with freed_shuffles(next(iter(self._frames.values())).sparkSession):
            self.part(readers_of(order, name))
            side_by_side([n for n in order if n != name], build, workers)

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)


def model(name: str, bronze: Mapping[str, DataFrame]) -> DataFrame:
    """One model as a lazy plan over bronze tables."""
    return Tables(bronze)[name]


def build_order(names: Iterable[str]) -> list[str]:
    """The named models and everything they need, parents first."""
    graph, todo = {}, list(names)
    while todo:
        name = todo.pop()
        if name in graph or name not in MODELS:
            continue
        parents = [p for p in MODELS[name][1] if p in MODELS]
        graph[name] = parents
        todo += parents
    return list(TopologicalSorter(graph).static_order())


def readers_of(order: Iterable[str], *wanted: str) -> set[str]:
    """Models of ``order`` that read event tables themselves: the scores take what they need of the
    vital signs, so that table is read in full only where it is wanted."""
    return {n for n in order if n != "vitalsign" or n in wanted}


def side_by_side(names: Iterable[str], build: Callable[[str], None], workers: int) -> None:
    """Call ``build`` for each model after its parents among ``names``, independent ones at once."""
    names = set(names)
    sorter = TopologicalSorter({n: [p for p in MODELS[n][1] if p in names] for n in names})
    sorter.prepare()

    def run(n: str) -> str:
        build(n)
        return n

    with ThreadPoolExecutor(workers) as pool:
        running = set()
        while sorter.is_active():
            running |= {pool.submit(run, n) for n in sorter.get_ready()}
            done, running = wait(running, return_when=FIRST_COMPLETED)
            sorter.done(*[f.result() for f in done])


def build_models(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    names: Iterable[str],
    database: str,
    comments: Mapping[str, Mapping[str, str]] | None = None,
    workers: int = 4,
) -> dict[str, DataFrame]:
    """Write models as tables, parents first and independent ones side by side; later models read
    the written tables.

    A written parent is computed once however many models read it, and nothing is recomputed
    through it when an executor is lost; what one plan reads several times is stored for it in the
    scratch folder. ``comments`` (model -> column -> text) are stored with the
    tables.
    """
    from vitalgrid.sources.tables import replace_table, with_comments

    frames = dict(bronze)
    order = build_order(names)
    small_broadcasts(spark)
    # Every model is built here, vital signs too, and the scores read them from their table.
    with freed_shuffles(spark):
        parted = Tables(bronze, scratch_dir(spark, "build_parts")).part(set(order) - {"sofa"})

    def build(name: str) -> None:
        plan, _ = MODELS[name]
        rows = plan(Tables(frames, scratch_dir(spark, f"build_{name}"), parted))
        rows = with_comments(rows, (comments or {}).get(name, {}))
        frames[name] = replace_table(spark, rows, database, name)

    try:
        with freed_shuffles(spark):
            side_by_side(order, build, workers)
    finally:
        own_broadcasts(spark)
    return {name: frames[name] for name in order}
