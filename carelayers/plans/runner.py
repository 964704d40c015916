"""Writes the layers of chosen tables: raw, cleaned, result."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from carelayers.operators.clean import mostly_null
from carelayers.operators.reports import null_profile_of
from carelayers.plans import inputs, observations, outputs, prescriptions, procedures
from carelayers.sources.layers import read_layer, shuffles_dropped, write_counted, write_layer


@dataclass(frozen=True)
class TablePlan:
    """How one result is made.

    ``raw`` tables are written as bronze unless ``plain``; each name in ``silver`` makes a cleaned
    layer from its bronze one; ``gold`` gets the most refined layer of every raw table, in order,
    then the results named in ``after``. With ``drop_sparse`` the cleaning step is told which columns
    are mostly NULL, as counted while bronze was written.
    """

    raw: tuple[str, ...]
    gold: Callable[..., DataFrame]
    silver: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    after: tuple[str, ...] = ()
    plain: bool = False
    drop_sparse: bool = False


PLANS: dict[str, TablePlan] = {
    "cptevents": TablePlan(
        ("cptevents",),
        procedures.gold_cptevents,
        {"cptevents": procedures.silver_cptevents},
    ),
    "procedures_icd": TablePlan(
        ("procedures_icd",),
        procedures.gold_procedures_icd,
        {"procedures_icd": procedures.silver_procedures_icd},
    ),
    "procedureevents_mv": TablePlan(
        ("procedureevents_mv",),
        procedures.gold_procedureevents_mv,
        {"procedureevents_mv": procedures.silver_procedureevents_mv},
        drop_sparse=True,
    ),
    "d_cpt": TablePlan(("d_cpt",), procedures.gold_d_cpt),
    "d_icd_procedures": TablePlan(("d_icd_procedures",), procedures.gold_d_icd_procedures),
    "outputevents": TablePlan(
        ("outputevents",),
        outputs.gold_outputevents,
        {"outputevents": outputs.silver_outputevents},
    ),
    "diagnoses_icd": TablePlan(
        ("diagnoses_icd", "d_icd_diagnoses"),
        outputs.gold_diagnoses_icd,
        {
            "diagnoses_icd": outputs.silver_diagnoses_icd,
            "d_icd_diagnoses": outputs.silver_d_icd_diagnoses,
        },
    ),
    "inputevents_cv": TablePlan(
        ("inputevents_cv",),
        inputs.gold_inputevents_cv,
        {"inputevents_cv": inputs.silver_inputevents_cv},
    ),
    "inputevents_mv": TablePlan(
        ("inputevents_mv",),
        inputs.gold_inputevents_mv,
        {"inputevents_mv": inputs.silver_inputevents_mv},
    ),
    "unified_inputevents": TablePlan(
        (), inputs.gold_unified_inputevents, after=("inputevents_cv", "inputevents_mv")
    ),
    "prescriptions": TablePlan(
        ("prescriptions",),
        prescriptions.gold_prescriptions,
        {"prescriptions": prescriptions.silver_prescriptions},
    ),
    "chart_events_named": TablePlan(
        ("chartevents", "d_items"), observations.chart_events_named, plain=True
    ),
    "lab_events_named": TablePlan(
        ("labevents", "d_labitems"), observations.lab_events_named, plain=True
    ),
    "microbiology_clean": TablePlan(
        ("microbiologyevents",), observations.microbiology_clean, plain=True
    ),
    "clinical_observation": TablePlan(
        (),
        observations.clinical_observation,
        after=("chart_events_named", "lab_events_named"),
        plain=True,
    ),
}


#: Results written at the same time: the jobs of one fill the cores that the end of another's leaves idle.
AT_ONCE = 4


def _result_layer(name: str) -> str | None:
    return None if PLANS[name].plain else "gold"


def _tables_of(name: str) -> set[str]:
    return {name, *PLANS[name].raw, *PLANS[name].after}


def run_table(
    spark: SparkSession,
    name: str,
    raw: Mapping[str, DataFrame],
    root: str,
    files: Callable[[str], int | None] = lambda table: None,
) -> list[tuple[str, str, int]]:
    """Write every layer of one result; return the layers written, in order, and their rows.

    The NULL profile of each bronze table is counted by its write and kept as layer ``profile``.
    """
    plan = PLANS[name]
    written: list[tuple[str, str, int]] = []
    refined: list[DataFrame] = []
    for table in plan.raw:
        df = raw[table]
        known = {}
        if not plan.plain:
            total, filled = write_counted(df, root, "bronze", table, files(table), df.columns)
            write_layer(null_profile_of(spark, total, filled), root, "profile", table, 1)
            df = read_layer(spark, root, "bronze", table)
            written.append(("bronze", table, total))
            if plan.drop_sparse:
                known = {"sparse": mostly_null(total, filled)}
        if table in plan.silver:
            cleaned = plan.silver[table](df, **known)
            written.append(("silver", table, write_layer(cleaned, root, "silver", table, files(table))))
            df = read_layer(spark, root, "silver", table)
        refined.append(df)
    refined += [read_layer(spark, root, _result_layer(other), other) for other in plan.after]
    rows = write_layer(plan.gold(*refined), root, _result_layer(name), name, files(name))
    written.append((_result_layer(name) or "result", name, rows))
    return written


def run_tables(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    tables: Iterable[str] | None = None,
    partitions: int | None = None,
    dictionary_partitions: int | None = None,
) -> DataFrame:
    """Write the chosen results (all by default); return the rows of every layer, in order.

    An unknown name is refused before anything is written. A result built on other results
    expects them below ``root``, written now or earlier. Up to ``AT_ONCE`` results are written at the
    same time, but one that reads or writes what another does waits for the one named first. If one
    fails, those not begun are left out. Rows are those counted by the writes; nothing is read again for them.
    What a query has shuffled is dropped when it ends.
    ``partitions`` fixes the number of files of each table, ``dictionary_partitions`` that of
    dictionaries; by default Spark decides.
    """
    chosen = list(PLANS) if tables is None else list(tables)
    unknown = [name for name in chosen if name not in PLANS]
    if unknown:
        raise ValueError(f"unknown tables {unknown}; known: {list(PLANS)}")

    def files(table: str) -> int | None:
        return dictionary_partitions if table.startswith("d_") else partitions

    def write(name: str, earlier: list[Future]) -> list[tuple[str, str, int]]:
        for run in earlier:
            run.result()
        return run_table(spark, name, raw, root, files)

    runs: list[tuple[str, Future]] = []
    with shuffles_dropped(spark), ThreadPoolExecutor(AT_ONCE) as pool:
        for name in chosen:
            earlier = [run for other, run in runs if _tables_of(other) & _tables_of(name)]
            runs.append((name, pool.submit(inheritable_thread_target(spark)(write), name, earlier)))
        try:
            layers = [layer for _, run in runs for layer in run.result()]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise
    return spark.createDataFrame(layers, "layer string, table string, rows bigint")
