"""One run from raw files to a checked warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from mercastar.operators.profiling import validate_all
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.quality import run_checks, verdict
from mercastar.plans.staging import stored_staging, write_staging
from mercastar.plans.warehouse import Warehouse
from mercastar.schemas import SOURCES
from mercastar.sources.csv_files import read_sources
from mercastar.sources.sinks import read_parquet, write_parquet
from mercastar.sources.versions import current, loading


@dataclass
class RunResult:
    warehouse: Warehouse
    staging: dict[str, DataFrame]
    warnings: list[str] = field(default_factory=list)
    checks: DataFrame | None = None
    success: bool = False


def land(
    spark: SparkSession, sources: Mapping[str, DataFrame], folder: str
) -> dict[str, DataFrame]:
    """Store the typed sources as Parquet, so that text is parsed once per run."""
    out = {}
    for name, df in sources.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_parquet(df, path)
        out[name] = read_parquet(spark, path, SOURCES[name])
    return out


def run(
    spark: SparkSession,
    source_folder: str,
    target_folder: str,
    parameters: ReportParameters | None = None,
    files: dict[str, str] | None = None,
    loaded_at: datetime | None = None,
    location_fraction: float | None = None,
) -> RunResult:
    """Extract, validate, stage, build the star schema, check it.

    Warnings about the sources never stop a run, and failed checks only show in
    the result. Orders and items of the star schema come from the sources, since
    staging drops repeated ones that the fact keeps; customers, products and sellers
    come from staging. All locations are read, unless `location_fraction` is given.

    All tables belong to one new version of the target folder, which is published at the
    end: a run that stops earlier leaves the tables of the run before as they were.
    """
    parameters = parameters or ReportParameters()
    read = read_sources(spark, source_folder, files, location_fraction)
    with loading(spark, target_folder) as target:
        sources = land(spark, read, f"{target}/raw")
        warnings = validate_all(sources)
        staging = write_staging(spark, sources, f"{target}/staging", loaded_at)
        warehouse = Warehouse(sources, folder=f"{target}/warehouse", staging=staging)
        warehouse.load()
        path = f"{target}/quality"
        write_parquet(run_checks(warehouse, staging, parameters), path)
        checks = spark.read.parquet(path)
        success = verdict(checks).first()["success"]
    return RunResult(warehouse, staging, warnings, checks, success)


def stored_run(spark: SparkSession, target_folder: str) -> RunResult:
    """The tables and checks of the last run that ended; warnings are not stored."""
    target = current(spark, target_folder)
    checks = spark.read.parquet(f"{target}/quality")
    return RunResult(
        Warehouse.stored(spark, f"{target}/warehouse"),
        stored_staging(spark, f"{target}/staging"),
        checks=checks,
        success=verdict(checks).first()["success"],
    )
