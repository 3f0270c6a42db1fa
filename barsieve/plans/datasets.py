"""The quality job: which datasets are checked, and from where to where."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from barsieve.functions.declared import column_specs
from barsieve.operators.quality import check
from barsieve.sources.csv import read_metadata
from barsieve.sources.published import publish
from barsieve.sources.tables import overwrite

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Dataset:
    """A dataset to check: chosen by the name of its metadata file, read and written by the caller's settings.

    Its rows are read once: they are written to `stage` (or the shared folder) with the rules that they break, and both
    results come from there. So a CSV scan need not stage what it parses. The results replace the tables that `failed`
    and `passed` name, one after the other, or are published together, as `failed` and `passed`, in `folder`.
    """

    name: str
    metadata_file: str
    read: Callable[[SparkSession], DataFrame]
    source_name: str
    target_name: str
    failed: dict[str, str] = field(default_factory=dict)
    passed: dict[str, str] = field(default_factory=dict)
    stage: str | None = None
    folder: str | None = None


def run_dataset(spark: SparkSession, dataset: Dataset, metadata_path: str) -> None:
    """Check one dataset and replace its failure report and its table of passed rows."""
    rows = dataset.read(spark)
    specs = column_specs(read_metadata(spark, metadata_path), rows.columns)
    result = check(rows, specs, dataset.source_name, dataset.target_name).staged(dataset.stage)
    if dataset.folder is not None:
        publish(spark, dataset.folder, {"failed": result.failed, "passed": result.passed_null_key})
        return
    overwrite(result.failed, **dataset.failed)
    overwrite(result.passed_null_key, **dataset.passed)


def run_listed(spark: SparkSession, listing: Iterable[str], datasets: list[Dataset]) -> dict[str, str | None]:
    """Run every dataset whose metadata file is in the listing; other files are ignored.

    A dataset that fails does not stop the others. Returns the error text per dataset that ran, or None.
    """
    outcome: dict[str, str | None] = {}
    for path in listing:
        for dataset in datasets:
            if path.rsplit("/", 1)[-1] != dataset.metadata_file:
                continue
            try:
                run_dataset(spark, dataset, path)
                outcome[dataset.name] = None
            except Exception as error:
                log.exception("dataset %s failed", dataset.name)
                outcome[dataset.name] = f"{type(error).__name__}: {error}"
    return outcome
