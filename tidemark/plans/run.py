"""Run declared jobs: by name, or all of them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target

from tidemark.plans.ingest import run_ingest
from tidemark.plans.lake import Lake
from tidemark.plans.model import run_model
from tidemark.plans.specs import Ingest, Specs


def run_job(lake: Lake, specs: Specs, name: str) -> int:
    spec = specs[name]
    return run_ingest(lake, spec) if isinstance(spec, Ingest) else run_model(lake, spec)


def run_all(lake: Lake, specs: Specs, parallel: int = 1) -> dict[str, int]:
    """All ingests, then all models, as models read silver tables only. Rows per job.

    ``parallel`` jobs at a time share the cluster, each in a scheduler pool of its own, so that with
    ``spark.scheduler.mode=FAIR`` a long one does not hold up the others. Each writes its own table.
    """
    rows: dict[str, int] = {}

    def run_in_pool(name: str) -> int:
        lake.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return run_job(lake, specs, name)

    run = inheritable_thread_target(lake.spark)(run_in_pool)
    for group in (specs.ingests(), specs.models()):
        names = [s.name for s in group]
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            rows.update(zip(names, pool.map(run, names)))
    return rows
