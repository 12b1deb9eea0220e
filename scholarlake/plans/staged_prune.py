"""A prune of versioned tables in stages, each of which is one commit, so that a run that broke goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from scholarlake.operators import closure, selection
from scholarlake.sources.versioned import Conflict, VersionedTables


def _kept_name(run: str, table: str) -> str:
    return f"kept_{run}_{table}"


def manifest_checksum(items: DataFrame) -> str:
    head = selection.set_checksum(items.select("article_id").distinct()).first()
    return f"{head['n']}:{head['checksum']}"


def _refuse_drift(store: VersionedTables, state: dict) -> None:
    """Tables whose stage is still to come must be those that the closure was taken from."""
    base, now = store.marker(state["base"])["tables"], store.marker()["tables"]
    changed = [s for s in state["stages"][state["sequence"] :] if base[s] != now.get(s)]
    if changed:
        raise Conflict(f"changed since the run began: {', '.join(changed)}")


def prune_report(store: VersionedTables, run: str) -> DataFrame:
    """table_name, total, keep, remove of each table that the run has pruned so far, from the markers' counts."""
    state = store.writer(run)
    before, now = store.counts(state["base"]), store.counts()
    rows = [(s, before[s], now[s], before[s] - now[s]) for s in state["stages"][: state["sequence"]]]
    return store.spark.createDataFrame(rows, "table_name string, total long, keep long, remove long")


def staged_prune(store: VersionedTables, items: DataFrame, run: str, confirm: str, protected: dict[str, DataFrame] | None = None, after: Callable[[str], None] = lambda stage: None) -> DataFrame:
    """Prune the newest tables to the closure of a manifest's items, and report; `confirm` must be PRUNE-<run>.

    The first commit holds the closure's kept keys, each later one a stage's table, children first, and the last follows the
    checks. Called again, a run that broke goes on after its last commit, and one that is done changes nothing. It is
    refused if the manifest or a table that is still to be pruned has changed since it began. `after` is called with each
    stage that has been committed.
    """
    if confirm != f"PRUNE-{run}":
        raise ValueError(f"confirm with PRUNE-{run}")
    checksum = manifest_checksum(items)
    state = store.writer(run)
    if state is None:
        base = store.version()
        tables = store.read(base)
        kept = closure.keep_sets(tables, items, protected)
        notes = {"base": base, "checksum": checksum, "kept": sorted(kept), "stages": [s for s in closure.PRUNE_STAGES if s in tables]}
        store.commit({_kept_name(run, n): df for n, df in kept.items()}, run, 0, notes)
        state = store.writer(run)
        after("closure")
    if state["checksum"] != checksum:
        raise Conflict("the manifest's checksum differs from the run's")
    stages, notes = state["stages"], {k: state[k] for k in ("base", "checksum", "kept", "stages")}
    if state["sequence"] > len(stages):
        return prune_report(store, run)
    kept_tables = store.read(names=[_kept_name(run, n) for n in state["kept"]])
    kept = {n: kept_tables[_kept_name(run, n)] for n in state["kept"]}
    for i, stage in enumerate(stages, 1):
        if i > state["sequence"]:
            _refuse_drift(store, store.writer(run))
            store.commit({stage: closure.prune(store.read(names=[stage]), kept)[stage]}, run, i, notes)
            after(stage)
    failed = [r["check_name"] for r in closure.verify_prune(store.read(names=stages), kept, items).where("not ok").collect()]  # one row for each table
    if failed:
        raise Conflict(f"after the prune: {', '.join(failed)}")
    store.commit({}, run, len(stages) + 1, notes)
    return prune_report(store, run)
