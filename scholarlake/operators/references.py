"""What a set of rows depends on, over foreign keys that are given as data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.sources.scratch import stored


@dataclass(frozen=True)
class Reference:
    """Rows of `table` name, in `column`, a row of `to` by its key; with `follows`, they are kept with the row that they name."""

    table: str
    column: str
    to: str
    follows: bool = False


def _strata(tables: dict[str, DataFrame], references: tuple[Reference, ...], start: dict[str, DataFrame]) -> list[set[str]]:
    """Tables that reach each other, in an order in which no table reaches one before it.

    Rows that come by one reference alone, which they follow, name by it only what is kept.
    """
    comes = [n for n in start] + [r.to for r in references] + [r.table for r in references if r.follows]
    reach = {n: {n} for n in tables}
    for _ in tables:
        for r in references:
            for a, b in (*([] if r.follows and comes.count(r.table) == 1 else [(r.table, r.to)]), *([(r.to, r.table)] if r.follows else [])):
                for n in tables:
                    if a in reach[n]:
                        reach[n] |= reach[b]
    strata = {frozenset(m for m in reach[n] if n in reach[m]) for n in tables}
    return [set(s) for s in sorted(strata, key=lambda s: (-len(reach[min(s)]), min(s)))]


def _closed(tables: dict[str, DataFrame], keys: dict[str, list[str]], references: tuple[Reference, ...], start: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Kept keys and kept rows of every table.

    Tables that reach each other go round, the others are looked at once, when all that leads to them is known. Rows that only
    follow rows of one table are found by its kept keys whenever they are read, and are neither written nor looked up again.
    """
    for r in references:
        if len(keys[r.to]) != 1:
            raise ValueError(f"{r.to} is named by {r.table}.{r.column} and has keys {keys[r.to]}")
    kept: dict[str, DataFrame] = {}
    rows: dict[str, DataFrame] = {}
    for stratum in _strata(tables, references, start):
        found: dict[str, list[DataFrame]] = {n: [df.select(*keys[n]).dropna()] for n, df in start.items() if n in stratum}
        named = [r for r in references if r.to in stratum and r.table in kept]
        followed = [r for r in references if r.follows and r.table in stratum and r.to in kept]
        inner = [r for r in references if r.table in stratum and r.to in stratum]
        if len(stratum) == 1 and not found and not named and not inner and len(followed) == 1:
            r = followed[0]
            rows[r.table] = tables[r.table].dropna(subset=keys[r.table]).join(kept[r.to].select(F.col(keys[r.to][0]).alias(r.column)), r.column, "left_semi").select(*tables[r.table].columns)
            kept[r.table] = rows[r.table].select(*keys[r.table]).distinct()
            continue
        for r in named:
            found.setdefault(r.to, []).append(rows[r.table].select(F.col(r.column).alias(keys[r.to][0])).dropna())
        for r in followed:
            found.setdefault(r.table, []).append(tables[r.table].join(kept[r.to].select(F.col(keys[r.to][0]).alias(r.column)), r.column, "left_semi").select(*keys[r.table]))
        parts: dict[str, list[DataFrame]] = {n: [] for n in stratum}
        while found:
            fresh = {}
            for n, frames in found.items():
                new = reduce(DataFrame.unionByName, frames).distinct().join(tables[n].select(*keys[n]), keys[n], "left_semi")
                for old in parts[n]:
                    new = new.join(old, keys[n], "left_anti")
                new = stored(new)
                if not new.isEmpty():
                    fresh[n] = new
                    parts[n].append(new)
            found = {}
            for r in inner:
                if r.table in fresh:
                    held = tables[r.table].join(fresh[r.table], keys[r.table], "left_semi")
                    found.setdefault(r.to, []).append(held.select(F.col(r.column).alias(keys[r.to][0])).dropna())
                if r.follows and r.to in fresh:
                    ends = fresh[r.to].select(F.col(keys[r.to][0]).alias(r.column))
                    found.setdefault(r.table, []).append(tables[r.table].join(ends, r.column, "left_semi").select(*keys[r.table]))
        for n in stratum:
            kept[n] = reduce(DataFrame.unionByName, parts[n], tables[n].select(*keys[n]).limit(0))
            rows[n] = tables[n].join(kept[n], keys[n], "left_semi").select(*tables[n].columns)
    return kept, rows


def closure(tables: dict[str, DataFrame], keys: dict[str, list[str]], references: tuple[Reference, ...], start: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Kept keys of every table: those of `start`, whatever kept rows name, and rows that follow kept rows; cycles are allowed.

    Semi-naive: a round looks only at the keys that the last one added, and its new keys are written once. Tables that are named by
    others have one key column; link tables may have several.
    """
    return _closed(tables, keys, references, start)[0]


def subset(tables: dict[str, DataFrame], keys: dict[str, list[str]], references: tuple[Reference, ...], start: dict[str, DataFrame], whole: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The rows of every table in the closure of `start`; tables of `whole` come in full."""
    rows = _closed(tables, keys, references, start)[1]
    return {n: df if n in whole else rows[n] for n, df in tables.items()}
