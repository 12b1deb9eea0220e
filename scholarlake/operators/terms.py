"""Texts that hold any of many terms, in one pass."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of terms that one automaton is built from; more terms take several passes of the texts.
TERM_BYTES = 8 << 20


def _blocks(terms: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for t in terms:
        if block and size + len(t.encode()) > TERM_BYTES:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t.encode())
    if block:
        yield block


def term_matches(df: DataFrame, columns: list[str], terms: list[str], key: str = "article_id") -> DataFrame:
    """Distinct keys of rows with any of the terms in any of the columns, ignoring case: what domain_matches gives for few terms.

    A multi-pattern automaton reads each text once, however many terms there are. Terms are a parameter of the run, as in
    domain_matches; they are sent to the tasks in blocks of bounded size. A text's search ends at its first hit.
    """
    lowered = df.select(key, *(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(f"_t{i}") for i, c in enumerate(columns)))
    hits = None
    for block in _blocks(sorted({t.lower() for t in terms if t})):

        def search(batches: Iterator[pa.RecordBatch], block: list[str] = block) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for t in block:
                automaton.add_word(t)
            automaton.make_automaton()
            for batch in batches:
                texts = zip(*(batch.column(f"_t{i}").to_pylist() for i in range(len(columns))))
                hit = [any(next(automaton.iter(t), None) is not None for t in row) for row in texts]
                yield pa.RecordBatch.from_arrays([batch.column(key).filter(pa.array(hit))], names=[key])

        part = lowered.mapInArrow(search, f"`{key}` {df.schema[key].dataType.simpleString()}")
        hits = part if hits is None else hits.unionByName(part)
    return df.select(key).limit(0) if hits is None else hits.distinct()
