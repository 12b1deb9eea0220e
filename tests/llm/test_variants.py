"""Spelling variants against a brute-force version over awkward rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scholarlake.llm import variants

from .fixtures import awkward_texts, prose


def one_edit(v: str, w: str) -> bool:
    if len(v) > len(w):
        v, w = w, v
    if len(v) == len(w):
        return sum(a != b for a, b in zip(v, w)) == 1
    return len(w) - len(v) == 1 and any(w[:i] + w[i + 1 :] == v for i in range(len(w)))


def brute(rows: list[tuple[int | None, str | None]], shortest: int = 5, least: int = 3, every: int = 97) -> list[tuple]:
    counts: Counter[str] = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= least}
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w: str) -> str:
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def misspelled(rng: random.Random, w: str) -> str:
    at, kind = rng.randrange(len(w)), rng.randrange(3)
    return w[:at] + (rng.choice("abcéß") if kind else "") + w[at + (kind != 2) :]


def rows_of(seed: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    stems = ["heading", "überall", "aaaaa", "aaaaaa", "abababab", "naïveté", "×÷×÷×", "Straßen", "reading", "leading", "x" * 150, "ab" * 70 + "c"]
    words = [*stems, *(misspelled(rng, rng.choice(stems)) for _ in range(60))]
    words += [misspelled(rng, w) for w in words]
    texts = [" ".join(rng.choice(words) if rng.random() < 0.8 else rng.choice(words).upper() for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += awkward_texts() + ["日本überall語heading\x00heading", "Āheadingā heading’heading"] * 3
    return [(rng.choice([None, 0, *range(40)]), t) for t in texts]


def got(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("every", [97, 3])
def test_variants_equal_brute_force(spark, every):
    rows = rows_of(1)
    docs = spark.createDataFrame([(i, t, "w", 5, "r") for i, t in rows], "doc_id long, text string, word string, n int, root string").repartition(3)
    want = brute(rows, every=every)
    assert sum(w[1] is not None for w in want) > 20 and any(w[2] not in (w[0], w[1]) for w in want)
    assert got(variants.spelling_variants(docs, every=every)) == want


def test_partitions_divided_again_and_blocks_equal_brute_force(spark, monkeypatch):
    rows = rows_of(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, every=5)
    monkeypatch.setattr(variants, "GROUP_WORDS", 3)
    monkeypatch.setattr(variants, "REST", 4)
    monkeypatch.setattr(variants, "COMBINE_BYTES", 40)
    assert got(variants.spelling_variants(docs, every=5)) == want


def test_a_common_beginning_of_a_third_of_all_words_is_divided(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = sorted({"conform" + "".join(rng.choice("abcd") for _ in range(rng.randint(4, 6))) for _ in range(900)} | {"".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(1500)})
    words = spark.createDataFrame([(w, rng.randint(3, 50)) for w in vocabulary], "word string, n long")
    monkeypatch.setattr(variants, "GROUP_WORDS", 50)
    found = {r["word"]: (r["n_near"], r["best"]) for r in variants.near_words(words).collect()}
    n = {r["word"]: r["n"] for r in words.collect()}
    for w in vocabulary:
        near = [v for v in vocabulary if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        assert found.get(w) == ((len(near), min(near, key=lambda v: (-n[v], v))) if near else None)


def test_composition_enumerates_each_pair_once():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(80)})
    acceptor = variants.Acceptor(words)
    pairs = acceptor.near(acceptor.start)
    assert len({frozenset(p) for p in pairs}) == len(pairs)
    assert {frozenset(p) for p in pairs} == {frozenset((v, w)) for v in words for w in words if v < w and one_edit(v, w)}
    assert sorted(acceptor.common(acceptor.start, acceptor.start)) == words
    trie = len({w[:i] for w in words for i in range(len(w) + 1)})
    assert len(acceptor.final) < 0.6 * trie  # minimal: equal states are one
    assert len({(f, *e.items()) for f, e in zip(acceptor.final, acceptor.edges)}) == len(acceptor.final)


def test_chains_of_forms_end_at_their_roots(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("v", "w7"), ("w40", None), ("z", None)]
    roots = {r["word"]: r["root"] for r in variants.with_roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert roots == {w: "w40" for w, f in chain if f}


def test_checksums_equal_the_library():
    rng = random.Random(6)
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in (1, 5, 64, 65, 200, 3, 7)]
    lengths = np.array([len(w) for w in words])
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(words))], np.uint32)
    got = variants._crc32(np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths, before)
    assert got.tolist() == [zlib.crc32(f"{i}:".encode() + w) for i, w in enumerate(words)]


def test_variants_of_no_words(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert variants.spelling_variants(spark.createDataFrame([(1, None), (None, ""), (2, "a bc 12 ,")], "doc_id long, text string")).count() == 0


def test_long_text_in_blocks(spark, monkeypatch):
    rng = random.Random(7)
    text = prose(rng, 3000) + " " + "q" * 500
    monkeypatch.setattr(variants, "COMBINE_BYTES", 1000)
    docs = [(1, text), (2, text), (3, text)]
    assert got(variants.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)
