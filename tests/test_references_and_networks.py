"""Closures over declared keys, many terms, and networks kept up to date, against plain versions."""

from __future__ import annotations

import random

import pytest

from scholarlake.operators import graph, references, resolve, terms
from scholarlake.plans import more_queries, registry


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_closure_follows_cycles_and_links(spark):
    rng = random.Random(1)
    papers = [(i, rng.choice([None, rng.randrange(60)]), rng.randrange(8)) for i in range(60)]  # cites at most one, itself included
    people = [(i, rng.choice([None, rng.randrange(40)])) for i in range(40)]  # taught by
    wrote = [(rng.randrange(60), rng.randrange(40)) for _ in range(50)] + [(3, 99), (98, 2)]
    tables = {
        "Paper": spark.createDataFrame(papers, "paper_id long, cites long, place long"),
        "Person": spark.createDataFrame(people, "person_id long, teacher long"),
        "Wrote": spark.createDataFrame(wrote, "paper_id long, person_id long"),
        "Place": spark.createDataFrame([(i,) for i in range(6)], "place_id long"),
        "Word": spark.createDataFrame([(1,)], "word_id long"),
    }
    keys = {"Paper": ["paper_id"], "Person": ["person_id"], "Wrote": ["paper_id", "person_id"], "Place": ["place_id"], "Word": ["word_id"]}
    R = references.Reference
    declared = (R("Paper", "cites", "Paper"), R("Paper", "place", "Place"), R("Person", "teacher", "Person"), R("Wrote", "paper_id", "Paper", follows=True), R("Wrote", "person_id", "Person"))
    start = [2, 3, 17, 500]
    kept = references.closure(tables, keys, declared, {"Paper": spark.createDataFrame([(i,) for i in start] + [(2,), (None,)], "paper_id long")})

    want = {"Paper": {i for i in start if i < 60}, "Person": set(), "Wrote": set(), "Place": set(), "Word": set()}
    before = None
    while before != (before := {n: len(v) for n, v in want.items()}):
        want["Paper"] |= {c for i, c, _ in papers if i in want["Paper"] and c is not None}
        want["Place"] |= {p for i, _, p in papers if i in want["Paper"] and p < 6}
        want["Wrote"] |= {w for w in wrote if w[0] in want["Paper"]}
        want["Person"] |= {b for _, b in want["Wrote"] if b < 40} | {t for i, t in people if i in want["Person"] and t is not None}
    assert {n: {r[0] if len(r) == 1 else tuple(r) for r in df.collect()} for n, df in kept.items()} == want
    assert all(df.count() == len(want[n]) for n, df in kept.items())
    out = references.subset(tables, keys, declared, {"Paper": tables["Paper"].where("paper_id = 2")}, whole=("Word",))
    assert out["Word"].count() == 1 and out["Paper"].columns == ["paper_id", "cites", "place"]
    with pytest.raises(ValueError, match="keys"):
        references.closure(tables, keys, (R("Paper", "cites", "Wrote"),), {})


def test_many_terms_equal_the_or_of_few(spark, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcä ") for _ in range(rng.randint(0, 40))) for _ in range(120)]
    df = spark.createDataFrame([(i % 100, rng.choice([None, t]), rng.choice([None, t.upper()])) for i, t in enumerate(texts)], "article_id long, title string, _t0 string").repartition(3)
    for words in (["ab", "CÄ", "", "a b c"], ["zz"], []):
        want = rows(resolve.domain_matches(df, ["title", "_t0"], [w.lower() for w in words if w]))
        assert rows(terms.term_matches(df, ["title", "_t0"], words)) == want
    many = sorted({"".join(rng.choice("abcä") for _ in range(5)) for _ in range(10_000)})
    held = lambda words: sorted(((i,) for i in {r["article_id"] for r in df.collect() if any(w in ((r["title"] or "") + "|" + (r["_t0"] or "").lower()) for w in words)}), key=str)
    assert rows(resolve.domain_matches(df, ["title", "_t0"], many)) == held(many)
    monkeypatch.setattr(terms, "TERM_BYTES", 500)  # several automata
    assert rows(terms.term_matches(df, ["title", "_t0"], many[:200])) == held(many[:200])


@pytest.mark.parametrize("block", [2, 4096])
def test_a_network_after_batches_equals_a_rebuild(spark, block):
    rng = random.Random(3)
    link = lambda n: [(0 if rng.random() < 0.4 else rng.randrange(1, 9), rng.randrange(14)) for _ in range(n)]  # noqa: E731 - group 0 is hot
    frame = lambda data: spark.createDataFrame(data, "g1 long, m1 long")
    now = set(link(40))
    counts = graph.cooccurrence(frame(sorted(now)), "g1", "m1")
    for _ in range(3):
        added, removed = link(15) + [(None, 3), (2, None)], rng.sample(sorted(now), 8) + [(50, 50)]
        added += [rng.choice(removed)]  # taken away and brought again
        counts = graph.update_cooccurrence(counts, frame(sorted(now)), frame(added * 2), frame(removed), "g1", "m1", block=block)
        counts = spark.createDataFrame(counts.collect(), "a long, b long, n long")
        now = (now - set(removed)) | {x for x in added if None not in x}
        assert rows(counts) == rows(graph.cooccurrence(frame(sorted(now)), "g1", "m1"))


def test_cooccurrence_takes_more_tasks_for_more_links(spark, monkeypatch):
    links = spark.createDataFrame([(i // 4, i % 7) for i in range(400)] + [(-1, i) for i in range(30)], "g1 long, m1 long")
    want = rows(graph.cooccurrence(links, "g1", "m1"))
    monkeypatch.setattr(graph, "LINKS_A_TASK", 10)
    many = graph.cooccurrence(links, "g1", "m1", block=8)
    assert rows(many) == want and len(want) >= 30 * 29 // 2
    assert "RepartitionByExpression [g" in (plan := many._jdf.queryExecution().analyzed().toString()) and "], 43" in plan


def test_a_batch_reads_each_link_once_and_makes_no_batch_before_it_again(spark, monkeypatch, tmp_path):
    rng = random.Random(5)
    items = [(rng.randrange(120), rng.randrange(30), rng.randrange(1, 8)) for _ in range(900)] + [(i % 5, 40 + i // 5, i % 7 + 1) for i in range(400)]
    spark.createDataFrame(items, "l_orderkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    plans, store = [], more_queries.stored
    monkeypatch.setattr(more_queries, "stored", lambda df: plans.append(df._jdf.queryExecution()) or store(df))
    got = registry.QUERIES["network_after_batches"](spark, str(tmp_path))
    kept = {(o, s) for o, s, n in items if o % 5 != 1 or n % 2 == 0}
    assert len(kept) < len({(o, s) for o, s, _ in items})
    assert rows(got) == rows(graph.cooccurrence(spark.createDataFrame(sorted(kept), "g1 long, m1 long"), "g1", "m1"))
    reads = [p.optimizedPlan().toString().count("Relation [") for p in plans]
    assert reads and max(reads) <= 7  # changes of each batch before, and twice what the batch adds and removes
    links = spark.createDataFrame(sorted(kept), "g1 long, m1 long")
    plan = graph.link_changes(links, links.limit(9), links.limit(5), "g1", "m1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") <= 3  # all links and the groups of the batch, then the links of these groups


def test_changes_of_large_and_small_groups(spark, monkeypatch):
    monkeypatch.setattr(graph, "LINKS_A_TASK", 10)
    frame = lambda data: spark.createDataFrame(data, "g1 long, m1 long")
    old = [(0, m) for m in range(40)] + [(1, 3), (1, 4), (2, 3), (2, 4), (3, 5)]
    removed = [(0, 7), (0, 8), (1, 4), (3, 5), (9, 9), (2, 3), (None, 1)]
    added = [(0, 50), (0, 51), (2, 3), (3, 6), (3, 7), (4, 1), (4, 2), (0, 1), (5, None)]
    changes = graph.link_changes(frame(old), frame(added), frame(removed), "g1", "m1", block=8)
    after = (set(old) - set(removed)) | {x for x in added if None not in x}
    assert rows(graph.changed_links([changes], "g1", "m1")) == sorted([(*x, 1) for x in after - set(old)] + [(*x, -1) for x in set(old) - after], key=str)
    got = graph.merge_changes([changes], graph.cooccurrence(frame(old), "g1", "m1"))
    assert rows(got) == rows(graph.cooccurrence(frame(sorted(after)), "g1", "m1"))
    made = rows(graph._changed_pairs(changes))
    assert len(made) == len(set(made)) == 2 * 38 + 1 + 2 * 38 + 1 + 1 + 1 + 1  # with members that stay and with each other, each once
    blocks = changes.where("g = 0").collect()
    assert {b["blocks"] for b in blocks} == {6} and len(blocks) > 3
    assert changes.where("g = 1").count() == 1 and graph.link_changes(frame(old), frame([(7, 1)]), frame([(8, 8)]), "g1", "m1").count() == 1  # only groups of the batch
    # links that go, come back and go again, over batches that see only the changes before them
    none, steps, now = frame([]), [], set()
    for came, went in ((old, []), (added, removed), ([(0, 7), (1, 4)], added), (old, [(0, 7)]), ([], old), (added[:3], [(0, 50)])):
        steps.append(spark.createDataFrame((c := graph.link_changes(graph.changed_links(steps, "g1", "m1") if steps else None, frame(came), frame(went), "g1", "m1", 8, "k" if steps else None)).collect(), c.schema))
        now = (now - set(went)) | {x for x in came if None not in x}
        assert rows(graph.merge_changes(steps)) == rows(graph.cooccurrence(frame(sorted(now)), "g1", "m1"))
    assert rows(graph.update_cooccurrence(graph.cooccurrence(none, "g1", "m1"), none, frame(old), none, "g1", "m1", block=8)) == rows(graph.cooccurrence(frame(old), "g1", "m1"))


def test_trends_see_gaps(spark):
    df = spark.createDataFrame([(1, 2000, 1.0, "Q2"), (1, 2000, 3.0, "Q1"), (1, 2003, 5.0, "-"), (1, 2004, 4.0, "Q4"), (2, 2001, None, None), (None, 2001, 1.0, "Q1")], "j long, y int, s double, q string")
    assert rows(graph.metric_trends(df, "j", "y", "s", "q")) == [(1, 2000, 2.0, 1, None, None, None), (1, 2003, 5.0, None, 3.0, None, 2), (1, 2004, 4.0, 4, -1.0, None, 0), (2, 2001, None, None, None, None, None)]


def test_similar_journals_equal_all_pairs_with_fewer_candidates(spark):
    rng = random.Random(3)
    word = lambda: int(40 * rng.random() ** 3) if rng.random() < 0.4 else 100 + rng.randrange(600)
    links = {
        "authors": [(j, word()) for j in range(60) for _ in range(rng.choice([1, 3, 12, 40]))] + [(99, 1), (99, 1), (None, 1), (5, None), (98, None)],
        "topics": [(j, rng.randrange(30)) for j in range(0, 70, 2) for _ in range(rng.randint(1, 6))],
    }
    links["authors"] += [(200 + j, m) for j, m in links["authors"] if j is not None and j < 10 and rng.random() < 0.8]  # near copies
    frames = {n: spark.createDataFrame(v, "journal_id long, m long") for n, v in links.items()}
    sets = {n: {j: {m for k, m in v if k == j} for j in {k for k, _ in v} - {None}} for n, v in links.items()}

    def similarity(s, a, b):
        both = len((s.get(a, set()) & s.get(b, set())) - {None})
        return both / (len(s[a]) + len(s[b]) - both) if both else 0.0

    every = sorted({j for s in sets.values() for j in s})
    for least in (0.05, 0.1, 0.5, 1.0):
        for names in (["authors"], ["authors", "topics"]):
            want = {(a, b): v for i, a in enumerate(every) for b in every[i + 1 :] if (v := sum(similarity(sets[n], a, b) for n in names) / len(names)) >= least}
            got = {(r["a"], r["b"]): r["similarity_score"] for r in graph.similar_journals({n: frames[n] for n in names}, least).collect()}
            assert got == pytest.approx(want)
    members = graph.counted_members(frames["authors"])
    shared = graph.cooccurrence(frames["authors"], "m", "journal_id").count()
    found = {least: {(r["a"], r["b"]) for r in graph.similarity_candidates(members, least, block=4).collect()} for least in (0.1, 0.5)}
    for least, pairs in found.items():
        assert {(a, b) for i, a in enumerate(every) for b in every[i + 1 :] if similarity(sets["authors"], a, b) >= least if a in sets["authors"] and b in sets["authors"]} <= pairs
    assert len(found[0.1]) < shared / 2 and len(found[0.5]) < shared / 20
    assert graph.similar_journals({"authors": frames["authors"].limit(0)}).count() == 0


@pytest.mark.parametrize("few", [0, 40, 10_000])
def test_few_journals_of_many_members_are_counted_by_members(spark, monkeypatch, few):
    rng = random.Random(4)
    sets = {j: {m for m in range(300) if rng.random() < 0.1 * j} for j in range(1, 10)}
    frame = spark.createDataFrame([(j, m) for j, s in sets.items() for m in s] * 2, "journal_id long, m long")
    monkeypatch.setattr(graph, "FEW_PAIRS", few)
    used, plain = [], graph._similarities
    monkeypatch.setattr(graph, "_similarities", lambda *a: used.append(1) or plain(*a))
    got = {(r["a"], r["b"]): r["similarity_score"] for r in graph.similar_journals({"parts": frame}, 0.2).collect()}
    want = {(a, b): s for a in sets for b in sets if a < b and (s := len(sets[a] & sets[b]) / len(sets[a] | sets[b])) >= 0.2}
    assert got == pytest.approx(want) and bool(used) == (few == 0)


def test_followers_of_one_table_are_not_written(spark, monkeypatch):
    written, store = [], references.stored
    monkeypatch.setattr(references, "stored", lambda df: written.append(df.columns) or store(df))
    tables = {"Paper": spark.createDataFrame([(i, i // 2) for i in range(1, 40)], "paper_id long, cites long"), "Wrote": spark.createDataFrame([(i, i % 7) for i in range(60)] + [(9, None)], "paper_id long, person_id long"), "Person": spark.createDataFrame([(i,) for i in range(5)], "person_id long")}
    keys = {"Paper": ["paper_id"], "Wrote": ["paper_id", "person_id"], "Person": ["person_id"]}
    R = references.Reference
    out = references.subset(tables, keys, (R("Paper", "cites", "Paper"), R("Wrote", "paper_id", "Paper", follows=True), R("Wrote", "person_id", "Person")), {"Paper": tables["Paper"].where("paper_id = 37")})
    papers = [1, 2, 4, 9, 18, 37]
    assert sorted(r["paper_id"] for r in out["Paper"].collect()) == papers
    assert sorted(tuple(r) for r in out["Wrote"].collect()) == [(p, p % 7) for p in papers]
    assert sorted(r["person_id"] for r in out["Person"].collect()) == sorted({p % 7 for p in papers} & set(range(5)))
    assert ["paper_id", "person_id"] not in written
