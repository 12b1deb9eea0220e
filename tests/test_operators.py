"""Operators, sources, sinks and the stream on small fixtures."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S
from scholarlake.operators import closure, embedding, graph, merge, rankings, reports, resolve, selection
from scholarlake.sources import readers, sinks
from scholarlake.streaming import landed


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# selection

FEATURES = "article_id long, primary_topic long, subject_area_id long, quality_score int, citation_count long, reference_count long, publication_year int, eligible boolean"


def test_selection_keeps_bookmarks_and_breaks_ties_by_id(spark):
    data = [(i, i % 4 if i % 5 else None, (i % 4) % 2 if i % 3 else None, 2, 7, 1, 2000 if i % 2 else None, i != 9) for i in range(1, 41)]
    marks = spark.createDataFrame([(9,), (9,), (40,)], "article_id long")
    f = spark.createDataFrame(data, FEATURES)
    got = selection.balanced_selection(f, marks, 12)
    ids = [r["article_id"] for r in got.orderBy("selected_rank").collect()]
    assert len(ids) == len(set(ids)) == 12 and set(ids[:2]) == {9, 40}
    again = selection.balanced_selection(f.repartition(7), marks, 12)
    assert rows(got) == rows(again)
    checks = reports.selection_checks(got, marks, 12)
    reports.require(checks)
    with pytest.raises(ValueError):
        reports.require(reports.selection_checks(got, marks, 13))


def test_features_score_and_eligibility(spark):
    arts = spark.createDataFrame([(1, "t", "a", "d", ["r"], "s", None, None, 2000, 5, None), (2, " ", "a", None, None, " ", 1, 1, None, None, False), (3, "t", "a", None, None, None, 1, 1, 1, 5, True)], "article_id long, title string, abstract string, doi string, references array<string>, semantic_tldr string, citation_count long, reference_count long, publication_year int, primary_topic long, is_deleted boolean")
    f = {r["article_id"]: r for r in selection.article_features(arts, spark.createDataFrame([(5, 8)], "topic_id long, subject_area_id long")).collect()}
    assert (f[1]["quality_score"], f[1]["eligible"], f[1]["subject_area_id"], f[1]["citation_count"]) == (4, True, 8, 0)
    assert (f[2]["quality_score"], f[2]["eligible"]) == (1, False) and not f[3]["eligible"]


def test_manifests(spark):
    sel = spark.createDataFrame([(7, 1, "bookmarked"), (3, 2, "x")], "article_id long, selected_rank int, selection_reason string")
    m = spark.createDataFrame([("old-one", 1, 1, "c", True)], "manifest_name string, target_count long, selected_count long, checksum string, is_active boolean")
    items = spark.createDataFrame([("old-one", 5, 1, "x")], "manifest_name string, article_id long, rank int, reason string")
    m2, i2 = selection.activate_manifest(m, items, "balanced-20k-v1", sel, 2)
    assert rows(m2, "manifest_name", "is_active") == [("balanced-20k-v1", True), ("old-one", False)]
    assert rows(selection.active_items(m2, i2), "article_id", "rank") == [(3, 2), (7, 1)]
    with pytest.raises(ValueError):
        selection.validate_manifest_name("unsafe manifest; drop table")
    with pytest.raises(ValueError):
        selection.activate_manifest(m2, i2, "balanced-20k-v1", sel, 2)
    selection.refuse_while_active(m2.where("not is_active"))
    with pytest.raises(ValueError):
        selection.refuse_while_active(m2)


# closure


def test_prune_keeps_the_closure(spark):
    t = lambda data, schema: spark.createDataFrame(data, schema)
    tables = {
        "Article": t([(1, 10), (2, 11), (3, None)], "article_id long, issue_id long"),
        "Issue": t([(10, 100), (11, 101)], "issue_id long, volume_id long"),
        "Volume": t([(100, 7), (101, 8)], "volume_id long, journal_id long"),
        "Journal": t([(7,), (8,), (9,)], "journal_id long"),
        "Journal_Ranking": t([(70, 7), (80, 8), (90, 9)], "journal_ranking_id long, journal_id long"),
        "Author_Article": t([(1, 4), (2, 5)], "article_id long, author_id long"),
        "Author": t([(4,), (5,)], "author_id long"),
        "Institution_Author": t([(4, 6, 2000), (5, 6, 2000)], "author_id long, institution_id long, year int"),
        "Institution": t([(6,), (66,)], "institution_id long"),
        "Zone": t([(1,)], "zone_id long"),
    }
    protected = {"Journal": t([(9,)], "journal_id long")}
    kept = closure.keep_sets(tables, t([(1,), (3,)], "article_id long"), protected)
    out = closure.prune(tables, kept)
    counts = {n: df.count() for n, df in out.items()}
    assert counts == {"Article": 2, "Issue": 1, "Volume": 1, "Journal": 2, "Journal_Ranking": 2, "Author_Article": 1, "Author": 1, "Institution_Author": 1, "Institution": 1, "Zone": 1}
    assert all(r["missing"] == 0 for r in closure.protected_missing(kept, protected).collect())
    assert {n: df.count() for n, df in closure.prune(out, kept).items()} == counts
    assert [r["remove"] for r in closure.keep_report(tables, out).where("table_name = 'ALL'").collect()] == [9]


def test_stages_resume_and_refuse_drift(spark):
    assert closure.PRUNE_STAGES.index("Author_Article") < closure.PRUNE_STAGES.index("Article") < closure.PRUNE_STAGES.index("Issue") < closure.PRUNE_STAGES.index("Volume") < closure.PRUNE_STAGES.index("Journal")
    done = spark.createDataFrame([("r", "Sub_Topic", "c", "done"), ("r", "Article", "c", "failed"), ("q", "Author", "c", "done")], "run string, stage string, checksum string, status string")
    left = closure.next_stages(done, "r", "c")
    assert "Sub_Topic" not in left and "Article" in left and "Author" in left
    with pytest.raises(ValueError):
        closure.next_stages(done, "r", "other")


# merges

JOURNAL = "id int, source string, name string, issn string"


def test_upserts_are_idempotent(spark):
    current = spark.createDataFrame([(1, "S1", "Name", None), (2, "S2-old", "Name 2", "5")], JOURNAL)
    new = spark.createDataFrame([(1, "S1", "Name", None), (2, "S2-new", "Name 2", "5"), (3, None, "n", None), (3, None, "n", None)], JOURNAL)
    assert rows(merge.changed_rows(current, new, ["id"], ["source", "name", "issn"]), "id") == [(2,), (3,)]
    for f in (lambda c: merge.conditional_upsert(c, new, ["id"], ["source", "name", "issn"]), lambda c: merge.full_upsert(c, new, ["id"]), lambda c: merge.insert_if_absent(c, new, ["id"])):
        once = f(current)
        assert once.count() == 3 and rows(f(once)) == rows(once)


def test_get_or_create(spark):
    dim = spark.createDataFrame([("a", 4)], "name string, id long")
    names = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "name string")
    once = merge.get_or_create(dim, names, "id", ["name"])
    assert rows(once, "name", "id") == [("a", 4), ("b", 5), ("c", 6)] == rows(merge.get_or_create(once, names, "id", ["name"]), "name", "id")
    assert merge.get_or_create(dim, names, "id", ["name"], hashed=True).select("id").distinct().count() == 3


def test_references_topics_authors_articles_and_rankings(spark):
    arts = spark.createDataFrame([(1, ["a"], 1, 9), (2, None, None, None)], "article_id long, references array<string>, reference_count int, citation_count int")
    works = spark.createDataFrame([(1, ["x", "y"], None, None), (3, [], 0, 1)], "article_id long, references array<string>, reference_count int, citation_count int")
    assert rows(merge.overwrite_references(arts, works)) == [(1, ["x", "y"], 2, 9), (2, None, None, None)]
    topics = spark.createDataFrame([("t", 1, None, 0.5)], "display_name string, subject_area_id long, subject_category_id long, score double")
    assert rows(merge.fill_topics(topics, spark.createDataFrame([("t", 7, 8, 0.9)], topics.schema))) == [("t", 1, 8, 0.9)]
    authors = spark.createDataFrame([(1, "o1", None, 5), (2, None, None, None), (3, None, None, None)], "author_id long, orcid string, openalex_id string, h_index int")
    details = spark.createDataFrame([(2, "o1", "A2", 7), (3, "o3", "A2", None)], authors.schema)
    assert rows(merge.update_authors(authors, details)) == [(1, "o1", None, 5), (2, None, "A2", 7), (3, "o3", None, None)]
    known = spark.createDataFrame([(1, "t", None), (2, "u", 5)], "article_id long, title string, issue_id long")
    w = spark.createDataFrame([("t", None), ("u", 5), ("u", 6)], "title string, issue_id long")
    assert rows(merge.get_or_create_articles(known, w), "article_id") == [(1,), (2,), (None,)]
    assert rows(merge.get_or_create_articles(known, w, literal_nulls=True), "article_id") == [(2,), (None,), (None,)]
    rank = "journal_id long, metric_id long, year int, value_txt string, value_int long, value_float double, category long"
    cur = spark.createDataFrame([(1, 1, 2025, "Q1", None, None, 3)], rank)
    assert rows(merge.ranking_upsert(cur, spark.createDataFrame([(1, 1, 2025, "Q1", None, None, 4), (1, 2, 2025, None, 5, None, None)], rank)), "category") == [(4,), (None,)]
    e = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "article_id long, embedding array<float>")
    assert rows(merge.clear_other_dimensions(e, 2, "REPLACE-2"), "article_id", F.col("embedding").isNull()) == [(1, True), (2, False)]
    with pytest.raises(ValueError):
        merge.clear_other_dimensions(e, 2, "yes")
    assert rows(merge.fill_from(spark.createDataFrame([(1, None), (2, "x"), (3, None)], "k int, v string"), spark.createDataFrame([(1, "g")], "k int, v string"), "k", "v", F.lit(""))) == [(1, "g"), (2, "x"), (3, "")]


def test_table_copies(spark):
    src = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], "k int, v string, only_here int")
    dst = spark.createDataFrame([(1, "old")], "k int, v string")
    assert rows(merge.copy_table(src, dst, ["k"], limit=2)) == [(1, "old"), (2, "b")]
    assert rows(merge.copy_table(src, dst, ["k"], mode="changed")) == rows(merge.copy_table(src, dst, ["k"], mode="reset")) == [(1, "a"), (2, "b"), (3, "c")]
    assert merge.profile_tables("articles")[-1] == "Keyword_Article" and "Journal" in merge.profile_tables("full")


# resolution


def test_journals_resolve_by_source_then_issn(spark):
    journals = spark.createDataFrame([(1, "S1", "1542-4863"), (2, None, "00079235, 1542-4863")], "journal_id long, source_id string, issn string")
    r = spark.createDataFrame([(1, "S1", None), (2, "S9", "x, 00079235"), (3, "S9", "1542-4863"), (4, None, "none")], "row_id long, source_id string, issn string")
    assert rows(resolve.resolve_journals(r, journals), "row_id", "journal_id") == [(1, 1), (2, 2), (3, 2), (4, None)]


def test_authors_resolve_in_order(spark):
    authors = spark.createDataFrame([(1, "A1", None, "Ann"), (2, None, "o2", "Bob"), (3, None, None, "Cy"), (4, "A4", None, "Di")], "author_id long, openalex_id string, orcid string, display_name string")
    new = spark.createDataFrame([(1, "A1", "o2", "x"), (2, "A9", "o2", "x"), (3, None, None, "Cy"), (4, None, None, "Di"), (5, None, None, None)], "row_id long, openalex_id string, orcid string, display_name string")
    assert rows(resolve.resolve_authors(new, authors)) == [(1, 1, "openalex_id"), (2, 2, "orcid"), (3, 3, "name"), (4, None, None), (5, None, None)]
    assert rows(resolve.resolve_authors(new, authors, literal_names=True))[3] == (4, 4, "name")
    payload = json.dumps([{"externalIds": {"DOI": "10.1/A"}}, {"paperId": "p"}])
    assert spark.createDataFrame([(payload,)], "p string").select(resolve.object_references("p")).first()[0] == ["https://doi.org/10.1/a"]
    dims = spark.createDataFrame([(1, "Art")], "id long, name string")
    assert rows(resolve.lookup_ignoring_case(spark.createDataFrame([("ART",), (None,)], "n string"), dims, "n", "name", "id")) == [("ART", 1), (None, None)]


# graph


def test_cooccurrence_over_blocks(spark):
    links = spark.createDataFrame([(g, m) for g in range(3) for m in range(40 - g)] + [(9, None), (None, 1)], "g long, m long")
    whole = rows(graph.cooccurrence(links, "g", "m"))
    assert whole == rows(graph.cooccurrence(links, "g", "m", block=7)) and len(whole) == 40 * 39 // 2
    assert graph.cooccurrence(links.limit(0), "g", "m").count() == 0


def test_schema_edges(spark):
    tables = {"Author_Article": spark.createDataFrame([(1, 5), (1, 5), (2, None), (9, 5)], "author_id long, article_id long"), "Author": spark.createDataFrame([(1,), (2,)], "author_id long"), "Article": spark.createDataFrame([(5, 3)], "article_id long, issue_id long")}
    e = graph.schema_edges(tables)
    assert rows(e["WRITES"]) == [(1, 5, "WRITES")] and rows(e["PUBLISHED_IN_ISSUE"]) == [(5, 3, "PUBLISHED_IN_ISSUE")]
    assert rows(graph.nodes(tables["Author_Article"], "author_id", [], 2)) == [(1,), (2,)]


# sources and sinks

HEAD = "Rank;Sourceid;Title;Type;Issn;SJR;SJR Best Quartile;Total Docs. (2025);Categories;Areas"


@pytest.mark.parametrize("encoding,bom", [("utf-8", b"\xef\xbb\xbf"), ("latin-1", b"")])
def test_ranking_file(spark, tmp_path, encoding, bom):
    lines = [HEAD, '1;S1;"Revué; x";journal;"15424863, 00079235";104,065;Q1;10;"Oncology (Q1); Hematology (Q1)";Medicine', "2;S2;Short;journal", "3;;blank;j;;-;;;;", "4;S4;Long;j;;1;;;;;;extra"]
    path = tmp_path / "rank.csv"
    path.write_bytes(bom + "\n".join(lines).encode(encoding))
    raw = readers.read_ranking(spark, str(path))
    got = readers.require_source_and_title(readers.map_ranking_columns(raw))
    assert rows(got, "rank_txt", "source_id", "title", "sjr", "total_docs_current_year", "country") == [("1", "S1", "Revué; x", "104,065", "10", ""), ("2", "S2", "Short", "", "", "")]
    long = rankings.metric_rows(got.withColumn("journal_id", F.col("rank_txt").cast("long")))
    first = rankings.first_metric_rows(long)
    assert rows(first.where("journal_id = 1"), "metric", "value_txt", "value_int", "value_float") == [("RANK", None, 1, None), ("SJR", None, None, 104.065), ("SJR_BEST_QUARTILE", "Q1", None, None), ("SJR_QUARTILE_BY_CAT", "Q1", None, None), ("TOTAL_DOCS_CURRENT_YEAR", None, 10, None)]
    assert rankings.first_metric_rows(long, category_in_key=True).where("metric = 'SJR_QUARTILE_BY_CAT'").count() == 2
    assert rows(rankings.journal_categories(got.withColumn("journal_id", F.lit(1))), "category", "area") == [("Hematology", "Medicine"), ("Oncology", "Medicine")]


def test_category_areas_pair_or_cross(spark):
    df = spark.createDataFrame([("A (Q1); B", "X; Y"), ("A; B; C", "X; Y"), ("", "")], "c string, a string")
    n = [len(r[0]) for r in df.select(S.category_areas(S.parse_categories("c"), S.parse_areas("a"))).collect()]
    assert n == [2, 6, 0]


def test_json_sources(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"cca2": "FR", "cca3": "FRA", "name": {"common": "France", "official": "French Republic"}}]))
    assert rows(readers.read_countries(spark, str(tmp_path / "c.json"))) == [("france", ["FR", "FRA"]), ("french republic", ["FR", "FRA"])]
    (tmp_path / "i.csv").write_text("name,issn\nJ,1234-5678; 8765-4321\n")
    assert rows(readers.read_issn_candidates(spark, str(tmp_path / "i.csv")), "issn") == [(["1234-5678", "8765-4321"],)]
    pairs = spark.createDataFrame([(["a", "b"], ["x", None])], "req array<string>, ans array<string>")
    assert rows(readers.aligned(pairs, "req", "ans")) == [("a", "x", True), ("b", None, False)]


def test_keyset_and_configured_scans(spark):
    df = spark.createDataFrame([(10, 20, 1), (10, 21, 2), (11, 1, 3), (9, 99, 4)], "a int, b int, p int")
    assert rows(readers.after_key(df, ["a", "b"], (10, 20)), "a", "b") == [(10, 21), (11, 1)]
    assert rows(readers.after_key(df, ["a", "b"], None, 1), "a", "b") == [(9, 99)]
    out = readers.configured_scan({"Tbl": df}, [{"table": "tbl", "columns": ["b", "zz"], "where": "a = 10", "order_by": "b desc", "limit": 1}])
    assert out[0][0] == "Tbl" and rows(out[0][1]) == [(21,)]
    assert [n for n, _ in readers.subset_scan({"A": df, "B": df}, "ALL", 2)] == ["A", "B"]
    assert rows(readers.resume_offset(df, 3, F.col("a"), F.col("b")), "a") == [(11,)]


def test_snapshot_and_nested_output(spark, tmp_path):
    tables = {"a": spark.range(5), "b": spark.range(3).withColumn("x", F.lit("v"))}
    meta = sinks.write_snapshot(tables, str(tmp_path / "s"))
    assert rows(meta, "table_name", "n") == [("a", 5), ("b", 3)]
    assert all(r["ok"] for r in sinks.verify_snapshot(spark, str(tmp_path / "s")).collect())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_snapshot(tables, str(tmp_path / "s"))
    j = spark.createDataFrame([(1, "J"), (2, "K")], "journal_id int, name string")
    nested = sinks.nested_articles(j, spark.createDataFrame([(1, "t2"), (1, "t1")], "journal_id int, title string"), spark.createDataFrame([(2, "w")], "journal_id int, warning string"))
    got = {r["journal_id"]: ([a["title"] for a in r["articles"]], r["warnings"]) for r in nested.collect()}
    assert got == {1: (["t1", "t2"], []), 2: ([], ["w"])}
    sinks.write_report(j, str(tmp_path / "r"))
    first = next((tmp_path / "r").glob("*.csv")).read_bytes()
    assert first.startswith("﻿journal_id".encode())


# embeddings, outcomes, stream


def test_embeddings(spark):
    arts = spark.createDataFrame([(1, "T", "A.", None, None), (2, " ", None, None, False), (3, "x", "y", [1.0, 1.0], None), (4, "d", "d", None, True)], "article_id long, title string, abstract string, embedding array<float>, is_deleted boolean")
    texts = embedding.pending(arts)
    assert rows(texts) == [(1, "T. A")]
    vec = embedding.embed(texts, lambda: lambda batch: [[3.0, 4.0] for _ in batch], 2, normalize=True)
    out = {r["article_id"]: r["embedding"] for r in embedding.store_embeddings(arts, vec).collect()}
    assert out[1] == pytest.approx([0.6, 0.8]) and out[3] == [1.0, 1.0] and out[2] is None
    with pytest.raises(Exception, match="dimensions"):
        embedding.embed(texts, lambda: lambda batch: [[1.0] for _ in batch], 2).collect()
    reports.require_one_dimension(arts, 2)
    with pytest.raises(ValueError):
        reports.require_one_dimension(arts, 3)


def test_incomplete_authorship(spark):
    links = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "article_id long, author_id long")
    known = spark.createDataFrame([(1, 2020), (2, 2019)], "author_id long, year int")
    got = reports.incomplete_links(spark.createDataFrame([(1, 2020)], "article_id long, publication_year int"), links, known)
    assert rows(got) == [(1, 3, 2)]
    response = got.select("article_id", F.lit(200).alias("http_status"), "n_authors", F.lit(0).alias("n_unresolved"), F.col("incomplete_count").alias("incomplete"))
    assert rows(reports.outcome_class(response), "outcome") == [("AUTHOR_UNRESOLVED",)]


def test_landed_stream_is_repeatable(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    work = {"title": "A title", "doi": "https://doi.org/10.1/A", "publication_year": 2020, "abstract_inverted_index": {"the": [0, 2], "cat": [1]}, "biblio": {"volume": "v12", "issue": "3"}, "referenced_works": ["W1"], "authorships": [{"author": {"id": "https://openalex.org/A1", "orcid": None, "display_name": "Ann"}}]}
    (src / "p1.json").write_text(json.dumps({"results": [work, {"title": None}], "meta": {"next_cursor": None}}))
    for _ in range(2):  # the second run finds nothing new
        q = landed.run_batches(landed.works_stream(spark, str(src)), landed.snapshot_writer(out, landed.articles_of), str(tmp_path / "cp"))
        q.awaitTermination(60)
    got = spark.read.parquet(out)
    assert rows(got, "title", "abstract", "doi", "volume", "reference_count") == [("A title", "the cat the", "https://doi.org/10.1/a", 12, 1)]
    assert rows(landed.authors_of(readers.read_works(spark, str(src))), "openalex_id", "display_name") == [("A1", "Ann")]


def test_a_token_of_many_journals_and_sources_makes_no_pairs(spark):
    journals = spark.range(60_000).select(F.col("id").alias("journal_id"), F.lit("1234-5678").alias("issn"))
    sources = spark.range(100, 60_100).select("id", F.array(F.lit("1234-5678")).alias("issn"), F.lit(None).cast("string").alias("issn_l"))
    out = resolve.match_sources(journals, sources)
    began = time.perf_counter()
    assert {r["status"]: (r["n"], r["x"]) for r in out.groupBy("status").agg(F.count("*").alias("n"), F.max("external_id").alias("x")).collect()} == {"MATCHED": (1, 100), "DUPLICATE": (59_999, None)}
    assert time.perf_counter() - began < 15  # 3,600,000,000 pairs take longer
