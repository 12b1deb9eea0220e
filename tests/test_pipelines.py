"""Whole flows on small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarlake.plans import flow_queries, more_queries, pipelines, registry
from scholarlake.sources import readers


def fixed(spark, tables):
    """Tables computed once."""
    return {n: spark.createDataFrame(df.collect(), df.schema).coalesce(1) for n, df in tables.items()}


def empty(spark, **schemas):
    return {n: spark.createDataFrame([], s) for n, s in schemas.items()}


def test_ranking_import_is_idempotent(spark, tmp_path):
    lines = [
        "Rank;Sourceid;Title;Type;Issn;Publisher;Open Access;SJR;H index;Total Docs. (2025);Country;Region;Categories;Areas",
        '1;S1;First;journal;"15424863";P;Yes;10,5;7;3;France;Western Europe;"Oncology (Q1); Surgery (Q2)";Medicine',
        '2;S2;Second;journal;"00079235";P;No;-;2;1;Viet Nam;Asiatic Region;Art (Q3);"Arts and Humanities"',
        "3;;No source;j;;;;;;;;;;",
    ]
    (tmp_path / "r.csv").write_text("\n".join(lines))
    raw = readers.read_ranking(spark, str(tmp_path / "r.csv"))
    t = empty(
        spark,
        Publisher="id long, display_name string",
        Zone="zone_id long, name string, type string, code string, iso_code string",
        Subject_Area="id long, display_name string",
        Subject_Category="id long, subject_area_id long, display_name string",
        Journal="journal_id long, source_id string, name string, type string, issn string, publisher_id long, country string, region string, is_open_access boolean, is_diamond boolean, is_deleted boolean",
        Journal_Subject_Category="journal_id long, subject_category_id long",
        Journal_Ranking="journal_id long, metric_id long, year int, value_txt string, value_int long, value_float double, subject_category_id long",
    )
    once = fixed(spark, pipelines.import_ranking(raw, t, 2025))
    counts = {n: df.count() for n, df in once.items()}
    assert counts == {"Publisher": 1, "Zone": 4, "Subject_Area": 3, "Subject_Category": 4, "Journal": 2, "Journal_Subject_Category": 4, "Journal_Ranking": 4 + 2 + 1 + 3 + 1 + 1}
    again = pipelines.import_ranking(raw, once, 2025)
    assert {n: df.count() for n, df in again.items()} == counts
    assert sorted(r["code"] for r in once["Zone"].collect()) == ["AS", "FR", "VN", "WE"]


def tables(spark):
    d = spark.createDataFrame
    return {
        "Article": d([(1, 10, 5, ["x"], 1, "10.1/a"), (2, 11, 6, None, 9, "10.1/b"), (3, 10, None, ["10.1/A"], 4, None)], "article_id long, issue_id long, primary_topic long, references array<string>, reference_count long, doi string"),
        "Issue": d([(10, 1), (11, 1)], "issue_id long, volume_id long"),
        "Volume": d([(1, 1)], "volume_id long, journal_id long"),
        "Journal": d([(1, 4), (2, 4)], "journal_id long, publisher_id long"),
        "Topic": d([(5, "Graph theory"), (6, "Art")], "topic_id long, display_name string"),
        "Keyword": d([(7, "graphs"), (8, "paint")], "keyword_id long, display_name string"),
        "Sub_Topic": d([(1, 5), (1, 6), (2, 6)], "article_id long, topic_id long"),
        "Keyword_Article": d([(3, 7), (3, 8), (2, 8)], "article_id long, keyword_id long"),
        "Author_Article": d([(1, 1), (2, 1), (1, 3)], "author_id long, article_id long"),
        "Author": d([(1,), (2,), (3,)], "author_id long"),
    }


def test_subsets(spark):
    t = tables(spark)
    ids = lambda out: sorted(r["article_id"] for r in out["Article"].collect())
    assert ids(pipelines.domain_subset(t, ["graph"])) == [1, 3]
    top = pipelines.priority_subset(t, 1)
    assert ids(top) == [3] and top["Author"].count() == 1 and top["Journal"].count() == 1 and top["Topic"].count() == 0
    m = spark.createDataFrame([("m-1", True)], "manifest_name string, is_active boolean")
    pruned, report = pipelines.prune_to_manifest(t, m, spark.createDataFrame([("m-1", 2)], "manifest_name string, article_id long"), {"Journal": t["Journal"]})
    assert ids(pruned) == [2] and pruned["Journal"].count() == 2
    assert report.where("table_name = 'Article'").first()["remove"] == 2


def test_graph(spark):
    g = pipelines.build_graph(tables(spark))
    assert [tuple(r) for r in g["COLLABORATES_WITH"].collect()] == [(1, 2, 1)]
    refs = {(r["src"], r["dst"], r["placeholder"]) for r in g["REFERENCES"].collect()}
    assert refs == {(1, None, True), (3, 1, False)}
    assert g["TOPIC_RELATED_TO"].count() == 1 and g["WRITES"].count() == 3


def test_works_sync_reads_each_work_once(spark):
    pages = spark.createDataFrame([(i, f"W{i}") for i in range(20)], "k int, i string")
    work = "named_struct('id', i, 'title', concat('Title ', k), 'doi', string(null), 'publication_year', 2000, 'cited_by_count', bigint(0), 'referenced_works', array('r'), 'referenced_works_count', bigint(1), 'abstract_inverted_index', map('a', array(0)), 'biblio', named_struct('volume', '1', 'issue', '2'), 'primary_topic', named_struct('display_name', 'T', 'score', 0.5D), 'authorships', array(named_struct('author', named_struct('id', i, 'orcid', string(null), 'display_name', i))), 'keywords', array(named_struct('display_name', 'K', 'score', 0.5D)))"
    seen = spark.sparkContext.accumulator(0)

    def read(x):
        seen.add(1)
        return x

    works = pages.selectExpr(f"array({work}) as results", "bigint(4) as journal_id").select("journal_id", F.inline("results"))
    works = works.withColumn("id", F.udf(read, "string")("id"))
    out = pipelines.sync_works(works, {n: spark.createDataFrame([], s) for n, s in flow_queries.SYNC_TABLES.items()})
    assert {n: df.count() for n, df in out.items()} == {"Topic": 1, "Volume": 1, "Issue": 1, "Article": 20, "Author": 20, "Author_Article": 20, "Keyword": 1, "Keyword_Article": 20}
    assert seen.value == 20


def test_works_and_articles_are_never_broadcast(spark, monkeypatch):
    import re

    plans, write = [], pipelines.stored
    monkeypatch.setattr(pipelines, "stored", lambda df: plans.append(df) or write(df))
    work = '{"results":[{"title":"T1","doi":"10.1/a","authorships":[{"author":{"id":"https://o/A1","display_name":"Ann"}}],"keywords":[{"display_name":"k","score":0.1}]}]}'
    pages = spark.createDataFrame([(work, 4)], "j string, journal_id long").selectExpr(f"from_json(j, '{readers.WORKS_PAGE}') as p", "journal_id").select("p.results", "journal_id")
    tables = {n: write(df) for n, df in empty(spark, **flow_queries.SYNC_TABLES).items()}
    out = pipelines.sync_works(readers.works_of(pages), tables)
    # by their files all tables here look small enough to pass through the driver
    found = [re.findall(r"BroadcastHashJoin \[([^\]]+)\]|(BroadcastNestedLoopJoin)", df._jdf.queryExecution().sparkPlan().toString()) for df in [*plans, *out.values()]]
    keys = {k for joins in found for join in joins for k in re.findall(r"[a-z_]\w*(?=#)|BroadcastNestedLoopJoin", "".join(join))}
    assert keys and not keys & {"work_key", "article_id", "row_id", "author_id", "doi", "_k0", "_k1", "_k2", "title", "BroadcastNestedLoopJoin"}, keys
    assert {n: df.count() for n, df in out.items()} == {"Topic": 0, "Volume": 0, "Issue": 0, "Article": 1, "Author": 1, "Author_Article": 1, "Keyword": 1, "Keyword_Article": 1}


def test_works_sync_is_idempotent(spark):
    t = empty(
        spark,
        Topic="topic_id long, display_name string, subject_area_id long, subject_category_id long, score double",
        Article="article_id long, title string, abstract string, doi string, publication_year int, issue_id long, primary_topic long, citation_count long, reference_count long, references array<string>, is_deleted boolean",
        Author="author_id long, orcid string, openalex_id string, display_name string",
        Author_Article="author_id long, article_id long",
        Keyword="keyword_id long, display_name string",
        Keyword_Article="keyword_id long, article_id long, score double",
    )
    work = '{"results":[{"title":"T1","primary_topic":{"display_name":"X","score":0.5},"authorships":[{"author":{"id":"https://o/A1","display_name":"Ann"}},{"author":{"display_name":"Bo"}}],"keywords":[{"display_name":"k","score":0.1},{"display_name":"k"}]},{"title":"T2","authorships":[{"author":{"id":"https://o/A1","display_name":"Ann"}}]},{"title":null}]}'
    pages = spark.createDataFrame([(work,)], "j string").selectExpr(f"from_json(j, '{readers.WORKS_PAGE}') as p").select("p.*")
    once = fixed(spark, pipelines.sync_works(readers.works_of(pages), t))
    counts = {n: df.count() for n, df in once.items()}
    assert counts == {"Topic": 1, "Article": 2, "Author": 2, "Author_Article": 3, "Keyword": 1, "Keyword_Article": 1}
    assert {n: df.count() for n, df in pipelines.sync_works(readers.works_of(pages), once).items()} == counts


def test_works_of_one_title_stay_apart_by_doi_and_issue(spark):
    from scholarlake.plans.flow_queries import SYNC_TABLES

    def work(title, doi, volume, issue, author):
        biblio = f'"biblio":{{"volume":"{volume}","issue":"{issue}"}}' if volume else '"biblio":{}'
        return f'{{"title":"{title}","doi":{doi},"publication_year":2020,{biblio},"authorships":[{{"author":{{"id":"https://o/{author}","display_name":"{author}"}}}}],"keywords":[]}}'

    rows = [work("Editorial", '"10.1/a"', 1, 1, "A1"), work("Editorial", '"10.1/b"', 9, 1, "A2"), work("Editorial", "null", 1, 2, "A3"), work("Editorial", "null", 1, 3, "A4"), work("Editorial", '"https://doi.org/10.1/A"', 1, 1, "A5")]
    page = '{"results":[' + ",".join(rows) + "]}"
    pages = spark.createDataFrame([(page, 7)], "j string, journal_id long").selectExpr(f"from_json(j, '{readers.WORKS_PAGE}') as p", "journal_id").select("p.results", "journal_id")
    t = empty(spark, **SYNC_TABLES)
    t["Volume"] = spark.createDataFrame([(3, 7, 1, 2020, True)], SYNC_TABLES["Volume"])
    out = fixed(spark, pipelines.sync_works(readers.works_of(pages), t))
    counts = {n: df.count() for n, df in out.items()}
    assert (counts["Article"], counts["Volume"], counts["Issue"], counts["Author_Article"]) == (4, 2, 4, 5)
    assert out["Volume"].where("volume_id = 3 and not is_deleted").count() == 1 and out["Issue"].where("volume_id = 3").count() == 3
    again = pipelines.sync_works(readers.works_of(pages), out)
    assert {n: again[n].count() for n in ("Article", "Volume", "Issue", "Author_Article")} == {n: counts[n] for n in ("Article", "Volume", "Issue", "Author_Article")}


def test_import_keeps_known_values_and_takes_a_limit(spark):
    current = spark.createDataFrame([(1, "old", "FR", True), (2, "two", None, False)], "id long, name string, country string, is_deleted boolean")
    incoming = spark.createDataFrame([(1, "new", None, False), (3, "three", "VN", False)], current.schema)
    from scholarlake.operators import merge

    got = sorted(tuple(r) for r in merge.update_known(current, incoming, ["id"]).collect())
    assert got == [(1, "new", "FR", False), (2, "two", None, False), (3, "three", "VN", False)]


def test_seeds_land_in_few_files(spark, tmp_path, monkeypatch):
    spark.range(25_000).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/sf/supplier.parquet")
    monkeypatch.setattr(more_queries, "folder", lambda _: f"{tmp_path}/seeds")
    got = {tuple(r) for r in registry.QUERIES["landed_seeds"](spark, f"{tmp_path}/sf").collect()}
    assert got == {(f"J{k}", f"https://j{k}.org") for k in range(25_000)}
    assert len(list((tmp_path / "seeds").glob("part-*"))) <= 3


def test_equal_titles_of_a_year_rank_by_article(spark, tmp_path):
    keys = sorted((k + 1_000_003 * i for k in range(1, 40, 2) for i in range(0, 20, 2)), reverse=True)  # titles repeat after 1,000,003 keys
    orders = spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1)
    orders.select("o_orderkey", F.lit("1-URGENT").alias("o_orderpriority"), F.to_timestamp(F.lit("1995-02-03")).alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.QUERIES["ranked_works_report"](spark, str(tmp_path)).orderBy("rank").collect()
    title = lambda k: f"{k * 7919 % 1_000_003:08d}"
    assert [r["article_id"] for r in got] == sorted(keys, key=lambda k: (k % 10 != 0, title(k), k))
    assert [r["rank"] for r in got] == list(range(1, len(keys) + 1))
