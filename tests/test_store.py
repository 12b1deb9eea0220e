"""Versioned tables, resumed runs, merges in a stream, archive walks, dense numbers and digests on small tables."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from scholarlake.operators import closure, crawl, merge, numbering
from scholarlake.plans import registry, store_queries  # noqa: F401 - registers its queries
from scholarlake.plans.staged_prune import prune_report, staged_prune
from scholarlake.sources import versioned
from scholarlake.streaming import landed


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def store_at(spark, path, **keys):
    return versioned.VersionedTables(spark, str(path), keys, buckets=4)


# versioned tables


def test_commits_are_versions_and_repeats_change_nothing(spark, tmp_path):
    store = store_at(spark, tmp_path, T=["k"])
    df = spark.createDataFrame([(i, f"v{i}", {"b": i, "a": 1}) for i in range(40)] + [(0, None, None)], "k long, v string, m map<string,int>")
    assert store.version() == 0 and store.read() == {}
    assert store.commit({"T": df, "E": df.limit(0)}, "w", 0, {"note": "x"}) == 1
    assert rows(store.read()["T"], "k", "v") == rows(df, "k", "v") and store.read()["E"].count() == 0 and store.read()["E"].dtypes == df.dtypes
    assert store.writer("w") == {"sequence": 0, "note": "x"} and store.counts() == {"T": 41, "E": 0}
    assert store.commit({"T": df.limit(0)}, "w", 0) == 1 and store.counts()["T"] == 41  # delivered again
    more = df.withColumn("v", F.when(F.col("k") == 7, "changed").otherwise(F.col("v")))
    assert store.commit({"T": more}, "w", 1) == 2
    one, two = (store.marker(v)["tables"]["T"]["buckets"] for v in (1, 2))
    assert sum(one[b]["path"] != two[b]["path"] for b in one) == 1  # equal buckets keep their files
    assert rows(store.read(1)["T"], "k", "v") == rows(df, "k", "v") and rows(store.read()["T"], "k", "v") == rows(more, "k", "v")
    assert store.verify().where("not ok").count() == 0 and store.verify().count() == len(two)


def test_a_broken_commit_leaves_the_version_and_a_lost_row_is_seen(spark, tmp_path):
    store = store_at(spark, tmp_path, T=["k"])
    df = spark.range(30).withColumnRenamed("id", "k")
    store.commit({"T": df}, "w", 0)
    boom = F.udf(lambda k: 1 // (k - 50), "int")
    with pytest.raises(Exception, match="division|ZeroDivision"):
        store.commit({"T": spark.range(60).withColumnRenamed("id", "k").where(boom("k") < 5)}, "w", 1)
    assert store.version() == 1 and rows(store.read()["T"]) == rows(df)
    assert store.commit({"T": df.union(df)}, "w", 1) == 2 and store.counts()["T"] == 60  # repeated rows don't cancel out
    table = store.marker()["tables"]["T"]["buckets"]
    bucket = sorted(table)[0]
    path = f"{tmp_path}/data/{table[bucket]['path']}/_bucket={bucket}"
    spark.read.parquet(path).limit(table[bucket]["n"] - 1).write.mode("overwrite").parquet(f"{tmp_path}/less")
    for name in os.listdir(path):
        os.remove(f"{path}/{name}")
    for name in os.listdir(f"{tmp_path}/less"):
        os.rename(f"{tmp_path}/less/{name}", f"{path}/{name}")
    assert rows(store.verify().where("not ok"), "table_name", "bucket") == [("T", int(bucket))]


def test_two_commits_of_one_version_conflict(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.commit({}, "a", 0)
    with pytest.raises(versioned.Conflict):
        store.files.create("versions/000000000001.json", "{}")
    assert store.version() == 1 and [n for n in store.files.names("versions") if n.startswith(".")] == []


def test_copies_read_only_buckets_that_differ(spark, tmp_path):
    source, target = store_at(spark, tmp_path / "s", T=["k"]), store_at(spark, tmp_path / "t", T=["k"])
    df = spark.createDataFrame([(i, i * i) for i in range(200)], "k long, v long")
    target.commit({"T": df.select("v", "k")}, "load", 0)  # another order of columns is no difference
    source.commit({"T": df}, "load", 0)
    at = (target, 1), (source, 1)
    assert versioned.differing_buckets("T", *at) == [] and versioned.changes("T", *at).count() == 0
    source.commit({"T": df.where("k <> 3").union(spark.createDataFrame([(3, -1)], df.schema))}, "load", 1)
    (bucket,) = versioned.differing_buckets("T", (target, 1), (source, 2))
    read = source.rows_of("T", [bucket])
    assert 0 < read.count() < 100 and all(f"_bucket={bucket}" in f for f in read.inputFiles())  # a quarter of the files
    assert rows(versioned.changes("T", (target, 1), (source, 2))) == [(3, "changed")]
    before = target.marker()["tables"]["T"]["buckets"]
    for mode in ("absent", "changed"):
        versioned.copy_differing("T", source, target, "copy", mode == "changed", mode)
        want = merge.copy_table(source.read()["T"], df, ["k"], mode=mode)
        assert rows(target.read()["T"], "k", "v") == rows(want, "k", "v")
    after = target.marker()["tables"]["T"]["buckets"]
    assert [b for b in before if before[b]["path"] != after[b]["path"]] == [bucket]
    (status,) = versioned.copy_status(["T"], source, target).collect()
    assert status.asDict() == {"table_name": "T", "source_n": 200, "target_n": 200, "buckets": 4, "differing": 0, "added": 0, "removed": 0, "changed": 0}


def test_buckets_that_lose_all_rows_go(spark, tmp_path):
    source, target = store_at(spark, tmp_path / "s", T=["k"]), store_at(spark, tmp_path / "t", T=["k"])
    df = spark.range(50).withColumnRenamed("id", "k")
    source.commit({"T": df.where("k = 5")}, "load", 0)
    target.commit({"T": df}, "load", 0)
    versioned.copy_differing("T", source, target, "copy", 0, "reset")
    assert rows(target.read()["T"]) == [(5,)] and len(target.marker()["tables"]["T"]["buckets"]) == 1


# merges in a stream


def test_a_batch_merges_once_however_often_it_comes(spark, tmp_path):
    store = store_at(spark, tmp_path / "t", T=["k"])
    store.commit({"T": spark.createDataFrame([], "k long, n long"), "Other": spark.range(3)}, "setup", 0)
    calls = []

    def add(batch, tables):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("broken")
        return {**tables, "T": tables["T"].unionByName(batch.select(F.col("id").alias("k"), F.lit(1).cast("long").alias("n")))}

    apply = landed.merge_writer(store, "w", add)
    apply(spark.range(5), 0)
    with pytest.raises(RuntimeError):
        apply(spark.range(5, 9), 1)
    assert store.counts()["T"] == 5
    apply(spark.range(5, 9), 1)
    apply(spark.range(5, 9), 1)
    assert rows(store.read()["T"], "k") == [(i,) for i in range(9)] and store.version() == 3
    assert store.marker(3)["tables"]["Other"] == store.marker(1)["tables"]["Other"]  # untouched tables aren't written


# resumed prune


def schema(spark):
    d = spark.createDataFrame
    return {
        "Journal_Ranking_Subject_Category": d([(1, 1), (2, 1)], "journal_ranking_id long, c long"),
        "Journal_Ranking": d([(1, 1), (2, 2)], "journal_ranking_id long, journal_id long"),
        "Journal_Subject_Category": d([(1, 1), (2, 1)], "journal_id long, c long"),
        "Sub_Topic": d([(1, 5), (2, 6), (3, 5)], "article_id long, topic_id long"),
        "Keyword_Article": d([(1, 7), (2, 8)], "article_id long, keyword_id long"),
        "Author_Article": d([(1, 1), (2, 2), (3, 1)], "article_id long, author_id long"),
        "Institution_Author": d([(1, 9), (2, 8)], "author_id long, institution_id long"),
        "Article": d([(1, 10), (2, 11), (3, 10)], "article_id long, issue_id long"),
        "Author": d([(1,), (2,), (3,)], "author_id long"),
        "Institution": d([(9,), (8,)], "institution_id long"),
        "Keyword": d([(7,), (8,)], "keyword_id long"),
        "Issue": d([(10, 1), (11, 2)], "issue_id long, volume_id long"),
        "Volume": d([(1, 1), (2, 2)], "volume_id long, journal_id long"),
        "Journal": d([(1,), (2,)], "journal_id long"),
        "Other": d([(4,)], "x long"),
    }


class Stop(RuntimeError):
    pass


def test_a_prune_resumes_after_any_stage(spark, tmp_path):
    tables = schema(spark)
    items, guard = spark.createDataFrame([(1,), (3,)], "article_id long"), {"Keyword": spark.createDataFrame([(8,)], "keyword_id long")}
    kept = closure.keep_sets(tables, items, guard)
    want = {n: rows(df) for n, df in closure.prune(tables, kept).items()}
    assert set(closure.PRUNE_STAGES) < set(tables)
    store = versioned.VersionedTables(spark, str(tmp_path), buckets=1)
    store.commit(tables, "load", 0)
    done, broken = [], []

    def after(stage):  # breaks once after every single stage
        done.append(stage)
        if stage not in broken:
            broken.append(stage)
            raise Stop

    for _ in range(len(closure.PRUNE_STAGES) + 1):
        with pytest.raises(Stop):
            staged_prune(store, items, "r1", "PRUNE-r1", guard, after)
    assert {n: df.count() for n, df in store.read(names=["Journal", "Author"]).items()} == {"Journal": 1, "Author": 1}
    report = {r["table_name"]: (r["total"], r["keep"], r["remove"]) for r in staged_prune(store, items, "r1", "PRUNE-r1", guard, after).collect()}
    assert done == ["closure", *closure.PRUNE_STAGES] == broken  # no stage ran twice
    assert {n: rows(df) for n, df in store.read(names=list(tables)).items()} == want
    assert report == {n: (tables[n].count(), len(want[n]), tables[n].count() - len(want[n])) for n in closure.PRUNE_STAGES}
    version = store.version()
    assert rows(staged_prune(store, items, "r1", "PRUNE-r1", guard, after)) == rows(prune_report(store, "r1")) and store.version() == version  # finished: no-op
    assert rows(store.read(1)["Article"]) == rows(tables["Article"])  # the version before stays


def test_a_prune_refuses_drift_and_wants_confirmation(spark, tmp_path):
    tables = {n: df for n, df in schema(spark).items() if n in ("Article", "Author_Article", "Author")}
    items = spark.createDataFrame([(1,)], "article_id long")
    store = versioned.VersionedTables(spark, str(tmp_path), buckets=1)
    store.commit(tables, "load", 0)
    with pytest.raises(ValueError, match="PRUNE-r"):
        staged_prune(store, items, "r", "yes")
    assert store.version() == 1

    def stop(stage):
        if stage == "Author_Article":
            raise Stop

    with pytest.raises(Stop):
        staged_prune(store, items, "r", "PRUNE-r", after=stop)
    with pytest.raises(versioned.Conflict, match="checksum"):
        staged_prune(store, spark.createDataFrame([(2,)], "article_id long"), "r", "PRUNE-r")
    store.commit({"Author": tables["Author"].union(spark.createDataFrame([(9,)], "author_id long"))}, "someone", 0)
    with pytest.raises(versioned.Conflict, match="Author"):
        staged_prune(store, items, "r", "PRUNE-r")


# archives


def test_archives_lead_to_issues_and_articles(spark):
    a = lambda url, text: f'<a href="{url}">{text}</a>'
    pages = spark.createDataFrame(
        [
            ("https://x.org/issue/archive", a("/issue/view/2", "Tập 2 (2019)") + a("issue/view/1", "relative: /issue/issue/view/1") + a("/issue/view/3", "pdf") + a("/issue/view/4", "") + a("/about", "About")),
            ("https://x.org/issue/view/2", a("/article/view/1", "<i>One</i> &amp; only") + a("/article/view/1/pdf", "PDF") + a("/article/view/2", "Two") + a("/article/view/2", "again") + a("/issue/archive", "Up")),
            ("https://x.org/issue/issue/view/1", a("https://x.org/article/view/1", "One in another issue") + a("/article/view/9", "Not landed")),
            ("https://x.org/article/view/1", '<meta name="citation_title" content="Own title"><meta name="citation_author" content="A"><meta name="citation_author" content="B"><meta name="dc.date" content="2021-05-01"><meta name="citation_pdf_url" content="u.pdf">'),
            ("https://x.org/article/view/2", '<meta property="og:title" content="Graph title"><meta name="keywords" content="a; b, a"><meta name="citation_doi" content="DOI: 10.1/Q">'),
            ("https://z.org/list", "nothing here"),
        ],
        "url string, html string",
    )
    seeds = spark.createDataFrame([("X", "https://x.org//", None, "vi"), ("Z", "https://z.org", "https://z.org/list", "en"), ("N", "https://none.org", "", "en")], "code string, base_url string, archive_url string, language string")
    got, warnings = crawl.crawl_journals(pages, seeds)
    plain = {(r["source_url"].rsplit("/", 1)[1], r["issue"]): (r["title"], r["authors"], r["doi"], r["pdf_url"], r["keywords"], r["publication_year"], r["language"]) for r in got.collect()}
    two, one = "Tập 2 (2019)", "relative: /issue/issue/view/1"
    own = ("Own title", ["A", "B"], None, "u.pdf", [], 2021, "vi")
    assert plain == {("1", two): own, ("1", one): own, ("2", two): ("Graph title", [], "10.1/Q", None, ["a", "b"], 2019, "vi"), ("9", one): ("Not landed", [], None, None, [], None, "vi")}
    assert sorted(r["source_journal_code"] for r in warnings.collect()) == ["N", "Z"]
    first, _ = crawl.crawl_journals(pages, seeds, limit=2)
    assert sorted(r["source_url"].rsplit("/", 1)[1] for r in first.collect()) == ["1", "2"]


def test_expansion_is_bounded_and_reads_no_page_twice(spark):
    rng = random.Random(1)
    links = {i: [rng.randrange(30) for _ in range(3)] for i in range(25)}  # 25 to 29 have not landed
    pages = spark.createDataFrame([(str(i), " ".join(map(str, v))) for i, v in links.items()], "url string, html string")
    read = []

    def follow(df, depth):
        read.append(sorted(int(r["url"]) for r in df.select("url").collect()))
        return df.select("url", F.posexplode(F.split("html", " ")).alias("place", "link")).withColumn("label", F.lit(""))

    for depth in (1, 3, 6):
        read.clear()
        got = rows(crawl.expand(pages, spark.createDataFrame([("o", "0"), ("o", "0"), ("p", "1")], "origin string, url string"), follow, depth), "origin", "depth", "parent", "place", "link")
        want = []
        for origin, start in (("o", 0), ("p", 1)):
            seen, frontier = {start}, [start]
            for d in range(1, depth + 1):
                edges = [(origin, d, str(u), i, str(v)) for u in frontier for i, v in enumerate(links.get(u, []))]
                want += edges
                frontier = list(dict.fromkeys(int(e[4]) for e in edges if int(e[4]) not in seen))
                seen.update(frontier)
        assert got == sorted(want, key=str)
        assert len(read) == depth


# numbers and digests


def test_dense_numbers_equal_one_sort(spark):
    rng = random.Random(2)
    data = [(rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(data, "a long, b long").repartition(7)
    assert rows(numbering.dense_numbers(df, [F.desc("a"), F.asc("b")], "n", 10), "a", "b", "n") == sorted(((a, b, 10 + i) for i, (a, b) in enumerate(sorted(data, key=lambda r: (-r[0], r[1])))), key=str)
    assert numbering.dense_numbers(df.limit(0), ["a"]).count() == 0
    plan = numbering.dense_numbers(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # that of the ranges' counts


def test_new_keys_follow_the_largest_number(spark):
    current = spark.createDataFrame([(5, "b"), (9, "x")], "id int, name string")
    out = merge.get_or_create(current, spark.createDataFrame([("x",), ("c",), ("a",), (None,), ("c",)], "name string"), "id", ["name"])
    assert rows(out) == sorted([(5, "b"), (9, "x"), (10, "a"), (11, "c")], key=str) and out.schema["id"].dataType == current.schema["id"].dataType


def test_digests_hold_at_any_partitioning_and_name_the_difference(spark):
    data = [(i, f"v{i}" if i % 5 else None) for i in range(700)]
    df = spark.createDataFrame(data, "k long, v string")
    roots = {numbering.tree_digest(numbering.digest_leaves(df.repartition(n), ["k"], 16), 4) for n in (1, 3, 9)}
    assert len(roots) == 1
    other = df.withColumn("v", F.when(F.col("k") == 333, "else").otherwise(F.col("v")))
    one, two = (numbering.digest_leaves(x, ["k"], 16) for x in (df, other))
    assert numbering.tree_digest(two, 4) not in roots
    (found,) = numbering.differing_leaves(one, two).collect()
    assert (found["leaf"], found["first"]["k"], found["last"]["k"]) == (20, 320, 335)
    shorter = numbering.differing_leaves(one, numbering.digest_leaves(df.where("k < 650"), ["k"], 16))
    assert sorted(r["leaf"] for r in shorter.collect()) == [40, 41, 42, 43]
    assert numbering.tree_digest(numbering.digest_leaves(df.limit(0), ["k"])) == ""


def test_a_volume_number_is_no_year(spark):
    labels = {"Vol. 1950 (1990) &amp; more": 1990, "Vol. 2001 No. 2 (2019): Spring (2020)": 2019, "Vol. 3 2015": 2015, "1999": 1999, "Vol. 12 (12)": None, None: None}
    got = spark.createDataFrame([(k,) for k in labels], "label string").select("label", crawl.year_of(F.col("label")).alias("y")).collect()
    assert {r["label"]: r["y"] for r in got} == labels


def test_articles_of_issues_numbered_like_years_equal_the_sql(spark, tmp_path):
    spark.range(39_580, 39_640).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("<p>x</p>").alias("html")).write.parquet(f"{tmp_path}/pages.parquet")
    years = {r["source_url"]: r["publication_year"] for r in registry.QUERIES["crawled_articles"](spark, str(tmp_path)).collect()}
    assert years == {f"https://j{p // 200}.example.org/article/view/{p}": 2000 + p % 20 if p % 11 and p % 4 else 1980 + p // 20 % 40 for p in range(39_580, 39_640)}


def test_a_bucket_is_written_by_as_many_tasks_as_its_size_asks_for(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "100k")
    try:
        store = versioned.VersionedTables(spark, str(tmp_path), {"T": ["k"]}, buckets=1)
        store.commit({"T": spark.range(0, 200_000, 1, 8).select(F.col("id").alias("k"), F.xxhash64("id").alias("v"))}, "w", 0)
    finally:
        spark.conf.unset(size)
    assert len(list(tmp_path.glob("data/*/T/*/part-*"))) > 4
    assert store.counts() == {"T": 200_000} and store.read()["T"].agg(F.count_distinct("k")).first()[0] == 200_000


def test_all_that_has_landed_is_one_batch(spark, tmp_path):
    pages = spark.range(6).selectExpr("""concat('{"results":[{"title":"T', id, '"}]}') as value""").repartition(3)
    seen = {}
    for _ in range(2):
        pages.write.mode("append").text(f"{tmp_path}/pages")
        stream = landed.works_stream(spark, f"{tmp_path}/pages", None, multi_line=False)
        landed.run_batches(stream, lambda batch, i: seen.update({i: batch.count()}), f"{tmp_path}/state").awaitTermination()
    assert seen == {0: 6, 1: 6}
