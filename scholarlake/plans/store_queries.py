"""Registered queries of versioned tables, resumed runs, archive walks, dense numbers and ordered digests, each with its SQL.

Roles of the given tables as in the registry; what a query stores lies below the session's shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlake.operators import crawl, merge, numbering
from scholarlake.plans import pipelines
from scholarlake.plans.flow_queries import SYNC_TABLES, key, none
from scholarlake.plans.registry import Tables, protected, query, schema_tables
from scholarlake.plans.staged_prune import staged_prune
from scholarlake.sources import versioned
from scholarlake.sources.scratch import folder
from scholarlake.streaming import landed

SCHEMA_KEYS = {"Keyword_Article": ["article_id"], "Author_Article": ["article_id"], "Article": ["article_id"], "Author": ["author_id"], "Keyword": ["keyword_id"], "Issue": ["issue_id"], "Volume": ["volume_id"], "Journal": ["journal_id"]}


class Broken(RuntimeError):
    """Stands for whatever ends a run."""


# merges inside the stream


def works_pages(t: Tables) -> DataFrame:
    """A page for each order. Works of a DOI, or of a title and issue without DOI, agree in all but authors and keywords."""
    k = F.col("o_orderkey")
    with_doi, j = k % 2 == 0, F.floor(k / 4)
    pick = lambda a, b: F.when(with_doi, a).otherwise(b)
    person = F.struct(F.concat(F.lit("https://openalex.org/A"), F.col("o_custkey")).alias("id"), none("string", "orcid"), F.concat(F.lit("N"), F.col("o_custkey")).alias("display_name"))
    work = F.struct(
        F.concat(F.lit("W"), k).alias("id"),
        F.concat(pick(F.lit("Title "), F.lit("Plain ")), pick(j % 40, k % 40)).alias("title"),
        F.when(with_doi, F.concat(F.lit("https://doi.org/10.1/"), j)).alias("doi"),
        pick(2000 + j % 20, 1990 + k % 10).alias("publication_year"),
        pick(j % 50, k % 40).alias("cited_by_count"),
        F.struct(F.concat(F.lit("Vol. "), pick(j % 3, k % 3)).alias("volume"), pick(j % 2, F.floor(k / 2) % 2).cast("string").alias("issue")).alias("biblio"),
        F.struct(F.concat(F.lit("T"), pick(j % 3, k % 40 % 3)).alias("display_name"), F.lit(0.5).alias("score")).alias("primary_topic"),
        F.array(F.struct(person.alias("author"))).alias("authorships"),
        F.array(F.struct(F.col("o_orderpriority").alias("display_name"), F.lit(0.25).alias("score"))).alias("keywords"),
    )
    return t.orders.select(k, F.to_json(F.struct(F.array(work).alias("results"))).alias("value"))


WORKS = """with w as (select o_orderkey as k, o_orderkey // 4 as j, o_orderkey % 2 = 0 as d, o_custkey as c, o_orderpriority as p from orders),
a as (select case when d then 'Title ' || (j % 40) else 'Plain ' || (k % 40) end as title, case when d then 'https://doi.org/10.1/' || j end as doi, case when d then 2000 + j % 20 else 1990 + k % 10 end as y,
  case when d then j % 50 else k % 40 end as cited, case when d then j % 3 else k % 3 end as v, case when d then j % 2 else (k // 2) % 2 end as i, 'T' || (case when d then j % 3 else k % 40 % 3 end) as topic, c, p from w),
x as (select *, coalesce(doi, title || '|' || v || '/' || i || '/' || y) as article from a)
"""


@query(
    WORKS
    + """select distinct 'Article' as table_name, article as a, title || '|' || topic || '|' || y || '|' || v || '/' || i as b, cast(cited as bigint) as n from x
union all select distinct 'Author_Article', article, 'N' || c, null from x union all select distinct 'Keyword_Article', article, p, null from x
union all select distinct 'Topic', topic, null, null from x union all select distinct 'Author', 'N' || c, 'A' || c, null from x union all select distinct 'Keyword', p, null, null from x
union all select distinct 'Volume', v || '/' || y, null, null from x union all select distinct 'Issue', v || '/' || i || '/' || y, null, null from x"""
)
def stream_synced_tables(t: Tables) -> DataFrame:
    """All tables, by names instead of ids, after pages came through the stream in three batches, of which one breaks before its commit, one is delivered twice, and one brings pages again."""
    spark = t.orders.sparkSession
    path = folder(spark)
    pages = works_pages(t)
    store = versioned.VersionedTables(spark, f"{path}/tables", {"Article": ["article_id"], "Author_Article": ["article_id"], "Keyword_Article": ["article_id"]}, buckets=2)
    store.commit({n: spark.createDataFrame([], s) for n, s in SYNC_TABLES.items()}, "setup", 0)
    apply = landed.merge_writer(store, "works", lambda batch, tables: pipelines.sync_works(batch.withColumn("journal_id", F.lit(4).cast("long")), tables))
    broken = []

    def delivered(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            raise Broken("before the commit")
        apply(batch, batch_id)
        if batch_id == 1:
            apply(batch, batch_id)

    def run() -> None:
        landed.run_batches(landed.works_stream(spark, f"{path}/pages", None, multi_line=False), delivered, f"{path}/state").awaitTermination()

    # what has landed is one batch, in as many files as tasks wrote
    for some in (key() % 3 != 0, key() % 3 == 0, key() % 6 == 0):
        again = bool(broken)
        pages.where(some).drop("o_orderkey").write.mode("append").text(f"{path}/pages")
        try:
            run()
        except Exception as e:
            if again or not broken:
                raise e
            run()
    out = store.read()
    volumes = out["Volume"].select("volume_id", "volume_number", F.col("publication_year").alias("y"))
    issues = out["Issue"].join(volumes, "volume_id").select("issue_id", F.concat_ws("/", "volume_number", "issue_number").alias("place"), "y")
    topics = out["Topic"].select(F.col("topic_id").alias("primary_topic"), F.col("display_name").alias("topic"))
    arts = out["Article"].join(issues, "issue_id").join(topics, "primary_topic")
    arts = arts.withColumn("a", F.coalesce("doi", F.concat_ws("|", "title", F.concat_ws("/", "place", "y"))))
    named = arts.select("article_id", "a")
    row = lambda df, name, a, b=None, n=None: df.select(F.lit(name).alias("table_name"), a.alias("a"), (none("string") if b is None else b).alias("b"), (none("long") if n is None else n).alias("n"))
    parts = [
        row(arts, "Article", F.col("a"), F.concat_ws("|", "title", "topic", "publication_year", "place"), F.col("citation_count")),
        row(out["Author_Article"].join(out["Author"].hint(pipelines.GROWS), "author_id").join(named, "article_id"), "Author_Article", F.col("a"), F.col("display_name")),
        row(out["Keyword_Article"].join(out["Keyword"], "keyword_id").join(named, "article_id"), "Keyword_Article", F.col("a"), F.col("display_name")),
        row(out["Topic"], "Topic", F.col("display_name")),
        row(out["Author"], "Author", F.col("display_name"), F.col("openalex_id")),
        row(out["Keyword"], "Keyword", F.col("display_name")),
        row(volumes, "Volume", F.concat_ws("/", "volume_number", "y")),
        row(issues, "Issue", F.concat_ws("/", "place", "y")),
    ]
    return reduce(DataFrame.unionByName, parts)


# resumable prune

PRUNED = """
with ka as (select o_orderkey as k from orders where o_orderpriority like '1%'), ki as (select distinct o_custkey as k from orders where o_orderkey in (from ka)),
kv as (select distinct c_nationkey as k from customer where c_custkey in (from ki)), kj as (select distinct n_regionkey as k from nation where n_nationkey in (from kv)),
ku as (select distinct l_suppkey as k from lineitem where l_orderkey in (from ka)), kk as (select distinct l_partkey as k from lineitem where l_orderkey in (from ka) union select p_partkey from part where p_partkey % 501 = 0)
"""


@query(
    PRUNED
    + """select 'Keyword_Article' as table_name, l_orderkey as a, cast(l_partkey as bigint) as b from lineitem where l_orderkey in (from ka)
union all select 'Author_Article', l_orderkey, l_suppkey from lineitem where l_orderkey in (from ka) union all select 'Article', o_orderkey, o_custkey from orders where o_orderkey in (from ka)
union all select 'Author', s_suppkey, null from supplier where s_suppkey in (from ku) union all select 'Keyword', p_partkey, null from part where p_partkey in (from kk)
union all select 'Issue', c_custkey, c_nationkey from customer where c_custkey in (from ki) union all select 'Volume', n_nationkey, n_regionkey from nation where n_nationkey in (from kv)
union all select 'Journal', r_regionkey, null from region where r_regionkey in (from kj)"""
)
def resumed_prune(t: Tables) -> DataFrame:
    """All rows of all tables after a prune that broke after the closure and after two of its stages, and was called again each time and once more."""
    spark = t.orders.sparkSession
    store = versioned.VersionedTables(spark, folder(spark), SCHEMA_KEYS, buckets=2)
    tables = schema_tables(t)
    store.commit(tables, "load", 0)
    items = t.orders.where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("article_id"))

    def break_at(stage: str):
        def after(done: str) -> None:
            if done == stage:
                raise Broken(stage)

        return after

    for stage in ("closure", "Author_Article", "Issue", None, None):
        try:
            staged_prune(store, items, "urgent-1", "PRUNE-urgent-1", protected(t), break_at(stage))
        except Broken:
            continue
    rows = lambda n, df: df.select(F.lit(n).alias("table_name"), F.col(df.columns[0]).cast("long").alias("a"), (F.col(df.columns[1]).cast("long") if len(df.columns) > 1 else none("long")).alias("b"))
    return reduce(DataFrame.unionByName, [rows(n, df) for n, df in store.read(names=list(tables)).items()])


# archives


def landed_archives(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Landed pages (url, html) of journals' archives, issues of 20 pages and articles made of the given pages, and the journals; ten issues a journal."""
    p = F.col("page_id")
    issue, journal = F.floor(p / 20), F.floor(p / 200)
    host = F.concat(F.lit("https://j"), journal, F.lit(".example.org"))
    label = F.concat(F.lit("Vol. "), issue, F.lit(" ("), 1980 + issue % 40, F.lit(") &amp; more"))
    given = t.pages.select("page_id", "html", journal.alias("j"), issue.alias("i"), host.alias("host"), label.alias("label"))
    link = lambda url, text: F.concat(F.lit('<a class="x" href="'), url, F.lit('"><b>'), text, F.lit("</b></a> "))
    listed = lambda rows: F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["a"]), "")  # noqa: E731 - at most 20 pages, or ten issues
    meta = lambda name, value: F.concat(F.lit(f'<meta name="{name}" content="'), value, F.lit('">'))
    # an article's page: the given one with the tags of a journal's site; no title where 3, no date where 4 divides the page's number
    tags = F.concat(meta("citation_doi", F.concat(F.lit("doi:10.5/"), p)), F.when(p % 3 != 0, meta("citation_title", F.concat(F.lit("Meta "), p))).otherwise(F.lit("")), F.when(p % 4 != 0, meta("dc.date", (2000 + p % 20).cast("string"))).otherwise(F.lit("")), meta("citation_author", F.lit("A, B")))
    articles = given.where(p % 11 != 0).select(F.concat("host", F.lit("/article/view/"), p).alias("url"), F.concat(tags, "html").alias("html"))
    page = F.struct(p, F.concat(link(F.concat(F.lit("/article/view/"), p), F.concat(F.lit("Link "), p)), link(F.concat(F.lit("/article/view/"), p), F.lit("again")), link(F.concat(F.lit("/article/view/"), p, F.lit("/pdf")), F.lit("PDF")), link(F.lit("/issue/archive"), F.lit("up"))).alias("a"))
    issues = given.groupBy("host", "i", "label").agg(listed(page).alias("html")).select(F.concat("host", F.lit("/issue/view/"), "i").alias("url"), "html")
    there = given.select("host", "i", "label").distinct()
    shelf = F.struct(F.col("i"), F.concat(link(F.concat(F.lit("/issue/view/"), "i"), F.col("label")), link(F.concat(F.lit("/issue/view/"), "i", F.lit("/pdf")), F.lit("pdf")), link(F.lit("/about"), F.lit("About"))).alias("a"))
    archives = there.groupBy("host").agg(listed(shelf).alias("html")).select(F.concat("host", F.lit("/issue/archive")).alias("url"), "html")
    journals = given.select("j", "host").distinct()
    seeds = journals.select(F.concat(F.lit("J"), "j").alias("code"), F.concat("host", F.when(F.col("j") % 2 == 0, F.lit("//")).otherwise(F.lit(""))).alias("base_url"), none("string", "archive_url"), F.lit("vi").alias("language"))
    empty = journals.select(F.concat(F.lit("E"), "j").alias("code"), F.lit("").alias("base_url"), F.concat("host", F.lit("/none")).alias("archive_url"), F.lit("vi").alias("language"))
    return articles.unionByName(issues).unionByName(archives), seeds.unionByName(empty)


ARCHIVES = "with a as (select page_id as p, page_id // 20 as i, page_id // 200 as j, 'https://j' || (page_id // 200) || '.example.org' as host, page_id % 11 <> 0 as there from pages) "


@query(
    ARCHIVES
    + """select 'J' || j as code, host || '/article/view/' || p as source_url, case when there and p % 3 <> 0 then 'Meta ' || p else 'Link ' || p end as title, case when there then '10.5/' || p end as doi,
  case when there and p % 4 <> 0 then 2000 + p % 20 else 1980 + i % 40 end as publication_year, 'Vol. ' || i || ' (' || (1980 + i % 40) || ') & more' as volume, case when there then 'A, B' else '' end as authors, host || '/issue/view/' || i as issue_url from a"""
)
def crawled_articles(t: Tables) -> DataFrame:
    """Articles of all archives: from their own pages where landed, else from the links and their issues."""
    rows, _ = crawl.crawl_journals(*landed_archives(t))
    return rows.select(F.col("source_journal_code").alias("code"), "source_url", "title", "doi", F.col("publication_year").cast("long").alias("publication_year"), "volume", F.array_join("authors", ";").alias("authors"), "issue_url")


@query(ARCHIVES + "select distinct 'E' || j as code, 'no issue in the archive: ' || host || '/none' as warning from a")
def crawl_warnings(t: Tables) -> DataFrame:
    return crawl.crawl_journals(*landed_archives(t))[1].select(F.col("source_journal_code").alias("code"), "warning")


@query(
    ARCHIVES
    + """, e as (select distinct 'J' || j as origin, host || '/issue/archive' as parent, host || '/issue/view/' || i as link, 1 as depth from a union all select distinct 'J' || j, host || '/issue/archive', host || '/issue/view/' || i || '/pdf', 1 from a
  union all select distinct 'J' || j, host || '/issue/archive', host || '/about', 1 from a
  union all select 'J' || j, host || '/issue/view/' || i, host || '/article/view/' || p, 2 from a union all select 'J' || j, host || '/issue/view/' || i, host || '/article/view/' || p || '/pdf', 2 from a
  union all select distinct 'J' || j, host || '/issue/view/' || i, host || '/issue/archive', 2 from a)
select origin, parent, link, depth from e"""
)
def expanded_frontier(t: Tables) -> DataFrame:
    """All links within two of the archives, whatever they lead to; issues link back to their archive, which is not read again."""
    from scholarlake.functions import html

    pages, seeds = landed_archives(t)
    starts = seeds.where("code like 'J%'").select(F.col("code").alias("origin"), crawl.archive_url().alias("url"))
    follow = lambda landed_pages, depth: html.page_links(landed_pages.withColumn("page_id", F.col("url"))).withColumnRenamed("page_id", "url")
    return crawl.expand(pages, starts, follow, 2).select("origin", "parent", "link", "depth")


# numbers and digests in order


@query("select l_orderkey, l_linenumber, row_number() over (order by l_orderkey desc, l_linenumber, l_partkey, l_suppkey) as number from lineitem")
def numbered_links(t: Tables) -> DataFrame:
    links = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return numbering.dense_numbers(links, [F.desc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]).select("l_orderkey", "l_linenumber", "number")


@query(
    """with now as (select distinct l_partkey, l_suppkey from lineitem where l_partkey % 3 = 0), cur as (select *, 10 * row_number() over (order by l_suppkey, l_partkey) as id from now),
new as (select distinct l_partkey, l_suppkey from lineitem where l_partkey % 3 <> 0)
select id, l_partkey, l_suppkey from cur union all select (select coalesce(max(id), 0) from cur) + row_number() over (order by l_partkey, l_suppkey), l_partkey, l_suppkey from new"""
)
def created_pairs(t: Tables) -> DataFrame:
    """Pairs of a large dimension that are new get the next numbers."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    known = numbering.dense_numbers(pairs.where("l_partkey % 3 = 0"), ["l_suppkey", "l_partkey"], "id").withColumn("id", F.col("id") * 10)
    return merge.get_or_create(known.select("id", "l_partkey", "l_suppkey"), t.lineitem.select("l_partkey", "l_suppkey"), "id", ["l_partkey", "l_suppkey"])


DIGESTS = """with {name} as (select (row_number() over (order by o_orderkey) - 1) // 64 as leaf, o_orderkey as k, md5('{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || {value} || '}}') as h from orders) """


def digested(t: Tables, changed: bool) -> DataFrame:
    value = F.when((key() % 997 == 0) & F.lit(changed), -1).otherwise(F.col("o_custkey"))
    return numbering.digest_leaves(t.orders.select(key(), value.alias("o_custkey")), ["o_orderkey"], 64)


@query(DIGESTS.format(name="r", value="o_custkey") + "select leaf, count(*) as n, min(k) as first, max(k) as last, md5(string_agg(h, '' order by k)) as digest from r group by leaf")
def ordered_digests(t: Tables) -> DataFrame:
    return digested(t, False).select("leaf", "n", F.col("first.o_orderkey").alias("first"), F.col("last.o_orderkey").alias("last"), "digest")


@query(DIGESTS.format(name="r", value="o_custkey") + "select leaf, min(k) as first, max(k) as last from r group by leaf having count(*) filter (k % 997 = 0) > 0")
def differing_ranges(t: Tables) -> DataFrame:
    """Key ranges whose digests two versions of a table don't share."""
    found = numbering.differing_leaves(digested(t, False), digested(t, True))
    return found.select("leaf", F.col("first.o_orderkey").alias("first"), F.col("last.o_orderkey").alias("last"))


# differences of snapshots


def two_versions(t: Tables, spark: SparkSession) -> tuple[versioned.VersionedTables, versioned.VersionedTables]:
    """A source and a target of orders and customers; the target lacks orders, has others, and differs in some. Customers are equal."""
    path = folder(spark)
    orders = t.orders.select(key().alias("article_id"), F.col("o_custkey").alias("issue_id"))
    people = t.customer.select(F.col("c_custkey").alias("author_id"), "c_name")
    keys = {"Article": ["article_id"], "Author": ["author_id"]}
    source, target = (versioned.VersionedTables(spark, f"{path}/{n}", keys, buckets=8) for n in ("source", "target"))
    source.commit({"Article": orders, "Author": people}, "load", 0)
    k = F.col("article_id")
    old = orders.where(k % 101 != 0).withColumn("issue_id", F.when(k % 103 == 0, -1).otherwise(F.col("issue_id")))
    gone = orders.where(k % 107 == 0).select((-k - 1).alias("article_id"), "issue_id")
    target.commit({"Article": old.unionByName(gone), "Author": people}, "load", 0)
    return source, target


@query(
    """select o_orderkey as article_id, case when o_orderkey % 101 = 0 then 'added' else 'changed' end as kind from orders where o_orderkey % 101 = 0 or o_orderkey % 103 = 0
union all select -o_orderkey - 1, 'removed' from orders where o_orderkey % 107 = 0"""
)
def snapshot_changes(t: Tables) -> DataFrame:
    source, target = two_versions(t, t.orders.sparkSession)
    return versioned.changes("Article", (target, target.version()), (source, source.version()))


@query(
    """select 'Article' as table_name, count(*) as source_n, count(*) filter (o_orderkey % 101 <> 0) + count(*) filter (o_orderkey % 107 = 0) as target_n, count(*) filter (o_orderkey % 101 = 0) as added, count(*) filter (o_orderkey % 107 = 0) as removed, count(*) filter (o_orderkey % 101 <> 0 and o_orderkey % 103 = 0) as changed from orders
union all select 'Author', count(*), count(*), 0, 0, 0 from customer"""
)
def copy_progress(t: Tables) -> DataFrame:
    """What a copy has still to do, table by table; the equal table's rows are not read."""
    return versioned.copy_status(["Article", "Author"], *two_versions(t, t.orders.sparkSession)).drop("buckets", "differing")


@query("select o_orderkey as article_id, cast(o_custkey as bigint) as issue_id from orders union all select -o_orderkey - 1, o_custkey from orders where o_orderkey % 107 = 0")
def copied_differences(t: Tables) -> DataFrame:
    """The target after new and changed rows were copied from buckets that differ."""
    source, target = two_versions(t, t.orders.sparkSession)
    versioned.copy_differing("Article", source, target, "copy", 0)
    return target.read(names=["Article"])["Article"].select("article_id", F.col("issue_id").cast("long").alias("issue_id"))
