"""More registered queries: enrichment runs, upserts of whole flows, graph tables, sources and sinks, each with its SQL.

Roles of the given tables as in the registry. Queries of sources and sinks write what they read, derived from the
given tables, below the session's shared folder.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarlake.functions import html
from scholarlake.functions import scalars as S
from scholarlake.operators import candidates, closure, embedding, graph, merge, rankings, reports, resolve, selection
from scholarlake.plans import pipelines
from scholarlake.plans.registry import CLOSURE, Tables, bookmarks, kept, long, protected, query, schema_tables
from scholarlake.sources import readers, sinks
from scholarlake.streaming import landed


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; below one of our own only under a local master without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base}/flows-{uuid.uuid4().hex}"


def key() -> F.Column:
    return F.col("o_orderkey")


def none(kind: str, name: str | None = None) -> F.Column:
    return F.lit(None).cast(kind).alias(name) if name else F.lit(None).cast(kind)


# candidates


def journals(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    source = F.when(k % 7 != 0, F.element_at(F.array(F.lit("https://openalex.org/X"), F.lit("S"), F.lit("x")), (1 + k % 3).cast("int")))
    return t.supplier.select(k.alias("journal_id"), F.concat(source, k.cast("string")).alias("source_id"), F.when(k % 11 != 0, k % 5 == 0).alias("is_deleted"))


@query(
    """with j as (select s_suppkey as journal_id, case when s_suppkey % 7 <> 0 then ['https://openalex.org/X', 'S', 'x'][1 + s_suppkey % 3] || s_suppkey end as source_id, case when s_suppkey % 11 <> 0 then s_suppkey % 5 = 0 end as d from supplier)
select journal_id, case when source_id like 'x%' then 'unmatched' else 'matched' end as kind from j where not d and source_id is not null"""
)
def journal_candidates(t: Tables) -> DataFrame:
    j = journals(t)
    kinds = {"unmatched": candidates.unmatched_journals(j), "matched": candidates.matched_journals(j)}
    return reduce(DataFrame.unionByName, [df.select("journal_id", F.lit(n).alias("kind")) for n, df in kinds.items()])


def enriched(t: Tables) -> DataFrame:
    text = F.when(key() % 3 == 0, F.lit("10.1/x")).when(key() % 3 == 1, F.lit(" "))
    refs = F.when(key() % 4 == 0, F.array(F.lit("r"))).when(key() % 4 == 1, F.array().cast("array<string>"))
    return t.orders.select(
        key().alias("article_id"), F.when(key() % 13 != 0, F.col("o_orderpriority")).alias("title"), text.alias("doi"), F.year("o_orderdate").cast("long").alias("publication_year"), refs.alias("references"),
        F.when(key() % 5 != 0, key() % 6).alias("reference_count"), F.when(key() % 2 == 0, F.lit("p")).alias("semantic_scholar_id"), F.when(key() % 17 != 0, key() % 19 == 0).alias("is_deleted"),
    )


ENRICHED = """with a as (select o_orderkey as article_id, o_orderkey as k, case when o_orderkey % 17 <> 0 then o_orderkey % 19 = 0 end as d, cast(year(o_orderdate) as bigint) as y from orders) """


@query(ENRICHED + "select article_id from a where not d and k % 3 = 0 and y >= 1995 and (k % 4 <> 0 or k % 5 = 0 or k % 6 = 0)")
def references_missing(t: Tables) -> DataFrame:
    return candidates.references_missing(enriched(t), 1995).select("article_id")


@query(ENRICHED + "select article_id from a where not d and k % 13 <> 0 and (k % 2 <> 0 or k % 4 > 1)")
def enrichment_candidates(t: Tables) -> DataFrame:
    return candidates.enrichment_candidates(enriched(t), True).select("article_id")


@query(ENRICHED + "select count(*) as selected, count(*) filter (k % 4 = 0 or (k % 5 <> 0 and k % 6 > 0)) as with_references from a where k in (select o_orderkey from orders where o_totalprice > 100000)")
def selected_with_references(t: Tables) -> DataFrame:
    return candidates.with_references(enriched(t), t.orders.where("o_totalprice > 100000").select(key().alias("article_id")))


def people(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("author_id"), F.when(k % 3 != 0, F.concat(F.lit("https://orcid.org/"), k)).alias("orcid"), F.when(k % 4 == 0, F.concat(F.lit("https://openalex.org/A"), k)).alias("openalex_id"),
        F.when(k % 5 == 0, F.lit("seen")).alias("created_at"), F.when(k % 2 == 0, k).alias("h_index"),
    )


@query("select c_custkey as author_id, count(o_orderkey) as local_works from customer left join orders on o_custkey = c_custkey where (c_custkey % 5 <> 0 or c_custkey % 2 <> 0) and (c_custkey % 3 <> 0 or c_custkey % 4 = 0) group by 1")
def pending_authors(t: Tables) -> DataFrame:
    links = t.orders.select(F.col("o_custkey").alias("author_id"), key().alias("article_id"))
    return candidates.pending_authors(people(t), links).orderBy(*candidates.most_works_first()).select("author_id", "local_works")


@query(
    """select c_custkey as author_id, case when found then c_custkey + 1 end as works_count, case when found then c_custkey % 9 end as h_index, case when found and c_custkey % 2 = 0 then 'I' || c_custkey end as institution_id,
case when found is null then 'NOT_TRIED' when found then 'SYNCED' else 'NOT_FOUND' end as status, case when not found then 'now' when c_custkey % 5 = 0 then 'seen' end as created_at
from (select c_custkey, case when c_custkey % 3 <> 0 or c_custkey % 4 = 0 then c_custkey % 7 <> 0 end as found from customer)"""
)
def author_details(t: Tables) -> DataFrame:
    k, a = F.col("c_custkey"), people(t)
    place = F.struct(F.concat(F.lit("I"), k).alias("id"), F.lit("name").alias("display_name"))
    landed_ = t.customer.where("c_custkey % 7 <> 0").select(
        F.when(k % 4 == 0, F.concat(F.lit("https://openalex.org/A"), k)).alias("id"), F.when(k % 4 != 0, k.cast("string")).alias("orcid"), F.lit("n").alias("display_name"), (k + 1).alias("works_count"), k.alias("cited_by_count"),
        F.struct((k % 9).alias("h_index"), k.alias("i10_index")).alias("summary_stats"), F.when(k % 2 == 0, F.array(place, place)).otherwise(F.array().cast("array<struct<id:string,display_name:string>>")).alias("last_known_institutions"),
    )
    matched = candidates.match_authors(a.where("orcid is not null or openalex_id is not null"), candidates.author_summaries(landed_))
    marked = candidates.mark_scanned(a, matched, F.lit("now"))
    return marked.select("author_id", "status", "created_at").join(matched.select("author_id", "works_count", "h_index", "institution_id"), "author_id", "left")


@query("select count(*) as total, count(*) filter (p_partkey % 6 = 0 or p_size % 10 = 0) as skipped from part")
def skipped_rows(t: Tables) -> DataFrame:
    """Observed while the kept rows are counted."""
    rows = t.part.select(F.when(F.col("p_partkey") % 6 == 0, F.lit(" ")).otherwise(F.lit("s")).alias("source_id"), F.when(F.col("p_size") % 10 != 0, F.col("p_name")).alias("title"))
    good, seen = candidates.counting_skipped(rows, readers.has_source_and_title())
    good.agg(F.count("*")).collect()
    return t.part.sparkSession.createDataFrame([(seen.get["total"], seen.get["skipped"])], "total long, skipped long")


@query("select event_id, case event_id % 4 when 0 then 2 when 1 then 0 end as n, event_id % 4 = 0 as has from events")
def json_lengths(t: Tables) -> DataFrame:
    text = F.element_at(F.array(F.concat(F.lit("[1, "), "event_id", F.lit("]")), F.lit("[]"), F.lit('{"a": 1}'), none("string")), (1 + F.col("event_id") % 4).cast("int"))
    return t.events.select("event_id", S.json_length(text).cast("long").alias("n"), S.has_json_elements(text).alias("has"))


@query(
    """select user_id, event_id from (select user_id, event_id, [200, 429, 503][1 + event_id % 3] as s, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n = 1 and s <> 200"""
)
def retry_queue(t: Tables) -> DataFrame:
    status = F.element_at(F.array(*(F.lit(x) for x in (200, 429, 503))), (1 + F.col("event_id") % 3).cast("int"))
    rows = t.events.select("user_id", "event_id", "ts", status.alias("http_status"), F.lit(1).alias("n_authors"), F.lit(0).alias("n_unresolved"), F.lit(0).alias("incomplete"))
    return candidates.retry_queue(reports.outcome_class(rows), "user_id", F.desc("ts"), F.desc("event_id")).select("user_id", "event_id")


# upserts of flows


def landed_works(t: Tables) -> DataFrame:
    """Works of orders: titles shared by many, DOIs of even keys (shared by pairs), volumes and issues of journals."""
    person = F.struct(F.concat(F.lit("https://openalex.org/A"), F.col("o_custkey")).alias("id"), none("string", "orcid"), F.concat(F.lit("N"), F.col("o_custkey")).alias("display_name"))
    topic = F.concat(F.lit("T"), F.col("o_orderstatus"))
    return t.orders.select(
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.concat(F.lit("W"), key()).alias("id"),
                        F.concat(F.lit("Title "), key() % 40).alias("title"),
                        F.when(key() % 2 == 0, F.concat(F.lit("https://doi.org/10.1/"), F.floor(key() / 4))).alias("doi"),
                        F.year("o_orderdate").alias("publication_year"),
                        F.struct(F.when(key() % 5 != 0, F.concat(F.lit("Vol. "), key() % 3)).alias("volume"), F.when(key() % 7 != 0, (key() % 2).cast("string")).alias("issue")).alias("biblio"),
                        F.struct(topic.alias("display_name"), F.lit(0.5).alias("score")).alias("primary_topic"),
                        F.array(F.struct(person.alias("author"))).alias("authorships"),
                        F.array(F.struct(F.col("o_orderpriority").alias("display_name"), F.lit(0.25).alias("score"))).alias("keywords"),
                    )
                ).alias("results")
            )
        ).alias("value")
    )


SYNC_TABLES = {
    "Topic": "topic_id long, display_name string, subject_area_id long, subject_category_id long, score double",
    "Volume": "volume_id long, journal_id long, volume_number int, publication_year int, is_deleted boolean",
    "Issue": "issue_id long, volume_id long, issue_number string, publication_year int",
    "Article": "article_id long, title string, abstract string, doi string, publication_year int, issue_id long, primary_topic long, citation_count long, reference_count long, references array<string>, is_deleted boolean",
    "Author": "author_id long, orcid string, openalex_id string, display_name string",
    "Author_Article": "author_id long, article_id long",
    "Keyword": "keyword_id long, display_name string",
    "Keyword_Article": "keyword_id long, article_id long, score double",
}


@query(
    """with w as (select o_orderkey as k, 'Title ' || (o_orderkey % 40) as title, case when o_orderkey % 2 = 0 then '10.1/' || (o_orderkey // 4) end as doi, year(o_orderdate) as y,
  case when o_orderkey % 5 <> 0 then o_orderkey % 3 end as v, case when o_orderkey % 7 <> 0 then o_orderkey % 2 end as i, o_custkey as c, o_orderstatus as s, o_orderpriority as p from orders),
x as (select *, case when v is not null and i is not null then v || '/' || i || '/' || y else '' end as iss from w),
a as (select *, coalesce(doi, title || '|' || iss) as article from x)
select 'Topic' as table_name, count(distinct s) as n from a union all select 'Volume', count(distinct (v, y)) from a where v is not null union all select 'Issue', count(distinct iss) from a where iss <> ''
union all select 'Article', count(distinct article) from a union all select 'Author', count(distinct c) from a union all select 'Author_Article', count(distinct (c, article)) from a
union all select 'Keyword', count(distinct p) from a union all select 'Keyword_Article', count(distinct (p, article)) from a"""
)
def works_sync(t: Tables) -> DataFrame:
    """Counts of all tables after landed works; a page column gives the journal."""
    spark = t.orders.sparkSession
    pages = landed_works(t).select(F.from_json("value", readers.WORKS_PAGE).alias("p"), F.lit(4).cast("long").alias("journal_id")).select("p.results", "journal_id")
    # limit(0): the optimizer sees that the tables are empty
    out = pipelines.sync_works(readers.works_of(pages), {n: spark.createDataFrame([], s).limit(0) for n, s in SYNC_TABLES.items()})
    return reports.table_counts({n: out[n] for n in SYNC_TABLES})


@query("select c_custkey, coalesce(case when o % 3 <> 0 then c_mktsegment || '!' end, c_mktsegment) as segment, case when o is null then c_custkey % 3 = 0 else false end as is_deleted from (select c_custkey, c_mktsegment, case when c_custkey % 2 = 0 then c_custkey end as o from customer) where o is not null or c_custkey % 5 <> 0")
def known_values_kept(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    current = t.customer.where(k % 5 != 0).select(k, F.col("c_mktsegment").alias("segment"), (k % 3 == 0).alias("is_deleted"))
    incoming = t.customer.where(k % 2 == 0).select(k, F.when(k % 3 != 0, F.concat("c_mktsegment", F.lit("!"))).when(k % 5 == 0, F.col("c_mktsegment")).alias("segment"), F.lit(False).alias("is_deleted"))
    return merge.update_known(current, incoming, ["c_custkey"])


@query(
    """with r as (select o_orderkey as k, case when o_orderkey % 3 <> 0 then ['10.1/b', '10.1/a'] end as own, case when o_orderkey % 3 <> 0 and o_orderkey % 2 = 0 then '10.2/' || o_custkey end as other, o_orderkey % 11 = 0 as d from orders)
select k as article_id, case when own is null then '' when d then 'http://doi.org/10.1/B|10.1/a|https://openalex.org/W' || (select o_custkey from orders o where o.o_orderkey = k)
  else 'https://doi.org/10.1/a|https://doi.org/10.1/b' || case when other is null then '' else '|https://doi.org/' || other end end as refs,
  cast(case when own is null or d then 7 when other is null then 2 else 3 end as bigint) as n from r"""
)
def merged_references(t: Tables) -> DataFrame:
    refs = F.when(key() % 3 != 0, F.array(F.lit("http://doi.org/10.1/B"), F.lit("10.1/a"), F.concat(F.lit("https://openalex.org/W"), F.col("o_custkey"), F.when((key() % 2 == 0) | (key() % 11 == 0), F.lit("")).otherwise(F.lit("x")))))
    arts = t.orders.select(key().alias("article_id"), refs.alias("references"), F.lit(7).cast("long").alias("reference_count"), (key() % 11 == 0).alias("is_deleted"))
    mapping = t.customer.select(F.concat(F.lit("https://openalex.org/W"), "c_custkey").alias("work_id"), F.concat(F.lit("10.2/"), "c_custkey").alias("doi"))
    return resolve.merge_references(arts, mapping).select("article_id", F.coalesce(F.array_join("references", "|"), F.lit("")).alias("refs"), F.col("reference_count").alias("n"))


@query("select o_orderkey as article_id, case when o_orderkey % 3 = 0 then 2 else 9 end as n, case when o_orderkey % 3 = 0 and o_orderkey % 2 = 0 then o_custkey else -1 end as cited from orders")
def overwritten_references(t: Tables) -> DataFrame:
    arts = t.orders.select(key().alias("article_id"), F.array(F.lit("o")).alias("references"), F.lit(9).cast("long").alias("reference_count"), F.lit(-1).cast("long").alias("citation_count"))
    works = t.orders.where(key() % 3 == 0).select(key().alias("article_id"), F.array(F.lit("a"), F.lit("b")).alias("references"), none("long", "reference_count"), F.when(key() % 2 == 0, F.col("o_custkey")).alias("citation_count"))
    return merge.overwrite_references(arts, works).select("article_id", long("reference_count", "n"), F.col("citation_count").alias("cited"))


@query("select s_suppkey as author_id, case when s_suppkey % 2 = 1 then 'keep' || s_suppkey when s_suppkey % 4 = 2 then 'new' || (s_suppkey // 4) end as orcid, case when s_suppkey % 2 = 0 then 'n' else s_name end as display_name from supplier where s_suppkey % 4 <> 0 union all select s_suppkey, case when s_suppkey // 4 not in (select s_suppkey // 4 from supplier where s_suppkey % 4 = 2) then 'new' || (s_suppkey // 4) end, 'n' from supplier where s_suppkey % 4 = 0")
def updated_authors(t: Tables) -> DataFrame:
    """Authors 4n and 4n + 2 ask for one ORCID; the smaller id gets it."""
    k = F.col("s_suppkey")
    now = t.supplier.select(k.alias("author_id"), F.when(k % 2 == 1, F.concat(F.lit("keep"), k)).alias("orcid"), none("string", "openalex_id"), F.col("s_name").alias("display_name"))
    swapped = F.when(k % 4 == 2, F.concat(F.lit("new"), F.floor(k / 4))).otherwise(F.when(k % 4 == 0, F.concat(F.lit("new"), F.floor(k / 4))))
    details = t.supplier.where(k % 2 == 0).join(t.supplier.select((k - 2).alias("s_suppkey"), F.lit(True).alias("later")), "s_suppkey", "left").select(k.alias("author_id"), F.when((k % 4 == 2) | F.col("later").isNull(), swapped).alias("orcid"), none("string", "openalex_id"), F.lit("n").alias("display_name"))
    return merge.update_authors(now, details).select("author_id", "orcid", "display_name")


@query("select p_partkey as topic_id, p_name as display_name, case when p_partkey % 2 = 0 then 1 when p_partkey % 3 = 0 then 5 end as subject_area_id, case when p_partkey % 3 = 0 then 0.5 else 0.25 end as score from part")
def filled_topics(t: Tables) -> DataFrame:
    k, name = F.col("p_partkey"), F.concat("p_name", F.lit("#"), "p_partkey")
    topics = t.part.select(k.alias("topic_id"), name.alias("display_name"), F.when(k % 2 == 0, 1).cast("long").alias("subject_area_id"), none("long", "subject_category_id"), F.lit(0.25).alias("score"))
    incoming = t.part.where(k % 3 == 0).select(name.alias("display_name"), F.lit(5).cast("long").alias("subject_area_id"), none("long", "subject_category_id"), F.lit(0.5).alias("score"))
    return merge.fill_topics(topics, incoming).select("topic_id", F.substring_index("display_name", "#", 1).alias("display_name"), "subject_area_id", "score")


@query("select c_nationkey as journal_id, c_custkey as value_int, case when c_custkey % 2 = 0 then 2 else 1 end as subject_category_id from (select cast(c_nationkey as bigint) as c_nationkey, c_custkey from customer) where c_custkey % 3 <> 0 or c_custkey % 2 = 0")
def upserted_rankings(t: Tables) -> DataFrame:
    row = lambda cat: [long("c_nationkey", "journal_id"), F.lit(1).cast("long").alias("metric_id"), F.lit(2025).alias("year"), none("string", "value_txt"), F.col("c_custkey").alias("value_int"), none("double", "value_float"), F.lit(cat).cast("long").alias("subject_category_id")]
    out = merge.ranking_upsert(t.customer.where("c_custkey % 3 <> 0").select(*row(1)), t.customer.where("c_custkey % 2 = 0").select(*row(2)))
    return out.select("journal_id", "value_int", "subject_category_id")


@query("select vec_id, vec_id % 3 = 0 and embedding is not null as kept from embeddings")
def cleared_dimensions(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", F.when(F.col("vec_id") % 3 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 3)).alias("embedding"))
    return merge.clear_other_dimensions(rows, 64, "REPLACE-64").select("vec_id", F.col("embedding").isNotNull().alias("kept"))


@query("select o_orderkey as article_id, row_number() over (order by o_totalprice desc, o_orderkey) as rank from orders qualify rank <= 500")
def active_manifest(t: Tables) -> DataFrame:
    """Items of the manifest that a second activation left active."""
    spark = t.orders.sparkSession
    chosen = reports.top(t.orders.select(key().alias("article_id"), "o_totalprice"), 500, F.desc("o_totalprice"), F.asc("article_id"))
    m = spark.createDataFrame([], "manifest_name string, target_count long, selected_count long, checksum string, is_active boolean")
    i = spark.createDataFrame([], "manifest_name string, article_id long, rank long, reason string")
    ranked = chosen.select("article_id", F.row_number().over(Window.orderBy(F.desc("o_totalprice"), "article_id")).cast("long").alias("selected_rank"), F.lit("x").alias("selection_reason"))
    m, i = selection.activate_manifest(m, i, "first-one", ranked.where("selected_rank <= 10"), 10)
    m, i = selection.activate_manifest(m, i, "second-one", ranked, 500)
    return selection.active_items(m, i).select("article_id", "rank")


@query("select mode, count(*) as n, cast(sum(case when mode = 'absent' and there then 1 else price end) as bigint) as total from (select p_partkey % 3 <> 0 as there, 1 + p_partkey % 2 as price from part), (select unnest(['absent', 'changed', 'replace', 'reset']) as mode) group by mode")
def copied_tables(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    source = t.part.select(k, (1 + k % 2).alias("price"), F.lit("s").alias("only_here"))
    target = t.part.where(k % 3 != 0).select(k, F.lit(1).cast("long").alias("price"), F.lit("t").alias("only_there"))
    counted = [merge.copy_table(source, target, ["p_partkey"], mode=m).agg(F.lit(m).alias("mode"), F.count("*").alias("n"), F.sum("price").alias("total")) for m in ("absent", "changed", "replace", "reset")]
    return reduce(DataFrame.unionByName, counted)


@query("select 'Article' as table_name, count(*) as n from orders where o_custkey in (select c_custkey from customer where lower(c_mktsegment) like '%build%') or o_orderkey in (select l_orderkey from lineitem join part on l_partkey = p_partkey where lower(p_type) like '%build%' or lower(p_type) like '%brass%') or o_custkey in (select c_custkey from customer where lower(c_mktsegment) like '%brass%')")
def domain_copy(t: Tables) -> DataFrame:
    tables = {
        "Article": t.orders.select(key().alias("article_id"), F.col("o_custkey").alias("primary_topic"), none("long", "issue_id")),
        "Topic": t.customer.select(F.col("c_custkey").alias("topic_id"), F.col("c_mktsegment").alias("display_name")),
        "Keyword": t.part.select(F.col("p_partkey").alias("keyword_id"), F.col("p_type").alias("display_name")),
        "Sub_Topic": t.orders.limit(0).select(key().alias("article_id"), F.col("o_custkey").alias("topic_id")),
        "Keyword_Article": t.lineitem.select(F.col("l_orderkey").alias("article_id"), F.col("l_partkey").alias("keyword_id")),
    }
    return reports.table_counts({"Article": pipelines.domain_subset(tables, S.normalize_terms("build;BRASS"))["Article"]})


@query(
    """with a as (select o_orderkey from orders order by case when o_orderkey % 2 = 0 then 0 else 1 end, o_custkey desc nulls last, o_orderkey limit 1000)
select 'Article' as table_name, count(*) as n from a union all select 'Author', count(distinct l_suppkey) from lineitem where l_orderkey in (from a) union all select 'Author_Article', count(*) from lineitem where l_orderkey in (from a)"""
)
def priority_copy(t: Tables) -> DataFrame:
    s = schema_tables(t)
    tables = {"Article": t.orders.select(key().alias("article_id"), none("long", "issue_id"), F.when(key() % 2 == 0, F.array(F.lit("r"))).alias("references"), F.col("o_custkey").alias("reference_count")), "Author": s["Author"], "Author_Article": s["Author_Article"]}
    out = pipelines.priority_subset(tables, 1000)
    return reports.table_counts({n: out[n] for n in tables})


@query(CLOSURE + "select 'Keyword' as table_name, count(*) as missing from part where p_partkey % 501 = 0 and p_partkey not in (select l_partkey from lineitem where l_orderkey in (from ka))")
def protected_lost(t: Tables) -> DataFrame:
    """What a closure without protection would lose."""
    return closure.protected_missing(closure.keep_sets(schema_tables(t), bookmarks(t)), protected(t))


@query(CLOSURE + "select 'closed:' || table_name as check_name, total = keep as ok, total - keep as observed from r union all select 'manifest_complete', true, 0")
def unpruned_found(t: Tables) -> DataFrame:
    """The checks of a prune on tables that were not pruned."""
    tables, k = kept(t)
    return closure.verify_prune(tables, k, bookmarks(t))


@query(CLOSURE + "select 'r1' as run, table_name as stage, 'done' as status, total - keep as removed from r where table_name in ('Keyword_Article', 'Article')")
def prune_checkpoints(t: Tables) -> DataFrame:
    tables, k = kept(t)
    report = closure.keep_report(tables, closure.prune(tables, k), False)
    points = t.orders.sparkSession.createDataFrame([], "run string, stage string, checksum string, status string, removed long")
    for stage in ("Keyword_Article", "Article"):
        points = closure.record_stage(points, "r1", "c", stage, report.where(F.col("table_name") == stage).select(F.col("remove").alias("removed")))
    return points.select("run", "stage", "status", "removed")


# resolution


@query(
    """with j as (select s_suppkey as id, case when s_suppkey % 2 = 0 then 'S' || s_suppkey end as src, lpad(cast(s_suppkey % 30 as varchar), 8, '0') as a, lpad(cast(100 + s_suppkey % 20 as varchar), 8, '0') as b from supplier),
tok as (select tok, max(id) as id from (select id, a as tok from j union all select id, b from j) group by tok), s as (select src, max(id) as id from j where src is not null group by src),
r as (select c_custkey as row_id, 'S' || c_custkey as src, lpad(cast(c_custkey % 35 as varchar), 8, '0') as a, lpad(cast(100 + c_custkey % 25 as varchar), 8, '0') as b from customer)
select row_id, coalesce(s.id, x.id, y.id) as journal_id from r left join s using (src) left join tok x on x.tok = r.a left join tok y on y.tok = r.b"""
)
def resolved_journals(t: Tables) -> DataFrame:
    tok = lambda c, n, plus=0: F.lpad((plus + F.col(c) % n).cast("string"), 8, "0")
    known = t.supplier.select(F.col("s_suppkey").alias("journal_id"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("S"), "s_suppkey")).alias("source_id"), F.concat(tok("s_suppkey", 30), F.lit(", "), tok("s_suppkey", 20, 100)).alias("issn"))
    rows = t.customer.select(F.col("c_custkey").alias("row_id"), F.concat(F.lit("S"), "c_custkey").alias("source_id"), F.concat(tok("c_custkey", 35), F.lit(" "), tok("c_custkey", 25, 100)).alias("issn"))
    return resolve.resolve_journals(rows, known).select("row_id", "journal_id")


@query(
    """with a as (select s_suppkey as id, case when s_suppkey % 3 = 0 then 'A' || s_suppkey end as oa, case when s_suppkey % 3 = 1 then 'O' || s_suppkey end as orc, 'n' || (s_suppkey % 50) as nm from supplier),
n as (select nm, min(id) as id from a where oa is null and orc is null group by 1), r as (select c_custkey as row_id, 'A' || c_custkey as oa, 'O' || (c_custkey - 1) as orc, 'n' || (c_custkey % 60) as nm from customer)
select row_id, coalesce(x.id, y.id, n.id) as author_id, case when x.id is not null then 'openalex_id' when y.id is not null then 'orcid' when n.id is not null then 'name' end as step from r left join a x on x.oa = r.oa left join a y on y.orc = r.orc left join n on n.nm = r.nm"""
)
def resolved_authors(t: Tables) -> DataFrame:
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    known = t.supplier.select(k.alias("author_id"), F.when(k % 3 == 0, F.concat(F.lit("A"), k)).alias("openalex_id"), F.when(k % 3 == 1, F.concat(F.lit("O"), k)).alias("orcid"), F.concat(F.lit("n"), k % 50).alias("display_name"))
    rows = t.customer.select(c.alias("row_id"), F.concat(F.lit("A"), c).alias("openalex_id"), F.concat(F.lit("O"), c - 1).alias("orcid"), F.concat(F.lit("n"), c % 60).alias("display_name"))
    return resolve.resolve_authors(rows, known)


@query("select o_orderkey, cast(n_nationkey as bigint) as nation, coalesce(case when o_orderkey % 2 = 0 then o_orderpriority end, c_mktsegment, 'none') as segment from orders left join nation on lower(n_name) = lower('nation_' || (o_orderkey % 30)) left join customer on c_custkey = o_custkey + 1")
def filled_from_lookups(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.concat(F.lit("NATION_"), key() % 30).alias("name"), (F.col("o_custkey") + 1).alias("c_custkey"), F.when(key() % 2 == 0, F.col("o_orderpriority")).alias("segment"))
    named = resolve.lookup_ignoring_case(rows, t.nation.select("n_name", long("n_nationkey", "nation")), "name", "n_name", "nation")
    return merge.fill_from(named, t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment")), "c_custkey", "segment", F.lit("none")).select("o_orderkey", "nation", "segment")


# graph


def graph_tables(t: Tables) -> dict[str, DataFrame]:
    gone = lambda c: (F.col(c) % 10 == 0).alias("is_deleted")
    return {
        "Publisher": t.region.select(long("r_regionkey", "publisher_id"), F.col("r_name").alias("display_name")),
        "Journal": t.nation.select(long("n_nationkey", "journal_id"), F.col("n_name").alias("display_name"), long("n_regionkey", "publisher_id"), (F.col("n_nationkey") % 3).cast("long").alias("country"), (F.col("n_nationkey") % 10 == 9).alias("is_deleted")),
        "Volume": t.customer.select(F.col("c_custkey").alias("volume_id"), long("c_nationkey", "journal_id"), gone("c_custkey")),
        "Issue": t.customer.select(F.col("c_custkey").alias("issue_id"), (F.col("c_custkey") + 1).alias("volume_id")),
        "Article": t.orders.select(key().alias("article_id"), F.col("o_custkey").alias("issue_id"), F.concat(F.lit(" 10.1/A"), key()).alias("doi"), (key() % 10 == 0).alias("is_deleted")),
        "Author": t.supplier.select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("display_name"), gone("s_suppkey")),
        "Author_Article": t.lineitem.select(F.col("l_suppkey").alias("author_id"), F.col("l_orderkey").alias("article_id")),
        "Keyword": t.part.select(F.col("p_partkey").alias("keyword_id"), F.col("p_name").alias("display_name")),
        "Keyword_Article": t.lineitem.select(F.col("l_partkey").alias("keyword_id"), F.col("l_orderkey").alias("article_id")),
        "Zone": t.region.select(long("r_regionkey", "zone_id")),
    }


@query(
    """select 'Publisher' as label, cast(r_regionkey as bigint) as id, r_name as name from region union all select 'Journal', n_nationkey, n_name from nation where n_nationkey % 10 <> 9 union all select 'Volume', c_custkey, null from customer where c_custkey % 10 <> 0
union all select 'Issue', c_custkey, null from customer union all select 'Article', o_orderkey, '10.1/a' || o_orderkey from orders where o_orderkey % 10 <> 0 union all select 'Author', s_suppkey, s_name from supplier where s_suppkey % 10 <> 0 union all select 'Keyword', p_partkey, p_name from part"""
)
def graph_node_frames(t: Tables) -> DataFrame:
    frames = graph.schema_nodes(graph_tables(t))
    name = lambda df: F.col("name") if "name" in df.columns else F.col("doi") if "doi" in df.columns else none("string")
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("label"), "id", name(df).alias("name")) for n, df in frames.items()])


@query(
    """with j as (select cast(n_nationkey as bigint) as j, cast(n_regionkey as bigint) as p from nation where n_nationkey % 10 <> 9), v as (select c_custkey as v, cast(c_nationkey as bigint) as j from customer where c_custkey % 10 <> 0), i as (select c_custkey as i, c_custkey + 1 as v from customer),
a as (select o_orderkey as a, o_custkey as i from orders where o_orderkey % 10 <> 0), l as (select distinct l_suppkey as s, l_partkey as p, l_orderkey as a from lineitem where l_orderkey % 10 <> 0),
e as (select 'PUBLISHES' as type, p as src, j as dst from j union all select 'LOCATED_IN', j, j % 3 from j union all select 'BELONGS_TO_JOURNAL', v, j from v where j in (select j from j) union all select 'BELONGS_TO_VOLUME', i, v from i where v in (select v from v)
  union all select 'PUBLISHED_IN_ISSUE', a, i from a where i in (select i from i) union all select distinct 'PUBLISHED_IN', a, j from a join i using (i) join v using (v) join j using (j)
  union all select distinct 'WRITES', s, a from l where s % 10 <> 0 union all select distinct 'HAS_KEYWORD', a, p from l)
select type, src, dst from e"""
)
def graph_schema_edges(t: Tables) -> DataFrame:
    found = graph.schema_edges(graph_tables(t))
    return reduce(DataFrame.unionByName, [df.select("type", "src", "dst") for df in found.values()])


# sources and sinks


@query(
    """select c_custkey, 'RANK' as metric, c_custkey as value_int, cast(null as double) as value_float from customer where c_custkey % 4 <> 0
union all select c_custkey, 'SJR', null, c_custkey + 0.5 from customer where c_custkey % 4 <> 0 union all select c_custkey, 'TOTAL_DOCS_CURRENT_YEAR', cast(c_nationkey as bigint), null from customer where c_custkey % 4 <> 0"""
)
def ranking_file_metrics(t: Tables) -> DataFrame:
    """A ranking file written from customers, read back, mapped and melted; the lines of every fourth have no title."""
    path, k = folder(t.customer.sparkSession), F.col("c_custkey")
    file = t.customer.select(k.cast("string").alias("Rank"), F.concat(F.lit("S"), k).alias("Sourceid"), F.when(k % 4 != 0, F.concat(F.lit('"x;y" '), "c_name")).otherwise(F.lit("")).alias(" Title "), F.concat(k, F.lit(",5")).alias("SJR"), F.col("c_nationkey").cast("string").alias("Total Docs. (2025)"))
    file.write.csv(path, sep=";", header=True, escape='"')
    rows = readers.require_source_and_title(readers.map_ranking_columns(readers.read_ranking(t.customer.sparkSession, path)))
    found = rankings.first_metric_rows(rankings.metric_rows(rows.withColumn("journal_id", F.substring("source_id", 2, 20).cast("long"))))
    return found.select(F.col("journal_id").alias("c_custkey"), "metric", "value_int", "value_float")


@query("select 'part' as table_name, count(*) as n, true as ok from part union all select 'supplier', count(*), true from supplier")
def snapshot_verified(t: Tables) -> DataFrame:
    path = folder(t.part.sparkSession)
    sinks.write_snapshot({"part": t.part, "supplier": t.supplier}, path)
    return sinks.verify_snapshot(t.part.sparkSession, path).select("table_name", "n", "ok")


@query("select s_suppkey, s_name || ', \"x\"' as name, s_acctbal from supplier")
def report_written(t: Tables) -> DataFrame:
    path, spark = folder(t.supplier.sparkSession), t.supplier.sparkSession
    sinks.write_report(t.supplier.select("s_suppkey", F.concat("s_name", F.lit(', "x"')).alias("name"), "s_acctbal"), path)
    return spark.read.csv(path, header=True, schema="s_suppkey long, name string, s_acctbal double", enforceSchema=True, escape="\\")


@query("select cast(n_nationkey as bigint) as journal_id, count(c_custkey) as n, min(c_custkey) as first, case when n_nationkey % 2 = 0 then 1 else 0 end as warned from nation left join customer on c_nationkey = n_nationkey group by n_nationkey")
def nested_records(t: Tables) -> DataFrame:
    """Journals with their articles nested, written as JSON and read back."""
    spark, path = t.nation.sparkSession, folder(t.nation.sparkSession)
    j = t.nation.select(long("n_nationkey", "journal_id"))
    nested = sinks.nested_articles(j, t.customer.select(long("c_nationkey", "journal_id"), F.col("c_custkey").alias("article_id")), j.where("journal_id % 2 = 0").withColumn("warning", F.lit("w")))
    sinks.write_json(nested, path)
    back = spark.read.schema("journal_id long, articles array<struct<article_id:long>>, warnings array<string>").json(path)
    return back.select("journal_id", F.size("articles").cast("long").alias("n"), F.array_min(F.transform("articles", lambda x: x["article_id"])).alias("first"), F.size("warnings").cast("int").alias("warned"))


@query("select 'Article' as table_name, count(*) as n from orders where o_orderkey % 997 = 0 union all select 'Author_Article', count(*) from lineitem where l_orderkey % 997 = 0 union all select 'Keyword_Article', count(*) from lineitem where l_orderkey % 997 = 0")
def manifest_exported(t: Tables) -> DataFrame:
    """Tables of the active manifest through its written items and exports."""
    spark, path = t.orders.sparkSession, folder(t.orders.sparkSession)
    sinks.write_manifest(bookmarks(t).withColumn("manifest_name", F.lit("m-1")), f"{path}/items")
    exports = sinks.manifest_exports(spark.read.parquet(f"{path}/items"), schema_tables(t))
    sinks.write_tables(list(exports.items()), path)
    return reports.table_counts({n: spark.read.parquet(f"{path}/{n}") for n in exports})


@query("select count(*) as n, cast(sum(o_orderkey) as bigint) as ids, count(distinct o_orderkey % 40) as titles from orders")
def streamed_works(t: Tables) -> DataFrame:
    """Landed pages through the stream into batch snapshots."""
    spark, path = t.orders.sparkSession, folder(t.orders.sparkSession)
    landed_works(t).write.text(f"{path}/pages")
    stream = spark.readStream.schema(readers.WORKS_PAGE).option("maxFilesPerTrigger", 2).json(f"{path}/pages")
    landed.run_batches(readers.works_of(stream), landed.snapshot_writer(f"{path}/out", lambda df: df.select("id", "title")), f"{path}/state").awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return out.agg(F.count("*").alias("n"), F.sum(F.substring("id", 2, 20).cast("long")).alias("ids"), F.count_distinct("title").alias("titles"))


@query("select doc_id, cast(length(t) as double) as a, cast(length(t) // 2 as double) as b from (select doc_id, trim(coalesce(source, '') || '. ' || coalesce(lang, ''), '. ') as t from documents) where t <> ''")
def embedded_texts(t: Tables) -> DataFrame:
    arts = t.documents.select(F.col("doc_id").alias("article_id"), F.col("source").alias("title"), F.col("lang").alias("abstract"), F.lit(False).alias("is_deleted"), none("array<float>", "embedding"))
    vectors = embedding.embed(embedding.pending(arts), lambda: lambda texts: [[len(x), len(x) // 2] for x in texts], 2)
    stored = embedding.store_embeddings(arts, vectors).where("embedding is not null")
    return stored.select(F.col("article_id").alias("doc_id"), F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"))


@query("select o_orderkey, o_orderkey % 100 as volume, case when o_orderkey % 2 = 0 then 'short' else o_orderpriority end as tldr, 'S_NOT_FOUND_' || coalesce(case when o_orderkey % 3 = 0 then 'x' end, '') as label, case when o_orderkey % 5 = 0 then '10.1/a|b' else 'b' end as refs from orders")
def small_functions(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", S.volume_number(F.concat(F.lit("Vol. "), key() % 100, F.lit("-7"))).cast("long").alias("volume"), S.tldr_text(F.when(key() % 2 == 0, F.lit(' {"text": "short"}')).otherwise(F.col("o_orderpriority"))).alias("tldr"),
        S.failed_source_label(F.lit("NOT_FOUND"), F.when(key() % 3 == 0, F.lit("x"))).alias("label"), F.array_join(S.clean_references(F.array(F.when(key() % 5 == 0, F.lit(" 10.1/A ")).otherwise(F.lit(" ")), F.lit("B"))), "|").alias("refs"),
    )


@query("select o_orderkey as article_id, cast(year(o_orderdate) as bigint) as publication_year, o_orderpriority as title from orders where o_orderkey % 10 <> 0 order by case when o_orderkey % 7 = 0 then 0 else 1 end")
def works_report(t: Tables) -> DataFrame:
    arts = candidates.live(t.orders.select(key().alias("article_id"), F.year("o_orderdate").cast("long").alias("publication_year"), F.col("o_orderpriority").alias("title"), (key() % 10 == 0).alias("is_deleted")))
    return reports.in_report_order(arts.drop("is_deleted"))


@query("select doc_id, 'Tom & <' || lang || '> é' as text from documents where lang is not null")
def unescaped_texts(t: Tables) -> DataFrame:
    return t.documents.where("lang is not null").select("doc_id", html.clean_text(F.concat(F.lit("<p>Tom &amp;\n "), F.lit("&lt;"), "lang", F.lit("&gt;</p> &eacute; "))).alias("text"))


@query("select p_partkey, case when p_partkey % 2 = 0 then 2 else 1 end as issns from part where p_partkey % 3 <> 0")
def followed_candidates(t: Tables) -> DataFrame:
    """ISSN candidates from a CSV file, restricted to pages that links lead to."""
    spark, path, k = t.part.sparkSession, folder(t.part.sparkSession), F.col("p_partkey")
    t.part.select(k.cast("string").alias("url"), F.when(k % 2 == 0, F.lit("1234-5678 ; 8765-4321")).otherwise(F.lit("1234-5678;")).alias("issn")).write.csv(path, header=True)
    rows = readers.read_issn_candidates(spark, path)
    return readers.follow_links(rows, t.part.where(k % 3 != 0).select(k.cast("string").alias("link"))).select(F.col("url").cast("long").alias("p_partkey"), F.size("issn").cast("int").alias("issns"))


@query("select c_custkey, c_mktsegment from customer where c_acctbal > 0")
def configured_scan_all(t: Tables) -> DataFrame:
    """A scan without a limit returns all rows."""
    return readers.configured_scan({"customer": t.customer}, [{"table": "CUSTOMER", "columns": ["c_custkey", "c_mktsegment"], "where": "c_acctbal > 0", "limit": 0}])[0][1]


@query("select c_custkey, upper(n_name[1:2]) as code, upper(n_name[1:3]) as iso_code from customer join nation on c_nationkey = n_nationkey")
def customer_zone_codes(t: Tables) -> DataFrame:
    codes = S.zone_codes("n_name", F.lit("COUNTRY"))
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", codes[0].alias("code"), codes[1].alias("iso_code"))
