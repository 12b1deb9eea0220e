"""All registered queries of the bibliographic engine, each with its SQL equivalent.

The engine's operators take column names, so the given tables play these roles: orders are articles,
customers their topics or issues, nations areas or volumes, regions journals, suppliers authors,
parts keywords, and line items the links.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlake.functions import html
from scholarlake.functions import scalars as S
from scholarlake.operators import closure, graph, merge, rankings, reports, resolve, selection
from scholarlake.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TARGET = 3000


class Tables:
    """The given tables by name, read when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        setattr(self, name, df)
        return df


def query(sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def long(c: str, alias: str | None = None) -> F.Column:
    return F.col(c).cast("long").alias(alias or c)


# selection


def articles(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        key.alias("article_id"),
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(" ").alias("abstract"),
        F.when(key % 3 != 0, F.lit("10.1/x")).alias("doi"),
        F.when(key % 2 == 0, F.array(F.lit("r"))).alias("references"),
        F.when(key % 5 == 0, F.lit("tl")).alias("semantic_tldr"),
        F.floor("o_totalprice").alias("citation_count"),
        F.when(key % 7 != 0, key % 40).alias("reference_count"),
        F.year("o_orderdate").cast("long").alias("publication_year"),
        F.when(key % 211 != 0, F.col("o_custkey")).alias("primary_topic"),
        (key % 101 == 0).alias("is_deleted"),
    )


def bookmarks(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey % 997 = 0").select(F.col("o_orderkey").alias("article_id"))


def selected(t: Tables) -> DataFrame:
    topics = t.customer.select(F.col("c_custkey").alias("topic_id"), long("c_nationkey", "subject_area_id"))
    out = selection.balanced_selection(selection.article_features(articles(t), topics), bookmarks(t), TARGET)
    return out.withColumns({c: F.col(c).cast("long") for c in ("selected_rank", "quality_score")})


SELECTION = f"""
with f as (
  select o_orderkey as article_id, case when o_orderkey % 211 <> 0 then o_custkey end as primary_topic, cast(floor(o_totalprice) as bigint) as citation_count,
    case when o_orderkey % 7 <> 0 then o_orderkey % 40 else 0 end as reference_count, cast(year(o_orderdate) as bigint) as publication_year,
    cast(o_orderstatus <> 'P' as bigint) + cast(o_orderkey % 3 <> 0 as bigint) + cast(o_orderkey % 2 = 0 as bigint) + cast(o_orderkey % 5 = 0 as bigint) as quality_score,
    o_orderkey % 101 <> 0 and o_orderstatus <> 'P' as eligible
  from orders
), g as (select f.*, cast(c_nationkey as bigint) as subject_area_id from f left join customer on c_custkey = primary_topic),
tr as (select *, row_number() over (partition by primary_topic order by quality_score desc, citation_count desc, reference_count desc, publication_year desc nulls last, article_id) as topic_rank from g where eligible),
ar as (select *, row_number() over (partition by coalesce(subject_area_id, -1) order by topic_rank, quality_score desc, citation_count desc, reference_count desc, publication_year desc nulls last, article_id) as turn from tr),
c as (
  select article_id, subject_area_id, primary_topic, quality_score, citation_count, reference_count, publication_year, 0 as priority, 0 as turn, 'bookmarked' as selection_reason from g where article_id % 997 = 0
  union all select article_id, subject_area_id, primary_topic, quality_score, citation_count, reference_count, publication_year, 1, turn, 'topic_representative' from ar where topic_rank = 1
  union all select article_id, subject_area_id, primary_topic, quality_score, citation_count, reference_count, publication_year, 2, turn, 'subject_area_balanced' from ar
), d as (select * from c qualify row_number() over (partition by article_id order by priority) = 1),
o as (select *, row_number() over (order by priority, case when priority = 2 then turn else 0 end, case when priority = 1 then coalesce(subject_area_id, -1) else 0 end,
  case when priority = 1 then coalesce(primary_topic, -1) else 0 end, quality_score desc, citation_count desc, reference_count desc, publication_year desc nulls last, article_id) as selected_rank from d),
s as (select article_id, selected_rank, selection_reason, subject_area_id, primary_topic, quality_score, citation_count, reference_count, publication_year from o where selected_rank <= {TARGET})
"""


@query(SELECTION + "select * from s")
def balanced_selection(t: Tables) -> DataFrame:
    return selected(t)


@query(
    SELECTION
    + """, a as (select count(*) as n from s where subject_area_id is not null group by subject_area_id)
select count(*) as selected, count(distinct article_id) as articles, count(*) filter (selection_reason = 'bookmarked') as bookmarked,
  count(*) filter (selection_reason = 'topic_representative') as topic_representatives, count(*) filter (selection_reason = 'subject_area_balanced') as area_balanced,
  count(*) filter (quality_score = 4) as full_quality, round(avg(quality_score), 2) as avg_quality, min(publication_year) as first_year, max(publication_year) as last_year,
  (select min(n) from a) as area_min, (select max(n) from a) as area_max, (select round(avg(n), 2) from a) as area_avg from s"""
)
def selection_report(t: Tables) -> DataFrame:
    return selection.selection_report(selected(t))


@query(SELECTION + "select md5(string_agg(cast(article_id as varchar), ',' order by selected_rank)) as checksum, count(*) as n from s")
def selection_checksum(t: Tables) -> DataFrame:
    return selection.selection_checksum(selected(t))


@query(
    SELECTION
    + f""", n as (select count(*) as n, count(distinct article_id) as d, (select count(*) from orders where o_orderkey % 997 = 0 and o_orderkey not in (select article_id from s)) as lost from s)
select 'exact_count' as check_name, n = {TARGET} as ok, n as observed from n union all select 'no_duplicates', n = d, n - d from n union all select 'bookmarks_kept', lost = 0, lost from n"""
)
def selection_checks(t: Tables) -> DataFrame:
    return reports.selection_checks(selected(t), bookmarks(t), TARGET)


@query("select o_orderkey, cast(year(o_orderdate) as bigint) as y, row_number() over (partition by year(o_orderdate) order by o_totalprice desc, o_orderkey) as stratum_rank from orders qualify stratum_rank <= 3000")
def stratified_sample(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"), "o_totalprice")
    return selection.stratified_sample(df, F.col("y"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 3000).select("o_orderkey", "y", long("stratum_rank"))


@query("select l_partkey, l_orderkey, cast(l_linenumber as bigint) as l_linenumber from lineitem qualify row_number() over (partition by l_partkey order by l_quantity desc, l_orderkey, l_linenumber) = 1")
def first_by_priority(t: Tables) -> DataFrame:
    return selection.first_by_priority(t.lineitem.select("l_partkey", "l_orderkey", long("l_linenumber"), "l_quantity"), "l_partkey", F.desc("l_quantity"), F.asc("l_orderkey"), F.asc("l_linenumber")).drop("l_quantity")


# closure


def schema_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "Keyword_Article": t.lineitem.select(F.col("l_orderkey").alias("article_id"), F.col("l_partkey").alias("keyword_id")),
        "Author_Article": t.lineitem.select(F.col("l_orderkey").alias("article_id"), F.col("l_suppkey").alias("author_id")),
        "Article": t.orders.select(F.col("o_orderkey").alias("article_id"), F.col("o_custkey").alias("issue_id")),
        "Author": t.supplier.select(F.col("s_suppkey").alias("author_id")),
        "Keyword": t.part.select(F.col("p_partkey").alias("keyword_id")),
        "Issue": t.customer.select(F.col("c_custkey").alias("issue_id"), long("c_nationkey", "volume_id")),
        "Volume": t.nation.select(long("n_nationkey", "volume_id"), long("n_regionkey", "journal_id")),
        "Journal": t.region.select(long("r_regionkey", "journal_id")),
    }


def protected(t: Tables) -> dict[str, DataFrame]:
    return {"Keyword": t.part.where("p_partkey % 501 = 0").select(F.col("p_partkey").alias("keyword_id"))}


def kept(t: Tables) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    tables = schema_tables(t)
    return tables, closure.keep_sets(tables, bookmarks(t), protected(t))


CLOSURE = """
with ka as (select o_orderkey as k from orders where o_orderkey % 997 = 0), ki as (select distinct o_custkey as k from orders where o_orderkey in (from ka)),
kv as (select distinct c_nationkey as k from customer where c_custkey in (from ki)), kj as (select distinct n_regionkey as k from nation where n_nationkey in (from kv)),
ku as (select distinct l_suppkey as k from lineitem where l_orderkey in (from ka)), kk as (select distinct l_partkey as k from lineitem where l_orderkey in (from ka) union select p_partkey from part where p_partkey % 501 = 0),
r as (select 'Keyword_Article' as table_name, count(*) as total, count(*) filter (l_orderkey in (from ka)) as keep from lineitem
  union all select 'Author_Article', count(*), count(*) filter (l_orderkey in (from ka)) from lineitem
  union all select 'Article', count(*), count(*) filter (o_orderkey in (from ka)) from orders union all select 'Author', count(*), count(*) filter (s_suppkey in (from ku)) from supplier
  union all select 'Keyword', count(*), count(*) filter (p_partkey in (from kk)) from part union all select 'Issue', count(*), count(*) filter (c_custkey in (from ki)) from customer
  union all select 'Volume', count(*), count(*) filter (n_nationkey in (from kv)) from nation union all select 'Journal', count(*), count(*) filter (r_regionkey in (from kj)) from region)
"""


@query(CLOSURE + "select table_name, total, keep, total - keep as remove from r union all select 'ALL', cast(sum(total) as bigint), cast(sum(keep) as bigint), cast(sum(total - keep) as bigint) from r")
def closure_keep_counts(t: Tables) -> DataFrame:
    tables, k = kept(t)
    return closure.keep_report(tables, closure.prune(tables, k))


@query(CLOSURE + "select l_orderkey as article_id, l_partkey as keyword_id from lineitem where l_orderkey in (from ka)")
def prune_to_closure(t: Tables) -> DataFrame:
    tables, k = kept(t)
    return closure.prune(tables, k)["Keyword_Article"]


@query(CLOSURE + "select 'Keyword' as table_name, cast(0 as bigint) as missing")
def protected_missing(t: Tables) -> DataFrame:
    return closure.protected_missing(kept(t)[1], protected(t))


@query(CLOSURE + "select 'closed:' || table_name as check_name, true as ok, cast(0 as bigint) as observed from r union all select 'manifest_complete', true, 0")
def prune_verified(t: Tables) -> DataFrame:
    tables, k = kept(t)
    return closure.verify_prune(closure.prune(tables, k), k, bookmarks(t))


@query("select o_orderkey as article_id, cast(n_regionkey as bigint) as journal_id from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where o_orderkey % 101 <> 0")
def journal_of_article(t: Tables) -> DataFrame:
    s = schema_tables(t)
    return resolve.hierarchy(s["Article"].withColumn("is_deleted", F.col("article_id") % 101 == 0), s["Issue"], s["Volume"], s["Journal"])


# graph

PAIRS = "select a.{m} as a, b.{m} as b, count(*) as n from (select distinct l_orderkey, {m} from lineitem) a join (select distinct l_orderkey, {m} from lineitem) b on a.l_orderkey = b.l_orderkey and a.{m} < b.{m} group by 1, 2"


@query(PAIRS.format(m="l_suppkey"))
def cooccurrence_suppliers(t: Tables) -> DataFrame:
    return graph.cooccurrence(t.lineitem, "l_orderkey", "l_suppkey")


@query(PAIRS.format(m="l_partkey"))
def cooccurrence_parts(t: Tables) -> DataFrame:
    return graph.cooccurrence(t.lineitem, "l_orderkey", "l_partkey")


def citations(t: Tables) -> DataFrame:
    refs = t.lineitem.select(F.col("l_orderkey").alias("src"), F.concat(F.lit(" 10.1/P"), "l_partkey").alias("ref"))
    return graph.citation_edges(refs, t.orders.select(F.col("o_orderkey").alias("article_id"), F.concat(F.lit("10.1/p"), (F.col("o_orderkey") * 3).cast("string")).alias("doi")))


CITATIONS = "with e as (select r.src, r.ref, o_orderkey as dst from (select distinct l_orderkey as src, '10.1/p' || l_partkey as ref from lineitem) r left join orders on r.ref = '10.1/p' || (o_orderkey * 3)) "


@query(CITATIONS + "select src, ref, dst, dst is null as placeholder from e")
def citation_edges(t: Tables) -> DataFrame:
    return citations(t)


@query(CITATIONS + "select distinct ref as id from e where dst is null")
def citation_placeholders(t: Tables) -> DataFrame:
    return graph.placeholder_nodes(citations(t))


@query("select distinct l_orderkey as src, l_partkey as dst, 'HAS_KEYWORD' as type from lineitem where l_partkey in (select p_partkey from part where p_size > 10) and l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'F')")
def graph_edges_valid(t: Tables) -> DataFrame:
    return graph.edges(t.lineitem, "l_orderkey", "l_partkey", "HAS_KEYWORD", t.orders.where("o_orderstatus <> 'F'").select("o_orderkey"), t.part.where("p_size > 10").select("p_partkey"))


@query("select l_suppkey as id, min(l_shipmode) as l_shipmode from (select l_suppkey, l_returnflag as l_shipmode from lineitem) group by 1")
def graph_nodes(t: Tables) -> DataFrame:
    return graph.nodes(t.lineitem.select("l_suppkey", F.col("l_returnflag").alias("l_shipmode")), "l_suppkey", ["l_shipmode"])


@query(
    """with d as (select distinct cast(s_nationkey as bigint) as journal_id, l_partkey as m from lineitem join supplier on l_suppkey = s_suppkey), n as (select journal_id, count(*) as n from d group by 1),
p as (select x.journal_id as a, y.journal_id as b, count(*) as k from d x join d y on x.m = y.m and x.journal_id < y.journal_id group by 1, 2)
select a, b, round(s, 9) as similarity_score from (select a, b, k / (x.n + y.n - k) as s from p join n x on x.journal_id = a join n y on y.journal_id = b) where s >= 0.1"""
)
def journal_similarity(t: Tables) -> DataFrame:
    links = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(long("s_nationkey", "journal_id"), F.col("l_partkey").alias("m"))
    return graph.similar_journals({"parts": links}).withColumn("similarity_score", F.round("similarity_score", 9))


@query("select o_orderpriority as entity, cast(year(o_orderdate) as bigint) as year, count(*) as n, count(*) - lag(count(*)) over (partition by o_orderpriority order by year(o_orderdate)) as change from orders group by o_orderpriority, year(o_orderdate)")
def topic_trends(t: Tables) -> DataFrame:
    return graph.trends(t.orders.withColumn("y", F.year("o_orderdate").cast("long")), "o_orderpriority", "y")


# reports


@query(
    """select o_orderkey, coalesce(s.names, '') as authors, coalesce(p.names, '') as keywords from orders
left join (select l_orderkey, string_agg(s_name, ', ' order by s_name) as names from (select distinct l_orderkey, s_name from lineitem join supplier on l_suppkey = s_suppkey) group by 1) s on s.l_orderkey = o_orderkey
left join (select l_orderkey, string_agg(p_brand, ', ' order by p_brand) as names from (select distinct l_orderkey, p_brand from lineitem join part on l_partkey = p_partkey) group by 1) p on p.l_orderkey = o_orderkey"""
)
def article_report(t: Tables) -> DataFrame:
    authors = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("o_orderkey"), "s_name")
    keywords = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o_orderkey"), "p_brand")
    return reports.article_report(t.orders.select("o_orderkey"), "o_orderkey", {"authors": (authors, "s_name"), "keywords": (keywords, "p_brand")})


@query("select o_orderkey, o_totalprice from orders order by case when o_orderkey % 3 = 0 then 0 else 1 end, o_totalprice desc nulls last, o_orderkey limit 2000")
def priority_subset(t: Tables) -> DataFrame:
    return reports.top(t.orders.select("o_orderkey", "o_totalprice"), 2000, *reports.priority_order(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice"), F.col("o_orderkey")))


@query("select c_name, n_name, c_acctbal from customer join nation on c_nationkey = n_nationkey where c_acctbal is not null order by c_acctbal desc, c_custkey limit 10")
def top_by_metric(t: Tables) -> DataFrame:
    df = t.customer.where("c_acctbal is not null").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return reports.top(df, 10, F.desc("c_acctbal"), F.asc("c_custkey")).select("c_name", "n_name", "c_acctbal")


@query("select p_partkey, replace(cast(p_retailprice as varchar), '.', ',') as price from part order by p_retailprice desc nulls last, p_partkey limit 100")
def sorted_by_decimal_text(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("price"))
    return reports.top(df, 100, reports.by_decimal_text("price"), F.asc("p_partkey"))


@query("select p_partkey, replace(cast(p_retailprice as varchar), '.', ',') as price, p_retailprice as number from part order by p_retailprice desc nulls last, p_partkey")
def all_by_decimal_text(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("price"))
    return reports.all_by_decimal_text(df, "price", F.asc("p_partkey"))


@query("select count(*) as total, count(*) filter (o_orderstatus = 'F') as synced, count(*) filter (o_orderstatus is distinct from 'F') as pending, round(100.0 * count(*) filter (o_orderstatus = 'F') / count(*), 2) as percent from orders")
def coverage_stats(t: Tables) -> DataFrame:
    return reports.coverage(t.orders, F.col("o_orderstatus") == "F")


NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(" union all ".join(f"select '{n}' as table_name, count(*) as n from {n}" for n in NAMES))
def table_counts(t: Tables) -> DataFrame:
    return reports.table_counts({n: getattr(t, n) for n in NAMES})


@query("select 'orders' as table_name, count(*) as source_rows, count(*) filter (o_orderkey % 10 <> 0) as target_rows, count(*) filter (o_orderkey % 10 = 0) as missing, 'missing ' || count(*) filter (o_orderkey % 10 = 0) as status from orders union all select 'part', count(*), count(*), 0, 'up-to-date' from part")
def copy_status(t: Tables) -> DataFrame:
    return reports.copy_status({"orders": t.orders, "part": t.part}, {"orders": t.orders.where("o_orderkey % 10 <> 0"), "part": t.part}, {"orders": ["o_orderkey"], "part": ["p_partkey"]})


@query("select s_suppkey as author_id, count(l_orderkey) as local_works from supplier left join lineitem on l_suppkey = s_suppkey and l_returnflag = 'R' group by 1")
def works_per_author(t: Tables) -> DataFrame:
    links = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("author_id"), F.col("l_orderkey").alias("article_id"))
    return reports.works_per_author(t.supplier.select(F.col("s_suppkey").alias("author_id")), links)


@query("select min(o_orderkey) as min_id, max(o_orderkey) as max_id, max(o_orderkey) + 1 as next_id from orders")
def id_range(t: Tables) -> DataFrame:
    return reports.min_max_next(t.orders, "o_orderkey")


@query(
    """with k as (select distinct l_suppkey, year(l_shipdate) as y from lineitem where l_returnflag <> 'N'), d as (select distinct l_orderkey, l_suppkey from lineitem)
select l_orderkey as article_id, count(*) as n_authors, count(*) filter (k.y is null) as incomplete_count from d join orders on o_orderkey = l_orderkey left join k on k.l_suppkey = d.l_suppkey and k.y = year(o_orderdate) group by 1"""
)
def incomplete_links(t: Tables) -> DataFrame:
    known = t.lineitem.where("l_returnflag <> 'N'").select(F.col("l_suppkey").alias("author_id"), F.year("l_shipdate").alias("year"))
    arts = t.orders.select(F.col("o_orderkey").alias("article_id"), F.year("o_orderdate").alias("publication_year"))
    return reports.incomplete_links(arts, t.lineitem.select(F.col("l_orderkey").alias("article_id"), F.col("l_suppkey").alias("author_id")), known)


@query(
    """select case when s is null or s = 429 or s >= 500 then 'RETRYABLE' when s in (404, 410) then 'UNAVAILABLE_FROM_SOURCE' when s >= 400 then 'FAILED' when a = 0 then 'ARTICLE_HAS_NO_AUTHORS' when u > 0 then 'AUTHOR_UNRESOLVED' else 'SUCCESS' end as outcome, count(*) as n
from (select [200, 404, 429, 503, 403, 200, 200][1 + event_id % 7] as s, event_id % 3 as a, event_id % 5 as u from events) group by 1"""
)
def outcome_counts(t: Tables) -> DataFrame:
    status = F.element_at(F.array(*(F.lit(x) for x in (200, 404, 429, 503, 403, 200, 200))), (1 + F.col("event_id") % 7).cast("int"))
    rows = t.events.select("event_id", status.alias("http_status"), (F.col("event_id") % 3).alias("n_authors"), (F.col("event_id") % 5).alias("n_unresolved"), F.lit(0).alias("incomplete"))
    return reports.outcome_counts(reports.outcome_class(rows))


@query("select cast(p_partkey as varchar) as id, cast(p_partkey as varchar) as entity_id, 'part' as entity_type, p_name, coalesce(p_brand, '') as p_brand, cast(coalesce(p_size, 0) as bigint) as p_size from part")
def search_documents(t: Tables) -> DataFrame:
    return reports.document(t.part.withColumn("p_size", long("p_size")), "p_partkey", "part", ["p_brand"], ["p_size"], ["p_name"])


@query("select cast(len(embedding) as bigint) as dim, count(*) as n from embeddings where embedding is not null group by 1")
def embedding_dims(t: Tables) -> DataFrame:
    return reports.vector_dimensions(t.embeddings).select(long("dim"), "n")


@query("select doc_id, trim(coalesce(source, '') || '. ' || coalesce(text, ''), '. ') as text from documents")
def embedding_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.article_text("source", "text").alias("text"))


# merges


def supplier_changes(t: Tables) -> tuple[DataFrame, DataFrame]:
    current = t.supplier.where("s_suppkey % 4 <> 0").select("s_suppkey", "s_name", F.round("s_acctbal", 2).alias("s_acctbal"))
    incoming = t.supplier.where("s_suppkey % 3 <> 0").select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name")).alias("s_name"), F.round(F.col("s_acctbal") + 1, 2).alias("s_acctbal"))
    return current, incoming


CHANGES = "with c as (select s_suppkey, s_name, round(s_acctbal, 2) as s_acctbal from supplier where s_suppkey % 4 <> 0), i as (select s_suppkey, case when s_suppkey % 5 = 0 then s_name || '!' else s_name end as s_name, round(s_acctbal + 1, 2) as s_acctbal from supplier where s_suppkey % 3 <> 0) "


@query(CHANGES + "select * from c union all select * from i where s_suppkey not in (select s_suppkey from c)")
def insert_if_absent(t: Tables) -> DataFrame:
    return merge.insert_if_absent(*supplier_changes(t), ["s_suppkey"])


@query(CHANGES + "select * from i union all select * from c where s_suppkey not in (select s_suppkey from i)")
def full_upsert(t: Tables) -> DataFrame:
    return merge.full_upsert(*supplier_changes(t), ["s_suppkey"])


@query(CHANGES + ", x as (select i.* from i left join c using (s_suppkey) where c.s_suppkey is null or i.s_name is distinct from c.s_name) select * from x union all select * from c where s_suppkey not in (select s_suppkey from x)")
def conditional_upsert(t: Tables) -> DataFrame:
    return merge.conditional_upsert(*supplier_changes(t), ["s_suppkey"], ["s_name"])


@query("with c as (select p_brand as name, row_number() over (order by p_brand) as id from (select distinct p_brand from part where p_size < 10)), n as (select p_brand as name from (select distinct p_brand from part) where p_brand not in (select name from c)) select name, cast(id as bigint) as id from c union all select name, (select max(id) from c) + row_number() over (order by name) from n")
def get_or_create_dim(t: Tables) -> DataFrame:
    empty = t.part.select(F.col("p_brand").alias("name"), F.lit(0).cast("long").alias("id")).limit(0)
    first = merge.get_or_create(empty, t.part.where("p_size < 10").select(F.col("p_brand").alias("name")), "id", ["name"])
    return merge.get_or_create(first, t.part.select(F.col("p_brand").alias("name")), "id", ["name"])


@query("select o_orderkey as article_id, case when o_orderkey % 4 = 0 and length(o_orderpriority) > length(o_orderstatus) then o_orderpriority else o_orderstatus end as abstract, case when o_orderkey % 4 = 0 then o_custkey else o_orderkey end as citation_count, cast(case when o_orderkey % 4 = 0 and o_orderkey % 8 <> 0 then 2 when o_orderkey % 8 = 0 then 1 else 0 end as bigint) as reference_count from orders")
def enriched_articles(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    refs = F.when(key % 8 == 0, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>"))
    text = F.lit(None).cast("string")
    arts = t.orders.select(key.alias("article_id"), F.col("o_orderstatus").alias("abstract"), key.alias("citation_count"), F.when(key % 8 == 0, 1).otherwise(0).cast("long").alias("reference_count"), refs.alias("references"), text.alias("semantic_scholar_id"), F.lit(0).alias("semantic_influential_citation_count"), text.alias("semantic_external_ids"), text.alias("semantic_tldr"))
    papers = t.orders.where("o_orderkey % 4 = 0").select(key.alias("article_id"), F.lit("p").alias("paper_id"), F.col("o_custkey").alias("citation_count"), F.lit(1).alias("influential_citation_count"), text.alias("external_ids"), text.alias("tldr"), F.col("o_orderpriority").alias("abstract"), F.array(F.lit("x"), F.lit("y")).alias("references"))
    return merge.enrich_articles(arts, papers).select("article_id", "abstract", "citation_count", long("reference_count"))


@query("select c_nationkey, metric, value_txt, value_int from (select cast(c_nationkey as bigint) as c_nationkey, 'SEGMENT' as metric, c_mktsegment as value_txt, cast(null as bigint) as value_int, c_custkey from customer union all select cast(c_nationkey as bigint), 'WHOLE', null, cast(trunc(c_acctbal) as bigint), c_custkey from customer) where value_txt is not null or value_int is not null qualify row_number() over (partition by c_nationkey, metric, coalesce(value_txt, ''), coalesce(value_int, 0) order by c_custkey) = 1")
def long_metrics(t: Tables) -> DataFrame:
    none = lambda kind: F.lit(None).cast(kind)
    value = lambda m, txt, whole: F.struct(F.lit(m).alias("metric"), txt.cast("string").alias("value_txt"), whole.cast("bigint").alias("value_int"))
    rows = t.customer.select(long("c_nationkey"), F.col("c_custkey").alias("pos"), F.explode(F.array(value("SEGMENT", F.col("c_mktsegment"), none("bigint")), value("WHOLE", none("string"), S.norm_int("c_acctbal")))).alias("v"))
    long_rows = rows.select("c_nationkey", "pos", "v.*", F.lit(2025).alias("year"), none("double").alias("value_float"), none("string").alias("category"), none("string").alias("area")).where("value_txt is not null or value_int is not null")
    return rankings.first_metric_rows(long_rows, "c_nationkey").select("c_nationkey", "metric", "value_txt", "value_int")


# resolution


@query("select s_suppkey as row_id, coalesce(a.id, b.id) as target_id, case when a.id is not null then 'key' when b.id is not null then 'nation' end as step from supplier left join (select c_custkey as k, min(c_custkey) as id from customer where c_custkey % 2 = 0 group by 1) a on a.k = s_suppkey left join (select c_nationkey as k, min(c_custkey) as id from customer where c_mktsegment = 'BUILDING' group by 1) b on b.k = s_nationkey")
def resolve_cascade(t: Tables) -> DataFrame:
    rows = t.supplier.select(F.col("s_suppkey").alias("row_id"), "s_nationkey")
    steps = [("key", F.col("row_id"), F.when(F.col("target_id") % 2 == 0, F.col("target_id"))), ("nation", F.col("s_nationkey"), F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey")))]
    return resolve.cascade(rows, t.customer.withColumnRenamed("c_custkey", "target_id"), "row_id", "target_id", steps)


@query(
    """with j as (select s_suppkey as journal_id, lpad(cast(s_suppkey % 40 as varchar), 8, '0') as k, s_suppkey % 9 = 0 as bare from supplier), x as (select c_custkey as external_id, lpad(cast(c_custkey % 60 as varchar), 8, '0') as k from customer where c_custkey % 60 >= 10),
p as (select journal_id, min(external_id) as external_id from j join x using (k) where not bare group by 1), o as (select external_id, min(journal_id) as owner from p group by 1)
select j.journal_id, case when owner = j.journal_id and not bare then external_id end as external_id, case when bare then 'NO_ISSN' when owner is null then 'NOT_FOUND' when owner <> j.journal_id then 'DUPLICATE' else 'MATCHED' end as status from j left join p using (journal_id) left join o using (external_id)"""
)
def source_matches(t: Tables) -> DataFrame:
    digits = lambda c, n: F.lpad((F.col(c) % n).cast("string"), 8, "0")
    journals = t.supplier.select(F.col("s_suppkey").alias("journal_id"), F.when(F.col("s_suppkey") % 9 != 0, S.issn_display(digits("s_suppkey", 40))).alias("issn"))
    sources = t.customer.where("c_custkey % 60 >= 10").select(F.col("c_custkey").alias("id"), F.array(S.issn_display(digits("c_custkey", 60))).alias("issn"), F.lit(None).cast("string").alias("issn_l"))
    return resolve.match_sources(journals, sources)


@query(
    """with p as (select o_orderkey as paper_id, case when o_orderkey % 2 = 0 then '10.1/' || o_orderkey end as doi, 't' || o_custkey as title, case when o_orderkey % 5 <> 0 then year(o_orderdate) end as y from orders where o_orderkey % 3 = 0),
a as (select o_orderkey as article_id, '10.1/' || (o_orderkey + 6) as doi, 't' || o_custkey as title, year(o_orderdate) as y from orders where o_orderkey % 3 = 1 or o_orderkey % 6 = 0),
d as (select paper_id, min(article_id) as article_id from p join a using (doi) group by 1),
e as (select paper_id, min(article_id) as article_id from p join a on lower(p.title) = lower(a.title) and coalesce(abs(p.y - a.y) <= 1, true) where paper_id not in (select paper_id from d) group by 1)
select p.paper_id, coalesce(d.article_id, e.article_id) as article_id, case when d.paper_id is not null then 'doi' when e.paper_id is not null then 'title' end as step from p left join d using (paper_id) left join e using (paper_id)"""
)
def paper_matches(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    papers = t.orders.where("o_orderkey % 3 = 0").select(key.alias("paper_id"), F.when(key % 2 == 0, F.concat(F.lit("https://doi.org/10.1/"), key)).alias("doi"), F.concat(F.lit("T"), "o_custkey").alias("title"), F.when(key % 5 != 0, F.year("o_orderdate")).alias("year"))
    arts = t.orders.where("o_orderkey % 3 = 1 or o_orderkey % 6 = 0").select(key.alias("article_id"), F.concat(F.lit("10.1/"), key + 6).alias("doi"), F.concat(F.lit("t"), "o_custkey").alias("title"), F.year("o_orderdate").alias("publication_year"))
    return resolve.match_papers(papers, arts)


@query(
    """with r as (select distinct l_orderkey as article_id, case when l_partkey % 2 = 0 then 'https://doi.org/10.1/' || l_partkey when p_size > 25 then 'https://doi.org/10.2/' || l_partkey end as doi from lineitem join part on l_partkey = p_partkey)
select o_orderkey as article_id, coalesce(string_agg(doi, ' ' order by doi), '') as dois from orders left join r on article_id = o_orderkey and doi is not null group by 1"""
)
def resolved_references(t: Tables) -> DataFrame:
    ref = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("http://doi.org/10.1/"), "l_partkey")).otherwise(F.concat(F.lit("https://openalex.org/W"), "l_partkey"))
    lists = t.lineitem.groupBy(F.col("l_orderkey").alias("article_id")).agg(F.collect_set(ref).alias("references"))
    arts = t.orders.select(F.col("o_orderkey").alias("article_id")).join(lists, "article_id", "left")
    mapping = t.part.where("p_size > 25").select(F.concat(F.lit("https://openalex.org/W"), "p_partkey").alias("work_id"), F.concat(F.lit("10.2/"), "p_partkey").alias("doi"))
    return resolve.resolve_references(arts, mapping).select("article_id", F.array_join("references", " ").alias("dois"))


@query("select distinct article_id from (select l_orderkey as article_id from lineitem join part on l_partkey = p_partkey where lower(p_name) like '%a1%' or lower(p_type) like '%brass%' union all select o_orderkey from orders where lower(o_orderpriority) like '%urgent%')")
def domain_match(t: Tables) -> DataFrame:
    parts = resolve.domain_matches(t.part, ["p_name", "p_type"], S.normalize_terms("A1; Brass\n"), "p_partkey")
    by_keyword = t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select(F.col("l_orderkey").alias("article_id"))
    by_title = resolve.domain_matches(t.orders.withColumnRenamed("o_orderkey", "article_id"), ["o_orderpriority"], ["urgent"])
    return resolve.any_of(by_keyword, by_title)


# scans and scalar functions


@query("select l_orderkey, cast(l_linenumber as bigint) as l_linenumber from lineitem where (l_orderkey, l_linenumber) > (100, 2) order by 1, 2 limit 1000")
def keyset_page(t: Tables) -> DataFrame:
    return readers.after_key(t.lineitem.select("l_orderkey", long("l_linenumber")), ["l_orderkey", "l_linenumber"], (100, 2), 1000)


@query("select event_id from events where event_id > (select max(event_id) // 2 from events)")
def resumed_scan(t: Tables) -> DataFrame:
    return readers.resume_after(t.events, "event_id", t.events.agg(F.max("event_id")).first()[0] // 2).select("event_id")


@query("select c_custkey, c_mktsegment from customer where c_acctbal > 0 order by c_custkey desc limit 500")
def configured_scan(t: Tables) -> DataFrame:
    return readers.configured_scan({"customer": t.customer}, [{"table": "CUSTOMER", "columns": ["c_custkey", "c_mktsegment", "unknown"], "where": "c_acctbal > 0", "order_by": "c_custkey desc", "limit": 500}])[0][1]


@query("select o_orderkey, cast(trunc(o_totalprice) as bigint) as whole, o_totalprice as real, case when o_orderkey % 3 = 0 then true when o_orderkey % 3 = 1 then false end as flag, cast(null as bigint) as bad from orders")
def normalized_numbers(t: Tables) -> DataFrame:
    flag = F.element_at(F.array(F.lit(" Yes "), F.lit("0"), F.lit("maybe")), (1 + F.col("o_orderkey") % 3).cast("int"))
    return t.orders.select("o_orderkey", S.norm_int(F.format_number("o_totalprice", 2)).alias("whole"), S.norm_decimal(F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))).alias("real"), S.norm_bool(flag).alias("flag"), S.norm_int(F.col("o_orderpriority")).alias("bad"))


@query("select p_partkey, case when p_partkey % 3 = 0 then p_brand else p_brand || '|' || p_type end as names, 'Q' || (1 + p_size % 4) as best from part")
def subject_categories(t: Tables) -> DataFrame:
    text = F.concat(F.col("p_brand"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" AND "), F.lower("p_brand"))).otherwise(F.concat(F.lit(", "), "p_type")), F.lit(" (Q"), (1 + F.col("p_size") % 4).cast("string"), F.lit(")"))
    both = S.once(S.parse_categories(text), lambda found: F.struct(F.array_join(F.transform(found, lambda x: x["name"]), "|").alias("names"), S.best_quartile(F.transform(found, lambda x: x["quartile"])).alias("best")))
    # dealt anew: a file of few row groups would be few tasks
    return t.part.repartition("p_partkey").select("p_partkey", both.alias("b")).select("p_partkey", "b.names", "b.best")


@query("select p_partkey, lpad(cast(p_partkey as varchar), 8, '0') || '|' || lpad(cast(p_partkey as varchar), 7, '0') || 'X' as strict, cast(1 as bigint) as loose from part")
def issn_tokens(t: Tables) -> DataFrame:
    eight = F.lpad(F.col("p_partkey").cast("string"), 8, "0")
    text = F.concat(S.issn_display(eight), F.lit("; 12/"), F.substring(eight, 2, 7), F.lit("x"))
    return t.part.select("p_partkey", F.array_join(S.split_issns(text), "|").alias("strict"), F.size(F.filter(S.loose_issns(text), lambda x: x.contains("-"))).cast("long").alias("loose"))


@query("select p_partkey, 'https://doi.org/10.1/' || lower(p_brand) as url, '10.1/' || p_brand as bare, '10.1/' || p_brand || '/' as raw, 'W' || p_partkey as tail from part")
def doi_forms(t: Tables) -> DataFrame:
    doi = F.concat(F.lit(" https://dx.doi.org/10.1/"), "p_brand", F.lit("/ "))
    return t.part.select("p_partkey", S.normalize_doi(doi, "url").alias("url"), S.normalize_doi(doi, "bare").alias("bare"), S.normalize_doi(doi, "raw").alias("raw"), S.id_tail(F.concat(F.lit("https://openalex.org/W"), "p_partkey")).alias("tail"))


@query("select item_id, left(array_to_string(string_split(text, ' '), ' '), 2000) as abstract from benchmark where text is not null")
def abstract_from_index(t: Tables) -> DataFrame:
    words = t.benchmark.where("text is not null").select("item_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    index = words.groupBy("item_id", "word").agg(F.array_sort(F.collect_list("pos")).alias("places")).groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "places"))).alias("index"))
    return index.select("item_id", S.abstract_from_index("index").alias("abstract"))


@query("select n_name as name, upper(n_name[1:2]) as code, upper(n_name[1:3]) as iso_code from nation")
def zone_codes(t: Tables) -> DataFrame:
    codes = S.zone_codes("n_name", F.lit("COUNTRY"))
    return t.nation.select(F.col("n_name").alias("name"), codes[0].alias("code"), codes[1].alias("iso_code"))


@query("select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as double), 0.0) as score from events")
def scores(t: Tables) -> DataFrame:
    return t.events.select("event_id", S.score_or_zero(F.get_json_object("props", "$.k")).alias("score"))


def unescaped(sql: str) -> str:
    """SQL of a text with the entities of the given pages as characters."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·")):
        sql = f"replace({sql}, '{entity}', '{char}')"
    return f"regexp_replace({sql}, '&amp;?', '&', 'g')"


def clean_sql(sql: str) -> str:
    return f"trim(regexp_replace({unescaped(f"regexp_replace({sql}, '(?s)<[^>]+>', ' ', 'g')")}, '\\s+', ' ', 'g'))"


_ANCHORS = """regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']+)["''][^>]*>(.*?)</a>', {})"""


@query(
    f"""with a as (select page_id, url, {_ANCHORS.format(1)} as h, {_ANCHORS.format(2)} as l from pages), x as (select *, unnest(range(len(h))) as i from a),
y as (select page_id, cast(i as int) as place, regexp_extract(url, '^https?://[^/?#]+', 0) || {unescaped("h[i + 1]")} as link, {clean_sql("l[i + 1]")} as label from x)
select page_id, place, link, label from y qualify row_number() over (partition by page_id, link order by place) = 1"""
)
def page_links(t: Tables) -> DataFrame:
    return html.page_links(t.pages)


@query(f"select page_id, {clean_sql("coalesce(html, '')")} as text from pages")
def page_text(t: Tables) -> DataFrame:
    return html.page_text(t.pages)


@query()
def page_details(t: Tables) -> DataFrame:
    return html.article_details(t.pages)
