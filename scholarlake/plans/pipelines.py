"""Whole flows over tables: ranking import, works sync, manifest prune, subset copies, graph build.

Each takes the current tables by name and returns the next ones; no table is written here, so a dry run is
a run whose result is not stored. What several tables are made of is written once, as scratch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S
from scholarlake.operators import closure, graph, merge, rankings, reports, resolve, selection
from scholarlake.sources import readers
from scholarlake.sources.scratch import stored
from scholarlake.streaming import landed


def import_ranking(raw: DataFrame, tables: dict[str, DataFrame], year: int, limit: int | None = None) -> dict[str, DataFrame]:
    """Publisher, Zone, Subject_Area, Subject_Category, Journal, Journal_Subject_Category and Journal_Ranking after a ranking file.

    Journals are found by source id, then by ISSN; unknown ones get xxhash64 ids of their source id. Values that
    the file lacks keep what is known of a journal. `limit` takes the file's first rows alone.
    """
    rows = readers.map_ranking_columns(raw)
    rows = readers.require_source_and_title(rows.limit(limit) if limit else rows)
    named = lambda c: rows.where(F.trim(c) != "").select(F.trim(c).alias("display_name"))
    out = dict(tables)
    out["Publisher"] = merge.get_or_create(tables["Publisher"], named("publisher"), "id", ["display_name"], hashed=True)
    zones = lambda c, kind: rows.where(F.trim(c) != "").select(F.trim(c).alias("name"), F.lit(kind).alias("type"))
    found = zones("country", "COUNTRY").unionByName(zones("region", "REGION")).distinct()
    codes = S.zone_codes("name", "type")
    known = tables["Zone"].select("name", "type")
    fresh = found.join(known, ["name", "type"], "left_anti").select(F.xxhash64("name", "type").alias("zone_id"), "name", "type", codes[0].alias("code"), codes[1].alias("iso_code"))
    out["Zone"] = tables["Zone"].unionByName(fresh, allowMissingColumns=True)

    keyed = resolve.resolve_journals(rows.withColumn("row_id", F.xxhash64("source_id", "title")).dropDuplicates(["row_id"]), tables["Journal"]).withColumn("journal_id", F.coalesce("journal_id", F.xxhash64("source_id")))
    publishers = out["Publisher"].groupBy("display_name").agg(F.min("id").alias("publisher_id"))
    typed = rankings.typed_journals(keyed.withColumn("publisher", F.trim("publisher"))).join(keyed.select("source_id", "title", "journal_id"), ["source_id", "title"])
    journals = typed.join(publishers, typed.publisher == publishers.display_name, "left").select("journal_id", "source_id", F.col("title").alias("name"), "type", "issn", "publisher_id", "country", "region", "is_open_access", "is_diamond", F.lit(False).alias("is_deleted")).withColumns({c: F.when(~S.is_blank(c), F.col(c)) for c in ("type", "issn", "country", "region")})
    out["Journal"] = merge.update_known(tables["Journal"], journals.select(*tables["Journal"].columns), ["journal_id"])

    pairs = rankings.journal_categories(keyed)
    areas = pairs.select(F.col("area").alias("display_name"))
    out["Subject_Area"] = merge.get_or_create(tables["Subject_Area"], areas, "id", ["display_name"])
    with_area = pairs.join(out["Subject_Area"].select(F.col("id").alias("subject_area_id"), F.col("display_name").alias("area")), "area")
    out["Subject_Category"] = merge.get_or_create(tables["Subject_Category"], with_area.select("subject_area_id", F.col("category").alias("display_name")), "id", ["subject_area_id", "display_name"])
    ids = out["Subject_Category"].select(F.col("id").alias("subject_category_id"), "subject_area_id", F.col("display_name").alias("category"))
    links = with_area.join(ids, ["subject_area_id", "category"])
    out["Journal_Subject_Category"] = merge.insert_if_absent(tables["Journal_Subject_Category"], links.select("journal_id", "subject_category_id"), ["journal_id", "subject_category_id"])

    long = rankings.first_metric_rows(rankings.metric_rows(keyed, year=year))
    metric = F.create_map(*(x for i, (code, *_) in enumerate(rankings.METRICS, 1) for x in (F.lit(code), F.lit(i).cast("long"))))
    incoming = long.join(links.select("journal_id", "category", "area", "subject_category_id"), ["journal_id", "category", "area"], "left").select("journal_id", metric[F.col("metric")].alias("metric_id"), "year", "value_txt", "value_int", "value_float", "subject_category_id")
    out["Journal_Ranking"] = merge.ranking_upsert(tables["Journal_Ranking"], incoming.select(*tables["Journal_Ranking"].columns))
    return out


#: Spark takes a column's size as its share of the table's files, whose other columns may be packed to nothing, and so would bring millions
#: of rows to the driver as a small table. Joins with a side that grows with works or articles sort both sides; those with dimensions are left to Spark.
GROWS = "merge"


def sync_works(works: DataFrame, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Topic, Volume, Issue, Article, Author, Author_Article, Keyword and Keyword_Article after landed works; new rows get xxhash64 ids.

    Works with a journal_id get their volume and issue where the tables hold Volume and Issue. A work is the article of
    its DOI, else that of its title and issue. Works are read once, and so are their matches to articles and those of authors.
    """
    out, none = dict(tables), F.lit(None).cast("long")
    if "journal_id" not in works.columns:
        works = works.withColumn("journal_id", none)
    keyed = works.withColumn("work_key", S.row_hash("id", "title", "doi", "publication_year", F.col("biblio.volume"), F.col("biblio.issue"), "journal_id"))
    keyed = stored(landed.articles_of(keyed, "work_key", "journal_id", "authorships", "keywords"))
    arts = keyed.drop("authorships", "keywords")
    topics = arts.where("topic is not null").groupBy(F.col("topic").alias("display_name")).agg(F.max("topic_score").alias("score"))
    incoming_topics = topics.select("display_name", none.alias("subject_area_id"), none.alias("subject_category_id"), "score")
    filled = merge.fill_topics(tables["Topic"], incoming_topics)
    out["Topic"] = merge.get_or_create(filled, incoming_topics.select("display_name"), "topic_id", ["display_name"], hashed=True)
    ids = out["Topic"].select(F.col("display_name").alias("topic"), F.col("topic_id").alias("primary_topic"))
    if "Volume" in tables and "Issue" in tables:
        out["Volume"], out["Issue"], arts = merge.volumes_and_issues(arts, tables["Volume"], tables["Issue"])
    else:
        arts = arts.withColumn("issue_id", none)
    resolved = stored(merge.resolve_works(tables["Article"].hint(GROWS), arts.join(ids, "topic", "left")))
    out["Article"] = merge.full_upsert(tables["Article"].hint(GROWS), resolved.withColumn("is_deleted", F.lit(False)).select(*tables["Article"].columns), ["article_id"])
    articles = resolved.select("work_key", "article_id").distinct().hint(GROWS)

    person = lambda a: S.row_hash(S.id_tail(F.col(f"{a}.id")), S.orcid_url(F.col(f"{a}.orcid")), F.col(f"{a}.display_name"))
    people = landed.authors_of(keyed).withColumn("row_id", S.row_hash("openalex_id", "orcid", "display_name"))
    known = resolve.resolve_authors(people, tables["Author"].hint(GROWS))
    assigned = stored(people.join(known.hint(GROWS), "row_id").withColumn("author_id", F.coalesce("author_id", "row_id")))
    fresh = assigned.where("step is null").select("author_id", "orcid", "openalex_id", "display_name")
    out["Author"] = tables["Author"].unionByName(merge.latest(fresh, ["author_id"]), allowMissingColumns=True)
    listed = keyed.select("work_key", F.explode("authorships.author").alias("a")).select("work_key", person("a").alias("row_id"))
    links = listed.join(assigned.select("row_id", "author_id").hint(GROWS), "row_id").join(articles, "work_key").select("author_id", "article_id")
    out["Author_Article"] = merge.insert_if_absent(tables["Author_Article"], links.hint(GROWS), ["author_id", "article_id"])

    words = keyed.select("work_key", F.explode("keywords").alias("k")).select("work_key", F.col("k.display_name").alias("display_name"), S.score_or_zero(F.col("k.score")).alias("score")).where("display_name is not null")
    out["Keyword"] = merge.get_or_create(tables["Keyword"], words.select("display_name"), "keyword_id", ["display_name"], hashed=True)
    tagged = words.join(out["Keyword"], "display_name").join(articles, "work_key").select("keyword_id", "article_id", "score")
    out["Keyword_Article"] = merge.insert_if_absent(tables["Keyword_Article"], tagged.select(*tables["Keyword_Article"].columns).hint(GROWS), ["keyword_id", "article_id"])
    return out


def prune_to_manifest(tables: dict[str, DataFrame], manifests: DataFrame, items: DataFrame, protected: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables pruned to the active manifest's closure, and the report of what stays and goes."""
    kept = closure.keep_sets(tables, selection.active_items(manifests, items), protected)
    pruned = closure.prune(tables, kept)
    return pruned, closure.keep_report(tables, pruned)


def domain_subset(tables: dict[str, DataFrame], terms: list[str]) -> dict[str, DataFrame]:
    """Tables restricted to articles of a domain: primary topic, any sub topic or any keyword matches a term."""
    topics = resolve.domain_matches(tables["Topic"], ["display_name"], terms, "topic_id")
    keywords = resolve.domain_matches(tables["Keyword"], ["display_name"], terms, "keyword_id")
    articles = resolve.any_of(
        tables["Article"].join(topics.withColumnRenamed("topic_id", "primary_topic"), "primary_topic", "left_semi").select("article_id"),
        tables["Sub_Topic"].join(topics, "topic_id", "left_semi").select("article_id"),
        tables["Keyword_Article"].join(keywords, "keyword_id", "left_semi").select("article_id"),
    )
    return closure.prune(tables, closure.keep_sets(tables, articles))


def priority_subset(tables: dict[str, DataFrame], n: int) -> dict[str, DataFrame]:
    """The n articles with references and most of them first, and all that they depend on."""
    order = reports.priority_order(S.has_elements("references"), F.col("reference_count"), F.col("article_id"))
    top = reports.top(tables["Article"], n, *order).select("article_id")
    out = closure.prune(tables, closure.keep_sets(tables, top))
    if "Topic" in tables:
        used = resolve.any_of(out["Article"].select(F.col("primary_topic").alias("topic_id")), *([out["Sub_Topic"].select("topic_id")] if "Sub_Topic" in out else []))
        out["Topic"] = tables["Topic"].join(used, "topic_id", "left_semi")
    return out


def build_nodes(tables: dict[str, DataFrame], cap: int | None = None) -> dict[str, DataFrame]:
    """Node tables by label, and the placeholder nodes of unknown references."""
    out = graph.schema_nodes(tables, cap)
    out["Reference"] = graph.placeholder_nodes(graph.citation_edges(graph.graph_references(tables["Article"]), tables["Article"]))
    return out


def build_graph(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Edge tables by type: the schema's links, citations, and the derived networks."""
    out = graph.schema_edges(tables)
    out["REFERENCES"] = graph.citation_edges(graph.graph_references(tables["Article"]), tables["Article"])
    out["COLLABORATES_WITH"] = graph.cooccurrence(tables["Author_Article"], "article_id", "author_id", "paper_count")
    out["KEYWORD_RELATED_TO"] = graph.cooccurrence(tables["Keyword_Article"], "article_id", "keyword_id", "frequency")
    out["TOPIC_RELATED_TO"] = graph.cooccurrence(tables["Sub_Topic"], "article_id", "topic_id", "frequency")
    return out
