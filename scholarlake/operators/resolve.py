"""Resolution of journals, authors, papers and references to stable keys by cascades of joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S
from scholarlake.operators.terms import term_matches

#: Comparisons of a column with a term that one expression holds.
MANY_TERMS = 64


def lookup(df: DataFrame, dim: DataFrame, on: Column, *values: str) -> DataFrame:
    """Left join on a natural key; Spark broadcasts the dimension if it is small."""
    return df.join(dim, on, "left").select(df["*"], *(dim[v] for v in values))


def lookup_ignoring_case(df: DataFrame, dim: DataFrame, name: str, dim_name: str, dim_id: str) -> DataFrame:
    names = dim.groupBy(F.lower(dim_name).alias("_name")).agg(F.min(dim_id).alias(dim_id))
    return df.join(names, F.lower(F.col(name)) == F.col("_name"), "left").drop("_name")


def journals_by_issn(journals: DataFrame) -> DataFrame:
    """One journal for each loose ISSN token: that of the largest journal_id, as later rows replace earlier ones."""
    return journals.select("journal_id", F.explode(S.loose_issns("issn")).alias("token")).groupBy("token").agg(F.max("journal_id").alias("journal_id"))


def resolve_journals(rows: DataFrame, journals: DataFrame, row_id: str = "row_id") -> DataFrame:
    """rows with journal_id: by source_id, else by the first ISSN token that any journal has."""
    by_source = journals.where("source_id is not null").groupBy("source_id").agg(F.max("journal_id").alias("_by_source"))
    direct = rows.join(by_source, "source_id", "left")
    tokens = direct.where("_by_source is null").select(row_id, F.posexplode(S.loose_issns("issn")).alias("pos", "token"))
    by_token = tokens.join(journals_by_issn(journals), "token").groupBy(row_id).agg(F.min_by("journal_id", "pos").alias("_by_issn"))
    return direct.join(by_token, row_id, "left").withColumn("journal_id", F.coalesce("_by_source", "_by_issn")).drop("_by_source", "_by_issn")


def match_sources(journals: DataFrame, sources: DataFrame) -> DataFrame:
    """journal_id, external_id, status of each journal by any shared strict ISSN.

    A journal takes its smallest source, an external id the smallest journal; losers are DUPLICATE,
    journals without ISSN NO_ISSN, the rest NOT_FOUND.
    """
    own = journals.select("journal_id", S.split_issns("issn").alias("issns"))
    # one source for each token, so that a token that many share makes no pairs
    smallest = sources.select(F.col("id").alias("external_id"), F.explode(S.source_issns("issn", "issn_l")).alias("token")).groupBy("token").agg(F.min("external_id").alias("external_id"))
    picked = own.select("journal_id", F.explode("issns").alias("token")).join(smallest, "token").groupBy("journal_id").agg(F.min("external_id").alias("external_id"))
    owners = picked.groupBy("external_id").agg(F.min("journal_id").alias("owner"))
    found = picked.join(owners, "external_id")
    status = F.when(F.size("issns") == 0, "NO_ISSN").when(F.col("owner").isNull(), "NOT_FOUND").when(F.col("owner") != F.col("journal_id"), "DUPLICATE").otherwise("MATCHED")
    return own.join(found, "journal_id", "left").select("journal_id", F.when(status == "MATCHED", F.col("external_id")).alias("external_id"), status.alias("status"))


def cascade(rows: DataFrame, targets: DataFrame, row_id: str, target_id: str, steps: list[tuple[str, Column, Column]]) -> DataFrame:
    """row_id, target_id, step of the first step (name, row key, target key) that matches; unmatched rows have NULLs.

    Each step joins on one equal key, and a key of several targets gives the smallest.
    """
    out = rows.select(row_id, *(k.alias(f"_k{i}") for i, (_, k, _) in enumerate(steps)))
    for i, (_, _, key) in enumerate(steps):
        out = out.join(targets.where(key.isNotNull()).groupBy(key.alias(f"_k{i}")).agg(F.min(target_id).alias(f"_t{i}")), f"_k{i}", "left")
    step = reduce(lambda c, i: F.when(F.col(f"_t{i}").isNotNull(), F.lit(steps[i][0])).otherwise(c), reversed(range(len(steps))), F.lit(None).cast("string"))
    return out.select(row_id, F.coalesce(*(F.col(f"_t{i}") for i in range(len(steps)))).alias(target_id), step.alias("step"))


def resolve_authors(incoming: DataFrame, authors: DataFrame, literal_names: bool = False) -> DataFrame:
    """author_id of incoming (row_id, openalex_id, orcid, display_name): by openalex id, by orcid, by the name of an author without ids.

    `literal_names` lets the name step meet authors that have ids too.
    """
    bare = F.lit(True) if literal_names else F.col("orcid").isNull() & F.col("openalex_id").isNull()
    steps = [("openalex_id", F.col("openalex_id"), F.col("openalex_id")), ("orcid", F.col("orcid"), F.col("orcid")), ("name", F.col("display_name"), F.when(bare, F.col("display_name")))]
    return cascade(incoming, authors, "row_id", "author_id", steps)


def match_papers(papers: DataFrame, articles: DataFrame) -> DataFrame:
    """paper_id, article_id, step: by DOI, else by title in lower case with years at most one apart (an unknown year fits)."""
    by_doi = papers.select("paper_id", S.normalize_doi("doi").alias("d")).join(articles.select("article_id", S.normalize_doi("doi").alias("d")), "d").groupBy("paper_id").agg(F.min("article_id").alias("article_id"))
    left = papers.join(by_doi, "paper_id", "left_anti").select("paper_id", F.lower(F.trim("title")).alias("t"), F.col("year").alias("y1"))
    # one row for each title and year, so that a common title joins its years and not its articles
    titles = articles.where("title is not null").groupBy(F.lower(F.trim("title")).alias("t"), F.col("publication_year").alias("y")).agg(F.min("article_id").alias("a"))
    whole = titles.groupBy("t").agg(F.min("a").alias("any_year"), F.min(F.when(F.col("y").isNull(), F.col("a"))).alias("no_year"))
    around = left.where("y1 is not null").select("paper_id", "t", F.explode(F.array(F.col("y1") - 1, F.col("y1"), F.col("y1") + 1)).alias("y"))
    dated = around.join(titles, ["t", "y"]).groupBy("paper_id").agg(F.min("a").alias("a"))
    undated = left.join(whole, "t").select("paper_id", F.when(F.col("y1").isNull(), F.col("any_year")).otherwise(F.col("no_year")).alias("a"))
    by_title = dated.unionByName(undated.where("a is not null")).groupBy("paper_id").agg(F.min("a").alias("article_id"))
    found = by_doi.withColumn("step", F.lit("doi")).unionByName(by_title.withColumn("step", F.lit("title")))
    return papers.select("paper_id").join(found, "paper_id", "left")


def resolve_references(articles: DataFrame, mapping: DataFrame) -> DataFrame:
    """article_id and references: DOI references as they are normalised, work ids through mapping (work_id, doi); unresolved ones go."""
    refs = articles.select("article_id", F.explode_outer("references").alias("ref"))
    is_doi = F.col("ref").contains("10.") & ~F.col("ref").contains("openalex.org")
    direct = refs.where(is_doi).select("article_id", S.normalize_doi("ref").alias("doi"))
    through = refs.where(~is_doi).select("article_id", S.id_tail("ref").alias("work_id")).join(mapping.select(S.id_tail("work_id").alias("work_id"), S.normalize_doi("doi").alias("doi")), "work_id").select("article_id", "doi")
    sets = direct.unionByName(through).where("doi is not null").groupBy("article_id").agg(F.array_sort(F.collect_set("doi")).alias("references"))
    return articles.select("article_id").join(sets, "article_id", "left").select("article_id", F.coalesce("references", F.array().cast("array<string>")).alias("references"))


def merge_references(articles: DataFrame, mapping: DataFrame) -> DataFrame:
    """Articles after their stored references were united with the DOIs they resolve to; live ones with references change, their count too."""
    live = ~F.coalesce("is_deleted", F.lit(False)) if "is_deleted" in articles.columns else F.lit(True)
    found = resolve_references(articles.where(live & S.has_elements("references")), mapping).select("article_id", F.col("references").alias("_r"))
    out = articles.join(found, "article_id", "left")
    return out.withColumn("reference_count", F.coalesce(F.when(F.col("_r").isNotNull(), F.size("_r")).cast(articles.schema["reference_count"].dataType), "reference_count")).withColumn("references", F.coalesce("_r", "references")).select(*articles.columns)


def object_references(payload: Column | str) -> Column:
    """DOIs of reference objects in a JSON array."""
    items = F.from_json(S.col(payload), "array<struct<externalIds:map<string,string>>>")
    return F.filter(F.transform(items, lambda x: S.normalize_doi(F.try_element_at(x["externalIds"], F.lit("DOI")))), lambda d: d.isNotNull())


def domain_matches(articles: DataFrame, text_columns: list[str], terms: list[str], key: str = "article_id") -> DataFrame:
    """Distinct keys of rows with any term in any column, ignoring case; many terms go through one automaton, as an expression of all overflows."""
    if len(text_columns) * len(terms) > MANY_TERMS:
        return term_matches(articles, text_columns, terms, key)
    hit = reduce(lambda a, b: a | b, (F.coalesce(F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(t)), F.lit(False)) for c in text_columns for t in terms), F.lit(False))
    return articles.where(hit).select(key).distinct()


def any_of(*ids: DataFrame) -> DataFrame:
    """Distinct keys of several sets."""
    return reduce(DataFrame.union, ids).distinct()


def hierarchy(articles: DataFrame, issues: DataFrame, volumes: DataFrame, journals: DataFrame) -> DataFrame:
    """article_id and journal_id through issue and volume, none of them deleted."""
    live = lambda df: df.where(~F.coalesce("is_deleted", F.lit(False))) if "is_deleted" in df.columns else df
    chain = live(articles).select("article_id", "issue_id").join(live(issues).select("issue_id", "volume_id"), "issue_id").join(live(volumes).select("volume_id", "journal_id"), "volume_id")
    return chain.join(live(journals).select("journal_id"), "journal_id", "left_semi").select("article_id", "journal_id")


def first_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
