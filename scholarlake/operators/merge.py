"""Upserts as pure functions from current and incoming rows to the table's next snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S
from scholarlake.operators.numbering import dense_numbers


def common_columns(source: DataFrame, target: DataFrame) -> list[str]:
    """Columns of both tables, in the source's order."""
    have = set(target.columns)
    return [c for c in source.columns if c in have]


def latest(incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One incoming row for each key; the first by `order` (all columns by default, so that it is determined)."""
    order = order or [F.col(c).asc_nulls_last() for c in incoming.columns if c not in keys] or [F.lit(0)]
    return incoming.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows join the table only where their key is new."""
    return current.unionByName(latest(incoming, keys).join(current.select(*keys), keys, "left_anti"))


def full_upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace those of equal key."""
    fresh = latest(incoming, keys)
    return current.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh.select(*current.columns))


def update_known(current: DataFrame, incoming: DataFrame, keys: list[str], restore: str | None = "is_deleted") -> DataFrame:
    """Incoming rows update those of equal key and are added where there is none; an incoming NULL keeps the known value, `restore` becomes false."""
    fresh = latest(incoming, keys)
    values = [c for c in fresh.columns if c not in keys and c != restore]
    new = fresh.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in values), F.lit(True).alias("_there"))
    put = lambda c: F.coalesce(f"_new_{c}", c).alias(c) if c in values else F.when(F.col("_there"), False).otherwise(F.col(c)).alias(c) if c == restore else F.col(c)
    return current.join(new, keys, "full").select(*(put(c) for c in current.columns))


def get_or_create_keyed(current: DataFrame, incoming: DataFrame, id_column: str, keys: list[str]) -> DataFrame:
    """The table with a row for every incoming key, NULLs in keys being equal; new ids are hashes of the key."""
    new, old = incoming.select(*keys).distinct(), current.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    fresh = new.join(old, same, "left_anti").withColumn(id_column, S.row_hash(*keys))
    if "is_deleted" in current.columns:
        fresh = fresh.withColumn("is_deleted", F.lit(False))
    return current.unionByName(fresh, allowMissingColumns=True)


def _with_id(rows: DataFrame, dim: DataFrame, id_column: str, keys: dict[str, str]) -> DataFrame:
    """rows with the smallest id of the dimension row of equal keys {row column: dimension column}, NULLs being equal."""
    ids = dim.groupBy(*(F.col(v).alias(f"_{v}") for v in keys.values())).agg(F.min(id_column).alias(id_column))
    same = F.lit(True)
    for k, v in keys.items():
        same &= F.col(k).eqNullSafe(F.col(f"_{v}"))
    return rows.join(ids, same, "left").drop(*(f"_{v}" for v in keys.values()))


def volumes_and_issues(rows: DataFrame, volumes: DataFrame, issues: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Volumes, issues and rows (journal_id, volume, issue, publication_year) with issue_id.

    A volume is a journal's number and year, an issue a volume's number and year; a volume that is met again is
    no longer deleted. Rows without journal or volume number have neither, rows without issue number no issue.
    """
    in_volume = rows.where("journal_id is not null and volume is not null").select("journal_id", F.col("volume").alias("volume_number"), "publication_year").distinct()
    keys = ["journal_id", "volume_number", "publication_year"]
    out = get_or_create_keyed(volumes, in_volume, "volume_id", keys)
    if "is_deleted" in volumes.columns:
        met = in_volume.select(*(F.col(k).alias(f"_{k}") for k in keys), F.lit(True).alias("_met"))
        same = F.lit(True)
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        out = out.join(met, same, "left").withColumn("is_deleted", F.when(F.col("_met"), False).otherwise(F.col("is_deleted"))).select(*volumes.columns)
    placed = _with_id(rows, out, "volume_id", {"journal_id": "journal_id", "volume": "volume_number", "publication_year": "publication_year"})
    placed = placed.withColumn("volume_id", F.when(F.col("journal_id").isNotNull() & F.col("volume").isNotNull(), F.col("volume_id")))
    in_issue = placed.where("volume_id is not null and issue is not null").select("volume_id", F.col("issue").alias("issue_number"), "publication_year")
    known = get_or_create_keyed(issues, in_issue, "issue_id", ["volume_id", "issue_number", "publication_year"])
    placed = _with_id(placed, known, "issue_id", {"volume_id": "volume_id", "issue": "issue_number", "publication_year": "publication_year"})
    return out, known, placed.withColumn("issue_id", F.when(F.col("volume_id").isNotNull() & F.col("issue").isNotNull(), F.col("issue_id"))).drop("volume_id")


def changed_rows(current: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Incoming rows that are new or differ from the table in a tracked column (nulls are equal)."""
    old = current.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in tracked), F.lit(True).alias("_there"))
    same = F.col("_there").isNotNull()
    for c in tracked:
        same &= F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return latest(incoming, keys).join(old, keys, "left").where(~same).select(*incoming.columns)


def conditional_upsert(current: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    return full_upsert(current, changed_rows(current, incoming, keys, tracked), keys)


def get_or_create(current: DataFrame, names: DataFrame, id_column: str, key: list[str], hashed: bool = False) -> DataFrame:
    """The dimension with an id for every natural key; new ids follow the largest in key order.

    Numbering sorts the new keys in ranges and numbers each behind the counts of those before it; `hashed` gives
    xxhash64 ids, which need no order.
    """
    new = names.select(*key).distinct().dropna(subset=key).join(current.select(*key), key, "left_anti")
    if hashed:
        return current.unionByName(new.withColumn(id_column, F.xxhash64(*key)), allowMissingColumns=True)
    top = current.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))
    numbered = dense_numbers(new, key, "_n").join(F.broadcast(top))
    return current.unionByName(numbered.withColumn(id_column, (F.col("_top") + F.col("_n")).cast(current.schema[id_column].dataType)).drop("_top", "_n"), allowMissingColumns=True)


def enrich_articles(articles: DataFrame, papers: DataFrame) -> DataFrame:
    """Articles after paper rows (article_id, paper_id, citation_count, influential_citation_count, external_ids, tldr, abstract, references).

    Counts, ids and tldr are overwritten, a longer abstract wins, references fill only empty ones.
    """
    p = latest(papers, ["article_id"]).select("article_id", F.struct(*[c for c in papers.columns if c != "article_id"]).alias("_p"))
    found = F.col("_p").isNotNull()
    put = lambda old, new: F.when(found, F.col(f"_p.{new}")).otherwise(F.col(old))
    empty = F.coalesce(F.size("references") <= 0, F.lit(True))
    fill = found & empty & F.coalesce(F.size("_p.references") > 0, F.lit(False))
    longer = found & F.coalesce(F.length("_p.abstract") > F.length(F.coalesce("abstract", F.lit(""))), F.lit(False))
    out = articles.join(p, "article_id", "left").withColumns(
        {
            "semantic_scholar_id": put("semantic_scholar_id", "paper_id"),
            "citation_count": put("citation_count", "citation_count"),
            "semantic_influential_citation_count": put("semantic_influential_citation_count", "influential_citation_count"),
            "semantic_external_ids": put("semantic_external_ids", "external_ids"),
            "semantic_tldr": put("semantic_tldr", "tldr"),
            "abstract": F.when(longer, F.col("_p.abstract")).otherwise(F.col("abstract")),
            "reference_count": F.when(fill, F.size("_p.references")).otherwise(F.col("reference_count")),
            "references": F.when(fill, F.col("_p.references")).otherwise(F.col("references")),
        }
    )
    return out.select(*articles.columns)


def overwrite_references(articles: DataFrame, works: DataFrame) -> DataFrame:
    """Articles after works (article_id, references, reference_count, citation_count): references replaced, their count given or measured, citations kept if unknown."""
    w = latest(works, ["article_id"]).select("article_id", F.col("references").alias("_r"), F.col("reference_count").alias("_n"), F.col("citation_count").alias("_c"), F.lit(True).alias("_found"))
    found = F.col("_found").isNotNull()
    out = articles.join(w, "article_id", "left").withColumns(
        {
            "references": F.when(found, F.coalesce("_r", F.array().cast("array<string>"))).otherwise(F.col("references")),
            "reference_count": F.when(found, F.coalesce(F.col("_n"), F.greatest(F.size("_r"), F.lit(0)))).otherwise(F.col("reference_count")),
            "citation_count": F.when(found, F.coalesce("_c", "citation_count")).otherwise(F.col("citation_count")),
        }
    )
    return out.select(*articles.columns)


def update_authors(authors: DataFrame, details: DataFrame, identifiers: tuple[str, ...] = ("orcid", "openalex_id")) -> DataFrame:
    """Authors after detail rows; an identifier that another author owns, or that the batch gives to a smaller author_id, is not taken."""
    fresh = latest(details, ["author_id"])
    for name in identifiers:
        owners = authors.where(F.col(name).isNotNull()).select(F.col(name), F.col("author_id").alias("_owner"))
        first = fresh.where(F.col(name).isNotNull()).groupBy(name).agg(F.min("author_id").alias("_first"))
        fresh = fresh.join(owners, name, "left").join(first, name, "left")
        mine = F.coalesce(F.col("_owner") == F.col("author_id"), F.col("_first") == F.col("author_id"), F.lit(False))
        fresh = fresh.withColumn(name, F.when(mine, F.col(name))).drop("_owner", "_first")
    values = [c for c in details.columns if c != "author_id"]
    fresh = fresh.select("author_id", *(F.col(c).alias(f"_new_{c}") for c in values))
    return authors.join(fresh, "author_id", "left").select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in values else F.col(c) for c in authors.columns))


def fill_topics(topics: DataFrame, incoming: DataFrame) -> DataFrame:
    """Topics after incoming rows: area and category only where missing, the score replaced; new names are added without id."""
    new = latest(incoming, ["display_name"]).select("display_name", F.col("subject_area_id").alias("_a"), F.col("subject_category_id").alias("_c"), F.col("score").alias("_s"))
    both = topics.join(new, "display_name", "left").select(*[c for c in topics.columns if c not in ("subject_area_id", "subject_category_id", "score")], F.coalesce("subject_area_id", "_a").alias("subject_area_id"), F.coalesce("subject_category_id", "_c").alias("subject_category_id"), F.coalesce("_s", "score").alias("score"))
    return both.select(*topics.columns)


def get_or_create_articles(articles: DataFrame, works: DataFrame, literal_nulls: bool = False) -> DataFrame:
    """Works with article_id of the article of equal title and issue; NULL issues are equal unless `literal_nulls`. Unmatched works have NULL."""
    a = articles.select(F.col("title").alias("_t"), F.col("issue_id").alias("_i"), "article_id").groupBy("_t", "_i").agg(F.min("article_id").alias("article_id"))
    same_issue = (F.col("issue_id") == F.col("_i")) if literal_nulls else F.col("issue_id").eqNullSafe(F.col("_i"))
    return works.join(a, (F.col("title") == F.col("_t")) & same_issue, "left").drop("_t", "_i")


def resolve_works(articles: DataFrame, works: DataFrame) -> DataFrame:
    """Works (title, issue_id, doi) with article_id: of equal DOI, else of equal title and issue unless both have DOIs; new ones get a hash.

    NULL issues are equal. Works of one new DOI, or of one new title and issue without DOI, are one article.
    """
    by_doi = articles.where("doi is not null").groupBy(F.col("doi").alias("_d")).agg(F.min("article_id").alias("_by_doi"))
    a = articles.groupBy(F.col("title").alias("_t"), F.col("issue_id").alias("_i")).agg(F.min("article_id").alias("_any"), F.min(F.when(F.col("doi").isNull(), F.col("article_id"))).alias("_bare"))
    out = works.join(by_doi, F.col("doi") == F.col("_d"), "left").join(a, (F.col("title") == F.col("_t")) & F.col("issue_id").eqNullSafe(F.col("_i")), "left")
    new = F.when(F.col("doi").isNotNull(), F.xxhash64(F.lit("doi"), "doi")).otherwise(S.row_hash(F.lit("title"), "title", "issue_id"))
    by_title = F.when(F.col("doi").isNull(), F.col("_any")).otherwise(F.col("_bare"))
    return out.withColumn("article_id", F.coalesce("_by_doi", by_title, new)).drop("_d", "_by_doi", "_t", "_i", "_any", "_bare")


def ranking_upsert(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rankings on (journal, metric, year, values with defaults); category and time of an equal key are replaced."""
    key = lambda: [F.col("journal_id"), F.col("metric_id"), F.col("year"), F.coalesce("value_txt", F.lit("")).alias("_t"), F.coalesce("value_int", F.lit(0)).alias("_i"), F.coalesce("value_float", F.lit(0.0)).alias("_f")]
    names = ["journal_id", "metric_id", "year", "_t", "_i", "_f"]
    keyed = lambda df: df.select(*key(), *[c for c in df.columns if c not in ("journal_id", "metric_id", "year")])
    return full_upsert(keyed(current), keyed(incoming), names).select(*current.columns)


def clear_other_dimensions(articles: DataFrame, dim: int, confirm: str) -> DataFrame:
    """Articles without embeddings of another length, after the confirmation REPLACE-<dim>."""
    if confirm != f"REPLACE-{dim}":
        raise ValueError(f"confirm with REPLACE-{dim}")
    return articles.withColumn("embedding", F.when(F.size("embedding") == dim, F.col("embedding")))


def fill_from(df: DataFrame, other: DataFrame, key: str, column: str, default: Column) -> DataFrame:
    """A required column filled from a related table, or with the default."""
    given = other.groupBy(key).agg(F.min(column).alias("_given"))
    return df.join(given, key, "left").withColumn(column, F.coalesce(*([F.col(column)] if column in df.columns else []), F.col("_given"), default)).drop("_given")


# Tables of each copy profile, in dependency order.
COPY_PROFILES = {
    "journals": ("Zone", "Subject_Area", "Subject_Category", "Publisher", "Ranking_Metric", "Journal", "Journal_Subject_Category", "Journal_Ranking"),
    "articles": ("Volume", "Issue", "Topic", "Keyword", "Article", "Sub_Topic", "Keyword_Article"),
    "full": ("Author", "Author_Article"),
}


def profile_tables(profile: str) -> list[str]:
    """Tables of a profile and of the smaller ones before it."""
    names: list[str] = []
    for name, tables in COPY_PROFILES.items():
        names += tables
        if name == profile:
            return names
    raise ValueError(f"no copy profile {profile}")


def copy_table(source: DataFrame, target: DataFrame, keys: list[str], limit: int | None = None, mode: str = "absent") -> DataFrame:
    """The target after a copy of their common columns, the first `limit` rows by key; mode absent, changed, replace or reset."""
    columns = common_columns(source, target)
    rows = source.select(*columns)
    if limit:
        rows = rows.orderBy(*keys).limit(limit)
    current = target.select(*columns)
    if mode == "reset":
        return rows
    if mode == "replace":
        return full_upsert(current, rows, keys)
    if mode == "changed":
        return conditional_upsert(current, rows, keys, [c for c in columns if c not in keys])
    return insert_if_absent(current, rows, keys)
