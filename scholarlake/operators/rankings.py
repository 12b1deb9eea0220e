"""Journal-ranking import: typed rows, dimensions, categories, and long metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S

# Metric codes, their names, kinds and columns.
METRICS = (
    ("RANK", "Rank", "INTEGER", "rank_txt"),
    ("SJR", "SJR Score", "SCORE", "sjr"),
    ("SJR_BEST_QUARTILE", "SJR Best Quartile", "QUARTILE", None),
    ("SJR_QUARTILE_BY_CAT", "SJR Quartile By Category", "QUARTILE", None),
    ("H_INDEX", "H Index", "INTEGER", "h_index"),
    ("TOTAL_DOCS_CURRENT_YEAR", "Total Docs (Current Year)", "INTEGER", "total_docs_current_year"),
    ("TOTAL_DOCS_3YEARS", "Total Docs (3 Years)", "INTEGER", "total_docs_3years"),
    ("TOTAL_REFS", "Total Refs", "INTEGER", "total_refs"),
    ("TOTAL_CITES_3YEARS", "Total Cites (3 Years)", "INTEGER", "total_cites_3years"),
    ("CITABLE_DOCS_3YEARS", "Citable Docs (3 Years)", "INTEGER", "citable_docs_3years"),
    ("CITES_PER_DOC_2YEARS", "Cites / Doc (2 Years)", "SCORE", "cites_doc_2years"),
    ("REF_PER_DOC", "Ref / Doc", "SCORE", "ref_doc"),
)
VALUE = "struct<metric:string,category:string,area:string,value_txt:string,value_int:bigint,value_float:double>"


def _value(metric: str, txt: Column | None = None, whole: Column | None = None, real: Column | None = None, category: Column | None = None, area: Column | None = None) -> Column:
    none = F.lit(None)
    pick = lambda x, kind: (none if x is None else x).cast(kind)
    return F.struct(F.lit(metric).alias("metric"), pick(category, "string").alias("category"), pick(area, "string").alias("area"), pick(txt, "string").alias("value_txt"), pick(whole, "bigint").alias("value_int"), pick(real, "double").alias("value_float"))


def metric_rows(rows: DataFrame, key: str = "journal_id", year: int | Column = 2025) -> DataFrame:
    """Long metric rows of mapped ranking rows, all-NULL ones dropped: metric, category, area and one of three values."""
    categories, areas = S.parse_categories("categories"), S.parse_areas("areas")
    by_category = F.transform(S.category_areas(categories, areas), lambda x: _value("SJR_QUARTILE_BY_CAT", txt=x["category"]["quartile"], category=x["category"]["name"], area=x["area"]))
    numbers = [_value(code, whole=S.norm_int(column)) if kind == "INTEGER" else _value(code, real=S.norm_decimal(column)) for code, _, kind, column in METRICS if column]
    best = _value("SJR_BEST_QUARTILE", txt=S.best_quartile(F.transform(categories, lambda c: c["quartile"])))
    values = F.concat(by_category, F.array(best, *numbers))
    year = F.lit(year) if isinstance(year, int) else year
    long = rows.select(key, year.alias("year"), F.posexplode(values).alias("pos", "v")).select(key, "year", "pos", "v.*")
    return long.where(F.coalesce("value_txt", F.col("value_int").cast("string"), F.col("value_float").cast("string")).isNotNull())


def first_metric_rows(long: DataFrame, key: str = "journal_id", category_in_key: bool = False) -> DataFrame:
    """Metric rows without later ones of equal journal, metric, year and value. By default two categories of one quartile keep the first."""
    parts = [F.col(key), F.col("metric"), F.col("year"), F.coalesce("value_txt", F.lit("")), F.coalesce("value_int", F.lit(0)), F.coalesce("value_float", F.lit(0.0))]
    parts += [F.coalesce("category", F.lit("")), F.coalesce("area", F.lit(""))] if category_in_key else []
    order = Window.partitionBy(*parts).orderBy("pos", "category", "area")
    return long.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "pos")


def journal_categories(rows: DataFrame, key: str = "journal_id") -> DataFrame:
    """Distinct (journal, category, area)."""
    pairs = S.category_areas(S.parse_categories("categories"), S.parse_areas("areas"))
    return rows.select(key, F.explode(pairs).alias("p")).select(key, F.col("p.category.name").alias("category"), F.col("p.area").alias("area")).distinct()


def typed_journals(rows: DataFrame) -> DataFrame:
    """Journal attributes of mapped ranking rows."""
    return rows.select("source_id", "title", "type", F.array_join(S.split_issns("issn"), ",").alias("issn"), "publisher", "country", "region", S.norm_bool("open_access").alias("is_open_access"), S.norm_bool("open_access_diamond").alias("is_diamond"))
