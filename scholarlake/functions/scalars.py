"""Column functions of the bibliographic engine; all are built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone codes of regions (code, three-letter code).
REGION_CODES = {
    "Western Europe": ("WE", "WEU"),
    "Latin America": ("LA", "LAC"),
    "Northern America": ("NA", "NAM"),
    "Africa": ("AF", "AFR"),
    "Asiatic Region": ("AS", "ASN"),
    "Eastern Europe": ("EE", "EES"),
    "Middle East": ("ME", "MEA"),
    "Pacific Region": ("PA", "PAC"),
}

# Zone codes of countries whose names the country dictionary may lack.
COUNTRY_CODES = {
    "united kingdom": ("GB", "GBR"),
    "united states": ("US", "USA"),
    "south korea": ("KR", "KOR"),
    "vietnam": ("VN", "VNM"),
    "viet nam": ("VN", "VNM"),
    "russia": ("RU", "RUS"),
    "russian federation": ("RU", "RUS"),
    "iran": ("IR", "IRN"),
    "iran, islamic republic of": ("IR", "IRN"),
    "syria": ("SY", "SYR"),
    "syrian arab republic": ("SY", "SYR"),
    "laos": ("LA", "LAO"),
    "macao": ("MO", "MAC"),
    "macau": ("MO", "MAC"),
    "taiwan": ("TW", "TWN"),
    "taiwan, province of china": ("TW", "TWN"),
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """NULL or only spaces."""
    return F.coalesce(F.trim(col(c)) == "", F.lit(True))


def norm_bool(c: Column | str) -> Column:
    """yes/y/true/1 and no/n/false/0, else NULL."""
    v = F.lower(F.trim(col(c).cast("string")))
    return F.when(v.isin("yes", "y", "true", "1"), True).when(v.isin("no", "n", "false", "0"), False)


def norm_int(c: Column | str) -> Column:
    """Whole number, thousands commas removed, fraction cut; NULL if bad, infinite or out of range."""
    number = F.regexp_replace(F.trim(col(c).cast("string")), ",", "").try_cast("double")
    cut = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.when(~F.isnan(number) & (F.abs(number) < 9.2e18), cut.try_cast("bigint"))


def norm_decimal(c: Column | str) -> Column:
    """Number with a decimal comma or point; NULL if bad."""
    return F.replace(F.trim(col(c).cast("string")), F.lit(","), F.lit(".")).try_cast("double")


def split_issns(c: Column | str) -> Column:
    """Strict ISSNs (eight characters, hyphens removed) in order, repeats kept."""
    tokens = F.transform(F.split(F.coalesce(col(c), F.lit("")), r"[,;/\s]+"), lambda x: F.upper(F.replace(x, F.lit("-"), F.lit(""))))
    return F.filter(tokens, lambda x: x.rlike(r"^\d{7}[\dX]$"))


def loose_issns(c: Column | str) -> Column:
    """Tokens of at least eight characters between commas and blanks, as written."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), r"[,\s]+"), lambda x: F.length(x) >= 8)


def once(value: Column, f) -> Column:
    """f(value), in which value is computed once however often f names it; a column that a lambda names is computed at each element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def first_of_each(names: Column, key) -> Column:
    """Array without later elements whose key came before."""
    kept = lambda xs: once(F.transform(xs, key), lambda keys: F.filter(xs, lambda x, i: F.array_position(keys, F.element_at(keys, i + 1)) == i + 1))
    return once(names, kept)


def split_subject_names(c: Column | str) -> Column:
    """Names between semicolons, commas and the word and; the first of names equal in lower case stays."""
    chunks = F.split(F.coalesce(col(c), F.lit("")), ";")
    parts = F.flatten(F.transform(chunks, lambda x: F.split(F.trim(x), r"(?i)\s*,\s*|\s+and\s+")))
    names = F.transform(parts, lambda x: F.trim(F.regexp_replace(F.trim(x), r"(?i)^and\s+|\s+and$", "")))
    return first_of_each(F.filter(names, lambda x: x != ""), F.lower)


_QUARTILE = r"^(.*?)\s*\((Q[1-4])\)\s*$"


def parse_categories(c: Column | str) -> Column:
    """Array of (name, quartile or NULL) from `name (Qn); name`."""
    chunks = F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")

    def pairs(chunk: Column) -> Column:
        marked = chunk.rlike(_QUARTILE)
        quartile = F.when(marked, F.regexp_extract(chunk, _QUARTILE, 2))
        name = F.when(marked, F.regexp_extract(chunk, _QUARTILE, 1)).otherwise(chunk)
        return once(quartile, lambda q: F.transform(split_subject_names(name), lambda n: F.struct(n.alias("name"), q.alias("quartile"))))

    found = F.flatten(F.transform(chunks, pairs))
    return first_of_each(found, lambda x: F.concat_ws("|", F.lower(x["name"]), F.coalesce(x["quartile"], F.lit(""))))


def parse_areas(c: Column | str) -> Column:
    """Subject names, or General if there is none."""
    names = split_subject_names(c)
    return F.when(F.size(names) == 0, F.array(F.lit("General"))).otherwise(names)


def best_quartile(quartiles: Column | str) -> Column:
    """Smallest of Q1 to Q4, NULL without any."""
    return F.array_min(F.filter(col(quartiles), lambda q: q.isin("Q1", "Q2", "Q3", "Q4")))


def category_areas(categories: Column, areas: Column) -> Column:
    """(category, area) pairs: by position if there are as many of both, else each with each of the row's."""
    zipped = F.transform(F.arrays_zip(categories.alias("c"), areas.alias("a")), lambda z: F.struct(z["c"].alias("category"), z["a"].alias("area")))
    crossed = F.flatten(F.transform(categories, lambda x: F.transform(areas, lambda a: F.struct(x.alias("category"), a.alias("area")))))
    return F.when(F.size(categories) == F.size(areas), zipped).otherwise(crossed)


def _codes(table: dict[str, tuple[str, str]], key: Column) -> Column:
    entries = [F.lit(x) for k, (a, b) in table.items() for x in (k, f"{a}|{b}")]
    return F.split(F.element_at(F.create_map(*entries), key), r"\|")


def zone_codes(name: Column | str, kind: Column | str, dictionary: Column | None = None) -> Column:
    """array(code, three-letter code) of a zone; `dictionary`: codes of the joined country dictionary, or NULL."""
    clean = F.trim(col(name))
    words = F.split(clean, r"\s+")
    initials = lambda n: F.upper(F.array_join(F.transform(F.slice(words, 1, n), lambda w: F.substring(w, 1, 1)), ""))
    plain = F.array(F.upper(F.substring(clean, 1, 2)), F.upper(F.substring(clean, 1, 3)))
    many = F.array(initials(2), F.substring(F.concat(initials(3), F.lit("R")), 1, 3))
    region = F.coalesce(_codes(REGION_CODES, clean), F.when(F.size(words) >= 2, many).otherwise(plain))
    known = [dictionary] if dictionary is not None else []
    country = F.coalesce(*known, _codes(COUNTRY_CODES, F.lower(clean)), plain)
    return F.when(F.upper(col(kind)) == "REGION", region).otherwise(country)


# Prefixes under which DOIs are written.
DOI_PREFIXES = ("https://doi.org/", "http://doi.org/", "https://dx.doi.org/", "http://dx.doi.org/")


def normalize_doi(c: Column | str, mode: str = "url") -> Column:
    """DOI without URL prefixes. url: lower case behind https://doi.org/, slashes trimmed; bare: slashes trimmed; raw: neither."""
    v = F.trim(col(c))
    for prefix in DOI_PREFIXES:
        v = F.replace(v, F.lit(prefix), F.lit(""))
    if mode != "raw":
        v = F.trim(v, F.lit("/"))
    v = F.when(v != "", v)
    return F.concat(F.lit("https://doi.org/"), F.lower(v)) if mode == "url" else v


def id_tail(c: Column | str) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(col(c), "/"), -1)


def orcid_url(c: Column | str) -> Column:
    """ORCID as a URL, from either form."""
    return F.concat(F.lit("https://orcid.org/"), F.replace(col(c), F.lit("https://orcid.org/"), F.lit("")))


def abstract_from_index(c: Column | str, limit: int = 2000) -> Column:
    """Text of an inverted index {word: [places]}, cut to `limit` characters."""
    placed = F.flatten(F.transform(F.map_entries(col(c)), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.substring(F.array_join(F.transform(F.array_sort(placed), lambda x: x["w"]), " "), 1, limit)


def volume_number(c: Column | str) -> Column:
    """First run of digits as a number."""
    return F.regexp_extract(col(c), r"\d+", 0).try_cast("int")


def issn_display(c: Column | str) -> Column:
    """NNNN-NNNN of an eight-character ISSN; others as they are."""
    v = col(c)
    return F.when(F.length(v) == 8, F.concat_ws("-", F.substring(v, 1, 4), F.substring(v, 5, 4))).otherwise(v)


def source_issns(issn: Column | str, issn_l: Column | str) -> Column:
    """ISSNs of a source: its list and its linking ISSN, without hyphens, in upper case."""
    linking = F.filter(F.array(col(issn_l)), lambda x: x.isNotNull())
    both = F.array_union(F.coalesce(col(issn), F.array().cast("array<string>")), linking)
    return F.array_distinct(F.transform(both, lambda x: F.upper(F.replace(x, F.lit("-"), F.lit("")))))


def score_or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string").try_cast("double"), F.lit(0.0))


def tldr_text(c: Column | str) -> Column:
    """TLDR of a JSON object's text, or of a plain string."""
    v = col(c)
    return F.when(F.substring(F.ltrim(v), 1, 1) == "{", F.get_json_object(v, "$.text")).otherwise(v)


def has_elements(c: Column | str) -> Column:
    return F.coalesce(F.size(col(c)) > 0, F.lit(False))


def json_length(c: Column | str) -> Column:
    """Elements of a JSON array as text; NULL for NULL and for anything else than an array."""
    return F.json_array_length(col(c))


def has_json_elements(c: Column | str) -> Column:
    return F.coalesce(json_length(c) > 0, F.lit(False))


def row_hash(*columns: Column | str) -> Column:
    """xxhash64 that tells a NULL in one column from a NULL in the next."""
    parts = [col(c) for c in columns]
    return F.xxhash64(*(x for c in parts for x in (c.isNull(), c)))


def quality_score(abstract: Column, doi: Column, references: Column, tldr: Column) -> Column:
    """0 to 4: non-blank abstract, doi and tldr, and known references."""
    return sum(((x).cast("int") for x in (~is_blank(abstract), ~is_blank(doi), references.isNotNull(), ~is_blank(tldr))), F.lit(0))


def eligible(title: Column, abstract: Column, deleted: Column) -> Column:
    return ~F.coalesce(deleted, F.lit(False)) & ~is_blank(title) & ~is_blank(abstract)


def article_text(title: Column | str, abstract: Column | str) -> Column:
    """Title and abstract as one text without dots and blanks at its ends."""
    e = F.lit("")
    return F.btrim(F.concat(F.coalesce(col(title), e), F.lit(". "), F.coalesce(col(abstract), e)), F.lit(". "))


def clean_references(c: Column | str) -> Column:
    return F.filter(F.transform(col(c), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def normalize_terms(raw: str) -> list[str]:
    """Domain terms of a parameter: between commas, semicolons and line ends."""
    import re

    return [t for t in (x.strip().lower() for x in re.split(r"[,;\n]+", raw)) if t]


def failed_source_label(status: Column | str, old: Column | str) -> Column:
    """Label of a source that could not be matched: NO_ISSN, DUPLICATE_OPENALEX or NOT_FOUND."""
    return F.concat(F.lit("S_"), col(status), F.lit("_"), F.coalesce(col(old), F.lit("")))


# Order of a report's columns, as lower-case names, then patterns on lower-case names.
REPORT_COLUMNS = (
    "rank", "sourceid", "title", "type", "issn", "publisher", "country", "region", "coverage", "sjr", "sjr best quartile", "h index",
    "open access", "open access diamond", "openalex id", "openalex homepage", "openalex works count", "openalex cited by count", "scope detail",
)
REPORT_PATTERNS = (
    r"^total docs\.? \(", r"total docs.*3 ?years", r"total refs", r"total citations|total cites", r"citable docs", r"(?=.*citations)(?=.*doc)",
    r"(?=.*ref)(?=.*doc)", r"female", r"overton", r"areas", r"categories",
)


def report_order(columns: list[str]) -> list[str]:
    """Columns by the report's rules, the rest behind in their own order."""
    import re

    rules = [f"^{re.escape(x)}$" for x in REPORT_COLUMNS] + list(REPORT_PATTERNS)
    rank = lambda c: next((i for i, r in enumerate(rules) if re.search(r, c.lower())), len(rules))
    return sorted(columns, key=rank)
