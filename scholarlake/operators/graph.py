"""Property-graph tables: nodes, edges, citations and co-occurrence networks."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S
from scholarlake.operators import resolve
from scholarlake.sources.scratch import stored


def nodes(df: DataFrame, key: str, properties: list[str], cap: int | None = None) -> DataFrame:
    """id and properties, one row for each id; with `cap` the first ids in order."""
    out = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*(F.min(p).alias(p) for p in properties)) if properties else df.where(F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct()
    return out.orderBy("id").limit(cap) if cap else out


def edges(links: DataFrame, src: str, dst: str, kind: str, sources: DataFrame | None = None, targets: DataFrame | None = None, properties: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (src, dst, type, properties) whose ends both exist."""
    out = links.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit(kind).alias("type"), *properties).distinct()
    for end, known in (("src", sources), ("dst", targets)):
        if known is not None:
            out = out.join(known.select(F.col(known.columns[0]).alias(end)), end, "left_semi")
    return out.select("src", "dst", "type", *properties)


#: (type, table, source column, target column, properties) of the schema's edges.
SCHEMA_EDGES = (
    ("PUBLISHES", "Journal", "publisher_id", "journal_id", ()),
    ("BELONGS_TO_JOURNAL", "Volume", "volume_id", "journal_id", ()),
    ("BELONGS_TO_VOLUME", "Issue", "issue_id", "volume_id", ()),
    ("PUBLISHED_IN_ISSUE", "Article", "article_id", "issue_id", ()),
    ("WRITES", "Author_Article", "author_id", "article_id", ()),
    ("AFFILIATED_WITH", "Institution_Author", "author_id", "institution_id", ("year",)),
    ("HAS_TOPIC", "Sub_Topic", "article_id", "topic_id", ()),
    ("HAS_KEYWORD", "Keyword_Article", "article_id", "keyword_id", ()),
    ("LOCATED_IN", "Journal", "journal_id", "country", ()),
    ("BELONGS_TO", "Journal_Subject_Category", "journal_id", "subject_category_id", ()),
    ("PART_OF", "Subject_Category", "subject_category_id", "subject_area_id", ()),
)
#: Node label: key column, properties {name: column}.
SCHEMA_NODES = {
    "Publisher": ("publisher_id", {"name": "display_name"}),
    "Journal": ("journal_id", {"name": "display_name", "type": "type", "open_access": "is_open_access", "diamond_oa": "is_oa_diamond", "issn": "issn"}),
    "Volume": ("volume_id", {"volume_number": "volume_number", "publication_year": "publication_year"}),
    "Issue": ("issue_id", {"issue_number": "issue_number", "publication_year": "publication_year"}),
    "Author": ("author_id", {"name": "display_name", "h_index": "h_index", "cited_by_count": "cited_by_count"}),
    "Institution": ("institution_id", {"name": "display_name", "type": "type"}),
    "Article": ("article_id", {"title": "title", "doi": "doi", "publication_year": "publication_year"}),
    "Topic": ("topic_id", {"name": "display_name"}),
    "Keyword": ("keyword_id", {"name": "display_name"}),
}


def _live(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce("is_deleted", F.lit(False))) if "is_deleted" in df.columns else df


def schema_nodes(tables: dict[str, DataFrame], cap: int | None = None) -> dict[str, DataFrame]:
    """Node frame of each label that has a table: id and properties of live rows; absent property columns are left out, DOIs are trimmed and in lower case."""
    out = {}
    for label, (key, properties) in SCHEMA_NODES.items():
        if label in tables:
            df = _live(tables[label])
            value = lambda name, c: (F.nullif(F.lower(F.trim(c)), F.lit("")) if c == "doi" else F.col(c)).alias(name)
            named = {n: c for n, c in properties.items() if c in df.columns}
            out[label] = nodes(df.select(key, *(value(n, c) for n, c in named.items())), key, list(named), cap)
    return out


def schema_edges(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All edges of SCHEMA_EDGES between live nodes, by type, and PUBLISHED_IN from articles through issue and volume to journals.

    Ends are checked where their table is given.
    """
    owner = {"publisher_id": "Publisher", "journal_id": "Journal", "volume_id": "Volume", "issue_id": "Issue", "article_id": "Article", "author_id": "Author", "institution_id": "Institution", "topic_id": "Topic", "keyword_id": "Keyword"}
    zone = {"country": ("Zone", "zone_id"), "subject_category_id": ("Subject_Category", "subject_category_id"), "subject_area_id": ("Subject_Area", "subject_area_id")}

    def known(c: str) -> DataFrame | None:
        name, column = zone.get(c) or (owner[c], c)
        return _live(tables[name]).select(column) if name in tables else None

    out = {kind: edges(_live(tables[t]), a, b, kind, known(a), known(b), props) for kind, t, a, b, props in SCHEMA_EDGES if t in tables and {a, b} <= set(tables[t].columns)}
    if all(t in tables for t in ("Article", "Issue", "Volume", "Journal")):
        shortcut = resolve.hierarchy(tables["Article"], tables["Issue"], tables["Volume"], tables["Journal"])
        out["PUBLISHED_IN"] = edges(shortcut, "article_id", "journal_id", "PUBLISHED_IN")
    return out


def citation_edges(references: DataFrame, articles: DataFrame) -> DataFrame:
    """src, dst, placeholder from references (src, ref) to all articles with that DOI; an unknown one stays as a placeholder node."""
    refs = references.select("src", F.lower(F.trim("ref")).alias("ref")).where("ref <> ''").distinct()
    known = articles.select(F.col("article_id").alias("dst"), F.lower(F.trim("doi")).alias("ref")).where("ref <> ''")
    return refs.join(known, "ref", "left").select("src", "ref", "dst", F.col("dst").isNull().alias("placeholder"))


def placeholder_nodes(citations: DataFrame) -> DataFrame:
    return citations.where("placeholder").select(F.col("ref").alias("id")).distinct()


#: Links that one task of cooccurrence or link_changes packs; a few hundred bytes each, with its pairs.
LINKS_A_TASK = 250_000


def _tasks(spark: SparkSession, links: int) -> int:
    """Tasks of bounded memory: as many as the links ask for, where Spark would take what its shuffle partitions hold."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(links / LINKS_A_TASK))


def cooccurrence(links: DataFrame, group: str, member: str, count: str = "n", block: int = 256) -> DataFrame:
    """a, b, n: in how many groups two members (a < b) are together.

    Pairs are made inside each row of a bounded block pair, so that a group of any size is never one
    task's work: a group's members are numbered into blocks of `block`, and block pairs meet by join.
    """
    tasks = _tasks(links.sparkSession, links.count())
    known = links.where(F.col(group).isNotNull() & F.col(member).isNotNull()).select(F.col(group).alias("g"), F.col(member).alias("m"))
    distinct = known.repartition(tasks, "g").distinct()
    dealt = distinct.withColumn("blocks", F.ceil(F.count("*").over(Window.partitionBy("g")) / block).cast("int"))
    pack = lambda rows: rows.withColumn("own", F.pmod(F.xxhash64("m"), F.col("blocks")).cast("int")).groupBy("g", "blocks", "own").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    one, packed = F.col("blocks") == 1, pack(dealt.where("blocks > 1"))
    left = packed.select("g", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), F.col("ms").alias("xs"))
    right = packed.select("g", F.col("own").alias("j"), F.col("ms").alias("ys"))
    # most groups are one block: their pairs need no join
    alone = pack(dealt.where(one)).select("g", F.col("ms").alias("xs"), F.col("ms").alias("ys"), F.lit(True).alias("same"))
    many = left.join(right, ["g", "j"]).select("g", "xs", "ys", (F.col("i") == F.col("j")).alias("same"))
    pairs = alone.unionByName(many).select("same", F.explode("xs").alias("x"), "ys").select("same", "x", F.explode("ys").alias("y")).where((F.col("x") < F.col("y")) | (~F.col("same") & (F.col("x") > F.col("y"))))
    return pairs.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias(count))


def link_changes(links: DataFrame | None, added: DataFrame, removed: DataFrame, group: str, member: str, block: int = 256, change: str | None = None) -> DataFrame:
    """g, blocks, own, ms: what a batch does to the links of the groups that it names, packed into blocks of about `block` members.

    `ms` holds (m, k): k is 0 for a link that stays, 1 for a new one and -1 for one that is gone; a link that is removed and added again
    stays. With the column `change`, `links` are the changes that made them, which add up to 1 where a link is; None are no links. Links
    of groups that the batch does not name are read once and go no further. Who reads the changes more than once stores them.
    """
    tasks = _tasks(added.sparkSession, (links.count() if links is not None else 0) + added.count())
    known = F.col(group).isNotNull() & F.col(member).isNotNull()
    marked = lambda df, was, bit: df.where(known).select(F.col(group).alias("g"), F.col(member).alias("m"), was.cast("long").alias("was"), F.lit(bit).alias("bit"))
    seen = marked(added, F.lit(0), 1).unionByName(marked(removed, F.lit(0), 2))
    if links is not None:
        named = seen.select("g").repartition(tasks, "g").distinct()
        seen = seen.unionByName(marked(links, F.col(change) if change else F.lit(1), 0).join(named, "g", "left_semi"))
    links_of = seen.repartition(tasks, "g").groupBy("g", "m").agg(F.sum("was").alias("was"), F.bit_or("bit").alias("bit"))
    was, now = F.expr("was > 0"), F.expr("bit & 1 = 1 or was > 0 and bit = 0")
    dealt = links_of.where(was | now).withColumn("blocks", F.ceil(F.count("*").over(Window.partitionBy("g")) / block).cast("int"))
    k = F.when(was & now, 0).when(now, 1).otherwise(-1).cast("long").alias("k")
    return dealt.withColumn("own", F.pmod(F.xxhash64("m"), F.col("blocks")).cast("int")).groupBy("g", "blocks", "own").agg(F.collect_list(F.struct("m", k)).alias("ms"))


def changed_links(changes: list[DataFrame], group: str, member: str) -> DataFrame:
    """group, member, k: the new (1) and gone (-1) links of batches; over all batches of a network they add up to its links."""
    every = reduce(DataFrame.unionByName, changes).select("g", F.explode("ms").alias("x")).where("x.k <> 0")
    return every.select(F.col("g").alias(group), F.col("x.m").alias(member), F.col("x.k").alias("k"))


def _changed_pairs(changes: DataFrame) -> DataFrame:
    """a, b, k: 1 for each group that brings two members (a < b) together since the batch, -1 for each that no longer does.

    Each pair has a new or a gone member; those of a block of a larger group meet all its blocks.
    """
    some = changes.where("exists(ms, x -> x.k <> 0)").withColumn("xs", F.filter("ms", lambda x: x["k"] != 0))
    # most groups are one block: their pairs need no join
    alone = some.where("blocks = 1").select("xs", "ms")
    left = some.where("blocks > 1").select("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"), "xs")
    many = left.join(changes.where("blocks > 1").select("g", "own", "ms"), ["g", "own"]).select("xs", "ms")
    pairs = alone.unionByName(many).select(F.explode("xs").alias("x"), "ms").select("x", F.explode("ms").alias("y"))
    pairs = pairs.where("y.k = 0 or (y.k = x.k and x.m < y.m)")
    return pairs.select(F.least("x.m", "y.m").alias("a"), F.greatest("x.m", "y.m").alias("b"), "x.k")


def merge_changes(changes: list[DataFrame], counts: DataFrame | None = None, count: str = "n") -> DataFrame:
    """The network (a, b, n) after batches that changed the network `counts`, or nothing; only pairs with an added or a removed member are made."""
    before = [] if counts is None else [counts.select("a", "b", F.col(count).alias("k"))]
    every = reduce(DataFrame.unionByName, before + [_changed_pairs(c) for c in changes])
    return every.groupBy("a", "b").agg(F.sum("k").alias(count)).where(F.col(count) > 0)


def update_cooccurrence(counts: DataFrame, links: DataFrame, added: DataFrame, removed: DataFrame, group: str, member: str, count: str = "n", block: int = 256) -> DataFrame:
    """The network `counts` (a, b, n) of `links` after links were added and others removed; equal to cooccurrence of the new links."""
    return merge_changes([link_changes(links, added, removed, group, member, block)], counts, count)


#: Bounds on similarities leave this share for rounding.
SLACK = 1 - 1e-9

#: Up to so many pairs of journals are counted by members, with a row for each pair and task; more are scored pair by pair.
FEW_PAIRS = 10_000


def counted_members(links: DataFrame) -> DataFrame:
    """g, m, f: distinct (journal_id, last column), with the number of journals that have the member, stored once."""
    d = links.where(F.col("journal_id").isNotNull()).select(F.col("journal_id").alias("g"), F.col(links.columns[-1]).alias("m")).distinct()
    return stored(d.join(d.where("m is not null").groupBy("m").agg(F.count("*").alias("f")), "m", "left"))


def similarity_candidates(members: DataFrame, min_score: float, block: int = 1024) -> DataFrame:
    """a, b: pairs of sets (a < b) that may reach the Jaccard similarity `min_score`; none that does is missing. `members` is (g, m, f).

    Two such sets share a member among each one's rarest n - ceil(min_score * n) + 1 (whole classes of equal f are taken, so that
    counts by f replace a sort of each set), and sizes that differ by more than min_score never meet. A member's sets are
    dealt to parts of about `block`. What both prefixes share and what the shorter one leaves out bound the common members.
    """
    t, whole = max(min_score, 0.0) * SLACK, Window.partitionBy("g")
    by_f = members.groupBy("g", "f").agg(F.count("*").alias("c"))
    by_f = by_f.select("g", "f", F.sum("c").over(whole.orderBy("f")).alias("upto"), F.sum("c").over(whole).alias("n"))
    enough = F.col("upto") > F.col("n") - F.greatest(F.ceil(F.col("n") * t), F.lit(1))
    cuts = by_f.where(enough & F.col("f").isNotNull()).groupBy("g").agg(F.min(F.struct("f", "upto", "n")).alias("x")).select("g", F.col("x.f").alias("cut"), (F.col("x.n") - F.col("x.upto")).alias("rest"), F.col("x.n").alias("n"))
    size = F.floor(F.ln("n") / math.log((1 + 1e-6) / min_score)) if 0 < min_score <= 1 else F.lit(0).cast("long")
    rare = members.where("f > 1").join(cuts, "g").where("f <= cut").select("g", "m", "cut", "rest", "n", size.alias("size"))
    parts = rare.groupBy("m", "size").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    near = F.array(*(F.col("size") + i for i in (-1, 0, 1))) if 0 < min_score <= 1 else F.array("size")
    info = F.struct("g", "n", "cut", "rest")
    left = rare.select("m", info.alias("x"), F.explode(near).alias("size")).join(parts, ["m", "size"]).select("m", "size", "x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = rare.join(parts, ["m", "size"]).select("m", "size", info.alias("y"), F.pmod(F.xxhash64("g"), F.col("parts")).cast("int").alias("part"))
    fits = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * t
    met = left.join(right, ["m", "size", "part"]).where((F.col("x.g") < F.col("y.g")) & fits)
    pairs = met.groupBy(F.col("x.g").alias("a"), F.col("y.g").alias("b")).agg(F.count("*").alias("k"), F.min("x").alias("x"), F.min("y").alias("y"))
    left_out = F.when(F.col("x.cut") < F.col("y.cut"), F.col("x.rest")).when(F.col("x.cut") > F.col("y.cut"), F.col("y.rest")).otherwise(F.least("x.rest", "y.rest"))
    return pairs.where(F.col("k") + left_out >= (F.col("x.n") + F.col("y.n")) * (t / (1 + t))).select("a", "b")


def _similarities(members: DataFrame, pairs: DataFrame, block: int = 4096) -> DataFrame:
    """a, b, s: Jaccard similarities of the pairs that share a member. A set's members are dealt to parts of about `block`."""
    sizes = members.groupBy("g").agg(F.count("*").alias("n"))
    of = lambda end, n: sizes.select(F.col("g").alias(end), F.col("n").alias(n))
    parts = F.ceil(F.col("na") / block).cast("int")
    sized = pairs.join(of("a", "na"), "a").join(of("b", "nb"), "b")
    asked = sized.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    mine = members.where("f > 1").join(of("a", "own"), F.col("g") == F.col("a")).select("a", "m", F.pmod(F.xxhash64("m"), F.ceil(F.col("own") / block).cast("int")).cast("int").alias("part"))
    both = asked.join(mine, ["a", "part"]).join(members.select(F.col("g").alias("b"), "m"), ["b", "m"])
    return both.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("k")).select("a", "b", (F.col("k") / (F.col("na") + F.col("nb") - F.col("k"))).alias("s"))


def _sized_pairs(members: DataFrame, min_score: float) -> DataFrame | None:
    """a, b: all pairs of sets (a < b) whose sizes allow the similarity; None where they may be more than FEW_PAIRS."""
    sizes = stored(members.groupBy("g").agg(F.count("*").alias("n")))
    sets = sizes.count()
    if sets * (sets - 1) // 2 > FEW_PAIRS:
        return None
    x, y = (sizes.select(F.col("g").alias(end), F.col("n").alias(n)) for end, n in (("a", "na"), ("b", "nb")))
    fits = F.least("na", "nb") >= F.greatest("na", "nb") * (max(min_score, 0.0) * SLACK)
    return x.join(y, (F.col("a") < F.col("b")) & fits).select("a", "b")


def _few_similarities(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """As _similarities, for at most FEW_PAIRS pairs: a member's sets, which are then few, meet at the member, and tasks add up their pairs before any is shuffled."""
    sizes = members.groupBy("g").agg(F.count("*").alias("n"))
    asked = pairs.select(F.explode(F.array("a", "b")).alias("g")).distinct()
    mine = members.where("f > 1").join(F.broadcast(asked), "g", "left_semi")
    met = mine.select("m", F.col("g").alias("a")).join(mine.select("m", F.col("g").alias("b")), "m").where("a < b")
    both = met.join(F.broadcast(pairs), ["a", "b"], "left_semi").groupBy("a", "b").agg(F.count("*").alias("k"))
    for end, n in (("a", "na"), ("b", "nb")):
        both = both.join(sizes.select(F.col("g").alias(end), F.col("n").alias(n)), end)
    return both.select("a", "b", (F.col("k") / (F.col("na") + F.col("nb") - F.col("k"))).alias("s"))


def similar_journals(links: dict[str, DataFrame], min_score: float = 0.1) -> DataFrame:
    """a, b, similarity_score: mean Jaccard similarity of journals over link sets (journal_id, member). The formula is ours.

    A mean of at least min_score needs a link set with that similarity, so only candidates of some set are scored. Links without
    a journal are ignored; a link without a member is in its journal's size and in common with nothing.
    """
    members = [counted_members(df) for df in links.values()]

    def candidates(m: DataFrame) -> DataFrame:
        every = _sized_pairs(m, min_score)
        return similarity_candidates(m, min_score) if every is None else every

    pairs = stored(reduce(DataFrame.unionByName, map(candidates, members)).distinct())
    scored = _few_similarities if pairs.limit(FEW_PAIRS + 1).count() <= FEW_PAIRS else _similarities
    total = reduce(DataFrame.unionByName, (scored(m, pairs) for m in members)).groupBy("a", "b").agg((F.sum("s") / len(members)).alias("similarity_score"))
    return total.where(F.col("similarity_score") >= min_score)


def trends(df: DataFrame, entity: str, year: str) -> DataFrame:
    """entity, year, n and the change against the entity's year before in the data. Ours."""
    n = df.where(F.col(entity).isNotNull() & F.col(year).isNotNull()).groupBy(F.col(entity).alias("entity"), F.col(year).alias("year")).agg(F.count("*").alias("n"))
    return n.withColumn("change", F.col("n") - F.lag("n").over(Window.partitionBy("entity").orderBy("year")))


def metric_trends(rankings: DataFrame, entity: str, year: str, score: str, quartile: str) -> DataFrame:
    """entity, year, score, quartile, score_change, quartile_change, gap: yearly means of a score, the best quartile (1 to 4), and their changes.

    Changes are against the entity's last year in the data; `gap` is how many years lie between them. Ours.
    """
    q = F.substring(quartile, 2, 1).try_cast("int")
    yearly = rankings.where(F.col(entity).isNotNull() & F.col(year).isNotNull()).groupBy(F.col(entity).alias("entity"), F.col(year).alias("year")).agg(F.avg(score).alias("score"), F.min(F.when(q.between(1, 4), q)).alias("quartile"))
    before = Window.partitionBy("entity").orderBy("year")
    return yearly.select("*", (F.col("score") - F.lag("score").over(before)).alias("score_change"), (F.col("quartile") - F.lag("quartile").over(before)).alias("quartile_change"), (F.col("year") - F.lag("year").over(before) - 1).alias("gap"))


def graph_references(articles: DataFrame) -> DataFrame:
    """(src, ref) rows of articles' cleaned references."""
    return articles.select(F.col("article_id").alias("src"), F.explode(S.clean_references("references")).alias("ref"))
