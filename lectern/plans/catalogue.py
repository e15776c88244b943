"""A catalogue over the tables at hand, and the plan from records to the published table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import attach, language, linkage, publish

#: The same view in SQL, for comparisons.
CATALOG_SQL = """
cat AS (
  SELECT d.doc_id AS id, split_part(d.text, '.', 1) AS title,
    CASE d.doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN d.source ELSE concat('van ', d.source, ', ', upper(d.lang)) END AS author,
    CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE CAST(1850 + (d.doc_id * 7) % 106 AS INTEGER) END AS year_num,
    CASE WHEN d.doc_id % 17 = 0 THEN 'n.d.' ELSE CAST(1850 + (d.doc_id * 7) % 106 AS VARCHAR) END AS year,
    CASE d.doc_id % 6 WHEN 0 THEN '2nd ed.' WHEN 1 THEN '3' ELSE '' END AS edition,
    CASE WHEN d.doc_id % 9 = 0 THEN '2 v.' ELSE '' END AS volume,
    CASE d.doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST([] AS VARCHAR[])
      ELSE [concat('https://gallica.bnf.fr/ark:/', CAST(d.doc_id AS VARCHAR)), concat('https://archive.org/details/item', CAST(d.doc_id AS VARCHAR))] END AS links,
    concat('Imprint: Paris, ', d.source, ' & Co. | Extent: ', CAST(d.n_chars AS VARCHAR), ' p. | Annotation: of note | Note: ', d.lang) AS other,
    d.source AS source,
    CASE d.doc_id % 8 WHEN 0 THEN 'article' WHEN 1 THEN 'chapter' WHEN 2 THEN 'periodical' ELSE 'book' END AS type,
    CASE d.lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish' ELSE '' END AS language,
    CASE WHEN d.doc_id % 3 <> 2 THEN '' WHEN l.quality = 1 THEN 'open' WHEN l.quality = 0 THEN 'borrow' ELSE 'restricted' END AS access
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id)
"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """books-like rows from documents and labels."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    quality = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    i = F.col("doc_id")
    text = lambda *parts: F.concat(*parts)
    year = F.when(i % 17 != 0, (F.lit(1850) + (i * 7) % 106).cast("int"))
    links = F.when(i % 3 == 1, F.array().cast("array<string>")).when(i % 3 == 2, F.array(text(F.lit("https://gallica.bnf.fr/ark:/"), i.cast("string")), text(F.lit("https://archive.org/details/item"), i.cast("string"))))
    languages = F.create_map(*(F.lit(x) for pair in (("en", "English"), ("de", "German"), ("fr", "French"), ("es", "Spanish")) for x in pair))
    return d.join(quality, "doc_id", "left").select(
        i.alias("id"),
        F.substring_index("text", ".", 1).alias("title"),
        F.when(i % 5 == 0, "").when(i % 5 == 1, F.col("source")).otherwise(text(F.lit("van "), F.col("source"), F.lit(", "), F.upper("lang"))).alias("author"),
        year.alias("year_num"),
        F.coalesce(year.cast("string"), F.lit("n.d.")).alias("year"),
        F.when(i % 6 == 0, "2nd ed.").when(i % 6 == 1, "3").otherwise("").alias("edition"),
        F.when(i % 9 == 0, "2 v.").otherwise("").alias("volume"),
        links.alias("links"),
        text(F.lit("Imprint: Paris, "), F.col("source"), F.lit(" & Co. | Extent: "), F.col("n_chars").cast("string"), F.lit(" p. | Annotation: of note | Note: "), F.col("lang")).alias("other"),
        "source",
        F.when(i % 8 == 0, "article").when(i % 8 == 1, "chapter").when(i % 8 == 2, "periodical").otherwise("book").alias("type"),
        F.coalesce(languages[F.col("lang")], F.lit("")).alias("language"),
        F.when(i % 3 != 2, "").when(F.col("quality") == 1, "open").when(F.col("quality") == 0, "borrow").otherwise("restricted").alias("access"),
    )


def _gains(matched: DataFrame) -> DataFrame:
    """(ord, _gains): what each row is brought by matched(ord, match, _s, _l, _p), each source, link and note once, by the first record that has
    it. Repeats go before rows meet, so a work with very many records costs what it gains."""
    one = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.alias("v"))
    links = F.transform(F.coalesce("_l", F.array().cast("array<string>")), lambda v: one("link", v))
    every = F.concat(F.array(one("source", F.col("_s")), one("note", F.col("_p"))), links)
    said = matched.select("match", "ord", F.posexplode(every).alias("_at", "_g")).filter("_g.v <> ''")
    first = said.groupBy("match", "_g").agg(F.min(F.struct("ord", "_at")).alias("_first"))
    return first.groupBy(F.col("match").alias("ord")).agg(F.array_sort(F.collect_list(F.struct("_first", "_g"))).alias("_gains"))


def _with_gains(rows: DataFrame) -> DataFrame:
    """rows with their _gains, in order: their sources, links that are not there yet, and where else they are described."""
    none = F.array().cast("array<string>")
    of = lambda kind: F.transform(F.filter("_gains", lambda x: x["_g"]["kind"] == kind), lambda x: x["_g"]["v"])
    links, more = of("link"), F.array_join(F.array_sort(of("source")), "; ")
    notes = F.filter(of("note"), lambda p: ~F.coalesce("other", F.lit("")).contains(p))
    named = more.isNull() | F.col("source").contains(more)
    return rows.withColumns(
        {
            "source": F.when(named, F.col("source")).otherwise(F.concat_ws("; ", "source", more)),
            "links": F.when(F.size(links) > 0, F.array_distinct(F.concat(F.coalesce("links", none), links))).otherwise(F.col("links")),
            "other": F.when(F.size(notes) > 0, F.concat_ws(" | ", F.nullif("other", F.lit("")), F.array_join(notes, " | "))).otherwise(F.col("other")),
        }
    )


def build(existing: DataFrame, sources: list[tuple[str, DataFrame]], copies: DataFrame | None = None, excluded: DataFrame | None = None, fixes: DataFrame | None = None, languages: DataFrame | None = None) -> DataFrame:
    """The published table from linked sources, in their order: each source's records are linked to what is there, what is new
    is appended, copies are attached by key, ids are given, and then rows that are not to be published go.

    existing and each source: (author, title, year, year_num, edition, volume, links, other, source, type, ord), ord within each; a
    source may have place_in, a note for the rows that it is linked to, which also gain its links;
    copies: (rowkey, url); excluded: (rowkey); fixes: (rowkey, title); languages: (rowkey, language), as checked by hand.
    The language is that checked by hand, else guessed from the title as the source has it; titles are corrected after that.
    """
    columns = ["author", "title", "year", "year_num", "edition", "volume", "links", "other", "source", "type"]
    rows = existing.select(F.lit(0).alias("seq"), "ord", *columns)
    for seq, (name, records) in enumerate(sources, 1):
        numbered = publish.with_ids(rows, "seq", "ord").withColumn("ord", F.col("id"))
        base = numbered.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        new = records.withColumn("ord", F.col("ord") + F.lit(base + 1))
        shaped = lambda df: df.select("ord", "author", "title", F.col("year_num").alias("year"), linkage.kind_of(F.col("type")).alias("kind"))
        found = linkage.merge(shaped(numbered), shaped(new), linkage.CASCADES.get(name, linkage.Cascade()))
        told = new.select("ord", F.col("source").alias("_s"), F.col("links").alias("_l"), (F.col("place_in") if "place_in" in new.columns else F.lit(None).cast("string")).alias("_p"))
        also = _gains(found.filter("match IS NOT NULL").select("ord", "match").join(told, "ord"))
        added = new.join(found.filter("match IS NULL").select("ord"), "ord", "left_semi")
        both = numbered.select("seq", "ord", *columns).unionByName(added.select(F.lit(seq).alias("seq"), "ord", *columns))
        rows = _with_gains(both.join(also, "ord", "left")).select("seq", "ord", *columns)
    keyed = rows.withColumn("rowkey", X.row_key(F.col("author"), F.col("title"), F.col("year")))
    if copies is not None:
        keyed = attach.attach_by_key(keyed, copies)
    plain = keyed.withColumn("other", publish.strip_annotations(F.col("other")))
    named = plain.withColumn("language", language.guess(F.col("title"), F.col("other"))["language"])
    if languages is not None:
        checked = languages.filter("language <> ''").groupBy("rowkey").agg(F.max("language").alias("_checked"))
        named = named.join(checked, "rowkey", "left").withColumn("language", F.coalesce("_checked", "language")).drop("_checked")
    if fixes is not None:
        named = publish.overridden(named, fixes, "rowkey", ["title"])
    shown = named.withColumn("title", publish.display_title(F.col("title"), F.col("language")))
    return publish.published(publish.with_ids(shown, "seq", "ord"), excluded)
