"""Registered queries of the way from a source to the table: mapping, work lists, look-ups, verdicts, page checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import mapping, publish, validate, worklists
from lectern.plans.catalogue import catalog
from lectern.plans.queries import MAIN, NORM, query, table
from lectern.sources import xml
from lectern.plans.workspace import folder_of, materialize, new_path
from lectern.streaming.linking import keyed_links, keyed_state, online_links

# --- from source records to common ones -----------------------------------------------------------------------------------

_FLAGS = """r AS (SELECT *, CASE id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'uncertain' END AS japan,
  CASE type WHEN 'book' THEN 'book' WHEN 'periodical' THEN 'periodical' ELSE 'map' END AS kind FROM cat),
d AS (SELECT doc_id, max(quality) = 1 AS decision FROM labels GROUP BY doc_id),
w AS (SELECT r.*, CASE japan WHEN 'uncertain' THEN coalesce(decision, false) ELSE japan = 'true' END AS wanted FROM r LEFT JOIN d ON doc_id = id)"""


def _flagged(spark, sf_dir):
    """Records with a flag, and decisions of two rounds: the first said no to everything, the second is the labels'."""
    i = F.col("id")
    japan = F.when(i % 3 == 0, "true").when(i % 3 == 1, "false").otherwise("uncertain")
    records = catalog(spark, sf_dir).withColumns({"japan": japan, "kind": F.when(F.col("type").isin("book", "periodical"), F.col("type")).otherwise("map")})
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg((F.max("quality") == 1).alias("decision"))
    rounds = labels.select("id", F.lit(False).alias("decision"), F.lit(0).alias("round")).unionByName(labels.withColumn("round", F.lit(1)))
    return mapping.with_decisions(records, rounds, "id", "japan", "round")


@query(f"+ {_FLAGS} SELECT id, wanted FROM w", cat=True)
def wanted_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select("id", "wanted")


@query(
    f"""+ {_FLAGS} SELECT concat(source, ', ', language) AS author, trim(title) AS title, year, year_num, volume AS volumes,
  concat_ws('; ', nullif(edition, ''), CASE WHEN kind <> 'book' THEN concat('A ', kind, ' in the catalogue') END) AS note,
  concat('Asiatic Society of Japan catalogue, PDF p. ', CAST(id % 30 + 5 AS VARCHAR), ', entry ', CAST(id AS VARCHAR)) AS place_in
FROM w WHERE wanted AND kind <> 'periodical' AND year_num BETWEEN 1850 AND 1955""",
    cat=True,
)
def mapped_asj(spark, sf_dir):
    i = F.col("id")
    printed = F.concat(F.lit(" "), F.col("source"), F.lit(" ("), F.col("language"), F.lit(")"))
    records = _flagged(spark, sf_dir).withColumns({"author": printed, "volumes": F.col("volume"), "note": F.col("edition"), "pdf_page": i % 30 + 5, "entry_no": i})
    out = mapping.common(records, mapping.RULES["asj"])
    return out.select("author", "title", "year", "year_num", "volumes", "note", "place_in")


_ENTRIES = """r AS (SELECT * REPLACE (CASE WHEN id % 11 = 0 THEN concat('Япония ', title) ELSE title END AS title,
    CASE WHEN id % 9 = 0 THEN 'Russian' ELSE language END AS language),
  CASE WHEN id % 10 = 3 THEN 'Text In Russian' ELSE '' END AS note, CASE WHEN id % 13 = 0 THEN 'article' END AS skip,
  CASE id % 7 WHEN 0 THEN 'XXI. Other lands' WHEN 1 THEN 'XIII. Medicine / e. Theses' WHEN 2 THEN 'XIII. Medicine / d. Baths' ELSE '' END AS section,
  id % 558 + 21 AS pdf_page FROM cat),
k AS (SELECT * FROM r WHERE skip IS NULL AND id % 11 <> 0 AND id % 10 <> 3)"""


def _entries(spark, sf_dir):
    i = F.col("id")
    section = F.when(i % 7 == 0, "XXI. Other lands").when(i % 7 == 1, "XIII. Medicine / e. Theses").when(i % 7 == 2, "XIII. Medicine / d. Baths")
    made = {
        "title": F.when(i % 11 == 0, F.concat(F.lit("Япония "), "title")).otherwise(F.col("title")),
        "language": F.when(i % 9 == 0, "Russian").otherwise(F.col("language")),
        "note": F.when(i % 10 == 3, "Text In Russian"),
        "skip": F.when(i % 13 == 0, "article"),
        "section": section,
        "pdf_page": i % 558 + 21,
        "entry_no": i,
    }
    return catalog(spark, sf_dir).withColumns(made)


@query(
    f"""+ {_ENTRIES} SELECT author, trim(title) AS title, year, year_num, edition, language, section,
  concat('Nachod (1928) no. ', CAST(id AS VARCHAR), ', p. ', CAST(pdf_page + 149 AS VARCHAR)) AS place_in FROM k WHERE year_num IS NOT NULL""",
    cat=True,
)
def mapped_nachod(spark, sf_dir):
    out = mapping.common(_entries(spark, sf_dir), mapping.RULES["nachod"])
    return out.select("author", "title", "year", "year_num", "edition", "language", "section", "place_in")


_KEY = f"concat_ws('|', {NORM.format('author')}, {NORM.format('title')}, {NORM.format('year')})"


@query(
    f"""+ {_ENTRIES}, x AS (SELECT {_KEY} AS gone FROM r WHERE id % 5 = 2)
SELECT author, trim(title) AS title, year, year_num, edition, language, section, concat('Wenckstern (1907)', CASE WHEN pdf_page >= 537 THEN ', Swedish list' WHEN pdf_page >= 509 THEN ', Pagès supplement' ELSE '' END,
  ' p. ', CAST(pdf_page - CASE WHEN pdf_page >= 537 THEN 536 WHEN pdf_page >= 509 THEN 508 ELSE 20 END AS VARCHAR)) AS place_in
FROM k WHERE language <> 'Russian' AND id % 7 NOT IN (0, 1) AND {_KEY} NOT IN (SELECT gone FROM x)""",
    cat=True,
)
def mapped_wenckstern(spark, sf_dir):
    records = _entries(spark, sf_dir)
    ruled_out = records.filter("id % 5 = 2").select(X.row_key(F.col("author"), F.col("title"), F.col("year")).alias("rowkey"))
    out = mapping.common(records, mapping.RULES["wenckstern"], ruled_out)
    return out.select("author", "title", "year", "year_num", "edition", "language", "section", "place_in")


# --- work lists and look-ups ----------------------------------------------------------------------------------------------


@query("SELECT id, type IN ('book', 'periodical') AND (year_num IS NOT NULL OR regexp_matches(edition, '[0-9]{4}')) AS eligible FROM cat", cat=True)
def lookup_eligible(spark, sf_dir):
    return catalog(spark, sf_dir).select("id", worklists.wants_lookup(F.col("type"), F.col("year_num"), F.col("edition")).alias("eligible"))


@query(
    """+ t AS (SELECT id, title, year_num FROM cat WHERE language = 'English' AND type IN ('book', 'periodical') AND coalesce(len(links), 0) = 0
  AND id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)) SELECT id, title, year_num FROM t ORDER BY year_num IS NULL, id LIMIT 200""",
    cat=True,
)
def lookup_targets(spark, sf_dir):
    """One run takes on 200 works."""
    done = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("id"))
    return worklists.targets(catalog(spark, sf_dir), "English", done, "id", 200).select("id", "title", "year_num")


def _match(name: str, number: Column, year: Column, creator: Column, score: Column) -> Column:
    identifier = F.concat(F.lit(name), number.cast("string"))
    return F.struct(identifier.alias("identifier"), year.cast("int").alias("year"), creator.alias("creator"), score.cast("double").alias("score"))


_LKEY = f"concat_ws('|', {NORM.format('author')}, {NORM.format('title')})"


@query(
    f"""+ c AS (SELECT lkey, min(id) AS n FROM (SELECT *, {_LKEY} AS lkey FROM cat WHERE id % 4 <> 0) GROUP BY lkey),
m AS (SELECT lkey, concat('a', CAST(n AS VARCHAR)) AS identifier, CAST(1850 + (n * 7) % 106 AS INTEGER) AS year, 'x' AS creator, 0.9::DOUBLE AS score, 0 AS pos FROM c
  UNION ALL SELECT lkey, concat('b', CAST(n AS VARCHAR)), NULL, '', CASE WHEN n % 2 = 0 THEN 0.98::DOUBLE ELSE 0.9::DOUBLE END, 1 FROM c
  UNION ALL SELECT lkey, concat('c', CAST(n AS VARCHAR)), CAST(1850 + (n * 7) % 106 + n % 6 AS INTEGER), CASE WHEN n % 3 = 0 THEN '' ELSE 'y' END, 0.95::DOUBLE, 2 FROM c),
b AS (SELECT *, {_LKEY} AS lkey, contains(author, ',') AS personal, len(list_filter(string_split({NORM.format('title')}, ' '), lambda w: w <> '')) >= 6 AS telling FROM cat),
j AS (SELECT b.id, b.lkey, identifier, m.score, m.year, pos, coalesce(m.year = year_num, false) AS exact,
  CASE WHEN m.year IS NULL THEN personal OR telling AND m.score >= 0.97 ELSE coalesce(abs(m.year - year_num) <= 3, false) END AS same,
  m.year IS NOT NULL AND NOT coalesce(abs(m.year - year_num) <= 3, false) AND personal AND creator <> '' AS other FROM b JOIN m USING (lkey)),
g AS (SELECT id, coalesce(string_agg(identifier, ' ' ORDER BY NOT exact, year IS NULL, -score, pos) FILTER (same), '') AS links,
  coalesce(string_agg(identifier, ' ' ORDER BY -score, year, pos) FILTER (other), '') AS others FROM j GROUP BY id)
SELECT cat.id, g.links, g.others FROM cat LEFT JOIN g ON g.id = cat.id""",
    cat=True,
)
def cached_matches(spark, sf_dir):
    rows = catalog(spark, sf_dir).withColumns({"lkey": X.link_key(F.col("author"), F.col("title")), "years": F.array_compact(F.array("year_num"))})
    n = F.col("n")
    year = 1850 + (n * 7) % 106
    undated = _match("b", n, F.lit(None), F.lit(""), F.when(n % 2 == 0, 0.98).otherwise(0.9))
    later = _match("c", n, year + n % 6, F.when(n % 3 == 0, "").otherwise("y"), F.lit(0.95))
    cache = rows.filter("id % 4 <> 0").groupBy("lkey").agg(F.min("id").alias("n")).select("lkey", F.array(_match("a", n, year, F.lit("x"), F.lit(0.9)), undated, later).alias("matches"))
    got = worklists.split_matches(rows.drop("links"), cache)
    return got.select("id", *(F.array_join(c, " ").alias(c) for c in ("links", "others")))


@query(
    """WITH o AS (SELECT l_orderkey, list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR))[1:8] AS words, list(CAST(l_partkey AS VARCHAR)) FILTER (l_quantity > 20) AS pool FROM lineitem GROUP BY l_orderkey),
c AS (SELECT l_orderkey, len(list_filter(words, lambda w: coalesce(list_contains(pool, w), false))) / len(words) AS cov FROM o)
SELECT l_orderkey, round(cov, 9) AS cov FROM c WHERE cov >= 0.6"""
)
def loose_candidates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey").cast("string")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", part.alias("p")))), lambda x: x["p"])
    made = lines.groupBy("l_orderkey").agg(listed.alias("words"), F.collect_list(F.when(F.col("l_quantity") > 20, part)).alias("pool"))
    return worklists.covering(made).select("l_orderkey", F.round("cov", 9).alias("cov"))


@query(
    f"""+ s AS (SELECT id, CASE WHEN {NORM.format('title')} = '' OR id % 3 = 0 THEN 0 ELSE 1 + CASE WHEN NOT contains(author, ',') OR id % 4 = 0 THEN 0 WHEN id % 2 = 1 THEN 0.1 ELSE -0.25 END END::DOUBLE AS score FROM cat)
SELECT id, round(score, 9) AS score FROM s WHERE score >= 0.82""",
    cat=True,
)
def strict_candidates(spark, sf_dir):
    """A third of the candidates has a title of marks only; of the others' creators a quarter are not told."""
    i = F.col("id")
    key = X.norm(F.col("title"))
    creator = F.when(i % 4 == 0, "").when(i % 2 == 1, F.concat(F.lit("Doe and "), "source")).otherwise("Nobody")
    made = catalog(spark, sf_dir).select(
        "id", key.alias("main"), key.alias("full"), X.surname(F.col("author")).alias("surname"), F.when(i % 3 == 0, "***").otherwise(F.col("title")).alias("c_title"), creator.alias("c_creator")
    )
    return worklists.scored(made).select("id", F.round("score", 9).alias("score"))


@query(
    f"""+ s AS (SELECT id, unnest(string_split({NORM.format('title')}, ' ')) AS w, generate_subscripts(string_split({NORM.format('title')}, ' '), 1) AS pos FROM cat),
v AS (SELECT *, length(w) AS n, CASE pos % 5 WHEN 0 THEN w WHEN 1 THEN concat(w, 'xq') WHEN 2 THEN concat(left(w, length(w) - 1), '0') WHEN 3 THEN concat('1', w) ELSE substr(w, 3) END AS p FROM s WHERE w <> ''),
r AS (SELECT *, CASE pos % 5 WHEN 1 THEN 2 * n / (2 * n + 2) WHEN 2 THEN (n - 1) / n WHEN 3 THEN 2 * n / (2 * n + 1) WHEN 4 THEN 2 * (n - 2) / (2 * n - 2) END AS ratio, regexp_full_match(w, '[0-9]+') OR regexp_full_match(p, '[0-9]*') AS number FROM v)
SELECT id, pos::INTEGER AS pos, 1.0::DOUBLE AS cov FROM r WHERE w = p OR (NOT number AND least(n, length(p)) >= 5 AND (starts_with(p, w) OR starts_with(w, p))) OR (NOT number AND least(n, length(p)) >= 4 AND ratio >= 0.84)""",
    cat=True,
)
def loose_spellings(spark, sf_dir):
    """Each word of a title against one other spelling of it: the same, longer, with another last letter, with a letter before, without its first two."""
    w = F.col("w")
    words = catalog(spark, sf_dir).select("id", F.posexplode(F.split(X.norm(F.col("title")), " ")).alias("i", "w")).filter("w <> ''").withColumn("pos", F.col("i") + 1)
    kind = F.col("pos") % 5
    other = (
        F.when(kind == 0, w).when(kind == 1, F.concat(w, F.lit("xq"))).when(kind == 2, F.concat(F.left(w, F.length(w) - 1), F.lit("0"))).when(kind == 3, F.concat(F.lit("1"), w))
        .otherwise(F.substring(w, F.lit(3), F.length(w)))
    )
    return worklists.covering(words.select("id", "pos", F.array("w").alias("words"), F.array(other).alias("pool"))).select("id", "pos", "cov")


@query(
    f"""WITH p AS (SELECT p_partkey AS id, {NORM.format('p_name')} AS m, p_partkey % 9 AS k, p_size % 4 AS j, p_partkey % 5 AS c FROM part),
l AS (SELECT *, length(m) AS n FROM p),
s AS (SELECT id, greatest(
    CASE WHEN k = 0 THEN 1 ELSE 2 * n / (2 * n + k + 1) END,
    CASE WHEN k = 0 AND j = 0 THEN 1 WHEN k = 0 THEN 2 * n / (2 * n + j + 1) WHEN j = 0 THEN 2 * n / (2 * n + k + 1) ELSE 2 * (n + 1 + least(j, k)) / (2 * n + 2 + j + k) END,
    CASE WHEN k = 0 THEN 1 ELSE 2 * n / (2 * n + least(3, k + 1)) END - 0.05) + CASE WHEN c = 0 THEN 0 WHEN c < 3 THEN 0.1 ELSE -0.25 END AS score FROM l)
SELECT id, round(score::DOUBLE, 9) AS score FROM s WHERE score >= 0.82"""
)
def strict_scores(spark, sf_dir):
    """Offers whose titles go on after the record's by up to eight letters, while the record's own whole title goes on by up to three; creators that
    have the surname, that do not, that are not told."""
    main, last = X.norm(F.col("p_name")), F.substring_index("p_name", " ", -1)
    tail = lambda n: F.concat(F.lit(" "), F.repeat(F.lit("z"), n.cast("int")))
    j, c = F.col("p_size") % 4, F.col("p_partkey") % 5
    # few bytes a row and much work: a file that one task would read is many tasks' work
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    made = rows.select(
        F.col("p_partkey").alias("id"), main.alias("main"), F.when(j == 0, main).otherwise(F.concat(main, tail(j))).alias("full"), X.norm(last).alias("surname"),
        F.concat("p_name", tail(F.col("p_partkey") % 9)).alias("c_title"), F.when(c == 0, "").when(c < 3, F.concat(F.lit("Doe, and "), last)).otherwise("No-one").alias("c_creator"),
    )
    return worklists.scored(made).select("id", F.round("score", 9).alias("score"))


@query("SELECT doc_id AS line, CASE WHEN doc_id IN (3, 5, 100, 119, 120) THEN 'y' ELSE 'n' END AS verdict FROM labels WHERE doc_id < 120")
def batch_verdicts(spark, sf_dir):
    review = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("line"))
    return worklists.batch_verdicts(review, "line", 120, [3, 5, 100, 119, 120])


@query(
    """WITH k AS (SELECT concat('u', CAST(o_orderkey AS VARCHAR)) AS u FROM orders WHERE o_orderstatus = 'P'),
n AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
i AS (SELECT o_orderkey, unnest([concat('u', CAST(o_orderkey + 1 AS VARCHAR)), concat('u', CAST(o_orderkey * 2 AS VARCHAR))]) AS u FROM n)
SELECT o_orderkey FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM i WHERE u IN (SELECT u FROM k))"""
)
def fresh_items(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    address = lambda number: F.concat(F.lit("u"), number.cast("string"))
    known = orders.filter("o_orderstatus = 'P'").select(F.array(address(F.col("o_orderkey"))).alias("urls"))
    items = orders.filter("o_orderstatus <> 'P'").select("o_orderkey", F.array(address(F.col("o_orderkey") + 1), address(F.col("o_orderkey") * 2)).alias("urls"))
    return worklists.fresh(items, known, "o_orderkey").select("o_orderkey")


@query(
    """+ z AS (SELECT *, id % 4 <> 0 AS has, 'Roe, R.' AS z_author, concat('Whole ', title) AS z_title, CASE WHEN id % 3 = 0 THEN NULL ELSE 1900 END AS z_num, CASE WHEN id % 5 = 0 THEN '' ELSE 'new ed.' END AS z_edition,
  CASE WHEN id % 2 = 0 THEN '' ELSE 'Kelly' END AS z_pub, CASE WHEN id % 7 < 3 THEN '' ELSE '320' END AS z_pages, CASE WHEN id % 6 < 2 THEN '' ELSE 'Lives' END AS z_series FROM cat),
n AS (SELECT *, CAST(author <> '' AS INT) + CAST(title <> '' AS INT) + CAST(year_num IS NOT NULL AS INT) + CAST(edition <> '' AS INT) + CAST(volume <> '' AS INT) + 4 AS own,
  2 + 1 + 1 + CAST(z_num IS NOT NULL AS INT) + CAST(z_edition <> '' AS INT) + CAST(z_pub <> '' AS INT) + CAST(z_pages <> '' AS INT) + CAST(z_series <> '' AS INT) AS theirs FROM z),
f AS (SELECT *, has AND theirs > own AS fuller FROM n)
SELECT id, fuller, CASE WHEN fuller THEN z_author ELSE author END AS author, CASE WHEN fuller THEN z_title ELSE title END AS title, CASE WHEN fuller THEN '1900' ELSE year END AS year, CASE WHEN fuller THEN coalesce(z_num, year_num) ELSE year_num END AS year_num,
  CASE WHEN fuller AND z_edition <> '' THEN z_edition ELSE edition END AS edition,
  CASE WHEN fuller THEN concat('Imprint: ', concat_ws(', ', 'London', nullif(z_pub, '')), CASE WHEN z_pages <> '' THEN ' | Extent: 320 p.' ELSE '' END, CASE WHEN z_series <> '' THEN ' | Series: Lives' ELSE '' END, ' | Note: good',
      ' | Description from Zotero; entered elsewhere as: ', concat_ws('. ', nullif(author, ''), nullif(title, ''), nullif(edition, ''), year), ' | ', other)
    WHEN has THEN concat(other, ' | Also in Zotero: ', z_author, '. ', z_title, '. ', concat_ws(', ', 'London', nullif(z_pub, ''), '1900'), CASE WHEN z_pages <> '' THEN ' (320 p.)' ELSE '' END) ELSE other END AS other FROM f""",
    cat=True,
)
def fuller_description(spark, sf_dir):
    i = F.col("id")
    made = {
        "author": F.lit("Roe, R."),
        "title": F.concat(F.lit("Whole "), "title"),
        "year": F.lit("1900"),
        "year_num": F.when(i % 3 != 0, 1900),
        "edition": F.when(i % 5 == 0, "").otherwise("new ed."),
        "volume": F.lit(""),
        "place": F.lit("London"),
        "publisher": F.when(i % 2 == 0, "").otherwise("Kelly"),
        "pages": F.when(i % 7 < 3, "").otherwise("320"),
        "series": F.when(i % 6 < 2, "").otherwise("Lives"),
        "abstract": F.lit("good"),
    }
    rows = catalog(spark, sf_dir).withColumn("z", F.when(i % 4 != 0, F.struct(*(v.alias(k) for k, v in made.items()))))
    return publish.fuller_description(rows, "Zotero").select("id", "fuller", "author", "title", "year", "year_num", "edition", "other")


# --- page checks ----------------------------------------------------------------------------------------------------------

_NUMBERED = "n AS (SELECT l_orderkey AS page, l_linenumber AS line, CAST(l_orderkey * 10 + l_linenumber + CASE WHEN l_quantity > 40 THEN 1 WHEN l_quantity < 8 THEN -1 ELSE 0 END AS BIGINT) AS number, l_discount > 0.05 AS lettered FROM (SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity, min(l_discount) AS l_discount FROM lineitem GROUP BY l_orderkey, l_linenumber))"


def _numbered(spark, sf_dir):
    shift = F.when(F.col("l_quantity") > 40, 1).when(F.col("l_quantity") < 8, -1).otherwise(0)
    number = (F.col("l_orderkey") * 10 + F.col("l_linenumber") + shift).cast("long")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity"), F.min("l_discount").alias("l_discount"))
    return lines.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line"), number.alias("number"), (F.col("l_discount") > 0.05).alias("lettered"))


@query(
    f"""WITH {_NUMBERED}, p AS (SELECT *, lag(number) OVER (PARTITION BY page ORDER BY line) AS before FROM n)
SELECT page, before AS number, number AS next, CASE WHEN number = before THEN 'repeated' WHEN number < before THEN 'goes back' ELSE 'jumps' END AS error FROM p
WHERE number <> before + 1 AND NOT (number = before AND number IN (SELECT number FROM n WHERE lettered))"""
)
def neighbour_numbers(spark, sf_dir):
    return validate.neighbour_errors(_numbered(spark, sf_dir), suffixed="lettered")


@query(
    f"""WITH {_NUMBERED}, o AS (SELECT page, line, page * 4 + line AS number, lettered FROM n),
e AS (SELECT page, arg_min(number, line) FILTER (NOT lettered) AS first, arg_max(number, line) FILTER (NOT lettered) AS last FROM o GROUP BY page),
g AS (SELECT a.page, a.last, b.first AS next_first FROM e a JOIN e b ON b.page = a.page + 1 WHERE b.first <> a.last + 1)
SELECT page, last, next_first FROM g WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.lettered AND o.page IN (g.page, g.page + 1) AND o.number > g.last AND o.number <= g.next_first)"""
)
def page_borders(spark, sf_dir):
    own = _numbered(spark, sf_dir).withColumn("number", F.col("page") * 4 + F.col("line"))
    return validate.border_errors(own, lettered="lettered")


@query(
    f"""WITH {_NUMBERED}, p AS (SELECT *, lag(number) OVER (PARTITION BY page ORDER BY line) AS before FROM n),
c AS (SELECT page, NOT coalesce(bool_or(number < before), false) AS in_order, count(DISTINCT number) = count(*) AS distinct_numbers FROM p GROUP BY page)
SELECT page, in_order, distinct_numbers FROM c WHERE NOT in_order OR NOT distinct_numbers"""
)
def page_orders(spark, sf_dir):
    return validate.order_errors(_numbered(spark, sf_dir))


@query(
    """WITH o AS (SELECT l_orderkey AS page, count_if(l_quantity <= 25) AS b, count_if(l_quantity > 25) AS s FROM lineitem GROUP BY l_orderkey),
h AS (SELECT page, b, s, CASE WHEN page >= 537 THEN page - 536 WHEN page >= 509 THEN page - 508 ELSE page - 20 END AS due, page % 100 AS said, b + CASE WHEN page % 3 = 0 THEN 1 ELSE 0 END AS books FROM o)
SELECT page, concat('printed_page ', CAST(said AS VARCHAR), ', not ', CAST(due AS VARCHAR)) AS error FROM h WHERE said <> due
UNION ALL SELECT page, concat('summary says ', CAST(books AS VARCHAR), ' books and ', CAST(s AS VARCHAR), ' skipped, file has ', CAST(b AS VARCHAR), ' and ', CAST(s AS VARCHAR)) FROM h WHERE books <> b"""
)
def page_summaries(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("int").alias("page"), F.col("l_linenumber").cast("int").alias("line"), "l_quantity")
    entry = F.when(F.col("l_quantity") > 25, F.lit('{"seq": 1, "skip": "article"}')).otherwise('{"seq": 1}')
    counts = lines.groupBy("page").agg(F.count_if(F.col("l_quantity") <= 25).alias("b"), F.count_if(F.col("l_quantity") > 25).alias("s"))
    told = F.struct((F.col("b") + F.col("s")).alias("entries_on_page"), (F.col("page") % 100).alias("printed_page"), (F.col("b") + F.when(F.col("page") % 3 == 0, 1).otherwise(0)).alias("books"), F.col("s").alias("skipped"))
    heads = counts.select("page", F.lit(0).alias("line"), F.to_json(told).alias("raw"))
    return validate.summary_errors(heads.unionByName(lines.select("page", "line", entry.alias("raw"))), validate.SHAPES["wenckstern"])


# --- streams --------------------------------------------------------------------------------------------------------------


@query(
    r"""SELECT doc_id AS id, part, CASE WHEN doc_id % 3 = 0 THEN nullif(t, '') WHEN part = 1 THEN concat('EN <', source, '> & ', lang) ELSE concat('es ', source) END AS title,
concat('Émile ', source) AS name, array_to_string(CASE WHEN part = 1 THEN [lang, source] ELSE [lang] END, '|') AS subjects, concat(doc_id, '-', part) AS code
FROM (SELECT *, regexp_replace(split_part(text, '.', 1), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS t FROM documents), (SELECT unnest([1, 2]) AS part)"""
)
def xml_parsed(spark, sf_dir):
    """Two records in each document's XML, with prefixes, character data, numeric entities, titles in several languages, a title of something else
    inside, and an attribute."""
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    made = table(spark, sf_dir, "documents").withColumn("t", F.substring_index("text", ".", 1))
    i = F.col("doc_id")
    french = F.concat(F.lit('<dc:title xml:lang="fr">'), esc(F.col("t")), F.lit("</dc:title>"))

    def part(n: int) -> Column:
        other = F.concat(F.lit('<dc:title xml:lang="en"><![CDATA[EN <'), "source", F.lit("> & "), "lang", F.lit("]]></dc:title>")) if n == 1 else F.concat(F.lit('<dc:title xml:lang="es">es '), "source", F.lit("</dc:title>"))
        subjects = F.concat(F.lit("<dc:subject>"), "lang", F.lit("</dc:subject>"), *([F.lit("<dc:subject> "), "source", F.lit("\n</dc:subject><dc:subject/>")] if n == 1 else []))
        return F.concat(
            F.lit('<oai:record code="'), i.cast("string"), F.lit(f'-{n}"><about><dc:title xml:lang="en">not this one</dc:title></about>'), french, F.when(i % 3 == 0, "").otherwise(other),
            F.lit("<dc:creator><person><name>&#201;mile "), "source", F.lit("</name></person></dc:creator>"), subjects, F.lit("</oai:record>"),
        )

    whole = F.concat(F.lit('<?xml version="1.0"?><oai:list xmlns:oai="urn:o" xmlns:dc="urn:d"><oai:set>'), part(1), part(2), F.lit("</oai:set></oai:list>"))
    fields = {"title": xml.Field("title", langs=("en", "es", "fr")), "name": xml.Field("creator/person/name"), "subjects": xml.Field("subject", many=True), "code": xml.Field("@code")}
    found = xml.xml_table(made.select(i.alias("id"), whole.alias("xml")), "xml", "set/record", fields)
    return found.select("id", F.substring_index("code", "-", -1).cast("int").alias("part"), "title", "name", F.array_join("subjects", "|").alias("subjects"), "code")


@query(
    r"""WITH u AS (SELECT c_custkey AS id, [concat('http://www.archive.org/details/', c_custkey), concat('https://', CASE c_nationkey % 4 WHEN 0 THEN 'nas.local' WHEN 1 THEN 'LOCALHOST:80' ELSE 'example.org' END, '/', c_custkey),
  concat('ark:/', c_custkey), concat(' https://archive.org/details/', c_custkey - c_custkey % 2, ' '), concat('https://x.org/', c_custkey % 5)] AS urls FROM customer),
n AS (SELECT id, list_transform(urls, lambda x: regexp_replace(trim(x), '^http://(www\.)?archive\.org/', 'https://archive.org/')) AS urls FROM u),
k AS (SELECT id, list_filter(urls, lambda x: starts_with(x, 'http') AND x <> 'https://x.org/3' AND NOT regexp_matches(lower(x), '^https?://([^/]*\.local/|localhost)')) AS urls FROM n)
SELECT id, array_to_string(CASE WHEN id % 2 = 0 THEN [urls[1]] || urls[2:] ELSE urls END, ' ') AS urls FROM (SELECT id, list_filter(urls, lambda x, i: list_position(urls, x) = i) AS urls FROM k)"""
)
def kept_addresses(spark, sf_dir):
    """Addresses in normal form, once each, without those of internal hosts, bare identifiers and what was taken out by hand."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    host = F.when(F.col("c_nationkey") % 4 == 0, "nas.local").when(F.col("c_nationkey") % 4 == 1, "LOCALHOST:80").otherwise("example.org")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    urls = F.array(
        text("http://www.archive.org/details/", key), text("https://", host, "/", key), text("ark:/", key),
        text(" https://archive.org/details/", (F.col("c_custkey") - F.col("c_custkey") % 2).cast("string"), " "), text("https://x.org/", (F.col("c_custkey") % 5).cast("string")),
    )
    return c.select(F.col("c_custkey").alias("id"), F.array_join(X.kept_urls(urls, ["https://x.org/3"]), " ").alias("urls"))


@query("SELECT id FROM cat WHERE language = 'French' AND type IN ('book', 'periodical') AND coalesce(len(links), 0) = 0 AND contains(lower(source), 'rc1')", cat=True)
def lookup_targets_like(spark, sf_dir):
    return worklists.targets(catalog(spark, sf_dir), "French", containing=("source", "RC1")).select("id")


@query(
    """WITH c AS (SELECT l_orderkey AS k, count(*) AS n, bool_or(l_returnflag = 'R') AS redone, max(CASE WHEN l_linestatus = 'O' AND l_quantity > 45 THEN 'timeout' END) AS error FROM lineitem GROUP BY l_orderkey)
SELECT k, error IS NOT NULL AS after_error, error IS NOT NULL OR (n = 6 AND NOT redone) AS after_cap FROM c"""
)
def redo_lookups(spark, sf_dir):
    """Orders as look-ups with their lines as matches: made again after an error, or where they stopped at six."""
    made = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.collect_list("l_linenumber").alias("matches"), F.bool_or(F.col("l_returnflag") == "R").alias("redone"), F.max(F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45), "timeout")).alias("error"),
    )
    columns = F.col("matches"), F.col("error"), F.col("redone")
    return made.select("k", worklists.to_redo(*columns).alias("after_error"), worklists.to_redo(*columns, old_cap=6).alias("after_cap"))


@query(
    r"""WITH i AS (SELECT doc_id, doc_id % 6 AS k, text, source, lang, n_chars, regexp_replace(split_part(text, '.', 1), '^ +| +$', '', 'g') AS title FROM documents),
u AS (SELECT *, CASE WHEN k = 0 THEN 'https://nas.local/x' WHEN k = 1 THEN concat('https://archive.org/details/', doc_id % 50) ELSE concat('https://x.org/', doc_id) END AS url FROM i),
f AS (SELECT * FROM u WHERE k <> 0 QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1),
y AS (SELECT *, CASE doc_id % 4 WHEN 0 THEN concat(1850 + doc_id % 90, '-0', 1 + doc_id % 9) WHEN 1 THEN concat('c. ', 1850 + doc_id % 90, '?') WHEN 2 THEN '' ELSE 'undated' END AS date FROM f)
SELECT doc_id, CASE k WHEN 2 THEN concat(source, ', Ann; ', lang, ', Bob C.') WHEN 3 THEN concat(source, ', Ed, ed.') WHEN 4 THEN 'The Japan Society' ELSE '' END AS author, title,
  CASE doc_id % 4 WHEN 0 THEN CAST(1850 + doc_id % 90 AS VARCHAR) WHEN 1 THEN date WHEN 2 THEN 'n.d.' ELSE 'undated' END AS year, CASE WHEN doc_id % 4 < 2 THEN CAST(1850 + doc_id % 90 AS INTEGER) END AS year_num, url AS links,
  concat('Imprint: ', CASE WHEN k > 3 THEN 'Paris, ' ELSE '' END, source, ' | Extent: ', n_chars, CASE WHEN k % 2 = 0 THEN ' p.' ELSE ' leaves' END, ' | Language: ', lang, ' | Translator: ', source, ', Tr | Subjects: ', lang, '; ', source,
    CASE k WHEN 5 THEN concat(' | Note: about ', lang) ELSE '' END) AS other FROM y"""
)
def mapped_collection(spark, sf_dir):
    """A reference manager's items: internal addresses, one item filed twice, editors for authors, bodies, dates of four kinds, abstracts that say nothing."""
    i, none = F.col("doc_id"), F.array().cast("array<string>")
    k = i % 6
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    year = (F.lit(1850) + i % 90).cast("string")
    items = table(spark, sf_dir, "documents").select(
        "doc_id", F.substring_index("text", ".", 1).alias("title"), F.when(i % 4 == 0, text(year, "-0", (1 + i % 9).cast("string"))).when(i % 4 == 1, text("c. ", year, "?")).when(i % 4 == 3, "undated").alias("date"),
        F.array(F.when(k == 0, "https://nas.local/x").when(k == 1, text("http://www.archive.org/details/", (i % 50).cast("string"))).otherwise(text("https://x.org/", i.cast("string"))), F.lit("ark:/1")).alias("urls"),
        F.when(k == 2, F.array(text("Ann ", F.col("source")), F.lit("Not available"), text("Bob C. ", F.col("lang")))).when(k == 4, F.array(F.lit("The Japan Society"))).otherwise(none).alias("authors"),
        F.when(k.isin(2, 3), F.array(text("Ed ", F.col("source")))).alias("editors"), F.array(text("Tr ", F.col("source"))).alias("translators"), none.alias("contributors"), F.array("lang", "source").alias("subjects"),
        F.when(k > 3, "Paris").alias("place"), F.col("source").alias("publisher"), F.when(k % 2 == 0, F.col("n_chars").cast("string")).otherwise(text(F.col("n_chars").cast("string"), " leaves")).alias("pages"), F.lit("").alias("series"), F.col("lang").alias("language"),
        F.when(k == 5, text("about ", F.col("lang"))).when(k == 4, "Book digitized by Google from a library").otherwise("12 34").alias("abstract"),
    )
    return mapping.collected(items, "doc_id").withColumn("links", F.array_join("links", " "))


@query(
    r"""SELECT regexp_replace(split_part(text, '.', 1), '^ +| +$', '', 'g') AS title, CASE doc_id % 3 WHEN 0 THEN concat('Pérez, ', source) WHEN 1 THEN concat('Gil, ', lang) ELSE '' END AS author, CASE WHEN doc_id % 5 = 0 THEN 'n.d.' ELSE CAST(1700 + doc_id % 250 AS VARCHAR) END AS year,
  CASE WHEN doc_id % 5 <> 0 THEN CAST(1700 + doc_id % 250 AS INTEGER) END AS year_num, concat('https://bne.es/', doc_id) AS links,
  concat('Imprint: Madrid, ', source, ' | Extent: ', n_chars, ' h. | Language: Spanish | Biblioteca Nacional de España, BNE Digital ', doc_id, CASE WHEN doc_id % 2 = 0 THEN concat(' (signatura R/', doc_id, ')') ELSE '' END) AS other, 'Biblioteca Nacional de España' AS source
FROM documents WHERE doc_id % 11 <> 0 AND trim(split_part(text, '.', 1)) <> ''"""
)
def mapped_cards(spark, sf_dir):
    """A digital library's cards; every eleventh was answered by an error."""
    i = F.col("doc_id")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    number = i.cast("string")
    cards = table(spark, sf_dir, "documents").select(
        text(F.substring_index("text", ".", 1), " / por ", F.col("lang")).alias("title"), F.when(i % 3 == 0, text("Pérez, ", F.col("source"), " (1850-19?) | otro")).when(i % 3 == 1, text("Gil, ", F.col("lang"), " (b. 1801)")).alias("author"),
        F.when(i % 5 != 0, text("entre ", (F.lit(1700) + i % 250).cast("string"), " y 1999")).alias("date"), F.lit("Madrid").alias("place"), F.col("source").alias("publisher"), text(F.col("n_chars").cast("string"), " h. ").alias("extent"),
        F.when(i % 2 == 0, text("R/", number)).alias("signature"), number.alias("id"), text("https://bne.es/", number).alias("viewer"), F.when(i % 11 == 0, "no answer").alias("error"),
    )
    return mapping.library_cards(cards).withColumn("links", F.array_join("links", " "))


@query(
    f"""WITH p AS (SELECT p_partkey AS k, concat(upper(left(p_name, 1)), substr(p_name, 2)) AS name, 1840 + p_partkey % 70 AS y, p_size FROM part),
c AS (SELECT k, CASE k % 3 WHEN 0 THEN 'Doe, J.' WHEN 1 THEN 'Roe, R.' ELSE '' END AS author, split_part(name, ' ', 1) AS title, y, p_size FROM p WHERE k % 13 <> 0 AND y BETWEEN 1850 AND 1900)
SELECT k, author, title, CAST(y AS VARCHAR) AS year, CAST(y AS INTEGER) AS year_num, concat(p_size, ' p.') AS extent FROM c QUALIFY row_number() OVER (PARTITION BY k % 3, {NORM.format('title')}, y ORDER BY k) = 1"""
)
def mapped_printed_books(spark, sf_dir):
    """Copies of works in one collection; every thirteenth could not be fetched, every second has its year in the list only."""
    k = F.col("p_partkey")
    year = (F.lit(1840) + k % 70).cast("string")
    items = table(spark, sf_dir, "part").select(
        k.alias("k"), F.when(k % 3 == 0, "Doe, J.").when(k % 3 == 1, "Roe, R.").alias("author"), F.concat(F.initcap(F.substring_index("p_name", " ", 1)), F.when(k % 4 == 0, ", circa.").when(k % 4 == 1, " n.d.").otherwise(".")).alias("title"),
        F.when(k % 2 == 0, F.concat(F.lit("c"), year)).alias("year"), year.alias("list_year"), F.concat(F.col("p_size").cast("string"), F.lit(" p. ")).alias("collation"), F.when(k % 13 == 0, "lost").alias("error"),
    )
    return mapping.one_per_work(items, "k")


@query(
    r"""SELECT concat('i', c_custkey) AS identifier, CASE WHEN c_custkey % 10 = 0 THEN 'By Hand' WHEN c_custkey % 4 = 0 THEN 'BUILDING, Ann Bea' WHEN c_custkey % 4 = 1 THEN 'Japan Mail Line' WHEN c_custkey % 4 = 2 THEN 'Hume, Bill; Annarino, John' ELSE '' END AS author,
concat('On ', c_mktsegment) AS title, CASE WHEN c_custkey % 3 = 0 THEN 'n.d.' ELSE CAST(1600 + c_custkey % 400 AS VARCHAR) END AS year, CASE WHEN c_custkey % 3 <> 0 THEN CAST(1600 + c_custkey % 400 AS INTEGER) END AS year_num,
c_mktsegment AS publisher, CASE WHEN c_nationkey > 0 THEN concat(c_nationkey, ' images') ELSE '' END AS extent, concat('https://archive.org/details/i', c_custkey) AS links, concat('archive.org item i', c_custkey, ', chosen by hand') AS place_in FROM customer"""
)
def mapped_archive_items(spark, sf_dir):
    """Items with creators in several forms; every tenth author is set right by hand."""
    k = F.col("c_custkey")
    key = F.concat(F.lit("i"), k.cast("string"))
    c = table(spark, sf_dir, "customer")
    items = c.select(
        key.alias("identifier"), F.when(k % 4 == 0, " Ann  Bea BUILDING ").when(k % 4 == 1, "Japan Mail Line").when(k % 4 == 2, "Hume, Bill; Annarino, John").alias("creator"), F.concat(F.lit("On\n"), "c_mktsegment").alias("title"),
        F.when(k % 3 != 0, F.concat(F.lit("c"), (F.lit(1600) + k % 400).cast("string"), F.lit("-01"))).alias("date"), F.col("c_mktsegment").alias("publisher"), F.col("c_nationkey").alias("imagecount"),
    )
    fixes = c.filter(k % 10 == 0).select(key.alias("identifier"), F.lit("By Hand").alias("author"), F.lit(None).cast("string").alias("title"))
    return mapping.archive_items(items, fixes).withColumn("links", F.array_join("links", " "))


@query()
def stream_links(spark, sf_dir):
    """The catalogue as a stream of one batch; tests compare it with a plain rendering."""
    schema = table(spark, sf_dir, "documents").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")  # a stream reads a single file by pattern only
    author = F.concat(F.lit("van "), F.coalesce("source", F.lit("")), F.lit(", "), F.coalesce("lang", F.lit("")))
    made = rows.select(F.col("doc_id").alias("ord"), author.alias("author"), F.substring_index("text", ".", 1).alias("title"), F.lit(None).cast("int").alias("year"))
    out = new_path(spark, "stream-links")
    online_links(made).writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "stream-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("ord long, match long").parquet(out)


@query(
    f"""+ r AS (SELECT id, author, {NORM.format(MAIN.format('title'))} AS key, year_num AS year, row_number() OVER (ORDER BY id) AS n FROM cat),
b AS (SELECT *, concat(CASE WHEN contains(author, ',') AND len(string_split({NORM.format("split_part(author, ',', 1)")}, ' ')) <= 3 THEN string_split({NORM.format("split_part(author, ',', 1)")}, ' ')[-1] ELSE '' END, '|', key) AS k FROM r),
go(n, taken, ord, match) AS (SELECT 0::BIGINT, CAST([] AS STRUCT(ord BIGINT, k VARCHAR, year INTEGER)[]), NULL::BIGINT, NULL::BIGINT UNION ALL
  SELECT x.n, CASE WHEN m IS NULL AND x.key <> '' THEN list_append(taken, {{'ord': x.id, 'k': x.k, 'year': x.year}}) ELSE taken END, x.id, m
  FROM (SELECT b.n, b.id, b.key, b.k, b.year, taken, CASE WHEN b.key <> '' THEN list_filter(taken, lambda y: y.k = b.k AND coalesce(abs(y.year - b.year) <= 3, true))[1].ord END AS m FROM go JOIN b ON b.n = go.n + 1) x)
SELECT ord, match FROM go WHERE n > 0""",
    cat=True,
)
def stream_equal_links(spark, sf_dir):
    """The catalogue as a stream over keyed state: each record's earliest accepted one of its surname, title and years."""
    rows = materialize(catalog(spark, sf_dir).select(F.col("id").alias("ord"), "author", "title", F.col("year_num").alias("year")), "stream-in")
    source = spark.readStream.schema(rows.schema).parquet(folder_of(rows))
    out = new_path(spark, "stream-equal")
    with keyed_state(spark):
        keyed_links(source, least=1.0).writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "stream-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("ord long, match long").parquet(out)
