"""Secret scan with multipart credential linking, in DataFrame functions only.

Base spans are found per kind by a regular expression. Positions come from the text between matches: split() gives the
pieces, regexp_extract_all() the matches, and running sums of their lengths the starts (in two levels, so that a text with
very many matches costs no more than in proportion).

Weak candidates (short access identifiers, short assigned values, bare keys, endpoints) say little alone. They are joined
with all parts of the same document whose interval lies within SCOPE code points, bin by bin, and reported only where the
complementary parts are there: an identifier needs a secret, a secret needs an identifier, an endpoint needs both.
A bin holds a bounded number of spans, as spans of one kind do not overlap; so no document makes a quadratic join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import materialize

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the same spans as [0-9a-f]+ of 16 characters at least: both match whole runs
SESSION = r"ASIA[A-Z0-9]{8,}"
BARE = r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_=.-])"
#: A host is looked for from the start of its run of letters only, so that a long run is gone through once.
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>,;]+|(?<![a-z0-9.-])[a-z0-9.-]+\.amazonaws\.com"""
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
#: Shortest weak ones.
WEAK_ASSIGN, WEAK_ACCESS = 6, 12
#: Kinds in the order in which spans with one start are listed.
KINDS = ["assign", "access", "hex", "weak_access", "weak_assign", "bare_key", "endpoint"]
#: Parts are linked over this many code points at most.
SCOPE = 200
#: Items per block of the two-level running sum.
BLOCK = 256

_SPAN = "array<struct<s:int,k:int,e:int>>"
_NO_SPAN = f"CAST(array() AS {_SPAN})"
_NO_INT = "CAST(array() AS array<int>)"


def _literal(pattern: str) -> str:
    return "r'" + pattern + "'" if "'" not in pattern else 'r"' + pattern.replace('"', r"\x22") + '"'


def _with_spans(df: DataFrame, name: str, pattern: str, given: str, group: int | None = None) -> DataFrame:
    """Add name_s, name_e (arrays of starts and ends in code points) and, with group, name_v (that group's lengths).

    given: a cheaper condition; texts without a match are passed by.
    """
    p, t, n = _literal(pattern), "_text", name
    some = f"({given}) AND {t} RLIKE {p}"
    df = df.withColumns(
        {f"{n}_h": F.expr(f"CASE WHEN {some} THEN transform(regexp_extract_all({t}, {p}, 0), x -> length(x)) ELSE {_NO_INT} END")}
    ).withColumns(
        {f"{n}_p": F.expr(f"CASE WHEN size({n}_h) > 0 THEN transform(split({t}, {p}, -1), x -> length(x)) ELSE {_NO_INT} END")} | ({f"{n}_v": F.expr(f"CASE WHEN size({n}_h) > 0 THEN transform(regexp_extract_all({t}, {p}, {group}), x -> length(x)) ELSE {_NO_INT} END")} if group else {})
    )
    steps = f"zip_with(slice({n}_p, 1, size({n}_h)), {n}_h, (a, b) -> a + b)"
    df = df.withColumn(f"{n}_l", F.expr(f"CASE WHEN size({n}_h) > 0 THEN {steps} ELSE {_NO_INT} END"))
    total = "aggregate({}, 0, (a, x) -> a + x)"
    blocks = f"transform(sequence(0, int((size({n}_l) - 1) div {BLOCK})), b -> {total.format(f'slice({n}_l, b * {BLOCK} + 1, {BLOCK})')})"
    df = df.withColumn(f"{n}_b", F.expr(f"CASE WHEN size({n}_l) > 0 THEN {blocks} ELSE {_NO_INT} END"))
    df = df.withColumn(f"{n}_c", F.expr(f"CASE WHEN size({n}_l) > 0 THEN transform(sequence(0, size({n}_b) - 1), b -> {total.format(f'slice({n}_b, 1, b)')}) ELSE {_NO_INT} END"))
    start = f"{n}_c[int(i div {BLOCK})] + {total.format(f'slice({n}_l, int(i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK})')} + {n}_p[i]"
    df = df.withColumn(f"{n}_s", F.expr(f"CASE WHEN size({n}_l) > 0 THEN transform(sequence(0, size({n}_l) - 1), i -> {start}) ELSE {_NO_INT} END"))
    df = df.withColumn(f"{n}_e", F.expr(f"zip_with({n}_s, {n}_h, (a, b) -> a + b)"))
    return df.drop(f"{n}_p", f"{n}_l", f"{n}_b", f"{n}_c")


def _structs(name: str, kind: str, measure: str, least: int, below: int = 2**31 - 1) -> Column:
    """The spans of a kind whose measure (an array in step with them) is in [least, below)."""
    every = f"transform(arrays_zip({name}_s, {name}_e, {name}_{measure}), x -> named_struct('s', x.{name}_s, 'k', {KINDS.index(kind)}, 'e', x.{name}_e, 'm', x.{name}_{measure}))"
    return F.expr(f"CAST(transform(filter({every}, x -> x.m >= {least} AND x.m < {below}), x -> named_struct('s', x.s, 'k', x.k, 'e', x.e)) AS {_SPAN})")


def _listed(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform(array_sort({spans}), x -> concat({names}[x.k], ':', x.s, ':', x.e)), ',')")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: _row (a fixed number), id_col, base and weak spans; weak is empty where no link is possible."""
    df = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    df = _with_spans(df, "assign", ASSIGN, "true", group=2)
    df = _with_spans(df, "access", ACCESS, "contains(_text, 'AKIA')")
    df = _with_spans(df, "hex", HEX, "true")
    df = _with_spans(df, "session", SESSION, "contains(_text, 'ASIA')")
    has_access = "(size(access_h) > 0 OR size(session_h) > 0)"
    df = _with_spans(df, "bare", BARE, has_access)
    df = _with_spans(df, "endpoint", ENDPOINT, f"{has_access} AND (size(assign_h) > 0 OR size(hex_h) > 0 OR size(bare_h) > 0)")
    base = F.concat(_structs("assign", "assign", "v", LEAST_ASSIGN), _structs("access", "access", "h", LEAST_ACCESS), _structs("hex", "hex", "h", 16))
    weak = F.concat(
        _structs("access", "weak_access", "h", WEAK_ACCESS, LEAST_ACCESS),
        _structs("session", "weak_access", "h", WEAK_ACCESS),
        _structs("assign", "weak_assign", "v", WEAK_ASSIGN, LEAST_ASSIGN),
        _structs("bare", "bare_key", "h", 40),
        _structs("endpoint", "endpoint", "h", 1),
    )
    df = df.select(F.col("_id").alias(id_col), base.alias("base"), weak.alias("weak"), F.expr(has_access).alias("_a"), F.expr("size(assign_h) + size(hex_h) + size(bare_h) > 0").alias("_s"))
    return df.withColumn("weak", F.expr(f"CASE WHEN _a AND _s THEN weak ELSE {_NO_SPAN} END")).drop("_a", "_s").withColumn("_row", F.monotonically_increasing_id())


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(_row, links): the weak spans of each row that have their complementary parts within scope; rows without any are absent."""
    some = found.filter("size(weak) > 0")
    parts = some.select("_row", F.explode(F.concat("base", "weak")).alias("p")).withColumn("bin", F.explode(F.expr(f"sequence(int(p.s div {scope}), int((p.e - 1) div {scope}))")))
    weak = some.select("_row", F.explode("weak").alias("w")).withColumn("bin", F.explode(F.expr(f"sequence(int(greatest(w.s - {scope}, 0) div {scope}), int((w.e + {scope}) div {scope}))")))
    near = weak.join(parts, ["_row", "bin"]).filter(f"p.s <= w.e + {scope} AND p.e >= w.s - {scope} AND NOT (p.k = w.k AND p.s = w.s)")
    k = {name: i for i, name in enumerate(KINDS)}
    seen = near.groupBy("_row", "w").agg(
        F.expr(f"bool_or(p.k IN ({k['access']}, {k['weak_access']}))").alias("access"),
        F.expr(f"bool_or(p.k IN ({k['assign']}, {k['hex']}, {k['weak_assign']}, {k['bare_key']}))").alias("secret"),
        F.expr("bool_or(p.k <= 2 AND p.s < w.e AND p.e > w.s)").alias("inside"),
    )
    need = f"CASE WHEN w.k = {k['weak_access']} THEN secret WHEN w.k = {k['endpoint']} THEN access AND secret ELSE access END"
    return seen.filter(f"NOT inside AND {need}").groupBy("_row").agg(F.collect_list("w").alias("links"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of docs: id_col, n_assign, n_access, n_hex, base (the base spans listed), spans (with the linked ones).

    A span is kind:start:end of the whole match, in code points, end exclusive. Null texts count as empty and have no span;
    repeated rows and ids, null ids included, are scanned row by row; an empty table gives an empty result; other columns
    are ignored. Weak spans that overlap a base span are not repeated. Texts of any length are scanned whole; each pattern goes through
    a run of characters once, so time grows with the text's length, and spans meet within bins of scope code points only.
    """
    found = materialize(scan(docs, id_col, text_col), "spans")
    alone = found.filter("size(weak) = 0").withColumn("links", F.expr(_NO_SPAN))
    others = found.filter("size(weak) > 0").join(linked(found, scope), "_row", "left").withColumn("links", F.expr(f"coalesce(links, {_NO_SPAN})"))
    every = alone.unionByName(others)
    counts = [F.expr(f"size(filter(base, x -> x.k = {i}))").cast("long").alias(f"n_{KINDS[i]}") for i in range(3)]
    return every.select(id_col, *counts, _listed("base").alias("base"), _listed("concat(base, links)").alias("spans"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def _sql_spans(name: str, pattern: str, group: int = 0, where: str = "true") -> str:
    """A CTE with a row for each match: doc_id, s, e, m (the group's length)."""
    p = "'" + pattern.replace("'", "''") + "'"
    before = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    start = f"{before.format('c[1:i]')} + {before.format('h[1:i - 1]')}"
    return f"""{name}_0 AS (SELECT doc_id, regexp_extract_all(t, {p}) AS h, regexp_extract_all(t, {p}, {group}) AS v, string_split_regex(t, {p}) AS c FROM d WHERE {where}),
{name} AS (SELECT doc_id, CAST(x.s AS BIGINT) AS s, CAST(x.s + x.n AS BIGINT) AS e, x.m FROM (
  SELECT doc_id, unnest(list_transform(range(1, len(h) + 1), lambda i: {{'s': {start}, 'n': length(h[i]), 'm': length(v[i])}})) AS x FROM {name}_0))"""


#: The leftmost match starts where its run does; this engine has no look-behind, and no need of it.
_SQL_ENDPOINT = ENDPOINT.replace("(?<![a-z0-9.-])", "")
_ID = "(contains(t, 'AKIA') OR contains(t, 'ASIA'))"
_NAMES = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_sql_spans("assign", ASSIGN, 2)},
{_sql_spans("access", ACCESS, 0, "contains(t, 'AKIA')")},
{_sql_spans("hex", HEX)},
{_sql_spans("session", SESSION, 0, "contains(t, 'ASIA')")},
{_sql_spans("run", "[A-Za-z0-9+/_=.-]+", 0, _ID)},
{_sql_spans("endpoint", _SQL_ENDPOINT, 0, _ID)},
bare AS (SELECT r.* FROM run r JOIN d USING (doc_id) WHERE r.m = 40 AND regexp_full_match(substr(d.t, CAST(r.s + 1 AS BIGINT), 40), '[A-Za-z0-9+/]{{40}}')),
base AS (SELECT doc_id, 0 AS k, s, e FROM assign WHERE m >= {LEAST_ASSIGN} UNION ALL SELECT doc_id, 1, s, e FROM access WHERE m >= {LEAST_ACCESS} UNION ALL SELECT doc_id, 2, s, e FROM hex),
weak AS (SELECT doc_id, 3 AS k, s, e FROM access WHERE m >= {WEAK_ACCESS} AND m < {LEAST_ACCESS} UNION ALL SELECT doc_id, 3, s, e FROM session
  UNION ALL SELECT doc_id, 4, s, e FROM assign WHERE m >= {WEAK_ASSIGN} AND m < {LEAST_ASSIGN} UNION ALL SELECT doc_id, 5, s, e FROM bare UNION ALL SELECT doc_id, 6, s, e FROM endpoint),
part AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
seen AS (SELECT w.doc_id, w.k, w.s, w.e, bool_or(p.k IN (1, 3)) AS ids, bool_or(p.k IN (0, 2, 4, 5)) AS secrets, bool_or(p.k <= 2 AND p.s < w.e AND p.e > w.s) AS inside
  FROM weak w JOIN part p ON p.doc_id = w.doc_id AND p.s <= w.e + {SCOPE} AND p.e >= w.s - {SCOPE} AND NOT (p.k = w.k AND p.s = w.s) GROUP BY ALL),
every AS (SELECT doc_id, k, s, e FROM base UNION ALL SELECT doc_id, k, s, e FROM seen WHERE NOT inside AND CASE k WHEN 3 THEN secrets WHEN 6 THEN ids AND secrets ELSE ids END),
listed AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(concat({_NAMES}[k + 1], ':', CAST(s AS VARCHAR), ':', CAST(e AS VARCHAR)), ',' ORDER BY s, k) FILTER (k <= 2) AS b,
  string_agg(concat({_NAMES}[k + 1], ':', CAST(s AS VARCHAR), ':', CAST(e AS VARCHAR)), ',' ORDER BY s, k) AS a FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans FROM d LEFT JOIN listed USING (doc_id)
"""
