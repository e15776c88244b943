"""A text index for substring searches: postings of three letters, as a partitioned table.

Every place of a folded field starts a posting (gram, field, id): the three letters from there on, filled up with a mark at the end of
the field, so that a term of one or two letters is the start of a posting, too. Postings are partitioned by their first letter
and sorted, so a term's scan reads its letters' partitions only, and of their files the row groups that can have its grams. A field
that others make up has postings only of grams that none of these has, over their borders; a scan of it reads theirs, too. A
search intersects the postings of its terms and verifies what is left on the rows themselves, so its answer is that of the search
without an index.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators.search import FIELDS, Request, condition, relevance
from lectern.plans.workspace import materialize, new_path

SIZE = 3
#: Fills up the last postings of a field; folded texts do not have it.
END = "\u0003"
#: Partitions of postings by their first letter.
HEADS = 64
#: Grams of one term that are looked up, evenly spread over it; the rest is left to the verification.
MOST_GRAMS = 8
#: Fields that are made up of others.
PARTS = {"fall": ("fa", "ft", "fo")}


def head(gram: Column) -> Column:
    return F.pmod(F.ascii(gram), F.lit(HEADS))


def _grams(field: str) -> Column:
    """The distinct grams of a field; its letters are told apart once, so a long text costs what it has letters."""
    text = F.concat(F.coalesce(field, F.lit("")), F.lit(END * (SIZE - 1)))
    starts = lambda letters: F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(letters) - SIZE))
    gram = lambda letters, i: F.concat(*(F.get(letters, i + k) for k in range(SIZE)))
    return F.array_distinct(X.once(F.split(text, ""), lambda letters: F.transform(starts(letters), lambda i: gram(letters, i))))


def postings(view: DataFrame, fields: tuple[str, ...] = ("fa", "ft", "fs", "fo", "fall"), key: str = "id") -> DataFrame:
    """(head, gram, field, key) of each distinct gram of each field, without those that a part of the field has; null fields count as
    empty ones."""
    cut = view.select(key, *(_grams(f).alias(f"_{f}") for f in fields))

    def own(f: str) -> Column:
        parts = [F.col(f"_{p}") for p in PARTS.get(f, ()) if p in fields]
        return F.array_except(f"_{f}", F.concat(*parts)) if parts else F.col(f"_{f}")

    columns = F.array(*(F.struct(F.lit(f).alias("field"), own(f).alias("grams")) for f in fields))
    each = cut.select(key, F.explode(columns).alias("_f")).select(key, F.col("_f.field").alias("field"), F.explode("_f.grams").alias("gram"))
    return each.filter(~F.col("gram").startswith(END)).select(head(F.col("gram")).alias("head"), "gram", "field", key)


@dataclass(frozen=True)
class TextIndex:
    """Postings as a table, and the rows that they are of."""

    table: DataFrame
    view: DataFrame
    key: str = "id"

    @classmethod
    def build(cls, view: DataFrame, path: str | None = None, key: str = "id") -> TextIndex:
        """The index of a view of with_search_columns, written to a path, by default one in the work folder."""
        spark = view.sparkSession
        path = path or new_path(spark, "postings")
        # ranges are told from a sample, which is a second reading: of the postings, not of the texts
        rows = materialize(postings(view, key=key), "grams")
        # a letter's postings are several tasks' work: files hold ranges of grams
        ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "head", "gram", "field", key).sortWithinPartitions("head", "gram", "field", key)
        ranged.write.partitionBy("head").option("compression", "zstd").parquet(path)
        return cls(spark.read.schema(f"gram string, field string, {view.select(key).schema[0].simpleString().replace(':', ' ')}, head int").parquet(path), view, key)

    def scan(self, field: str, text: str) -> DataFrame:
        """(gram, key) of the postings that a term asks for: those of its grams, or those that it starts."""
        there = F.col("field").isin(field, *PARTS.get(field, ()))
        at = there & (F.col("head") == ord(text[0]) % HEADS) if len(text) <= SIZE else there
        if len(text) < SIZE:
            return self.table.filter(at & F.col("gram").startswith(text)).select(F.lit(text).alias("gram"), self.key)
        grams = wanted_grams(text)
        heads = sorted({ord(g[0]) % HEADS for g in grams})
        return self.table.filter(at & F.col("head").isin(heads) & F.col("gram").isin(grams)).select("gram", self.key)

    def holders(self, field: str, text: str) -> DataFrame:
        """(key) of the rows whose field has all grams of a term: all that contain it, and perhaps others."""
        found = self.scan(field, text)
        n = len(wanted_grams(text)) if len(text) >= SIZE else 1
        return found.groupBy(self.key).agg(F.count_distinct("gram").alias("_n")).filter(F.col("_n") == n).select(self.key) if n > 1 else found.select(self.key).distinct()

    def candidates(self, r: Request) -> DataFrame | None:
        """(key) of the rows that have all grams of all terms asked for; None where no term is."""
        wanted = {(FIELDS.get(t.field or r.field, "fall"), t.text) for t in r.terms if t.field != "type" and not t.negated and END not in t.text}
        if not wanted:
            return None
        each = [self.holders(*term) for term in sorted(wanted)]
        return functools.reduce(lambda a, b: a.join(b, self.key, "left_semi"), each)

    def search(self, r: Request) -> DataFrame:
        """As search.search, reading no more than the rows that the postings leave."""
        found = self.candidates(r)
        rows = self.view if found is None else self.view.join(found, self.key, "left_semi")
        return rows.filter(condition(r)).withColumn("rel", relevance(r))


def wanted_grams(text: str) -> list[str]:
    """Distinct grams of a term, MOST_GRAMS at most: any of them may be left out, as rows are verified."""
    grams = list(dict.fromkeys(text[i : i + SIZE] for i in range(len(text) - SIZE + 1)))
    step = max(1, -(-len(grams) // MOST_GRAMS))
    return grams[::step]
