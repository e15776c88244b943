"""XML by Spark's own parser: records and fields by paths of element names, whatever their prefixes.

The paths make a schema, in which every element may repeat, and the parser fills it: character data sections, numeric entities,
nested elements of one name and attributes are its work. What is left are column expressions over arrays.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Namespaces are passed by; a document that is no XML gives nothing.
OPTIONS = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "attributePrefix": "_", "valueTag": "_VALUE", "ignoreSurroundingSpaces": "true"}


@dataclass(frozen=True)
class Field:
    """path: element names below the record, with / between them, or @name for an attribute of the last. many: all texts as an array, else
    one: the first in the first of the languages that has one, else the first of all."""

    path: str
    many: bool = False
    langs: tuple[str, ...] = ()

    @property
    def steps(self) -> list[str]:
        return [s for s in self.path.split("/") if s]


def _schema(tree: Mapping) -> str:
    inside = ["_VALUE: string", "_lang: string"] if tree.get("text") else []
    inside += [f"`_{a}`: string" for a in sorted(tree.get("attributes", ())) if a != "lang" or not inside]
    inside += [f"`{name}`: array<{_schema(sub)}>" for name, sub in sorted(tree.get("below", {}).items())]
    return f"struct<{', '.join(inside)}>"


def _tree(record: list[str], fields: Mapping[str, Field]) -> dict:
    """Which elements are wanted, below which."""
    root: dict = {}

    def at(node: dict, steps: list[str]) -> dict:
        for step in steps:
            node = node.setdefault("below", {}).setdefault(step, {})
        return node

    for field in fields.values():
        steps = [*record, *field.steps]
        if steps[-1].startswith("@"):
            at(root, steps[:-1]).setdefault("attributes", set()).add(steps[-1][1:])
        else:
            at(root, steps)["text"] = True
    return root


def _all(values: Column, steps: list[str]) -> Column:
    """All elements (or attribute texts) at the end of the steps, in order."""
    for step in steps:
        if step.startswith("@"):
            values = _attribute(values, f"_{step[1:]}")
        else:
            values = _below(values, step)
    return values


def _below(values: Column, name: str) -> Column:
    return F.flatten(F.array_compact(F.transform(values, lambda v: v[name])))


def _attribute(values: Column, name: str) -> Column:
    return F.filter(F.transform(values, lambda v: v[name]), lambda x: x.isNotNull())


def _chosen(texts: Column, langs: tuple[str, ...]) -> Column:
    """Of (text, language) pairs the text in the first language that there is, else the first text."""
    return F.coalesce(*(_first_in(texts, lang) for lang in langs), F.get(texts, F.lit(0))["_VALUE"])


def _first_in(texts: Column, lang: str) -> Column:
    return F.get(F.filter(texts, lambda t: t["_lang"] == lang), F.lit(0))["_VALUE"]


def xml_table(df: DataFrame, xml: str, record: str, fields: Mapping[str, Field]) -> DataFrame:
    """A row for each record of each document: df's other columns, and the fields. record: the path of the record's element from below
    the root. Empty texts count as none; documents that are no XML, and null ones, give no rows."""
    steps = [s for s in record.split("/") if s]
    parsed = df.withColumn("_doc", F.from_xml(F.col(xml), _schema(_tree(steps, fields)), OPTIONS))
    each = parsed.withColumn("_record", F.explode(_all(F.array("_doc"), steps)))

    def column(field: Field) -> Column:
        found = _all(F.array("_record"), field.steps)
        every = lambda texts: F.coalesce(texts, F.array().cast("array<string>"))
        if field.steps[-1].startswith("@"):
            return every(found) if field.many else F.get(found, F.lit(0))
        texts = F.filter(found, lambda t: F.coalesce(t["_VALUE"], F.lit("")) != "")
        return every(F.transform(texts, lambda t: t["_VALUE"])) if field.many else _chosen(texts, field.langs)

    return each.select(*(F.col(f"`{c}`") for c in df.columns if c != xml), *(column(f).alias(name) for name, f in fields.items()))
