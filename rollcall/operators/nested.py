"""Nested-record operators (N1–N7, N9–N11) over ``StructType`` columns.

All of them are column expressions (``to_json``/``from_json``, higher-order
array functions, struct field access), so they stay inside whole-stage
codegen and run wherever the rows are; none needs a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from rollcall.functions.dates import iso_unparsable, parse_iso_timestamp


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ N1/N2
def flatten(df: DataFrame, mapping: Mapping[str, str], struct_col: str | None = None,
            keep: Sequence[str] = ()) -> DataFrame:
    """Nested record → columns through a field-path → column map.
    Fields not in the map are dropped; nested objects are reached by path."""
    base = f"{struct_col}." if struct_col else ""
    return df.select(*keep, *[F.col(f"{base}{path}").alias(col) for path, col in mapping.items()])


def first_external_id(ids, types: Sequence[str] = ("student", "staff")) -> Column:
    """First element whose customType is in ``types`` (NULL when none;
    an empty or NULL array never raises)."""
    return F.get(F.filter(_c(ids), lambda x: x["customType"].isin(list(types))), 0)


def flatten_user_resources(users: DataFrame, mapping: Mapping[str, str], struct_col: str = "u",
                           id_types: Sequence[str] = ("student", "staff")) -> DataFrame:
    """C4 core: directory user resources → account rows (N1 + N2 + F13).

    ``lastlogin_unparsable`` flags a timestamp that is present but matches
    neither layout, so the caller can quarantine the row.
    """
    ts_cols = {"creationTime", "lastLoginTime"}
    cols = []
    for path, col in mapping.items():
        src = F.col(f"{struct_col}.{path}")
        cols.append((parse_iso_timestamp(src) if path in ts_cols else src).alias(col))
    ext = first_external_id(F.col(f"{struct_col}.externalIds"), id_types)
    return users.select(*cols,
                        ext["customType"].alias("user_type"),
                        ext["value"].try_cast("bigint").alias("external_uid"),
                        iso_unparsable(F.col(f"{struct_col}.lastLoginTime")).alias("lastlogin_unparsable"))


# --------------------------------------------------------------------- N3
def payload(fields: Mapping[str, Column]) -> Column:
    """JSON body from named columns; NULL fields are omitted (Spark's
    ``to_json`` drops them), nested names build nested objects."""
    tree: dict = {}
    for name, col in fields.items():
        node = tree
        parts = name.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = col

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    return F.to_json(build(tree))


def external_ids_payload(id_type, value, custom_type=None) -> Column:
    """``{"externalIds": [{"type": …, "value": …}]}`` from two columns."""
    item = [_c(id_type).alias("type")]
    if custom_type is not None:
        item.append(_c(custom_type).alias("customType"))
    item.append(_c(value).alias("value"))
    return F.to_json(F.struct(F.array(F.struct(*item)).alias("externalIds")))


# --------------------------------------------------------------------- N5
def schema_projection(df: DataFrame, record: StructType, view: str, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the properties a view owns, generated from field metadata.

    view='store': properties with a ``column`` → renamed to that column.
    view='api'  : properties flagged ``api`` → a JSON body (NULLs dropped;
    unlike the reference, 0/False/'' are kept — R9).
    ``df`` holds the record's properties as columns (missing ones are NULL).
    """
    have = set(df.columns)

    def prop(f):
        return F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType)

    if view == "store":
        return df.select(*keep, *[prop(f).alias(f.metadata["column"]) for f in record.fields
                                  if "column" in f.metadata])
    if view == "api":
        body = F.struct(*[prop(f).alias(f.name) for f in record.fields if f.metadata.get("api")])
        return df.select(*keep, F.to_json(body).alias("payload"))
    raise ValueError(view)


# --------------------------------------------------------------------- N6
def sparse_patch(fields: Mapping[str, Column]) -> Column:
    """Body with only the supplied non-blank fields; ``{}`` → NULL (no call)."""
    body = F.to_json(F.struct(*[F.nullif(_c(c), F.lit("")).alias(k) for k, c in fields.items()]))
    return F.nullif(body, F.lit("{}"))


# --------------------------------------------------------------------- N7
def merge_later_wins(earlier: str, later: str, fields: Sequence[str]) -> list[Column]:
    """Field by field, the later record's value unless it is NULL."""
    return [F.coalesce(F.col(f"{later}.{f}"), F.col(f"{earlier}.{f}")).alias(f) for f in fields]


# --------------------------------------------------------------------- N9
def invert_map(m) -> Column:
    """Value → key.  When values repeat, the last entry wins (as a dict
    rebuilt in iteration order would)."""
    entries = F.map_entries(_c(m))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)),
                                                   lambda x: x["value"] == e["value"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["value"].alias("key"),
                                                                   e["key"].alias("value"))))


# -------------------------------------------------------------------- N10
@dataclass(frozen=True)
class Rule:
    """One row of the rule table: what is wrong with a field where ``broken`` holds."""

    field: str
    kind: str
    broken: Column

    @property
    def text(self) -> str:
        return f"{self.field}: {self.kind}"


def rules_of(record: StructType, col_of=None, types: Mapping[str, DataType] | None = None) -> list[Rule]:
    """The rule table of a record, compiled from field metadata: required (NULL), enum (value outside the list) and type (text
    that does not parse as the declared type, for columns that ``types`` says are text)."""
    col_of = col_of or (lambda f: F.col(f.metadata.get("column", f.name)))
    rules = []
    for f in record.fields:
        if f.metadata.get("readonly"):
            continue
        c = col_of(f)
        if f.metadata.get("required"):
            rules.append(Rule(f.name, "required", c.isNull()))
        if "enum" in f.metadata:
            rules.append(Rule(f.name, "not in enum", c.isNotNull() & ~c.isin(list(f.metadata["enum"]))))
        landed = (types or {}).get(f.metadata.get("column", f.name))
        if isinstance(landed, StringType) and not isinstance(f.dataType, StringType):
            rules.append(Rule(f.name, f"no {f.dataType.simpleString()}", c.isNotNull() & c.try_cast(f.dataType).isNull()))
    return rules


def violations(record: StructType, col_of=None, types: Mapping[str, DataType] | None = None) -> Column:
    """Array of rule violations for one row, from field metadata (:func:`rules_of`)."""
    checks = [F.when(rule.broken, F.lit(rule.text)) for rule in rules_of(record, col_of, types)]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def column_types(df: DataFrame) -> dict[str, DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def violation_counts(df: DataFrame, record: StructType, col_of=None) -> DataFrame:
    """(field, rule, n_rows) of every rule of the table, also of those that no row breaks: one aggregate over the rows."""
    rules = rules_of(record, col_of, column_types(df))
    totals = df.agg(*[F.count_if(rule.broken).alias(f"r{i}") for i, rule in enumerate(rules)])
    each = F.array(*[F.struct(F.lit(rule.field).alias("field"), F.lit(rule.kind).alias("rule"), F.col(f"r{i}").alias("n_rows"))
                     for i, rule in enumerate(rules)])
    return totals.select(F.inline(each))


def split_valid(df: DataFrame, record: StructType, col_of=None) -> tuple[DataFrame, DataFrame]:
    """Rows with no violation, and the quarantine (rows + their violations)."""
    v = df.withColumn("violations", violations(record, col_of, column_types(df)))
    return v.filter(F.size("violations") == 0).drop("violations"), v.filter(F.size("violations") > 0)


# -------------------------------------------------------------------- N11
def as_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every value (booleans and NULL included) as text."""
    cols = cols or df.columns
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])
