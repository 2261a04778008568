"""Schema-less documents: walking them to any depth, flattening by key (N1) and recursive patches.

:func:`walk` opens one level of objects of all documents at a time (``variant_explode``), so the number of passes is the depth of
the deepest document and every pass is a narrow, distributed one.  What follows works on its rows, one per value:

* :func:`by_key` – columns from mapped keys wherever they stand; :func:`unknown_keys` – what no mapping names;
* :func:`patches` – the patch that turns a stored document into the desired one: changed and new values, an explicit null for
  what the desired one lacks (at the highest place that is missing), nothing where nothing differs.  The rows of both sides meet on (key, path),
  and the patch is put together from the deepest level up.

A value is an object with fields, or a leaf: a scalar, a list (compared and replaced as a whole), a null or an object without fields.  Equal
values are equal as text after parsing, so blanks and the order of fields never count.  Text that does not parse is
a document without values; :func:`unparsable` finds those.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.ranking import materialize


def unparsable(docs: DataFrame, doc: str) -> DataFrame:
    """Rows whose document is text that is no JSON."""
    return docs.filter(F.col(doc).isNotNull() & F.try_parse_json(F.col(doc)).isNull())


def walk(docs: DataFrame, keys: Sequence[str], doc: str) -> DataFrame:
    """(keys…, path array, is_object, text): every value below the root of each document, objects included.

    The documents are spread over as many tasks as shuffles have first: a file of many small documents is read by few.
    """
    spark = docs.sparkSession
    spread = docs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, doc)
    level = spread.select(*keys, F.array().cast("array<string>").alias("path"), F.lit(True).alias("is_object"),
                        F.to_json(F.try_parse_json(F.col(doc))).alias("text")).filter(F.col("text").startswith("{"))
    found: list[DataFrame] = []
    while True:
        opened = level.filter("is_object").withColumn("value", F.parse_json(F.col("text"))).drop("text")
        opened = opened.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("pos", "name", "item"))
        text = F.to_json(F.col("item"))
        level = materialize(opened.select(*keys, F.concat("path", F.array("name")).alias("path"),
                                          (text.startswith("{") & (text != "{}")).alias("is_object"), text.alias("text")))
        found.append(level)
        if level.filter("is_object").isEmpty():
            return reduce(DataFrame.unionByName, found)


# --------------------------------------------------------------------- N1
def _name() -> Column:
    return F.element_at("path", -1)


def by_key(values: DataFrame, keys: Sequence[str], mapping: Mapping[str, str]) -> DataFrame:
    """One row per document: a column for each mapped key with the leaf of that name, as text (scalars bare), at any depth.

    Where a name stands several times the shallowest counts, then the first path.  Documents without any mapped key have no row.
    """
    leaves = values.filter(~F.col("is_object") & _name().isin(list(mapping)))
    bare = F.when(F.col("text").startswith('"'), F.get_json_object(F.concat(F.lit("["), F.col("text"), F.lit("]")), "$[0]")) \
        .when(F.col("text") != "null", F.col("text"))
    named = leaves.select(*keys, _name().alias("name"), F.struct(F.size("path").alias("depth"), "path", bare.alias("value")).alias("v"))
    columns = [F.min(F.when(F.col("name") == name, F.col("v")))["value"].alias(column) for name, column in mapping.items()]
    return named.groupBy(*keys).agg(*columns)


def unknown_keys(values: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """(path, n_values): the places of leaves that the mapping does not name, and how often they occur."""
    return (values.filter(~F.col("is_object") & ~_name().isin(list(mapping)))
            .groupBy(F.array_join("path", ".").alias("path")).agg(F.count(F.lit(1)).alias("n_values")))


# --------------------------------------------------------------------- N8
def first_of(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in the given order (a partial aggregate): tied desired rows, before they are compared."""
    rest = [c for c in rows.columns if c not in keys]
    row = F.struct(*order, F.struct(*rest).alias("row"))
    return rows.groupBy(*keys).agg(F.min(row).alias("first")).select(*keys, "first.row.*")


def _assembled(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys…, patch) from (keys…, path, text), the objects put together from the deepest level up, fields by name."""
    entries = materialize(entries)
    deepest = entries.agg(F.max(F.size("path"))).first()[0] or 0
    quoted = F.to_json(F.create_map(F.element_at("path", -1), F.lit(0)))
    field = F.struct(F.element_at("path", -1).alias("name"), F.concat(F.substring(quoted, F.lit(2), F.length(quoted) - 3), "text").alias("field"))
    built = entries.filter(F.lit(False))
    for depth in range(deepest, 0, -1):
        here = entries.filter(F.size("path") == depth).unionByName(built)
        parent = F.slice("path", 1, F.size("path") - 1).alias("path")
        fields = here.select(*keys, parent, field.alias("f")).groupBy(*keys, "path").agg(F.array_sort(F.collect_list("f")).alias("fields"))
        built = fields.select(*keys, "path", F.concat(F.lit("{"), F.array_join("fields.field", ","), F.lit("}")).alias("text"))
    return built.select(*keys, F.col("text").alias("patch"))


def patches(desired: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys…, patch) for the documents on both sides that differ, from their :func:`walk` rows.

    Both sides must hold one document per key (:func:`first_of`).  Documents on one side only have no patch.
    """
    both = desired.select(*keys).distinct().join(stored.select(*keys).distinct(), list(keys))
    want = desired.join(both, list(keys), "left_semi").select(*keys, "path", F.col("is_object").alias("d_object"), F.col("text").alias("d_text"))
    have = stored.join(both, list(keys), "left_semi").select(*keys, "path", F.col("is_object").alias("s_object"), F.col("text").alias("s_text"))
    met = materialize(want.join(have, [*keys, "path"], "full_outer"))

    empty_for_object = (F.col("d_text") == "{}") & F.coalesce("s_object", F.lit(False))
    put = met.filter(F.col("d_text").isNotNull() & ~F.col("d_object") & ~F.col("d_text").eqNullSafe(F.col("s_text")) & ~empty_for_object)
    put = put.select(*keys, "path", F.col("d_text").alias("text"))

    # a stored value goes where the desired document holds its parent as an object: elsewhere the parent went or was replaced
    lost = met.filter(F.col("d_text").isNull()).select(*keys, "path", F.slice("path", 1, F.size("path") - 1).alias("parent"))
    objects = met.filter(F.col("d_object") | (F.col("d_text") == "{}")).select(*keys, F.col("path").alias("parent"))
    nested = lost.filter(F.size("parent") > 0).join(objects, [*keys, "parent"], "left_semi")
    gone = lost.filter(F.size("parent") == 0).unionByName(nested.select(*lost.columns)).select(*keys, "path", F.lit("null").alias("text"))
    return _assembled(put.unionByName(gone), keys)
