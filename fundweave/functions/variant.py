"""Semi-structured expressions over VARIANT columns.

Nothing here shuffles: paths, array sizes and the inverted-index rebuild are all evaluated inside
the row, so a record of any width costs only its own task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import blank_to_null


def text_at(raw: Column, path: str) -> Column:
    """Text under `path` ("a.b", "x[0].id"); missing paths and JSON null both give NULL."""
    return F.try_variant_get(raw, f"$.{path}", "string")


def node_at(raw: Column, path: str) -> Column:
    return F.try_variant_get(raw, f"$.{path}", "variant")


def extract(
    raw: DataFrame, texts: dict[str, str], nodes: dict[str, str], keep: list[str]
) -> DataFrame:
    """Paths of the `raw` column as columns, and nothing else.

    Reading paths in a projection of their own lets the Parquet scan hand over just these fields;
    mixed with the cleaning expressions the whole VARIANT would have to travel along.
    """
    raw_column = F.col("raw")
    return raw.select(
        *[text_at(raw_column, path).alias(name) for name, path in texts.items()],
        *[node_at(raw_column, path).alias(name) for name, path in nodes.items()],
        *keep,
    )


def elements(node: Column) -> Column:
    """Elements of a VARIANT array; NULL when the node is missing or not an array."""
    return F.try_variant_get(node, "$", "array<variant>")


def array_length(node: Column) -> Column:
    return F.array_size(elements(node))


def object_or_json_text(node: Column) -> Column:
    """The node itself when it is an object, otherwise its text parsed as JSON (bad JSON -> NULL)."""
    is_object = F.schema_of_variant(node).startswith("OBJECT")
    parsed = F.try_parse_json(F.try_variant_get(node, "$", "string"))
    return F.when(is_object, node).otherwise(parsed)


def inverted_index_text(node: Column) -> Column:
    """Running text of a word -> positions object.

    The positions are unnested, ordered and joined inside the row; the text never crosses a
    shuffle. A word whose value is not a list of integers contributes nothing.
    """
    by_word = F.map_entries(F.try_variant_get(object_or_json_text(node), "$", "map<string,variant>"))
    placed = F.flatten(
        F.transform(
            by_word,
            lambda e: F.transform(
                F.coalesce(
                    F.try_variant_get(e["value"], "$", "array<int>"), F.array().cast("array<int>")
                ),
                lambda p: F.struct(p.alias("at"), e["key"].alias("word")),
            ),
        )
    )
    ordered = F.array_sort(F.filter(placed, lambda x: x["at"].isNotNull()))
    return blank_to_null(F.array_join(F.transform(ordered, lambda x: x["word"]), " "))


def explode_elements(df: DataFrame, node: str, *keep: str | Column) -> DataFrame:
    """One row per array element with its index; rows without elements vanish (inner unnest)."""
    return df.select(*keep, F.posexplode(elements(F.col(node))).alias("position", "element"))


def json_list_contains(json_list: Column, value: Column) -> Column:
    """1.0 when `value` is an item of a JSON list of codes held as text, else 0.0 (also for NULLs).

    Looks for the quoted code in the text: codes hold no quotes, so no list has to be parsed.
    """
    quoted = F.concat(F.lit('"'), blank_to_null(value), F.lit('"'))
    return F.coalesce(F.contains(json_list, quoted).cast("double"), F.lit(0.0))
