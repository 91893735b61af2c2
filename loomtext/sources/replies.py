"""Lenient JSON replies to typed items, all in VARIANT and array expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, strip


def _between(text: Column, opening: str, closing: str) -> Column:
    """Text from the first opening to the last closing mark; null unless closing comes later."""
    first = F.instr(text, opening)
    last = F.length(text) - F.instr(F.reverse(text), closing) + 1
    found = (first > 0) & (F.instr(text, closing) > 0) & (last > first)
    return F.when(found, F.substring(text, first, last - first + 1))


def _is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value.

    The parser ignores what follows a complete value, so the text is placed before an end mark in
    an array: the mark is the second and last element only if the text is exactly one value.
    """
    framed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"_end"]')))
    is_second = F.try_variant_get(framed, "$[1]", "string") == "_end"
    return is_second & F.try_variant_get(framed, "$[2]", "variant").isNull()


def json_text(c: Column | str) -> Column:
    """The part of a reply that is JSON: the whole, else [ to ], else { to }; else null."""
    raw = strip(c)
    tries = [raw, _between(raw, "[", "]"), _between(raw, "{", "}")]
    return F.coalesce(*[F.when(_is_json(t), t) for t in tries])


def parse_llm_json(c: Column | str) -> Column:
    """A reply parsed as a VARIANT, or null."""
    return F.try_parse_json(json_text(c))


def _kinds(variants: Column) -> Column:
    """STRING, OBJECT, ARRAY or another kind for each element."""
    return F.transform(
        variants, lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    )


def _elements(array_text: Column) -> Column:
    """Elements of a JSON array as array<struct<item, kind>>; objects keep their source text."""
    items = F.from_json(array_text, "array<string>")
    kinds = _kinds(F.from_json(array_text, "array<variant>"))
    return F.zip_with(items, kinds, lambda i, k: F.struct(i.alias("item"), k.alias("kind")))


def _fields(object_text: Column) -> Column:
    """Fields of a JSON object in source order as array<struct<text, kind>>."""
    keys = F.json_object_keys(object_text)
    texts = F.from_json(object_text, "map<string,string>")
    kinds = F.from_json(object_text, "map<string,variant>")

    def one(key: Column) -> Column:
        kind = F.regexp_extract(F.schema_of_variant(F.element_at(kinds, key)), "^[A-Z]+", 0)
        return F.struct(F.element_at(texts, key).alias("text"), kind.alias("kind"))

    return F.transform(keys, one)


def explode_llm_items(
    replies: DataFrame, reply: str = "reply", arrays: str = "first", ordinal: str = "item_no"
) -> DataFrame:
    """One row per item of each reply: (..., ordinal from 1, item, kind).

    An array gives its elements. An object gives the elements of its first array-valued field in
    source order (``arrays='first'``) or of all of them (``'all'``).
    """
    if arrays not in ("first", "all"):
        raise ValueError("arrays must be 'first' or 'all'")
    keep = [c for c in replies.columns if c != reply]
    found = replies.select(*keep, json_text(reply).alias("_json"))
    fields = found.withColumn("_fields", F.when(_opens("{"), _fields(F.col("_json"))))
    lists = F.filter("_fields", lambda f: f["kind"] == "ARRAY")
    wanted = F.slice(lists, 1, 1) if arrays == "first" else lists
    from_object = F.flatten(F.transform(wanted, lambda f: _elements(f["text"])))
    items = F.when(_opens("["), _elements(F.col("_json"))).when(_opens("{"), from_object)
    return (
        fields.select(*keep, F.posexplode_outer(items).alias("_p", "_e"))
        .filter(F.col("_e").isNotNull())
        .select(*keep, (F.col("_p") + 1).alias(ordinal), "_e.item", "_e.kind")
    )


def _opens(mark: str) -> Column:
    return F.col("_json").startswith(mark)


def item_text(items: DataFrame, name: str = "text") -> DataFrame:
    """Add the trimmed text of string items, or of the first non-empty string value of objects;
    items without one are dropped."""
    texts = F.transform(
        F.filter(_fields(F.col("item")), lambda f: f["kind"] == "STRING"),
        lambda f: strip(f["text"]),
    )
    first = F.get(F.filter(texts, lambda t: t != ""), F.lit(0))
    plain = F.when(F.col("kind") == "STRING", strip("item"))
    value = F.when(F.col("kind") == "OBJECT", first).otherwise(plain)
    return items.withColumn(name, value).filter(F.col(name) != "")


def validate_items(items: DataFrame, required: Sequence[str]) -> DataFrame:
    """Object items that have all required keys, as trimmed string columns; blanks are dropped."""
    keep = [c for c in items.columns if c not in ("item", "kind")]
    objects = items.filter(F.col("kind") == "OBJECT").select(
        *keep, F.from_json("item", "map<string,string>").alias("_m")
    )
    typed = objects.select(
        *keep, *[strip(F.try_element_at("_m", F.lit(key))).alias(key) for key in required]
    )
    for key in required:
        typed = typed.filter(F.col(key) != "")
    return typed
