"""Tool definitions in their several forms, as columns of JSON text. What isn't a list of objects gives null or is left out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameter types and their names in JSON schemas.
JSON_TYPES = {"str": "string", "string": "string", "int": "integer", "integer": "integer", "float": "number", "number": "number", "bool": "boolean", "boolean": "boolean", "list": "array", "array": "array", "dict": "object", "object": "object"}


def _objects(x: Column) -> Column:
    """The objects of a JSON list, or a JSON object alone, each as JSON text; null for other text."""
    t = F.trim(x)
    listed = F.when(t.startswith("{"), F.concat(F.lit("["), t, F.lit("]"))).when(t.startswith("["), t)
    return F.filter(F.from_json(listed, "array<string>"), lambda o: F.json_object_keys(o).isNotNull())


def _entries(x: Column) -> Column:
    """The entries of a JSON object, values as JSON text; none for other text."""
    return F.coalesce(F.from_json(F.when(F.json_object_keys(x).isNotNull(), x), "map<string,string>"), F.create_map().cast("map<string,string>"))


def _of(x: Column, key: str, otherwise: str | Column) -> Column:
    return F.coalesce(F.get_json_object(x, f"$.{key}"), F.lit(otherwise) if isinstance(otherwise, str) else otherwise)


def openai_tools(x: Column | str) -> Column:
    """Flat tool definitions (a JSON list or one object) in the function-calling form; parameters without a default are required."""
    kinds = F.create_map(*(F.lit(v) for p in JSON_TYPES.items() for v in p))

    def schema(_, p: Column) -> Column:
        whole = F.json_object_keys(p).isNotNull()
        kind = F.coalesce(F.try_element_at(kinds, F.lower(_of(p, "type", "string"))), F.lit("string"))
        return F.struct(F.when(whole, kind).otherwise("string").alias("type"), F.when(whole, _of(p, "description", "")).otherwise(F.coalesce(p, F.lit(""))).alias("description"))

    def needed(_, p: Column) -> Column:
        keys = F.json_object_keys(p)
        return F.coalesce(~F.array_contains(keys, "default") | (F.get_json_object(p, "$.default") == ""), F.lit(False))

    def tool(o: Column) -> Column:
        name, parameters = _of(o, "name", "unknown"), _entries(F.get_json_object(o, "$.parameters"))
        shape = F.struct(F.lit("object").alias("type"), F.transform_values(parameters, schema).alias("properties"), F.map_keys(F.map_filter(parameters, needed)).alias("required"))
        function = F.struct(name.alias("name"), _of(o, "description", F.concat(F.lit("Execute "), name)).alias("description"), shape.alias("parameters"))
        return F.struct(F.lit("function").alias("type"), function.alias("function"))

    return F.to_json(F.transform(_objects(F.col(x) if isinstance(x, str) else x), tool))


def hermes_tools(x: Column) -> Column:
    """Function-calling definitions, wrapped or bare, as flat ones: each parameter's description and type."""

    def tool(o: Column) -> Column:
        f = _of(o, "function", o)
        flat = F.transform_values(_entries(F.get_json_object(f, "$.parameters.properties")), lambda _, p: F.struct(_of(p, "description", "").alias("description"), _of(p, "type", "string").alias("type")))
        return F.struct(_of(f, "name", "unknown").alias("name"), _of(f, "description", "").alias("description"), flat.alias("parameters"))

    return F.to_json(F.transform(_objects(x), tool))


def prompt_tools(system: Column) -> Column:
    """The first JSON list in a prompt's <tools> blocks, its entries in the function-calling form; null without one."""
    blocks = F.regexp_extract_all(F.coalesce(system, F.lit("")), F.lit(r"(?s)<tools>\s*(.*?)\s*</tools>"), 1)
    lists = F.filter(blocks, lambda b: b.startswith("[") & F.try_parse_json(b).isNotNull())
    wrapped = F.transform(F.from_json(F.get(lists, F.lit(0)), "array<string>"), lambda o: F.when(F.get_json_object(o, "$.type") == "function", o).otherwise(F.concat(F.lit('{"type":"function","function":'), o, F.lit("}"))))
    return F.concat(F.lit("["), F.array_join(wrapped, ","), F.lit("]"))
