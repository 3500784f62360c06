"""Reading JSON whose keys are not known in advance, as VARIANT."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parsed(text: Column) -> Column:
    """JSON text as VARIANT; broken text gives null, not an error."""
    return F.try_parse_json(text)


def as_object(value: Column, path: str = "$") -> Column:
    """Key -> value map of an object; null for anything that is not an object."""
    return F.try_variant_get(value, path, "map<string,variant>")


def as_list(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def as_text(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "string")


def has_key(obj: Column, key: str) -> Column:
    return F.map_contains_key(obj, key)


def member(obj: Column, key: str) -> Column:
    return F.try_element_at(obj, F.lit(key))


def member_text(obj: Column, key: str) -> Column:
    return as_text(member(obj, key))


def get_or(obj: Column, key: str, fallback: Column) -> Column:
    """Text of a key; the fallback only where the key is missing, not where it is null."""
    return F.when(has_key(obj, key), member_text(obj, key)).otherwise(fallback)


def first_present(obj: Column, keys: list[str], fallback: Column) -> Column:
    out = fallback
    for key in reversed(keys):
        out = get_or(obj, key, out)
    return out


NODE_TYPE = T.ArrayType(
    T.StructType()
    .add("path", T.StringType())
    .add("kind", T.StringType())
    .add("items", T.IntegerType())
    .add("type", T.StringType())
    .add("id", T.StringType())
)
_NODE = pa.struct(
    [("path", pa.string()), ("kind", pa.string()), ("items", pa.int32()), ("type", pa.string()), ("id", pa.string())]
)


def _walk(root):
    """Nodes in document order, from a stack, so that depth does not matter."""
    out, open_values = [], [(root, "$")]
    while open_values:
        value, path = open_values.pop()
        if isinstance(value, dict):
            node_type, node_id = value.get("type"), value.get("id")
            out.append((path, "object", len(value), node_type if isinstance(node_type, str) else None,
                        None if node_id is None else _id_text(node_id)))
            open_values.extend((inner, f"{path}.{key}") for key, inner in reversed(value.items()))
        elif isinstance(value, list):
            out.append((path, "array", len(value), None, None))
            open_values.extend((inner, path + "[]") for inner in reversed(value))
        else:
            kind = {str: "string", bool: "boolean", type(None): "null"}.get(type(value), "number")
            out.append((path, kind, None, None, None))
    return out


def _id_text(value):
    try:
        return str(value)
    except RecursionError:  # an id that is itself a deep tree
        return None


def _tree(text):
    """The nodes of a text; none if it is broken, or nested deeper than the interpreter reads (thousands of levels)."""
    try:
        return _walk(json.loads(text))
    except (TypeError, ValueError, RecursionError):
        return None


def _nodes_of(text):
    nodes = _tree(text)
    return None if nodes is None else [dict(zip(("path", "kind", "items", "type", "id"), node)) for node in nodes]


def _ids_of(text: str, node_type: str) -> list[str] | None:
    """Distinct ids of one type in document order; of a text's nodes only open values and found ids are held."""
    try:
        found, open_values = {}, [json.loads(text)]
    except (TypeError, ValueError, RecursionError):
        return None
    while open_values:
        value = open_values.pop()
        if isinstance(value, dict):
            node_id = value.get("id")
            if value.get("type") == node_type and node_id is not None:
                found[_id_text(node_id)] = None
            open_values.extend(v for v in reversed(value.values()) if isinstance(v, (dict, list)))
        elif isinstance(value, list):
            open_values.extend(v for v in reversed(value) if isinstance(v, (dict, list)))
    found.pop(None, None)
    return list(found)


def typed_ids(payload: Column, node_type: str) -> Column:
    """Distinct ids of the objects of one type, in document order; only they leave Python.

    A walk of the text, because VARIANT keeps the keys of an object sorted, not in the order
    of the document, and reads no more than 1,000 levels.
    """

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def walked(texts: pa.Array) -> pa.Array:
        return pa.array([_ids_of(text.as_py(), node_type) for text in texts], pa.list_(pa.string()))

    return walked(payload)


_OBJECT, _LIST = "try_variant_get({v}, '$', 'map<string,variant>')", "try_variant_get({v}, '$', 'array<variant>')"


def _seen(more: str) -> str:
    """The kind of a value v, how many items it has, and itself where `more` holds and something is below it."""
    fields, items = _OBJECT.format(v="v"), _LIST.format(v="v")
    return f"""CASE WHEN {fields} IS NOT NULL THEN 'object' WHEN {items} IS NOT NULL THEN 'array'
        ELSE CASE schema_of_variant(v) WHEN 'STRING' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VOID' THEN 'null' ELSE 'number' END END AS kind,
      coalesce(size({fields}), size({items})) AS items,
      CASE WHEN {more} AND (size({fields}) > 0 OR size({items}) > 0) THEN v END AS v"""


def _below(path: str, v: str, opened: str) -> str:
    """The values right below a value, with their paths; none below a plain one."""
    fields, items = _OBJECT.format(v=v), _LIST.format(v=v)
    child = lambda at, value: f"named_struct('path', {path} || {at}, 'v', {value}, 'opened', {opened})"
    return f"""coalesce(transform(map_entries({fields}), f -> {child("'.' || f.key", "f.value")}), transform({items}, x -> {child("'[]'", "x")}),
      CAST(array() AS ARRAY<STRUCT<path: STRING, v: VARIANT, opened: BOOLEAN>>))"""


def every_node(df: DataFrame, payload: str) -> DataFrame:
    """(path, kind, items) of all nodes of JSON texts, two levels in each step of a recursive query, as VARIANT.

    Every step puts what it hands on through an exchange: of two levels the lower one only, each
    value once, and only those that have something below them. Texts that are broken, or nested
    beyond VARIANT's 1,000 levels, have no nodes. The step stops when nothing is left to explode;
    `session.SETTINGS` lift Spark's limits on it.
    """
    roots = df.select(parsed(F.col(payload)).alias("v")).filter("v IS NOT NULL")
    return df.sparkSession.sql(
        f"""WITH RECURSIVE node(path, kind, items, v) AS (
          SELECT '$' AS path, {_seen('true')} FROM {{roots}}
          UNION ALL
          SELECT path, {_seen('NOT opened')} FROM (
            SELECT n.path, n.v, n.opened FROM (
              SELECT explode(flatten(transform({_below('path', 'v', 'true')}, c -> concat(array(c), {_below('c.path', 'c.v', 'false')})))) AS n
              FROM node WHERE v IS NOT NULL)))
        SELECT path, kind, items FROM node""",
        roots=roots,
    )


@F.arrow_udf(NODE_TYPE)
def json_nodes(texts: pa.Array) -> pa.Array:
    """Every node of a JSON tree, in document order and of depths that VARIANT does not read (Arrow batches)."""
    return pa.array([_nodes_of(t) for t in texts.to_pylist()], type=pa.list_(_NODE))
