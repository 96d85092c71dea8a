"""Definition diff: two tables of (name, JSON text) compared by name.

Each definition is parsed into ``map<string, variant>``; every value is
rendered back with ``to_json``, which writes object keys in sorted order,
so two texts that differ only in key order compare equal.  A field is
changed when it is only on one side or its
canonical text differs (this also catches type changes, such as 7 against
"7").  A changed field that is an object on both sides is opened, level by
level, and the changes are named by their path (``a.b``).  A field that
holds a list is compared without regard to the order of its items, unless
``list_order`` is set.  Text that does not parse, or is not a JSON object,
yields the one marker field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentflow.config import ensure_checkpoint_dir
from segmentflow.functions.columns import sorted_distinct

# The actions and the marker field used when a definition
# cannot be parsed.
CREATE = "CREATE"
UPDATE = "UPDATE"
NO_CHANGE = "NO CHANGE"
WHOLE_DEFINITION = "<entire policy definition>"


def parse_definition(text: Column) -> Column:
    """JSON object text to ``map<string, variant>``; NULL when the text is
    not valid JSON or not an object."""
    return F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")


def canonical(value: Column, list_order: bool = False) -> Column:
    """Canonical JSON text of a variant; a list's items sorted by theirs."""
    text = F.to_json(value)
    if list_order:
        return text
    items = F.try_variant_get(value, "$", "array<variant>")
    joined = F.array_join(F.array_sort(F.transform(items, lambda x: F.coalesce(F.to_json(x), F.lit("null")))), ",")
    return F.when(items.isNotNull(), F.concat(F.lit("["), joined, F.lit("]"))).otherwise(text)


def changed_fields(source: Column, target: Column, list_order: bool = False) -> Column:
    """Sorted top-level fields whose canonical value differs between two
    parsed definitions (``json_field_diff``)."""
    keys = F.array_distinct(F.concat(F.map_keys(source), F.map_keys(target)))
    differs = F.filter(
        keys,
        lambda k: (F.map_contains_key(source, k) != F.map_contains_key(target, k))
        | ~canonical(F.element_at(source, k), list_order).eqNullSafe(canonical(F.element_at(target, k), list_order)),
    )
    return sorted_distinct(differs)


def nested_paths(pairs: DataFrame, list_order: bool = False) -> DataFrame:
    """``name`` and the ``path`` of each change below the changed fields
    ``(name, path, s, t)`` (the variants of both sides).

    A pass opens the objects of one level: their keys that differ are the
    next level's fields, all others are done.  So there is one pass for each
    level that holds a change, and equal parts are never opened."""
    ensure_checkpoint_dir(pairs.sparkSession)
    as_map = lambda c: F.try_variant_get(c, "$", "map<string,variant>")
    done = None
    while True:
        level = pairs.select("name", "path", as_map("s").alias("sm"), as_map("t").alias("tm")).checkpoint()
        both = F.col("sm").isNotNull() & F.col("tm").isNotNull()
        leaves = level.filter(~both).select("name", "path")
        done = leaves if done is None else done.union(leaves)
        inner = level.filter(both)
        if inner.isEmpty():
            return done
        keys = F.explode(changed_fields(F.col("sm"), F.col("tm"), list_order)).alias("k")
        inner = inner.select("name", "path", keys, "sm", "tm")
        value = lambda m: F.try_element_at(m, F.col("k"))
        pairs = inner.select("name", F.concat_ws(".", "path", "k").alias("path"), value("sm").alias("s"), value("tm").alias("t"))


def definition_diff(source: DataFrame, target: DataFrame, name: str = "name",
                    definition: str = "definition", list_order: bool = False) -> DataFrame:
    """Per source name: ``CREATE`` when the target lacks it, ``UPDATE`` with
    the sorted paths of the changes, or ``NO CHANGE``.  Names only in the target
    are ignored (``definition_lookup`` is the LEFT join)."""
    # Each text is parsed once, into a column, before the join: inside the
    # array lambda below the parse would otherwise run once per key.
    s = source.select(F.col(name).alias("name"), parse_definition(F.col(definition)).alias("_sm"))
    t = target.select(
        F.col(name).alias("_tname"), parse_definition(F.col(definition)).alias("_tm")
    )
    j = s.join(t, F.col("name") == F.col("_tname"), "left")
    sm, tm = F.col("_sm"), F.col("_tm")
    fields = F.when(sm.isNull() | tm.isNull(), F.array(F.lit(WHOLE_DEFINITION))).otherwise(
        changed_fields(sm, tm, list_order)
    )
    found = F.col("_tname").isNotNull()
    parsed = sm.isNotNull() & tm.isNotNull()
    j = j.select("name", found.alias("_found"), fields.alias("_fields"), F.when(found & parsed, sm).alias("_sm"), F.when(found & parsed, tm).alias("_tm"))
    pairs = j.filter("_sm is not null").select("name", F.explode("_fields").alias("path"), "_sm", "_tm")
    side = lambda m: F.try_element_at(m, F.col("path"))
    paths = nested_paths(pairs.select("name", "path", side("_sm").alias("s"), side("_tm").alias("t")), list_order)
    paths = paths.groupBy(F.col("name").alias("_name")).agg(F.sort_array(F.collect_set("path")).alias("_paths"))
    j = j.join(paths, F.col("name") == F.col("_name"), "left")
    none = F.array().cast("array<string>")
    opened = F.when(F.col("_sm").isNull(), F.col("_fields")).otherwise(F.coalesce("_paths", none))
    return j.select("name", "_found", opened.alias("_fields")).select(
        "name",
        F.when(~F.col("_found"), F.lit(CREATE))
        .when(F.size("_fields") > 0, F.lit(UPDATE))
        .otherwise(F.lit(NO_CHANGE))
        .alias("action"),
        F.when(F.col("_found") & (F.size("_fields") > 0), F.col("_fields")).alias("changed_fields"),
    )
