"""Contract of JSON properties: which are there, of which type, and which nobody has declared.

A contract names required and optional properties with their types, alternatives split by ``|``: string, integer, number,
boolean, object, null. Properties are read as VARIANT values, so a text that looks like a number stays a text, a truth
value is no integer, and a missing property differs from one that is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Types of a VARIANT value that a declared type takes.
TYPES = {"string": "STRING", "integer": r"BIGINT|DECIMAL\([0-9]+,0\)", "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9]+,[0-9]+\)", "boolean": "BOOLEAN", "object": "OBJECT<.*>", "null": "VOID"}


def _type(value: Column, name: str) -> Column:
    """The type of a property, null where it is absent."""
    if "'" in name and '"' in name:
        raise ValueError(f"no path to a property with both kinds of quotes: {name}")
    path = f'$["{name}"]' if "'" in name else f"$['{name}']"
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def checked(rows: DataFrame, json: str, required: dict[str, str], optional: dict[str, str]) -> DataFrame:
    """The rows with ``violations``, an array of (property, violation): ``missing``, ``type``, or ``unreadable`` with the
    property null where the text is no JSON object; and ``undeclared``, the other properties in order. A null text is
    unreadable."""
    # A property may be named twice; such a text is no readable object either.
    value, rows = F.col("_value"), rows.withColumn("_value", F.try_parse_json(json))
    violation = lambda name, kind: F.struct(F.lit(name).cast("string").alias("property"), F.lit(kind).alias("violation"))
    found = []
    for name, kinds in {**required, **optional}.items():
        kind = _type(value, name)
        fits = kind.rlike("^(" + "|".join(TYPES[k] for k in kinds.split("|")) + ")$")
        absent = violation(name, "missing") if name in required else F.lit(None)
        found.append(F.when(kind.isNull(), absent).when(~fits, violation(name, "type")))
    keys = F.json_object_keys(json)
    good = value.isNotNull() & F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    declared = F.array(*[F.lit(n) for n in {**required, **optional}]).cast("array<string>")
    out = rows.withColumn("violations", F.when(good, F.array_compact(F.array(*found))).otherwise(F.array(violation(None, "unreadable"))))
    return out.withColumn("undeclared", F.when(good, F.array_sort(F.array_except(keys, declared))).otherwise(F.array().cast("array<string>"))).drop("_value")


def violations(rows: DataFrame, json: str, required: dict[str, str], optional: dict[str, str]) -> DataFrame:
    """Rows by property and violation, undeclared properties among them."""
    other = F.transform("undeclared", lambda k: F.struct(k.alias("property"), F.lit("undeclared").alias("violation")))
    each = checked(rows, json, required, optional).select(F.explode(F.concat("violations", other)).alias("v"))
    return each.groupBy("v.property", "v.violation").agg(F.count(F.lit(1)).alias("rows"))
