"""SQL surface: helper functions as Spark SQL functions.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` defines a SQL function that
Spark inlines into the plan (no Python, stays inside whole-stage codegen).
Two statements have to be written differently than before:

* a field of a JSON object by its name is ``json_field(json, field)``: the
  two-argument ``get_json_object`` is Spark's own and takes a path;
* SQL functions cannot be aggregates, so the distinct concatenation is Spark's
  own ``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``, or
  ``array_join(array_sort(collect_set(x)), ',')`` (see
  :func:`shoplens.functions.columns.distinct_joined`).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    # Id + separator + name
    "concat_cid_cname": (
        "id BIGINT, name STRING, separator STRING",
        "STRING",
        "concat_ws(separator, CAST(id AS STRING), name)",
    ),
    # One field of a JSON object by name (the built-in needs a '$.' path)
    "json_field": (
        "json STRING, field STRING",
        "STRING",
        "get_json_object(json, concat('$.', field))",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (args, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
