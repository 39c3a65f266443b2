"""SQL surface: the reference's registered functions as Spark SQL functions.

``concat_long_string`` (G1) and ``get_json_field`` (G3) become SQL-bodied
temporary functions, which Catalyst inlines into the plan (no Python, no JVM
UDF call). The distinct group concatenation (G2) takes the group's values as an
array: ``group_concat_distinct(collect_set(x))``; a SQL function can't wrap an
aggregate itself.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "concat_long_string": (
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v1 BIGINT, v2 STRING, sep STRING) "
        "RETURNS STRING RETURN concat(CAST(v1 AS STRING), sep, v2)"
    ),
    "group_concat_distinct": (
        "CREATE OR REPLACE TEMPORARY FUNCTION group_concat_distinct(items ARRAY<STRING>) "
        "RETURNS STRING RETURN array_join(array_sort(array_distinct(items)), ',')"
    ),
    "get_json_field": (
        "CREATE OR REPLACE TEMPORARY FUNCTION get_json_field(js STRING, field STRING) "
        "RETURNS STRING RETURN get_json_object(js, concat('$.', field))"
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the SQL functions in this session; returns their names."""
    for stmt in SQL_FUNCTIONS.values():
        spark.sql(stmt)
    return list(SQL_FUNCTIONS)
