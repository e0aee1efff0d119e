"""The expressions as SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .text import EDGE, FORBIDDEN_IN_XML, INVISIBLE


def _quoted(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


SQL_FUNCTIONS = {
    "clean_text(x STRING)": f"nullif(trim(regexp_replace(regexp_replace(x, {_quoted(INVISIBLE)}, ''), '(?U)\\\\s+', ' ')), '')",
    "xml_repaired(x STRING)": f"regexp_replace(x, {_quoted(FORBIDDEN_IN_XML)}, '')",
    "leaf_of(x STRING)": "nullif(regexp_extract(x, '([^/]+)$', 1), '')",
    "iso_week(t TIMESTAMP)": "concat(lpad(cast(extract(YEAROFWEEK from t) as string), 4, '0'), '-W', lpad(cast(weekofyear(t) as string), 2, '0'))",
    "word_tokens(x STRING)": "filter(split(trim(x), '(?U)\\\\s+'), t -> t <> '')",
    "bare_term(x STRING)": f"trim(BOTH {_quoted(EDGE)} FROM x)",
}


def register(spark: SparkSession) -> list[str]:
    """Makes them temporary SQL functions of the session; returns their names."""
    for head, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in SQL_FUNCTIONS]
