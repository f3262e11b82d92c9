"""The scalar functions for Spark SQL: text functions as SQL expressions, similarities as Arrow UDFs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .functions import similarity
from .functions.text import _folding


def register(spark: SparkSession) -> None:
    """Registers normalize_text, match_name, clean_document, jaro_winkler and name_similarity for the session."""
    a, b = _folding()
    spaces = r"(?U)[\s\x{1C}-\x{1F}]+"
    folded = f"regexp_replace(translate(value, '{a}', '{b}'), r'\\p{{Mn}}+', '')"
    upper = f"upper(regexp_replace({folded}, r'{spaces}', ' '))"
    normal = f"nullif(regexp_replace({upper}, r'^ | $', ''), '')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION normalize_text(value STRING) RETURNS STRING RETURN {normal}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION match_name(value STRING) RETURNS STRING RETURN nullif(trim(regexp_replace({normal}, '[^A-Z ]', '')), '')")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION clean_document(value STRING) RETURNS STRING RETURN if(length(value) > 0, regexp_replace(upper(value), r'[\s\-.]', ''), NULL)")
    spark.udf.register("name_similarity", similarity.name_similarity_udf())
    spark.udf.register("jaro_winkler", similarity.jaro_winkler_udf())
