"""Record schemas of the page and link tables and of the rule list."""

from pyspark.sql import types as T

PAGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("meta_description", T.StringType()),
    T.StructField("html_content", T.StringType()),
    T.StructField("content_length", T.IntegerType()),
    T.StructField("link_depth", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("content_hash", T.StringType()),
])

LINK_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("normalized_url", T.StringType()),
    T.StructField("anchor_text", T.StringType()),
    T.StructField("rel", T.StringType()),
    T.StructField("is_external", T.BooleanType(), False),
    T.StructField("discovered_at", T.TimestampType(), False),
    T.StructField("pred_category", T.StringType()),
])

RULE_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("pattern", T.StringType()),
    T.StructField("flags", T.ArrayType(T.StringType())),
])
