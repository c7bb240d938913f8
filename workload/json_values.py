"""Values inside JSON: kinds, casts, null against missing, and fields of changing type."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import json_values as J
from workload.registry import query, table


@query("json_polymorphic", """
    SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 3 THEN NULL
           ELSE string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) END AS flags
    FROM lineitem GROUP BY 1
""")
def json_polymorphic(spark, sf_dir):
    """Flags of an order: a null for three, an array for two, a plain text for one."""
    found = lambda f: F.max(F.when(F.col("l_returnflag") == f, f))
    flags = F.array_compact(F.array(found("A"), found("N"), found("R")))
    quoted = F.concat(F.lit('"'), F.element_at("flags", 1), F.lit('"'))
    value = F.when(F.size("flags") == 3, "null").when(F.size("flags") == 1, quoted).otherwise(
        F.to_json("flags")
    )
    doc = F.parse_json(F.concat(F.lit('{"flags": '), value, F.lit("}")))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(flags.alias("flags"))
    return lines.select("l_orderkey", J.joined_text(J.json_value(doc, "$.flags")).alias("flags"))


@query("json_null_vs_missing", """
    SELECT c_custkey,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'MISSING' WHEN c_acctbal < 0 THEN 'NULL'
                WHEN c_mktsegment = 'MACHINERY' THEN 'VARCHAR' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ARRAY'
                WHEN c_mktsegment = 'FURNITURE' THEN 'OBJECT' ELSE 'BIGINT' END AS kind,
           CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal < 0 THEN NULL
                WHEN c_mktsegment = 'MACHINERY' THEN c_name
                WHEN c_mktsegment = 'HOUSEHOLD' THEN '[' || c_nationkey || ',"x"]'
                WHEN c_mktsegment = 'FURNITURE' THEN '{"n":' || c_nationkey || '}'
                ELSE c_nationkey::VARCHAR END AS text
    FROM customer
""")
def json_null_vs_missing(spark, sf_dir):
    nation, segment = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    value = (
        F.when(F.col("c_acctbal") < 0, "null")
        .when(segment == "MACHINERY", F.concat(F.lit('"'), "c_name", F.lit('"')))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("["), nation, F.lit(', "x"]')))
        .when(segment == "FURNITURE", F.concat(F.lit('{"n": '), nation, F.lit("}")))
        .otherwise(nation)
    )
    doc = F.when(segment == "BUILDING", F.lit("{}")).otherwise(
        F.concat(F.lit('{"v": '), value, F.lit("}"))
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.parse_json(doc).alias("doc"))
    return rows.select(
        "c_custkey",
        J.json_kind(J.json_value(F.col("doc"), "$.v")).alias("kind"),
        J.json_text(F.col("doc"), "$.v").alias("text"),
    )


@query("json_typed_cast", """
    SELECT p_partkey, p_size AS plain, p_size AS quoted, TRY_CAST(p_retailprice::VARCHAR AS INT) AS from_text,
           TRY_CAST(to_json(p_retailprice) AS INT) AS from_number,
           TRY_CAST(p_name AS INT) AS unreadable, p_size > 25 AS flag, p_size > 10 AS quoted_flag
    FROM part
""")
def json_typed_cast(spark, sf_dir):
    quoted = F.struct(
        F.col("p_size").alias("plain"), F.col("p_size").cast("string").alias("quoted"),
        F.col("p_retailprice").cast("string").alias("price_text"),
        F.col("p_retailprice").alias("price"), F.col("p_name").alias("name"),
        (F.col("p_size") > 25).alias("flag"), (F.col("p_size") > 10).cast("string").alias("quoted_flag"),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", F.parse_json(F.to_json(quoted)).alias("v"))
    get = lambda f: J.json_value(F.col("v"), f"$.{f}")
    text = lambda f: J.json_text(F.col("v"), f"$.{f}")
    return rows.select(
        "p_partkey",
        J.json_to_int(get("plain")).alias("plain"), J.json_to_int(get("quoted")).alias("quoted"),
        J.text_to_int(text("price_text")).alias("from_text"),
        J.json_to_int(get("price")).alias("from_number"),
        J.text_to_int(text("name"), strict=False).alias("unreadable"),
        J.json_to_boolean(get("flag")).alias("flag"),
        J.json_to_boolean(get("quoted_flag")).alias("quoted_flag"),
    )


@query("version_timestamp", "SELECT event_id, ts AS version FROM events")
def version_timestamp(spark, sf_dir):
    """ISO texts with an offset, back to the UTC wall clock."""
    text = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    doc = F.to_json(F.struct(F.struct(text.alias("retrieved_at")).alias("metadata")))
    version = J.utc_timestamp(F.get_json_object(doc, "$.metadata.retrieved_at"))
    return table(spark, sf_dir, "events").select("event_id", version.alias("version"))
