"""Rule templates and rule configurations kept as JSON documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATE = (
    "struct<id:string,name:string,description:string,severity:string,"
    "validation_code:string,validation_code_sql:string>"
)
CONFIG = (
    "struct<rule_id:string,table_name:string,column_name:string,description:string,"
    "python_code:string,sql_code:string,severity:string,category:string,last_updated:string,"
    "is_active:boolean,activated_at:string,deactivated_at:string>"
)


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file."""
    return spark.read.text(path, wholetext=True)


def load_rule_templates(spark: SparkSession, path: str) -> DataFrame:
    """Flatten ``category -> [rule]`` and ``category -> subcategory -> [rule]`` into rows."""
    categories = _documents(spark, path).select(
        F.explode(F.from_json("value", "map<string,string>")).alias("category", "body")
    )
    is_list = F.ltrim("body").startswith("[")
    direct = categories.where(is_list).select(
        "category",
        F.lit(None).cast("string").alias("subcategory"),
        F.inline(F.from_json("body", f"array<{TEMPLATE}>")),
    )
    nested = (
        categories.where(~is_list)
        .select(
            "category",
            F.explode(F.from_json("body", f"map<string,array<{TEMPLATE}>>")).alias("subcategory", "rules"),
        )
        .select("category", "subcategory", F.inline("rules"))
    )
    return direct.unionByName(nested)


def load_rule_configs(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of ``{"rule_configs": {config_key: {...}}}``.

    A missing ``is_active`` counts as active.
    """
    return (
        _documents(spark, path)
        .select(
            F.explode(
                F.from_json("value", f"struct<rule_configs:map<string,{CONFIG}>>")["rule_configs"]
            ).alias("config_key", "config")
        )
        .select("config_key", "config.*")
        .withColumn("is_active", F.coalesce("is_active", F.lit(True)))
    )
