"""The raw retail tables, as views over the test tables.

Whole tables throughout: every customer, part and line item occurs. The generated
tables have no NULLs, no orphan keys and no malformed text, so the views put
some in. The same text runs in Spark and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "customers_raw": """
SELECT CAST(c_custkey AS STRING) AS customer_id,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(1.0 AS DOUBLE) END AS FN,
       CASE WHEN c_custkey % 4 = 0 THEN CAST(1 AS INT) END AS Active,
       CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'PRE-CREATE' WHEN 2 THEN 'LEFT CLUB'
            ELSE 'ACTIVE' END AS club_member_status,
       CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'NONE' WHEN 2 THEN 'None' WHEN 3 THEN 'Monthly'
            ELSE 'Regularly' END AS fashion_news_frequency,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(16 + (c_custkey * 7) % 86 AS INT) END AS age,
       c_mktsegment AS segment
FROM customer""",
    "articles_raw": """
SELECT p_partkey AS article_id, p_name AS prod_name, p_type AS product_type_name,
       p_brand AS product_group_name, CONCAT(p_brand, ' ', p_name) AS detail_desc
FROM part""",
    "transactions_raw": """
SELECT CASE WHEN l_partkey % 101 = 0 THEN NULL
            WHEN l_partkey % 103 = 0 THEN 'no date'
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS t_dat,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            WHEN l_partkey % 89 = 0 THEN CONCAT('X', CAST(o_custkey AS STRING))
            ELSE CAST(o_custkey AS STRING) END AS customer_id,
       CASE WHEN l_orderkey % 43 = 0 THEN -l_partkey ELSE l_partkey END AS article_id,
       l_extendedprice AS price,
       CASE WHEN (l_partkey + l_linenumber) % 10 = 0 THEN NULL
            ELSE CAST(CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 2 END AS INT) END AS sales_channel_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}

# A third and more of the transactions belong to one customer.
HOT_TRANSACTIONS = """
SELECT t_dat, CASE WHEN article_id % 5 < 2 THEN '1' ELSE customer_id END AS customer_id,
       article_id, price, sales_channel_id
FROM transactions_raw"""

TRANSACTIONS_SCHEMA = "t_dat STRING, customer_id STRING, article_id BIGINT, price DOUBLE, sales_channel_id INT"

_TABLES = {
    "customers_raw": ("customer",),
    "articles_raw": ("part",),
    "transactions_raw": ("lineitem", "orders"),
}


def raw(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """One raw table as a frame."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in _TABLES[view]}
    text = VIEWS[view]
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(text, **tables)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "customers_raw")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "articles_raw")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "transactions_raw")


def hot_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        HOT_TRANSACTIONS.replace("transactions_raw", "{transactions_raw}"),
        transactions_raw=transactions(spark, sf_dir),
    )
