"""SQL that computes the same rows as each query, written independently of it."""

from __future__ import annotations

from retailweave.registry.fixtures import HOT_TRANSACTIONS, VIEWS

_CTES = dict(VIEWS)
_CTES["hot_raw"] = HOT_TRANSACTIONS
_CTES["c"] = """
SELECT customer_id, COALESCE(CAST(Active AS VARCHAR), '0') AS active_status,
       COALESCE(club_member_status, 'ACTIVE') AS club_member_status,
       CASE WHEN fashion_news_frequency IS NULL OR fashion_news_frequency IN ('None', 'NONE')
            THEN 'Never' ELSE fashion_news_frequency END AS fashion_news_frequency,
       CAST(age_f AS INTEGER) AS age, segment,
       CASE WHEN age_f >= 0 AND age_f < 22 THEN 'Gen-Z' WHEN age_f >= 22 AND age_f < 38 THEN 'Millennials'
            WHEN age_f >= 38 AND age_f < 54 THEN 'Gen-X' WHEN age_f >= 54 AND age_f < 73 THEN 'Boomers'
            ELSE 'Silent' END AS age_group
FROM (SELECT *, COALESCE(age, (SELECT quantile_disc(age, 0.5) FROM customers_raw)) AS age_f FROM customers_raw)"""
_CTES["t"] = """
SELECT TRY_CAST(t_dat AS DATE) AS t_dat, customer_id, article_id, price,
       COALESCE(sales_channel_id, (SELECT sales_channel_id FROM transactions_raw GROUP BY 1
         ORDER BY COUNT(*) DESC, sales_channel_id ASC NULLS LAST LIMIT 1)) AS sales_channel_id,
       monthname(TRY_CAST(t_dat AS DATE)) AS month, dayname(TRY_CAST(t_dat AS DATE)) AS day,
       CAST(quarter(TRY_CAST(t_dat AS DATE)) AS INTEGER) AS quarter,
       CAST(year(TRY_CAST(t_dat AS DATE)) AS INTEGER) AS year
FROM transactions_raw"""
_CTES["a"] = """
SELECT article_id, prod_name, product_type_name, product_group_name FROM articles_raw"""
_CTES["w"] = """
SELECT article_id, customer_id, t_dat, price, sales_channel_id, month, day, quarter, year,
       active_status, club_member_status, fashion_news_frequency, age, segment, age_group,
       prod_name, product_type_name, product_group_name
FROM (SELECT * FROM t JOIN c USING (customer_id)) JOIN a USING (article_id)"""

_NEEDS = {
    "c": ("customers_raw",),
    "t": ("transactions_raw",),
    "a": ("articles_raw",),
    "hot_raw": ("transactions_raw",),
    "w": ("customers_raw", "articles_raw", "transactions_raw", "c", "t", "a"),
}


def _with(names: str, select: str) -> str:
    """The select behind the CTEs it reads."""
    ctes: dict[str, str] = {}
    for name in names.split():
        for needed in (*_NEEDS.get(name, ()), name):
            ctes[needed] = _CTES[needed]
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n" + select


def _dated(part: str = "") -> str:
    return _with("t", f"SELECT article_id, t_dat{part} FROM t")


def _joined(fact: str) -> str:
    return _with(
        f"customers_raw articles_raw {fact}",
        f"""SELECT f.article_id, f.customer_id, f.t_dat, f.price, f.sales_channel_id,
       c.FN, c.Active, c.club_member_status, c.fashion_news_frequency, c.age, c.segment,
       a.prod_name, a.product_type_name, a.product_group_name, a.detail_desc
FROM {fact} f JOIN customers_raw c ON f.customer_id = c.customer_id
     JOIN articles_raw a ON f.article_id = a.article_id""",
    )


_CUSTOMERS = _with("customers_raw", "SELECT * FROM customers_raw")
_TRANSACTIONS = _with("transactions_raw", "SELECT * FROM transactions_raw")

ORACLES: dict[str, str] = {
    "warehouse": _with("w", "SELECT * FROM w"),
    "src_parquet": "SELECT * FROM customer",
    "src_csv": _TRANSACTIONS,
    "src_csv_inferred": _with(
        "transactions_raw",
        """SELECT t_dat, customer_id, CAST(article_id AS INTEGER) AS article_id, price, sales_channel_id
FROM transactions_raw""",
    ),
    "src_latest_snapshot": _CUSTOMERS,
    "src_latest_snapshot_many_files": _TRANSACTIONS,
    "dat_run_date": _with("customers_raw", "SELECT customer_id, TRUE AS is_today FROM customers_raw"),
    "snk_snapshot_overwrite": _CUSTOMERS,
    "snk_snapshot_append": _with(
        "transactions_raw", "SELECT * FROM transactions_raw UNION ALL SELECT * FROM transactions_raw"
    ),
    "snk_table_append": _with("t", "SELECT * FROM t UNION ALL SELECT * FROM t"),
    "snk_table_overwrite": _with("c", "SELECT * FROM c"),
    "snk_table_overwrite_staged": _with("c", "SELECT * FROM c WHERE age IS NOT NULL"),
    "snk_append_deduplicated": _with("t", "SELECT * FROM t"),
    "snk_snapshot_committed": _CUSTOMERS,
    "lay_file_count": "SELECT CAST(4 AS BIGINT) AS n_files, COUNT(*) AS n_rows FROM lineitem",
    "lay_repartition": _TRANSACTIONS,
    "prj_drop": _with(
        "customers_raw",
        "SELECT customer_id, Active, club_member_status, fashion_news_frequency, age, segment FROM customers_raw",
    ),
    "prj_rename": _with(
        "customers_raw",
        """SELECT customer_id, FN, Active AS active_status, club_member_status, fashion_news_frequency, age, segment
FROM customers_raw""",
    ),
    "prj_select_alias": _with("transactions_raw", "SELECT sales_channel_id AS channel FROM transactions_raw"),
    "prj_casts": _with(
        "transactions_raw",
        """SELECT TRY_CAST(t_dat AS DATE) AS t_dat, CAST(sales_channel_id AS VARCHAR) AS channel_text,
       CAST(trunc(price) AS INTEGER) AS price_int
FROM transactions_raw""",
    ),
    "prd_is_null": _with(
        "transactions_raw",
        "SELECT article_id, customer_id, sales_channel_id IS NULL AS no_channel FROM transactions_raw",
    ),
    "prd_isin": _with(
        "customers_raw",
        "SELECT customer_id, fashion_news_frequency IN ('None', 'NONE') AS no_news FROM customers_raw",
    ),
    "prd_range": _with("customers_raw", "SELECT customer_id, age >= 22 AND age < 38 AS in_range FROM customers_raw"),
    "prd_case_when": _with(
        "customers_raw",
        """SELECT customer_id, CASE WHEN age < 22 THEN 'young' WHEN age < 54 THEN 'middle' ELSE 'other' END AS band
FROM customers_raw""",
    ),
    "cln_impute_median": _with(
        "customers_raw",
        """SELECT customer_id,
       CAST(COALESCE(age, (SELECT quantile_disc(age, 0.5) FROM customers_raw)) AS DOUBLE) AS age
FROM customers_raw""",
    ),
    "cln_active_status": _with(
        "customers_raw",
        "SELECT customer_id, COALESCE(CAST(Active AS VARCHAR), '0') AS active_status FROM customers_raw",
    ),
    "cln_fill_constant": _with(
        "customers_raw",
        "SELECT customer_id, COALESCE(club_member_status, 'ACTIVE') AS club_member_status FROM customers_raw",
    ),
    "cln_replace_values": _with(
        "customers_raw",
        """SELECT customer_id, CASE WHEN fashion_news_frequency IN ('None', 'NONE') THEN 'Never'
       ELSE fashion_news_frequency END AS fashion_news_frequency FROM customers_raw""",
    ),
    "cln_fill_never": _with(
        "customers_raw",
        "SELECT customer_id, COALESCE(fashion_news_frequency, 'Never') AS fashion_news_frequency FROM customers_raw",
    ),
    "cln_age_group": _with(
        "customers_raw",
        """SELECT customer_id, age, CASE WHEN age < 22 THEN 'Gen-Z' WHEN age < 38 THEN 'Millennials'
       WHEN age < 54 THEN 'Gen-X' WHEN age < 73 THEN 'Boomers' ELSE 'Silent' END AS age_group
FROM customers_raw""",
    ),
    "cln_impute_mode": _with(
        "transactions_raw",
        """SELECT t_dat, customer_id, article_id, price,
       COALESCE(sales_channel_id, (SELECT sales_channel_id FROM transactions_raw GROUP BY 1
         ORDER BY COUNT(*) DESC, sales_channel_id ASC NULLS LAST LIMIT 1)) AS sales_channel_id
FROM transactions_raw""",
    ),
    "cln_customers": _with("c", "SELECT * FROM c"),
    "cln_transactions": _with("t", "SELECT * FROM t"),
    "cln_articles": _with("a", "SELECT * FROM a"),
    "dat_to_date": _dated(),
    "dat_month_name": _dated(", month"),
    "dat_day_name": _dated(", day"),
    "dat_quarter": _dated(", quarter"),
    "dat_year": _dated(", year"),
    "agg_exact_quantile": _with(
        "customers_raw", "SELECT CAST(quantile_disc(age, 0.5) AS DOUBLE) AS value FROM customers_raw"
    ),
    "agg_exact_quantile_many_values": "SELECT quantile_disc(l_extendedprice, 0.5) AS value FROM lineitem",
    "agg_group_count": _with(
        "transactions_raw",
        'SELECT sales_channel_id, COUNT(*) AS "count" FROM transactions_raw GROUP BY sales_channel_id',
    ),
    "agg_mode": _with(
        "transactions_raw",
        """SELECT sales_channel_id FROM transactions_raw GROUP BY sales_channel_id
ORDER BY COUNT(*) DESC, sales_channel_id ASC NULLS LAST LIMIT 1""",
    ),
    "srt_order_desc": _with(
        "transactions_raw",
        """SELECT sales_channel_id, COUNT(*) AS "count" FROM transactions_raw GROUP BY sales_channel_id
ORDER BY COUNT(*) DESC""",
    ),
    "lim_top_k": _with(
        "transactions_raw",
        """SELECT article_id, COUNT(*) AS "count" FROM transactions_raw GROUP BY article_id
ORDER BY COUNT(*) DESC, article_id ASC NULLS LAST LIMIT 10""",
    ),
    "jon_broadcast": _joined("transactions_raw"),
    "jon_shuffle": _joined("transactions_raw"),
    "jon_shuffle_hot_key": _joined("hot_raw"),
    "jon_merge": _joined("transactions_raw"),
    "jon_same_key_dimensions": _with(
        "customers_raw hot_raw",
        """SELECT f.customer_id, f.article_id, f.price, x.age, y.segment FROM hot_raw f
JOIN (SELECT customer_id, age FROM customers_raw WHERE age IS NOT NULL) x ON x.customer_id = f.customer_id
JOIN customers_raw y ON y.customer_id = f.customer_id""",
    ),
    "jon_binary_key": _with(
        "customers_raw hot_raw",
        """SELECT f.customer_id, f.article_id, f.price, c.segment
FROM hot_raw f JOIN customers_raw c ON c.customer_id = f.customer_id""",
    ),
    "src_csv_quarantine": _with(
        "transactions_raw",
        """SELECT CASE WHEN article_id % 11 = 0 OR article_id % 13 = 0 OR article_id % 17 = 0 THEN 'malformed'
                       WHEN t_dat IS NOT NULL AND TRY_CAST(t_dat AS DATE) IS NULL THEN 't_dat' ELSE 'kept' END AS reason,
                  COUNT(*) AS n,
                  CASE WHEN reason = 'kept' THEN CAST(SUM(article_id) AS BIGINT) END AS articles
           FROM transactions_raw GROUP BY reason""",
    ),
    "src_schema_drift": _with(
        "customers_raw",
        """SELECT customer_id, CAST(age AS BIGINT) AS age, Active AS active, NULL AS segment FROM customers_raw
           UNION ALL SELECT customer_id, age, NULL, segment FROM customers_raw
           UNION ALL SELECT customer_id, age, NULL, segment FROM customers_raw""",
    ),
    "jon_bucketed": _with(
        "customers_raw transactions_raw", "SELECT f.*, c.segment FROM transactions_raw f JOIN customers_raw c ON f.customer_id = c.customer_id"
    ),
    "jon_bucketed_hot_key": _with("customers_raw hot_raw", "SELECT f.*, c.segment FROM hot_raw f JOIN customers_raw c ON f.customer_id = c.customer_id"),
    "jon_accounting": _with(
        "customers_raw articles_raw transactions_raw",
        """, f AS (SELECT t.*, c.customer_id IS NOT NULL AS has_customer, a.article_id IS NOT NULL AS has_article
                   FROM transactions_raw t LEFT JOIN customers_raw c ON c.customer_id = t.customer_id
                   LEFT JOIN articles_raw a ON a.article_id = t.article_id)
           SELECT unnest(['rows_in', 'null_keys', 'null_customer_id', 'null_article_id', 'orphans_customer_id', 'orphans_article_id', 'rows_out',
                          'rows', 'filled_sales_channel_id', 'undated_t_dat']) AS metric,
                  unnest([COUNT(*), COUNT(*) FILTER (WHERE customer_id IS NULL OR article_id IS NULL), COUNT(*) FILTER (WHERE customer_id IS NULL),
                          COUNT(*) FILTER (WHERE article_id IS NULL), COUNT(*) FILTER (WHERE customer_id IS NOT NULL AND NOT has_customer),
                          COUNT(*) FILTER (WHERE has_customer AND NOT has_article), COUNT(*) FILTER (WHERE has_customer AND has_article), COUNT(*),
                          COUNT(*) FILTER (WHERE sales_channel_id IS NULL),
                          COUNT(*) FILTER (WHERE t_dat IS NOT NULL AND TRY_CAST(t_dat AS DATE) IS NULL)]) AS n
           FROM f""",
    ),
    "pip_load_historic": _with("w", "SELECT * FROM w"),
    "pip_load_live": _with("w", "SELECT * FROM w"),
    "pip_extract_incremental": _with(
        "transactions_raw", "SELECT TRY_CAST(t_dat AS DATE) AS t_dat, customer_id, article_id, price, sales_channel_id FROM transactions_raw"
    ),
    "pip_live_incremental": _with("t", "SELECT t_dat, customer_id, article_id, price FROM t"),
    "pip_historic_resumed": _with("w", "SELECT * FROM w"),
    "pip_historic": _with("t", "SELECT * FROM t"),
    "pip_historic_then_live": _with(
        "w",
        """SELECT 'warehouse' AS table_name, 2 * COUNT(*) AS n_rows FROM w
UNION ALL SELECT 'customers', COUNT(*) FROM c
UNION ALL SELECT 'articles', COUNT(*) FROM a
UNION ALL SELECT 'transactions', 2 * COUNT(*) FROM t""",
    ),
    "pip_historic_then_live_transactions": _with("t", "SELECT * FROM t UNION ALL SELECT * FROM t"),
}
