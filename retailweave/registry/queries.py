"""One named query per operator. Each reads its tables whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retailweave.functions import columns, statistics
from retailweave.operators import cleaning, entities
from retailweave.operators.buckets import bucketed_join, write_bucketed
from retailweave.operators.joins import Accounts, star_join
from retailweave.plans import jobs as plans
from retailweave.plans.watermarks import Watermark, extract_new
from retailweave.registry import fixtures
from retailweave.registry.fixtures import articles, customers, hot_transactions, transactions
from retailweave.sinks.commits import write_committed
from retailweave.sinks.deduplicated import LoadLedger, append_new
from retailweave.sinks.scratch import work_folder, written
from retailweave.sinks.writers import Warehouse, spread, write_snapshot
from retailweave.sources.drift import read_history
from retailweave.sources.quarantine import read_csv_quarantined
from retailweave.sources.snapshots import feed_path, read_newest, run_date
from retailweave.sources.tables import read_csv, read_parquet

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATES = ("2024-01-31", "2024-02-01")


# ---- sources ---------------------------------------------------------------


def src_parquet(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/customer.parquet")


def _transactions_csv(spark, sf_dir) -> str:
    path = f"{work_folder(spark)}/transactions.csv"
    transactions(spark, sf_dir).write.csv(path, header=True)
    return path


def src_csv(spark, sf_dir):
    return read_csv(spark, _transactions_csv(spark, sf_dir), fixtures.TRANSACTIONS_SCHEMA)


def src_csv_inferred(spark, sf_dir):
    return read_csv(spark, _transactions_csv(spark, sf_dir))


def src_csv_quarantine(spark, sf_dir):
    """Transactions as CSV in which some lines are cut off, too long, or hold text for a number: the good rows, and the refused lines with their reason."""
    folder = work_folder(spark)
    raw = transactions(spark, sf_dir).select("t_dat", "customer_id", "article_id", "price")
    line = F.concat_ws(",", *(F.coalesce(F.col(name).cast("string"), F.lit("")) for name in raw.columns))
    harmed = (
        F.when(F.col("article_id") % 11 == 0, F.regexp_replace(line, ",[^,]*$", ""))
        .when(F.col("article_id") % 13 == 0, F.concat(line, F.lit(",more")))
        .when(F.col("article_id") % 17 == 0, F.concat_ws(",", F.lit("2020-01-01"), F.lit("c"), F.lit("number"), F.col("price").cast("string")))
        .otherwise(line)
    )
    raw.select(harmed.alias("value")).write.text(f"{folder}/lines.csv")
    good = read_csv_quarantined(
        spark, f"{folder}/lines.csv", "t_dat STRING, customer_id STRING, article_id BIGINT, price DOUBLE", f"{folder}/refused", ["t_dat"], header="false"
    )
    refused = read_parquet(spark, f"{folder}/refused").groupBy("reason").agg(F.count("*").alias("n"))
    kept = good.groupBy(F.lit("kept").alias("reason")).agg(F.count("*").alias("n"), F.sum("article_id").alias("articles"))
    return kept.unionByName(refused, allowMissingColumns=True)


def src_schema_drift(spark, sf_dir):
    """Customers of three snapshots as one frame: ages that were short numbers at first, a segment that came later, a flag that went."""
    root, raw = feed_path(work_folder(spark), "Customers", "historic"), customers(spark, sf_dir)
    old = raw.select("customer_id", F.col("age").cast("smallint").alias("age"), F.col("Active").alias("active"))
    for day, frame in (("2024-01-29", old), ("2024-01-30", raw.select("customer_id", "age", "segment")), ("2024-01-31", raw.select("segment", F.col("age").cast("bigint").alias("AGE"), "customer_id"))):
        write_committed(frame, root, day)
    return read_history(spark, root)


def src_latest_snapshot(spark, sf_dir):
    """Customers of the second of two days; the first day's snapshot holds other columns."""
    root = feed_path(work_folder(spark), "Customers", "historic")
    raw = customers(spark, sf_dir)
    write_snapshot(raw.select("customer_id"), f"{root}/{RUN_DATES[0]}")
    write_snapshot(raw, f"{root}/{RUN_DATES[1]}")
    return read_newest(spark, root)


def src_latest_snapshot_many_files(spark, sf_dir):
    """Transactions of a second write to the same day, which makes several files beside those of the first."""
    root = feed_path(work_folder(spark), "Transactions", "Live")
    raw = transactions(spark, sf_dir)
    write_snapshot(raw.where("price > 1000"), f"{root}/{RUN_DATES[0]}", "append", n_files=2)
    write_snapshot(raw, f"{root}/{RUN_DATES[0]}", "append", n_files=5)
    return read_newest(spark, root)


def dat_run_date(spark, sf_dir):
    """Whether the run date of a job is today's date in the session's time zone."""
    today = F.date_format(F.current_date(), "yyyy-MM-dd")
    return customers(spark, sf_dir).select("customer_id", (F.lit(run_date(spark)) == today).alias("is_today"))


# ---- sinks and layout ------------------------------------------------------


def snk_snapshot_overwrite(spark, sf_dir):
    path = f"{work_folder(spark)}/{RUN_DATES[0]}"
    raw = customers(spark, sf_dir)
    write_snapshot(raw.select("customer_id"), path, "overwrite")
    write_snapshot(raw, path, "overwrite")
    return read_parquet(spark, path)


def snk_snapshot_append(spark, sf_dir):
    path = f"{work_folder(spark)}/{RUN_DATES[0]}"
    raw = transactions(spark, sf_dir)
    write_snapshot(raw, path, "append")
    write_snapshot(raw, path, "append")
    return read_parquet(spark, path)


def _written_twice(spark, df, table, mode):
    folder = work_folder(spark)
    target = Warehouse("parquet", {"path": folder})
    target.write(df, table, mode)
    target.write(df, table, mode)
    return read_parquet(spark, f"{folder}/{table}")


def snk_table_append(spark, sf_dir):
    return _written_twice(spark, cln_transactions(spark, sf_dir), "transactions", "append")


def snk_table_overwrite(spark, sf_dir):
    return _written_twice(spark, cln_customers(spark, sf_dir), "customers", "overwrite")


def snk_table_overwrite_staged(spark, sf_dir):
    """Customers made from the table that they replace, after a replacement that failed half-way."""
    target = Warehouse("parquet", {"path": work_folder(spark)}, staged=True)
    target.write(cln_customers(spark, sf_dir).limit(10), "customers", "overwrite")
    target.write(cln_customers(spark, sf_dir), "customers", "overwrite")
    broken = target.read(spark, "customers").withColumn("age", F.when(F.rand() < 2, F.raise_error(F.lit("broken"))).cast("int"))
    try:
        target.write(broken, "customers", "overwrite")
    except Exception as error:
        if "broken" not in str(error):
            raise
    target.write(target.read(spark, "customers").where("age IS NOT NULL"), "customers", "overwrite")
    return target.read(spark, "customers")


def snk_append_deduplicated(spark, sf_dir):
    """Transactions appended in part, then as a whole, then by two live loads of one id: every row is there as often as in the source."""
    folder = work_folder(spark)
    target, ledger = Warehouse("parquet", {"path": folder}), LoadLedger(spark, f"{folder}/_loads")
    source = entities.clean_transactions(written(transactions(spark, sf_dir)))
    keys = ["t_dat", "customer_id", "article_id", "price"]
    append_new(target, source.where("price > 30000 or article_id % 7 = 0"), "transactions", keys)
    append_new(target, source, "transactions", keys, within="t_dat")
    for _ in range(2):
        append_new(target, source, "transactions", keys, ledger=ledger, load_id="2024-01-31")
    return target.read(spark, "transactions")


def snk_snapshot_committed(spark, sf_dir):
    """Customers of the last commit, although an earlier date was written last and a later write was never committed."""
    root = feed_path(work_folder(spark), "Customers", "historic")
    raw = customers(spark, sf_dir)
    write_committed(raw.select("customer_id"), root, RUN_DATES[1])
    write_committed(raw, root, RUN_DATES[0], n_files=5)
    write_snapshot(raw.limit(3), f"{root}/{RUN_DATES[0]}", "append")
    return read_newest(spark, root)


def lay_file_count(spark, sf_dir):
    """Number of files of a snapshot for which four were asked, and their rows in total."""
    path = f"{work_folder(spark)}/{RUN_DATES[0]}"
    write_snapshot(transactions(spark, sf_dir), path, n_files=4)
    return read_parquet(spark, path).agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("n_files"), F.count("*").alias("n_rows")
    )


def lay_repartition(spark, sf_dir):
    return spread(transactions(spark, sf_dir), 8)


# ---- projections and predicates --------------------------------------------


def prj_drop(spark, sf_dir):
    return customers(spark, sf_dir).drop("FN", "no_such_column")


def prj_rename(spark, sf_dir):
    return customers(spark, sf_dir).withColumnRenamed("Active", "active_status")


def prj_select_alias(spark, sf_dir):
    return transactions(spark, sf_dir).select(F.col("sales_channel_id").alias("channel"))


def prj_casts(spark, sf_dir):
    date = F.col("t_dat").try_cast("date")
    return transactions(spark, sf_dir).select(
        date.alias("t_dat"),
        F.col("sales_channel_id").cast("string").alias("channel_text"),
        F.col("price").cast("int").alias("price_int"),
    )


def prd_is_null(spark, sf_dir):
    return transactions(spark, sf_dir).select(
        "article_id", "customer_id", F.col("sales_channel_id").isNull().alias("no_channel")
    )


def prd_isin(spark, sf_dir):
    news = F.col("fashion_news_frequency")
    return customers(spark, sf_dir).select("customer_id", news.isin("None", "NONE").alias("no_news"))


def prd_range(spark, sf_dir):
    age = F.col("age")
    return customers(spark, sf_dir).select("customer_id", ((age >= 22) & (age < 38)).alias("in_range"))


def prd_case_when(spark, sf_dir):
    age = F.col("age")
    return customers(spark, sf_dir).select(
        "customer_id", F.when(age < 22, "young").when(age < 54, "middle").otherwise("other").alias("band")
    )


# ---- cleaning --------------------------------------------------------------


def cln_impute_median(spark, sf_dir):
    return customers(spark, sf_dir).transform(cleaning.impute_median, "age").select("customer_id", "age")


def cln_active_status(spark, sf_dir):
    return customers(spark, sf_dir).select("customer_id", columns.flag_text("Active").alias("active_status"))


def cln_fill_constant(spark, sf_dir):
    filled = cleaning.fill_constant(customers(spark, sf_dir), club_member_status="ACTIVE")
    return filled.select("customer_id", "club_member_status")


def cln_replace_values(spark, sf_dir):
    replaced = cleaning.replace_values(
        customers(spark, sf_dir), "fashion_news_frequency", entities.NO_NEWS_SPELLINGS, entities.NO_NEWS
    )
    return replaced.select("customer_id", "fashion_news_frequency")


def cln_fill_never(spark, sf_dir):
    filled = cleaning.fill_constant(customers(spark, sf_dir), fashion_news_frequency=entities.NO_NEWS)
    return filled.select("customer_id", "fashion_news_frequency")


def cln_age_group(spark, sf_dir):
    group = columns.bucketize("age", entities.AGE_EDGES, entities.AGE_LABELS, entities.AGE_OTHERWISE)
    return customers(spark, sf_dir).select("customer_id", "age", group.alias("age_group"))


def cln_impute_mode(spark, sf_dir):
    return transactions(spark, sf_dir).transform(cleaning.impute_mode, "sales_channel_id")


def cln_customers(spark, sf_dir):
    return entities.clean_customers(customers(spark, sf_dir))


def cln_transactions(spark, sf_dir):
    return entities.clean_transactions(transactions(spark, sf_dir))


def cln_articles(spark, sf_dir):
    return entities.clean_articles(articles(spark, sf_dir))


# ---- dates -----------------------------------------------------------------


def _dated(spark, sf_dir, name=None):
    dated = cleaning.add_calendar(transactions(spark, sf_dir), "t_dat")
    return dated.select("article_id", "t_dat", *([name] if name else []))


def dat_to_date(spark, sf_dir):
    return _dated(spark, sf_dir)


def dat_month_name(spark, sf_dir):
    return _dated(spark, sf_dir, "month")


def dat_day_name(spark, sf_dir):
    return _dated(spark, sf_dir, "day")


def dat_quarter(spark, sf_dir):
    return _dated(spark, sf_dir, "quarter")


def dat_year(spark, sf_dir):
    return _dated(spark, sf_dir, "year")


# ---- aggregates ------------------------------------------------------------


def agg_exact_quantile(spark, sf_dir):
    return statistics.exact_quantile(customers(spark, sf_dir), "age")


def agg_exact_quantile_many_values(spark, sf_dir):
    return statistics.exact_quantile(transactions(spark, sf_dir), "price")


def agg_group_count(spark, sf_dir):
    return statistics.group_counts(transactions(spark, sf_dir), "sales_channel_id")


def agg_mode(spark, sf_dir):
    return statistics.mode(transactions(spark, sf_dir), "sales_channel_id")


def srt_order_desc(spark, sf_dir):
    counts = statistics.group_counts(transactions(spark, sf_dir), "sales_channel_id")
    return counts.orderBy(F.col("count").desc())


def lim_top_k(spark, sf_dir):
    return statistics.top_groups(transactions(spark, sf_dir), "article_id", 10)


# ---- joins -----------------------------------------------------------------


def jon_broadcast(spark, sf_dir):
    dimensions = [(customers(spark, sf_dir), "customer_id"), (articles(spark, sf_dir), "article_id")]
    return star_join(transactions(spark, sf_dir), dimensions, "broadcast")


def jon_shuffle(spark, sf_dir):
    dimensions = [(customers(spark, sf_dir), "customer_id"), (articles(spark, sf_dir), "article_id")]
    return star_join(transactions(spark, sf_dir), dimensions, "shuffle")


def jon_shuffle_hot_key(spark, sf_dir):
    """Two fifths of the transactions on one customer, whose key is salted for a merge join."""
    dimensions = [(customers(spark, sf_dir), "customer_id"), (articles(spark, sf_dir), "article_id")]
    return star_join(hot_transactions(spark, sf_dir), dimensions, "merge")


def jon_merge(spark, sf_dir):
    """The joins that a load makes of dimensions that are too large to broadcast."""
    dimensions = [(customers(spark, sf_dir), "customer_id"), (articles(spark, sf_dir), "article_id")]
    return star_join(transactions(spark, sf_dir), dimensions, "merge")


def jon_same_key_dimensions(spark, sf_dir):
    """Two dimensions on the same key, one of which has a part of the customers only."""
    ages = customers(spark, sf_dir).where("age IS NOT NULL").select("customer_id", "age")
    segments = customers(spark, sf_dir).select(F.col("customer_id").alias("CUSTOMER_ID"), "segment")
    return star_join(hot_transactions(spark, sf_dir), [(ages, "customer_id"), (segments, "CUSTOMER_ID")], "merge").select(
        F.col("customer_id").alias("customer_id"), "article_id", "price", "age", "segment"
    )


def jon_binary_key(spark, sf_dir):
    """Customers joined on a key of bytes, the hot one salted."""
    key = F.col("customer_id").cast("binary").alias("customer_id")
    fact = hot_transactions(spark, sf_dir).select(key, "article_id", "price")
    joined = star_join(fact, [(customers(spark, sf_dir).select(key, "segment"), "customer_id")], "merge")
    return joined.withColumn("customer_id", F.col("customer_id").cast("string"))


def jon_bucketed(spark, sf_dir):
    """Transactions and customers from tables in the same buckets of their key, merged without a shuffle."""
    folder, number = work_folder(spark), uuid.uuid4().hex
    names = [f"{name}_{number}" for name in ("transactions", "customers")]
    for name, frame in zip(names, (transactions(spark, sf_dir), customers(spark, sf_dir).select("customer_id", "segment"))):
        write_bucketed(frame, name, "customer_id", 8, f"{folder}/{name}")
    return bucketed_join(spark, *names, "customer_id")


def jon_bucketed_hot_key(spark, sf_dir):
    """The same with two fifths of the transactions on one customer, whose rows do not go to one bucket's task."""
    folder, number = work_folder(spark), uuid.uuid4().hex
    names = [f"{name}_{number}" for name in ("transactions", "customers")]
    for name, frame in zip(names, (hot_transactions(spark, sf_dir), customers(spark, sf_dir).select("customer_id", "segment"))):
        write_bucketed(frame, name, "customer_id", 8, f"{folder}/{name}")
    return bucketed_join(spark, *names, "customer_id")


def jon_accounting(spark, sf_dir):
    """What became of the transactions in the pass that joins them: rows lost at each key, and values that cleaning filled."""
    accounts, cleaned = Accounts(), Observation()
    raw = cleaning.count_fills(transactions(spark, sf_dir), cleaned, ["sales_channel_id"], ["t_dat"])
    dimensions = [(customers(spark, sf_dir), "customer_id"), (articles(spark, sf_dir), "article_id")]
    mode = statistics.mode(transactions(spark, sf_dir), "sales_channel_id").scalar()
    star_join(entities.clean_transactions(raw, mode), dimensions, accounts=accounts).write.parquet(f"{work_folder(spark)}/warehouse")
    told = accounts.get() | cleaned.get
    return spark.createDataFrame(list(told.items()), "metric string, n long")


def warehouse(spark, sf_dir):
    """The flagship: cleaned transactions with their cleaned customers and articles."""
    customers_clean, articles_clean, transactions_clean = plans.clean_all(
        customers(spark, sf_dir), articles(spark, sf_dir), transactions(spark, sf_dir)
    )
    return star_join(transactions_clean, [(customers_clean, "customer_id"), (articles_clean, "article_id")])


# ---- jobs ------------------------------------------------------------------


def _jobs(spark, sf_dir) -> tuple[plans.Jobs, str]:
    """Jobs whose sources are the raw tables, with the historic transactions as CSV."""
    folder = work_folder(spark)
    tables = {
        "Customers": lambda session: customers(session, sf_dir),
        "Articles": lambda session: articles(session, sf_dir),
    }
    sources = {
        plans.HISTORIC: tables | {"Transactions": lambda session: src_csv(session, sf_dir)},
        plans.LIVE: tables | {"Transactions": lambda session: transactions(session, sf_dir)},
    }
    target = Warehouse("parquet", {"path": f"{folder}/tables"})
    return plans.Jobs(lake=f"{folder}/lake", warehouse=target, sources=sources), f"{folder}/tables"


def pip_load_historic(spark, sf_dir):
    jobs, tables = _jobs(spark, sf_dir)
    plans.extract_historic_dimensions(spark, jobs, RUN_DATES[0])
    plans.extract_historic_transactions(spark, jobs, RUN_DATES[0])
    plans.load_historic(spark, jobs)
    return read_parquet(spark, f"{tables}/warehouse")


def pip_load_live(spark, sf_dir):
    jobs, tables = _jobs(spark, sf_dir)
    plans.extract_live(spark, jobs, RUN_DATES[0])
    plans.load_live(spark, jobs)
    return read_parquet(spark, f"{tables}/warehouse")


def pip_extract_incremental(spark, sf_dir):
    """Dated transactions by three extracts of a source that grows: earlier days, the rest of the last of them, and all others."""
    folder = work_folder(spark)
    root, mark = feed_path(folder, "Transactions", "Live"), Watermark("t_dat")
    dated = transactions(spark, sf_dir).withColumn("t_dat", F.col("t_dat").try_cast("date"))
    write_snapshot(dated, f"{folder}/source")
    source = read_parquet(spark, f"{folder}/source")
    day = "t_dat = DATE '1998-01-15'"
    for seen in (f"t_dat < DATE '1998-01-15' OR {day} AND article_id % 2 = 0 OR t_dat IS NULL AND article_id > 100", "t_dat <= DATE '1998-01-15' OR t_dat IS NULL", "true"):
        extract_new(source.where(seen), root, RUN_DATES[0], mark)
    return read_newest(spark, root, scope="folder")


def pip_live_incremental(spark, sf_dir):
    """The transactions table after three live runs over one source, each of which takes what is new."""
    jobs, tables = _jobs(spark, sf_dir)
    jobs = replace(jobs, commits=True, ledger=f"{jobs.lake}/ledger", watermarks={"Transactions": Watermark("article_id")})
    parts = iter(["article_id < 0", "article_id <= 150", "true"])
    all_rows = jobs.sources[plans.LIVE]["Transactions"]
    for part in parts:
        sources = jobs.sources[plans.LIVE] | {"Transactions": lambda session, part=part: all_rows(session).where(part)}
        plans.run_live(spark, replace(jobs, sources={plans.LIVE: sources}), RUN_DATES[1])
    return read_parquet(spark, f"{tables}/transactions").select("t_dat", "customer_id", "article_id", "price")


def pip_historic_resumed(spark, sf_dir):
    """The warehouse table of a historic run that breaks once in each of its writes and is called again."""
    jobs, tables = _jobs(spark, sf_dir)
    broken: set[str] = set()

    class Breaking(Warehouse):
        def write(self, df, table, mode):
            super().write(df, table, mode)
            if table not in broken:
                broken.add(table)
                raise InterruptedError(table)

    jobs = replace(jobs, warehouse=Breaking("parquet", {"path": tables}), ledger=f"{jobs.lake}/ledger")
    while len(broken) < 4:
        try:
            plans.run_historic(spark, jobs, RUN_DATES[0])
        except InterruptedError:
            pass
    plans.run_historic(spark, jobs, RUN_DATES[0])
    return read_parquet(spark, f"{tables}/warehouse")


def pip_historic(spark, sf_dir):
    """The transactions table after a historic run."""
    jobs, tables = _jobs(spark, sf_dir)
    plans.run_historic(spark, jobs, RUN_DATES[0])
    return read_parquet(spark, f"{tables}/transactions")


def pip_historic_then_live(spark, sf_dir):
    """Rows of each warehouse table after one historic and one live run."""
    jobs, tables = _jobs(spark, sf_dir)
    plans.run_historic(spark, jobs, RUN_DATES[0])
    plans.run_live(spark, jobs, RUN_DATES[1])
    counts = [
        read_parquet(spark, f"{tables}/{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        for name in ("warehouse", "customers", "articles", "transactions")
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


def pip_historic_then_live_transactions(spark, sf_dir):
    """The transactions table after one historic and one live run, which appends all rows again."""
    jobs, tables = _jobs(spark, sf_dir)
    plans.run_historic(spark, jobs, RUN_DATES[0])
    plans.run_live(spark, jobs, RUN_DATES[1])
    return read_parquet(spark, f"{tables}/transactions")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        warehouse,
        src_parquet,
        src_csv,
        src_csv_inferred,
        src_csv_quarantine,
        src_schema_drift,
        src_latest_snapshot,
        src_latest_snapshot_many_files,
        dat_run_date,
        snk_snapshot_overwrite,
        snk_snapshot_append,
        snk_table_append,
        snk_table_overwrite,
        snk_table_overwrite_staged,
        snk_append_deduplicated,
        snk_snapshot_committed,
        lay_file_count,
        lay_repartition,
        prj_drop,
        prj_rename,
        prj_select_alias,
        prj_casts,
        prd_is_null,
        prd_isin,
        prd_range,
        prd_case_when,
        cln_impute_median,
        cln_active_status,
        cln_fill_constant,
        cln_replace_values,
        cln_fill_never,
        cln_age_group,
        cln_impute_mode,
        cln_customers,
        cln_transactions,
        cln_articles,
        dat_to_date,
        dat_month_name,
        dat_day_name,
        dat_quarter,
        dat_year,
        agg_exact_quantile,
        agg_exact_quantile_many_values,
        agg_group_count,
        agg_mode,
        srt_order_desc,
        lim_top_k,
        jon_broadcast,
        jon_shuffle,
        jon_shuffle_hot_key,
        jon_merge,
        jon_same_key_dimensions,
        jon_binary_key,
        jon_bucketed,
        jon_bucketed_hot_key,
        jon_accounting,
        pip_load_historic,
        pip_load_live,
        pip_extract_incremental,
        pip_live_incremental,
        pip_historic_resumed,
        pip_historic,
        pip_historic_then_live,
        pip_historic_then_live_transactions,
    )
}
