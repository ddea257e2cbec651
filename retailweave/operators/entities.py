"""The cleaners of the three retail tables. Columns they do not name pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailweave.functions import columns
from retailweave.operators import cleaning

# The cleaning rules of the retail tables.
AGE_EDGES = [0, 22, 38, 54, 73]
AGE_LABELS = ["Gen-Z", "Millennials", "Gen-X", "Boomers"]
AGE_OTHERWISE = "Silent"
INACTIVE_FLAG = "0"
DEFAULT_CLUB_STATUS = "ACTIVE"
NO_NEWS_SPELLINGS = ["None", "NONE"]
NO_NEWS = "Never"


def clean_customers(customers: DataFrame, median_age: Column | None = None) -> DataFrame:
    """Fill and normalise the customer attributes and add the age group.

    The group is taken from the imputed age before it is cut to an integer.
    """
    news = "fashion_news_frequency"
    return (
        customers.drop("FN")
        .transform(cleaning.impute_median, "age", median_age)
        .withColumns(
            {
                "Active": columns.flag_text("Active", INACTIVE_FLAG),
                "club_member_status": columns.fill("club_member_status", DEFAULT_CLUB_STATUS),
                news: F.coalesce(columns.replace_values(news, NO_NEWS_SPELLINGS, NO_NEWS), F.lit(NO_NEWS)),
                "age_group": columns.bucketize("age", AGE_EDGES, AGE_LABELS, AGE_OTHERWISE),
            }
        )
        .withColumnRenamed("Active", "active_status")
        .withColumn("age", F.col("age").try_cast("int"))
    )


def clean_transactions(transactions: DataFrame, channel_mode: Column | None = None) -> DataFrame:
    """Date and calendar columns, and the most frequent sales channel where none is given."""
    return transactions.transform(cleaning.impute_mode, "sales_channel_id", channel_mode).transform(
        cleaning.add_calendar, "t_dat"
    )


def clean_articles(articles: DataFrame) -> DataFrame:
    """Drop the long description."""
    return articles.drop("detail_desc")
