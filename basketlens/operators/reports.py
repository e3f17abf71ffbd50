"""Sales, customer, brand, age and calendar reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.labels import age_group, month_index, month_name, spend_tier
from basketlens.functions.numeric import exact_avg, exact_sum, round_half_up
from basketlens.operators.staging import staged
from basketlens.schema import require_columns


def average_by(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    averages = df.groupBy(group).agg(exact_avg(F.col(value)).alias(name))
    return averages.orderBy(F.desc(name), group)


def total_by(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    totals = df.groupBy(group).agg(exact_sum(F.col(value)).alias(name))
    return totals.orderBy(F.desc(name), group)


def count_by(df: DataFrame, group: str, counted: str, name: str) -> DataFrame:
    counts = df.groupBy(group).agg(F.count(counted).alias(name))
    return counts.orderBy(F.desc(name), group)


def average_and_count_by(df: DataFrame, group: str) -> DataFrame:
    """Average Amount and number of transactions by group, highest average first."""
    require_columns(df, [group, "Amount", "Transaction_ID"])
    report = df.groupBy(group).agg(
        round_half_up(exact_avg(F.col("Amount")), 2).alias("Avg_Amount"),
        F.count("Transaction_ID").alias("Transaction_Count"),
    )
    return report.orderBy(F.desc("Avg_Amount"), group)


def sales_and_count_by(df: DataFrame, group: str) -> DataFrame:
    """Total sales and number of transactions by group, highest sales first."""
    require_columns(df, [group, "Total_Amount", "Transaction_ID"])
    report = df.groupBy(group).agg(
        round_half_up(exact_sum(F.col("Total_Amount")), 2).alias("Total_Sales"),
        F.count("Transaction_ID").alias("Transaction_Count"),
    )
    return report.orderBy(F.desc("Total_Sales"), group)


def customer_spending(df: DataFrame) -> DataFrame:
    total = round_half_up(exact_sum(F.col("Total_Amount")), 2)
    return df.groupBy("Customer_ID").agg(total.alias("Total_Spending"))


def top_customers(df: DataFrame, n: int = 10) -> DataFrame:
    return customer_spending(df).orderBy(F.desc("Total_Spending"), "Customer_ID").limit(n)


def spend_tiers(df: DataFrame) -> DataFrame:
    tiers = customer_spending(df).withColumn("Segment", spend_tier(F.col("Total_Spending")))
    return tiers.groupBy("Segment").agg(F.count(F.lit(1)).alias("count"))


def monthly_sales(df: DataFrame) -> DataFrame:
    total = round_half_up(exact_sum(F.col("Total_Amount")), 2)
    by_month = df.groupBy(F.month("Date").alias("Month")).agg(total.alias("Total_Sales"))
    return by_month.orderBy("Month")


def top_share(df: DataFrame, group: str, n: int = 10) -> DataFrame:
    """The most frequent values and their share of all rows, in percent; one pass over the rows."""
    counts = staged(df.groupBy(group).agg(F.count(F.lit(1)).alias("count")))
    rows = counts.agg(F.sum("count").alias("rows"))
    share = round_half_up(F.col("count") * 100.0 / rows.scalar(), 4)
    return counts.dropna(subset=[group]).orderBy(F.desc("count"), group).limit(n).withColumn("percentage", share)


def monthly_trend(df: DataFrame, value: str = "Amount") -> DataFrame:
    """Sum, row count and their ratio for each calendar month that has a date."""
    dated = df.select(F.month("Date").alias("Month"), value).dropna(subset=["Month"])
    by_month = dated.groupBy("Month").agg(
        exact_sum(F.col(value)).alias("sales"), F.count(F.lit(1)).alias("transactions")
    )
    return by_month.withColumn("average_sale", F.col("sales") / F.col("transactions"))


def monthly_moving_average(df: DataFrame, value: str = "Amount", span: int = 2) -> DataFrame:
    """Mean of the last ``span`` months; null until there are that many.

    The window runs over the twelve rows of the month table.
    """
    recent = Window.orderBy("Month").rowsBetween(1 - span, 0)
    mean = F.when(F.count("sales").over(recent) == span, F.avg("sales").over(recent))
    return monthly_trend(df, value).select(
        "Month", "sales", round_half_up(mean, 4).alias("moving_average")
    )


def trend_facts(df: DataFrame, value: str = "Amount") -> DataFrame:
    """Growth, best and worst months: one row."""
    months = monthly_trend(df, value)
    by_rank = F.array_sort(
        F.collect_list(F.struct((-F.col("sales")).alias("order"), "Month"))
    )
    by_low = F.array_sort(F.collect_list(F.struct(F.col("sales").alias("order"), "Month")))

    def names(ranked, n: int = 3):
        top = F.slice(ranked, 1, n)
        return F.array_join(F.transform(top, lambda m: month_name(m["Month"])), ", ")

    facts = months.agg(
        F.min_by("sales", "Month").alias("first"),
        F.max_by("sales", "Month").alias("last"),
        by_rank.alias("best"),
        by_low.alias("worst"),
    )
    growth = F.try_divide((F.col("last") - F.col("first")) * 100, F.col("first"))
    return facts.select(
        round_half_up(growth, 4).alias("growth_rate"),
        names(F.col("best")).alias("peak_season"),
        names(F.col("worst")).alias("slow_season"),
        month_name(F.col("best")[0]["Month"]).alias("highest_month"),
        (-F.col("best")[0]["order"]).alias("highest_sales"),
        month_name(F.col("worst")[0]["Month"]).alias("lowest_month"),
        F.col("worst")[0]["order"].alias("lowest_sales"),
    )


def category_brand(df: DataFrame) -> DataFrame:
    both = df.dropna(subset=["Product_Category", "Product_Brand"])
    return both.groupBy("Product_Category", "Product_Brand").agg(
        F.sum("Total_Purchases").alias("Total_Purchases")
    )


def category_brand_rollup(df: DataFrame) -> DataFrame:
    """Totals of every brand, every category and everything; ``level`` 2, 1 and 0."""
    both = df.dropna(subset=["Product_Category", "Product_Brand"])
    level = 2 - F.grouping("Product_Category") - F.grouping("Product_Brand")
    return both.rollup("Product_Category", "Product_Brand").agg(
        level.cast("int").alias("level"), F.sum("Total_Purchases").alias("Total_Purchases")
    )


def brand_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("Product_Brand").agg(F.sum("Total_Purchases").alias("Total_Sales"))


def top_brands(df: DataFrame, n: int = 10) -> DataFrame:
    return brand_totals(df).orderBy(F.desc("Total_Sales"), "Product_Brand").limit(n)


def bottom_brands(df: DataFrame, n: int = 5) -> DataFrame:
    named = df.dropna(subset=["Product_Brand"])
    return brand_totals(named).orderBy(F.asc("Total_Sales"), "Product_Brand").limit(n)


def selected_brands(df: DataFrame, top: int = 10, bottom: int = 5) -> DataFrame:
    """Names of the top and bottom brands with a flag for each list; top + bottom rows at most."""
    tagged = top_brands(df, top).select("Product_Brand", F.lit("top").alias("list")).unionByName(
        bottom_brands(df, bottom).select("Product_Brand", F.lit("bottom").alias("list"))
    )
    return tagged.dropna().groupBy("Product_Brand").agg(
        F.bool_or(F.col("list") == "top").alias("is_top"),
        F.bool_or(F.col("list") == "bottom").alias("is_bottom"),
    )


def brand_members(df: DataFrame, top: int = 10, bottom: int = 5) -> DataFrame:
    """The rows whose brand is among the top or bottom brands."""
    return df.join(F.broadcast(selected_brands(df, top, bottom)), "Product_Brand", "left_semi")


def brand_monthly_trend(df: DataFrame, top: int = 10, bottom: int = 5) -> DataFrame:
    """Quantity by month for the top and bottom brands, in calendar order; one pass over the rows."""
    monthly = staged(
        df.groupBy(month_index(F.col("Month")).alias("Month_Index"), "Product_Brand")
        .agg(F.sum("Total_Purchases").alias("Total_Purchases"))
    )
    marked = monthly.join(F.broadcast(selected_brands(monthly, top, bottom)), "Product_Brand")
    return marked.orderBy("Month_Index", "Product_Brand")


def with_age_group(df: DataFrame) -> DataFrame:
    return df.withColumn("Age_Group", age_group(F.col("Age")))


def age_gender(df: DataFrame, op: str = "sum") -> DataFrame:
    aggregate, name = {
        "sum": (F.sum, "Total_Purchases"),
        "avg": (F.avg, "Avg_Purchases"),
    }[op]
    grouped = with_age_group(df).groupBy("Age_Group", "Gender")
    return grouped.agg(aggregate("Total_Purchases").alias(name)).orderBy("Age_Group", "Gender")


def monthly_quantity(df: DataFrame) -> DataFrame:
    by_month = df.groupBy(month_index(F.col("Month")).alias("Month_Index")).agg(
        F.sum("Total_Purchases").alias("Total_Purchases")
    )
    return by_month.orderBy("Month_Index")


def payment_segment(df: DataFrame) -> DataFrame:
    counts = df.groupBy("Payment_Method", "Customer_Segment").agg(
        F.count(F.lit(1)).alias("count")
    )
    return counts.orderBy("Payment_Method", "Customer_Segment")
