"""Products that go together, and products to show a customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.operators.cooccurrence import co_counts, top_partners
from shopflow.session import checkpoint_dir


def _partners(rows: DataFrame, user: str, k: int) -> DataFrame:
    found = top_partners(co_counts(rows, user, "product_id"), k)
    return found.select(F.col("item").alias("product_id"), "rank", F.col("other").alias("other_id"), "n_both",
                        F.col("n_item").alias("n_product"), "n_other")


def co_clicked(clicks: DataFrame, k: int = 10) -> DataFrame:
    """Per product the ``k`` others that most users clicked too: rank, other, users of both and of each."""
    return _partners(clicks, "user_id", k)


def co_purchased(orders: DataFrame, k: int = 10) -> DataFrame:
    """Per product the ``k`` others that most customers bought too: rank, other, customers of both and of each."""
    return _partners(orders, "customer_id", k)


def recommended(orders: DataFrame, clicks: DataFrame, k: int = 10, n: int = 5) -> DataFrame:
    """Per customer up to ``n`` products not bought yet, by what goes with those bought.

    A product's score is the sum of ``n_both`` over the customer's bought products that have it among their
    ``k`` co-clicked ones; ties go to the smaller product.  Customers without such a product are absent,
    NULL customers and products count nowhere.
    """
    checkpoint_dir(orders.sparkSession)
    bought = orders.select(F.col("customer_id").alias("user_id"), "product_id").dropna().distinct()
    # written first, so that Spark can split the customers of a product that most of them bought
    partners = co_clicked(clicks, k).select("product_id", "other_id", "n_both").checkpoint()
    scored = bought.join(partners, "product_id").groupBy("user_id", F.col("other_id").alias("product_id")).agg(
        F.sum("n_both").alias("score")).join(bought, ["user_id", "product_id"], "left_anti")
    order = Window.partitionBy("user_id").orderBy(F.col("score").desc(), "product_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select(
        "user_id", "rank", "product_id", "score")
