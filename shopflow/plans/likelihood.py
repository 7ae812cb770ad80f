"""Label table and purchase likelihood: will this click be followed by an order of the product?"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.times import ntz_literal
from shopflow.operators.matching import next_event, totals_before

#: hours after a click in which an order counts for it
HORIZON = 168

FEATURES = ["pair_clicks", "pair_view_time", "pair_orders", "user_clicks", "user_orders", "product_clicks", "product_orders"]


def _after(hours: int) -> Column:
    return F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(hours))


def label_table(clicks: DataFrame, orders: DataFrame, until: dt.datetime, horizon_hours: int = HORIZON) -> DataFrame:
    """One row per click before ``until``: what was known just before it, and whether an order followed.

    Features are sums over the clicks and orders strictly before the click's time, of the same user and
    product, the user, and the product; ``view_time`` is the click's own.  ``label`` is 1 if the user ordered the product
    from the click's time to ``horizon_hours`` later (and before ``until``), 0 if not and that time is over at
    ``until``, else NULL: not known yet.  So rows at or after a click never change its features, and
    rows at or after ``until`` change nothing.  Clicks without user, product or time are left out.
    """
    end = ntz_literal(until)
    known = F.col("user_id").isNotNull() & F.col("product_id").isNotNull() & (F.col("ts") < end)
    asked = clicks.select("user_id", "product_id", "ts", "view_time").filter(known)
    bought = orders.select(F.col("customer_id").alias("user_id"), "product_id", "ts").filter(F.col("ts") < end)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    events = clicks.filter(F.col("ts") < end).select(
        "user_id", "product_id", "ts", one.alias("clicks"), F.col("view_time").cast("long").alias("view_time"),
        none.alias("orders")).unionByName(bought.select(
            "*", none.alias("clicks"), none.alias("view_time"), one.alias("orders")))

    def of(rows: DataFrame, prefix: str, keys: list[str], values: list[str]) -> DataFrame:
        mine = events
        for k in keys:
            mine = mine.filter(F.col(k).isNotNull())
        mine = mine.select(*keys, "ts", *[F.col(v).alias(f"{prefix}_{v}") for v in values])
        return totals_before(rows, mine, keys, "ts", [f"{prefix}_{v}" for v in values])

    rows = of(asked, "pair", ["user_id", "product_id"], ["clicks", "view_time", "orders"])
    rows = of(rows, "user", ["user_id"], ["clicks", "orders"])
    rows = of(rows, "product", ["product_id"], ["clicks", "orders"])
    found = next_event(rows, bought.dropna(subset=["user_id", "product_id"]), ["user_id", "product_id"], "ts", [], "_next")
    label = F.when(F.col("_next.ts") <= _after(horizon_hours), 1).when(_after(horizon_hours) < end, 0)
    return found.select("user_id", "product_id", "ts", "view_time", *FEATURES, label.cast("int").alias("label"))


def _inputs(examples: DataFrame) -> DataFrame:
    """Counts on a log scale."""
    return examples.withColumns({f"_{c}": F.log1p(F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).cast("double"))
                                 for c in ["view_time", *FEATURES]})


def fit_likelihood(examples: DataFrame, split: dt.datetime, horizon_hours: int = HORIZON) -> PipelineModel:
    """A logistic regression on the examples whose label was known at ``split``: a split in time, nothing later is seen.

    Raises ValueError where no such example is there.
    """
    past = _inputs(examples.filter(F.col("label").isNotNull() & (_after(horizon_hours) < ntz_literal(split))))
    if past.isEmpty():
        raise ValueError(f"no example has its label known at {split}")
    inputs = VectorAssembler(inputCols=[f"_{c}" for c in ["view_time", *FEATURES]], outputCol="_features")
    return Pipeline(stages=[inputs, LogisticRegression(
        featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_predicted", regParam=0.001)]).fit(past)


def likelihood(model: PipelineModel, examples: DataFrame) -> DataFrame:
    """``examples`` with the probability of an order, ``likelihood`` (0 to 1)."""
    scored = model.transform(_inputs(examples))
    return scored.select(*examples.columns, vector_to_array("_probability")[1].alias("likelihood"))


def area_under_curve(scored: DataFrame, split: dt.datetime) -> float:
    """AUC of ``likelihood`` on the labelled examples at or after ``split``; 0.5 is what a constant gets."""
    later = scored.filter(F.col("label").isNotNull() & (F.col("ts") >= ntz_literal(split)))
    return BinaryClassificationEvaluator(rawPredictionCol="likelihood", labelCol="label").evaluate(later)
