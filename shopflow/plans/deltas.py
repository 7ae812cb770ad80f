"""Intent history and best sellers kept up to date by signed deltas.

Facts and dimensions are held as additive tables (a key and sums), outputs likewise, each as slices that add
up.  A commit brings rows with a sign (a price change is the old row with -1 and the new one with +1) and adds one
small slice to every table that it changes: for a join, the delta of the product

    d(X join Y) = dX join Y' + X join dY        (X before, Y' after the commit)

so a commit reads what its keys meet and never the history of facts.  All slices of a commit become visible by one
swap of a pointer; a commit whose number is not above the last one is ignored, so it may be sent again.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.sources import versions

SIGN = "_sign"
#: additive tables: key and measures
TABLES: dict[str, tuple[str, str]] = {
    "orders": ("customer_id string, product_id string", "n"),
    "clicks": ("user_id string, product_id string", "n, timed, viewed"),
    "shoes": ("id string, brand string, name string, sale_price int, rating double", "n"),
    "customers": ("id string", "n"),
    "weights": ("product_id string", "n"),  # order rows after the join with customers
    "intent_clicks": ("user_id string, shoes_id string, brand string", "n, timed, viewed"),
    "intent_buys": ("customer_id string, shoes_id string", "n"),
    "sold": ("shoes_id string, brand string, sale_price int, rating double", "n"),
    "sold_all_time": ("shoes_id string, brand string, name string, sale_price int, rating double", "n"),
}


def _keys(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table][0].split(", ")]


def _measures(table: str) -> list[str]:
    return TABLES[table][1].split(", ")


def _summed(rows: DataFrame, table: str) -> DataFrame:
    keys, measures = _keys(table), _measures(table)
    out = rows.groupBy(*keys).agg(*[F.sum(m).cast("long").alias(m) for m in measures])
    return out.filter(reduce(lambda a, b: a | b, (F.col(m) != 0 for m in measures)))


def _meet(left: DataFrame, right: DataFrame, on: Column | str, how: str = "inner") -> DataFrame:
    """A join that shuffles both sides.  A slice's bytes on disk, from which Spark would choose, are a fraction of its
    rows in memory: sides that grow with the tables would go through the driver."""
    return left.join(right.hint("merge"), on, how)


def _times(rows: DataFrame, factor: Column, table: str) -> list[Column]:
    return [(F.col(m) * factor).alias(m) for m in _measures(table)]


class Maintained:
    """The tables below a shared folder; one writer at a time, readers see whole commits."""

    def __init__(self, spark: SparkSession, path: str, fold_after: int = 16):
        self.spark, self.path, self.fold_after = spark, path.rstrip("/"), fold_after

    # ------------------------------------------------------------ slices

    def _state(self) -> tuple[int, list[str], list[str]]:
        """Number of the last commit, its slices, and those of the commit before."""
        words = versions.pointer(self.spark, self.path)
        if not words:
            return -1, [], []
        cut = words.index("|")
        return int(words[0]), words[1:cut], words[cut + 1:]

    def _read(self, table: str, slices: list[str]) -> DataFrame:
        schema = f"{TABLES[table][0]}, {', '.join(m + ' long' for m in _measures(table))}"
        own = [f"{self.path}/{s}" for s in slices if s.startswith(f"{table}/")]
        if not own:
            return self.spark.createDataFrame([], schema)
        return _summed(self.spark.read.schema(schema).parquet(*own), table)

    def table(self, name: str) -> DataFrame:
        return self._read(name, self._state()[1])

    def _write(self, rows: DataFrame, table: str) -> str:
        name = f"{table}/v_{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    def _swap(self, number: int, slices: list[str]) -> None:
        _, now, before = self._state()
        versions.swap_pointer(self.spark, self.path, [str(number), *slices, "|", *now])
        for left in set(before) - set(now) - set(slices):
            versions.delete(self.spark, f"{self.path}/{left}")

    def fold(self) -> None:
        """One slice for each table."""
        number, slices, _ = self._state()
        tables = sorted({s.partition("/")[0] for s in slices})
        self._swap(number, [self._write(self._read(t, slices), t) for t in tables])

    # ------------------------------------------------------------ commits

    def commit(self, number: int, orders: DataFrame | None = None, clicks: DataFrame | None = None,
               shoes: DataFrame | None = None, customers: DataFrame | None = None) -> bool:
        """Add rows of the bronze tables, each with ``_sign`` +1 or -1; False if the number was committed before.

        Every row taken away must have been added before.
        """
        last, slices, _ = self._state()
        if number <= last:
            return False
        one, new = F.col(SIGN).cast("long"), list(slices)

        def add(table: str, rows: DataFrame) -> DataFrame:
            """The summed delta, written as a slice of the coming commit."""
            name = self._write(_summed(rows, table), table)
            new.append(name)
            return self._read(table, [name])

        def none(table: str) -> DataFrame:
            return self._read(table, [])

        d_orders = none("orders") if orders is None else add("orders", orders.select(
            "customer_id", "product_id", one.alias("n")))
        d_clicks = none("clicks") if clicks is None else add("clicks", clicks.select(
            "user_id", "product_id", one.alias("n"),
            F.when(F.col("view_time").isNotNull(), one).otherwise(F.lit(0)).alias("timed"),
            (F.coalesce("view_time", F.lit(0)) * one).alias("viewed")))
        d_shoes = none("shoes") if shoes is None else add("shoes", shoes.select(*_keys("shoes"), one.alias("n")))
        d_customers = none("customers") if customers is None else add("customers", customers.select(
            "id", one.alias("n")))
        before, after = (lambda t: self._read(t, slices)), (lambda t: self._read(t, new))

        if shoes is not None or clicks is not None:
            def seen(facts: DataFrame, brands: DataFrame) -> DataFrame:
                b = brands.groupBy("id", "brand").agg(F.sum("n").alias("_m"))
                return _meet(facts, b, facts["product_id"] == b["id"]).select(
                    "user_id", F.col("product_id").alias("shoes_id"), "brand", *_times(facts, F.col("_m"), "clicks"))

            add("intent_clicks", seen(d_clicks, after("shoes")).unionAll(seen(before("clicks"), d_shoes)))
        if shoes is not None or orders is not None:
            def bought(facts: DataFrame, ids: DataFrame) -> DataFrame:
                m = ids.groupBy("id").agg(F.sum("n").alias("_m"))
                return _meet(facts, m, facts["product_id"] == m["id"]).select(
                    "customer_id", F.col("product_id").alias("shoes_id"), (F.col("n") * F.col("_m")).alias("n"))

            add("intent_buys", bought(d_orders, after("shoes")).unionAll(bought(before("orders"), d_shoes)))

            def sold(facts: DataFrame, offers: DataFrame) -> DataFrame:
                per = facts.groupBy("product_id").agg(F.sum("n").alias("_n"))
                return _meet(per, offers, per["product_id"] == offers["id"]).select(
                    F.col("id").alias("shoes_id"), "brand", "sale_price", "rating", (F.col("_n") * F.col("n")).alias("n"))

            add("sold", sold(d_orders, after("shoes")).unionAll(sold(before("orders"), d_shoes)))
        if shoes is not None or orders is not None or customers is not None:
            d_weights = add("weights", self._weighed(d_orders, after("customers")).unionAll(
                self._reweighed(before("orders"), before("customers"), d_customers)))
            add("sold_all_time", self._placed(d_weights, after("shoes")).unionAll(
                self._replaced(before("weights"), before("shoes"), d_shoes)))
        self._swap(number, new)
        if max(sum(s.startswith(t + "/") for s in new) for t in TABLES) > self.fold_after:
            self.fold()
        return True

    @staticmethod
    def _weighed(facts: DataFrame, customers: DataFrame) -> DataFrame:
        """Orders times their customers' rows; an unknown customer counts once (a left join)."""
        m = customers.select(F.col("id").alias("_c"), F.col("n").alias("_m"))
        return _meet(facts, m, facts["customer_id"] == F.col("_c"), "left").select(
            "product_id", (F.col("n") * F.coalesce("_m", F.lit(1))).alias("n"))

    @staticmethod
    def _reweighed(facts: DataFrame, customers: DataFrame, change: DataFrame) -> DataFrame:
        """What earlier orders gain where the number of their customer's rows changes."""
        old = customers.select(F.col("id").alias("_c"), F.col("n").alias("_old"))
        step = _meet(change.select(F.col("id").alias("_id"), F.col("n").alias("_d")), old,
                     F.col("_id") == F.col("_c"), "left")
        before = F.coalesce("_old", F.lit(0))
        step = step.select("_id", (F.greatest(before + F.col("_d"), F.lit(1)) - F.greatest(before, F.lit(1))).alias("_m"))
        return _meet(facts, step, facts["customer_id"] == F.col("_id")).select(
            "product_id", (F.col("n") * F.col("_m")).alias("n"))

    @staticmethod
    def _placed(weights: DataFrame, shoes: DataFrame) -> DataFrame:
        """Weights by the shoes' rows; what has no shoe goes to the all-NULL row."""
        s = shoes.withColumnRenamed("n", "_m")
        return _meet(weights, s, weights["product_id"] == s["id"], "left").select(
            F.col("id").alias("shoes_id"), "brand", "name", "sale_price", "rating",
            (F.col("n") * F.coalesce("_m", F.lit(1))).alias("n"))

    @classmethod
    def _replaced(cls, weights: DataFrame, shoes: DataFrame, change: DataFrame) -> DataFrame:
        """What earlier weights move between rows where their shoe's rows change, or appear, or go."""
        ids = change.select("id").distinct()
        moved = _meet(weights, ids, weights["product_id"] == ids["id"], "left_semi")
        old = _meet(shoes, ids, "id", "left_semi")
        new = _summed(old.unionByName(change), "shoes")
        gone = cls._placed(moved, old)
        return gone.withColumn("n", -F.col("n")).unionAll(cls._placed(moved, new))

    # ------------------------------------------------------------ outputs

    def intent_history(self) -> DataFrame:
        """As ``gold.intent_history``."""
        clicked, bought = self.table("intent_clicks"), self.table("intent_buys")
        bought = bought.select("customer_id", F.col("shoes_id").alias("_pid"), F.col("n").alias("_buy"))
        # a pair whose clicks cancel out has no row, whatever its other sums
        return _meet(clicked.filter("n > 0"), bought, (F.col("user_id") == F.col("customer_id")) & (
            F.col("shoes_id") == F.col("_pid")), "left").select(
            "user_id", "shoes_id", "brand", F.try_divide(F.col("viewed").cast("double"), F.col("timed")).alias("avg_view_time"),
            F.when(F.col("timed") > 0, F.col("viewed")).alias("total_view_time"), F.col("n").alias("click_count"),
            F.coalesce("_buy", F.lit(0)).alias("buy_count"))

    def top_sellers(self) -> DataFrame:
        """As ``gold.top_sellers``."""
        return self.table("sold").withColumnRenamed("n", "total_sales")

    def top_sellers_all_time(self) -> DataFrame:
        """As ``gold.top_sellers_all_time``."""
        return self.table("sold_all_time").withColumnRenamed("n", "total_sales")
