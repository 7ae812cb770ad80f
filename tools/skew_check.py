"""Hot-key experiment for the interval query.

    python -m tools.skew_check /root/testdata/sf0.01 [timeout_sec]

Derives a skewed variant of the driver data -- every click and every order
mapped onto one (customer, product) pair -- and times

* the reference's plan (orders joined to every click of the pair, then
  filtered), written as Spark SQL, and
* ``gold.interactions_before_buy`` (prefix sums, no pair join),

checking that both give the same rows when the pairwise plan finishes.
"""

from __future__ import annotations

import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    from pyspark.sql import functions as F

    from shopflow import fixtures as fx
    from shopflow.oracle import INTERACT_BEFORE_BUY
    from shopflow.plans import gold, silver
    from shopflow.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    limit = float(argv[1]) if len(argv) > 1 else 300.0
    spark = get_session(master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    hot = {"customer_id": F.lit("0"), "product_id": F.lit("0")}
    orders = fx.orders(spark, sf_dir).withColumns(hot)
    clicks = fx.clicks(spark, sf_dir).withColumns({"user_id": F.lit("0"), "product_id": F.lit("0")})
    history = silver.click_history_v2(clicks, fx.shoes(spark, sf_dir), fx.AS_OF)
    n_o, n_c = orders.count(), clicks.count()

    t0 = time.perf_counter()
    fast = gold.interactions_before_buy(orders, history).toPandas()
    t_prefix = time.perf_counter() - t0

    orders.createOrReplaceTempView("shoe_orders")
    history.createOrReplaceTempView("click_history_v2")
    result: dict = {}

    def run_pairwise():
        t = time.perf_counter()
        result["rows"] = spark.sql(INTERACT_BEFORE_BUY).toPandas()
        result["sec"] = time.perf_counter() - t

    spark.sparkContext.setJobGroup("pairwise", "pairwise", interruptOnCancel=True)
    th = threading.Thread(target=run_pairwise, daemon=True)
    th.start()
    th.join(limit)
    if th.is_alive():
        spark.sparkContext.cancelJobGroup("pairwise")
        th.join(60)
        pairwise = f"> {limit:.0f} s (cancelled)"
        same = "n/a"
    else:
        pairwise = f"{result['sec']:.2f} s"
        a = fast.sort_values("order_id").reset_index(drop=True)
        b = result["rows"].sort_values("order_id").reset_index(drop=True)
        same = bool(len(a) == len(b) and (a["interact_count_before_buy"].values == b["interact_count_before_buy"].values).all())
    print(f"orders={n_o} clicks={n_c} pairs={n_o * n_c:,} prefix={t_prefix:.2f} s pairwise={pairwise} same={same}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
