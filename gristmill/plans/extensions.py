"""Extensions beyond curation: event time, cubes, star joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.plans.registry import query, table
from gristmill.streaming.streams import sessions, windowed_counts


@query("""SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 1 HOUR AS "end", count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
  (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 1 HOUR THEN 1 ELSE 0 END AS new FROM events)) GROUP BY user_id, s""")
def ext_session_window(spark, d):
    return sessions(table(spark, d, "events"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def ext_tumbling_window(spark, d):
    return windowed_counts(table(spark, d, "events"))


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY CUBE (lang, source)")
def ext_cube(spark, d):
    return table(spark, d, "documents").cube("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY n_name""")
def ext_star_join(spark, d):
    t = lambda n: table(spark, d, n)
    j = t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey")).join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(t("supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    j = j.join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region").filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def ext_pricing_summary(spark, d):
    li = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.expr("timestamp_ntz '1998-09-02'"))
    price = F.col("l_extendedprice")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_base"), F.round(F.sum(price * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("SELECT event_id, rank() OVER w AS rnk, dense_rank() OVER w AS dense, ntile(4) OVER (PARTITION BY event_type ORDER BY value, event_id) AS quartile, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving FROM events WINDOW w AS (PARTITION BY event_type ORDER BY user_id)")
def ext_window_functions(spark, d):
    w = Window.partitionBy("event_type")
    moving = w.orderBy("ts", "event_id").rowsBetween(-2, 0)
    return table(spark, d, "events").select("event_id", F.rank().over(w.orderBy("user_id")).cast("long").alias("rnk"), F.dense_rank().over(w.orderBy("user_id")).cast("long").alias("dense"), F.ntile(4).over(w.orderBy("value", "event_id")).cast("long").alias("quartile"), F.round(F.sum("value").over(moving), 6).alias("moving"))
