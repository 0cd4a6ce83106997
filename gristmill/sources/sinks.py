"""Writers: exports that can be resumed, split outputs, normalized tables, upserts and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.operators.rollouts import run_summary


def export_records(results: DataFrame) -> DataFrame:
    """results (id, conversation, reward, ...) with accepted (a conversation of two or more messages) and errored (no result)."""
    c = F.col("conversation")
    return results.withColumns({"accepted": c.isNotNull() & (F.size(c) > 1), "errored": c.isNull() & F.col("reward").isNull()})


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def append_new(rows: DataFrame, path: str, id_col: str = "id") -> int:
    """Append rows whose id isn't at path yet, each id once; gives how many. Running it again adds nothing."""
    spark = rows.sparkSession
    fresh = rows.dropDuplicates([id_col])
    if exists(spark, path):
        fresh = fresh.join(spark.read.schema(rows.schema).json(path).select(id_col), id_col, "left_anti")
    fresh = fresh.persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").json(path)
    fresh.unpersist()
    return n


def write_export(records: DataFrame, paths: dict[str, str]) -> None:
    """Accepted rows, an audit row for each record and a one-row summary; each a complete write of its own."""
    records = records.persist()
    records.filter("accepted").drop("accepted", "errored").write.mode("overwrite").json(paths["accepted"])
    records.select("id", "accepted", "errored", "reward").write.mode("overwrite").json(paths["audit"])
    run_summary(records).coalesce(1).write.mode("overwrite").json(paths["summary"])
    records.unpersist()


def write_split(rows: DataFrame, dropped: Column, path: str) -> None:
    """Kept rows at path, the others beside it; rows are computed once."""
    rows = rows.persist()
    rows.filter(~dropped).write.mode("overwrite").json(path)
    rows.filter(dropped).write.mode("overwrite").json(f"{path}.dropped")
    rows.unpersist()


def normalized_tables(trajectories: DataFrame) -> dict[str, DataFrame]:
    """Trajectories (id, turns array with executions array each) as flat tables: trajectories, turns, executions."""
    turns = trajectories.select(F.col("id").alias("trajectory_id"), F.posexplode("turns").alias("turn_index", "t"))
    runs = turns.select("trajectory_id", "turn_index", F.posexplode("t.executions").alias("execution_index", "e"))
    return {"trajectories": trajectories.drop("turns"), "turns": turns.select("trajectory_id", "turn_index", "t.*").drop("executions"), "executions": runs.select("trajectory_id", "turn_index", "execution_index", "e.*")}


def read_back(tables: dict[str, DataFrame]) -> DataFrame:
    """normalized_tables() put together again, turns in order."""
    turn = tables["turns"]
    fields = [c for c in turn.columns if c not in ("trajectory_id", "turn_index")]
    whole = turn.groupBy(F.col("trajectory_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("turn_index", *fields))).alias("turns"))
    return tables["trajectories"].join(whole, "id", "left")


def upserted(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the latest of new by order, else that of old; null values of new keep those of old."""
    last = new.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("__k = 1").drop("__k")
    rest = [c for c in old.columns if c != key]
    j = old.alias("o").join(last.alias("n"), key, "full")
    return j.select(key, *(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in rest))


def safe_json(x: Column) -> Column:
    """JSON text that parses, else an object with the text under error; null stays null."""
    return F.when(x.isNull(), x).otherwise(F.coalesce(F.to_json(F.try_parse_json(x)), F.to_json(F.struct(x.alias("error")))))


def request_views(requests: DataFrame) -> dict[str, DataFrame]:
    """Projections of stored requests (id, model, raw_request, raw_response as JSON text) for reading."""
    get = lambda c, p, kind="string": F.try_variant_get(F.try_parse_json(c), p, kind)
    n = F.coalesce(F.json_array_length(F.get_json_object("raw_request", "$.messages")), F.lit(0))
    return {
        "llm_requests": requests.select("id", "model", get("raw_request", "$.temperature", "double").alias("temperature"), n.alias("n_messages")),
        "llm_responses": requests.select("id", "model", get("raw_response", "$.choices[0].message.content").alias("content"), get("raw_response", "$.usage.total_tokens", "int").alias("total_tokens")),
    }


def truncate(spark: SparkSession, names: list[str], dry_run: bool = True) -> dict[str, tuple[int, int]]:
    """Rows of tables before and after emptying them; a dry run leaves them as they are."""
    out = {}
    for n in names:
        before = spark.table(n).count()
        if not dry_run:
            spark.sql(f"TRUNCATE TABLE {n}")
        out[n] = (before, before if dry_run else 0)
    return out


#: Tables of rollout storage, in the order in which they can be created.
TABLES = {
    "rollout_groups": "id STRING, task_id STRING, environment STRING, num_rollouts INT, num_completed INT, num_failed INT, num_error INT, num_timeout INT, best_rollout_id STRING, best_reward DOUBLE, reward_mean DOUBLE, reward_std DOUBLE, reward_min DOUBLE, config_json STRING, created_at TIMESTAMP, completed_at TIMESTAMP",
    "rollouts": "id STRING, rollout_group_id STRING, trajectory_id STRING, rollout_index INT, status STRING, termination_reason STRING, num_turns INT, num_code_blocks INT, num_errors INT, total_reward DOUBLE, duration_ms DOUBLE, started_at TIMESTAMP, completed_at TIMESTAMP",
    "trajectories": "id STRING, rollout_id STRING, rollout_group_id STRING, task_id STRING, environment STRING, success BOOLEAN, answer_correct BOOLEAN, num_turns INT, num_errors INT, total_reward DOUBLE, step_rewards_json STRING, metadata_json STRING",
    "turns": "id STRING, trajectory_id STRING, turn_index INT, role STRING, content STRING, code STRING, reasoning_content STRING",
    "executions": "id STRING, turn_id STRING, success BOOLEAN, output STRING, error STRING, execution_time_ms INT, reward DOUBLE",
}


def create_tables(spark: SparkSession, recreate: bool = False) -> list[str]:
    """Make the storage tables; recreate drops those there are, the last first."""
    if recreate:
        for n in reversed(TABLES):
            spark.sql(f"DROP TABLE IF EXISTS {n}")
    for n, cols in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {n} ({cols}) USING parquet")
    return list(TABLES)


def card(rows: DataFrame, title: str, split_col: str = "split") -> str:
    """A dataset card: size class, columns and rows by split."""
    splits = {r[0]: r[1] for r in rows.groupBy(split_col).count().orderBy(split_col).collect()}
    n = sum(splits.values())
    size = "n<1K" if n < 1000 else "1K<n<10K" if n < 10_000 else "10K<n<100K" if n < 100_000 else "n>100K"
    lines = [f"# {title}", "", f"Size: {size}", "", "Columns: " + ", ".join(rows.columns), "", *(f"- {k}: {v} rows" for k, v in splits.items())]
    return "\n".join(lines)
