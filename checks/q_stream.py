"""Streaming queries over files that the driver tables are landed in."""

from __future__ import annotations

from pyspark.sql import functions as F

from buildmend.functions import taxonomy as tax
from buildmend.session import scratch_path
from buildmend.sources.jsonl import write_jsonl
from buildmend.streaming import requests, watch
from checks.registry import query
from checks.sql import FIX_ROWS, q, top_steps
from checks.views import N_LINES

_RUNS = "repo string, run_id bigint, conclusion string, created_at timestamp, ci_log string"


@query(
    "watch_failures", ["ci_runs", "log_templates"], steps=f"""failed AS (SELECT r.repo, r.run_id, t.line AS ci_log FROM ci_runs r JOIN log_templates t ON r.run_id % {N_LINES} = t.tid
  WHERE r.conclusion = 'failure'),
""" + top_steps("failed", "run_id") + ",\n" + FIX_ROWS,
    sql=f"""SELECT f.repo, f.run_id, t.h_class AS failure_class, t.h_sub AS failure_subclass, t.h_conf AS confidence, coalesce(x.strategy, {q(tax.DEFAULT_FIX)}) AS fix_strategy
    FROM failed f JOIN top t ON t.id = f.run_id LEFT JOIN fixes x ON x.sub = t.h_sub""",
)
def watch_failures(t):
    runs = t.ci_runs.join(t.log_templates, F.col("run_id") % N_LINES == F.col("tid")).select(
        "repo", "run_id", "conclusion", F.col("created_at").cast("timestamp").alias("created_at"), F.col("line").alias("ci_log")
    )
    # Every run lands twice, as polling sees it again.
    landing, output = scratch_path(t.spark, "runs"), scratch_path(t.spark, "seen")
    write_jsonl(runs, landing)
    write_jsonl(runs, landing, "append")
    stream = watch.landed_files(t.spark, landing, _RUNS)
    watch.watch_failures(stream, output, scratch_path(t.spark, "progress"), once=True).awaitTermination()
    return watch.watched(t.spark, output, _RUNS).select(
        "repo", "run_id", "failure_class", "failure_subclass", "confidence", "fix_strategy"
    )


@query(
    "repair_requests", ["ci_runs"],
    sql="""SELECT run_id AS request_id, CASE WHEN run_id % 5 = 0 THEN NULL WHEN run_id % 7 = 0 THEN '' ELSE repo END AS repo, CASE WHEN run_id % 3 = 0 THEN NULL ELSE run_id END AS run_id,
      CASE WHEN run_id % 5 = 0 OR run_id % 7 = 0 OR run_id % 3 = 0 THEN 'rejected' ELSE 'queued' END AS status,
      CASE WHEN run_id % 5 = 0 OR run_id % 7 = 0 OR run_id % 3 = 0 THEN 'repo and run_id required' END AS error FROM ci_runs""",
)
def repair_requests(t):
    number = F.col("run_id")
    asked = t.ci_runs.select(
        number.alias("request_id"),
        F.when(number % 5 == 0, F.lit(None)).when(number % 7 == 0, "").otherwise(F.col("repo")).alias("repo"),
        F.when(number % 3 != 0, number).alias("run_id"),
    )
    landing, output = scratch_path(t.spark, "asked"), scratch_path(t.spark, "queue")
    write_jsonl(asked, landing)
    stream = watch.landed_files(t.spark, landing, "request_id bigint, repo string, run_id bigint")
    checked = watch.repair_requests(stream)
    watch.run_to_files(checked, output, scratch_path(t.spark, "progress"), ["status"], once=True).awaitTermination()
    return t.spark.read.schema(checked.schema).parquet(output).select("request_id", "repo", "run_id", "status", "error")


_ASKED = """asked AS (SELECT run_id AS request_id, CASE WHEN run_id % 3 = 0 THEN 'rejected' ELSE 'queued' END AS status FROM ci_runs),
held AS (SELECT run_id AS request_id, (run_id % 3 + 1)::INTEGER AS attempt, run_id % 4 = 1 AS runs_on FROM ci_runs WHERE run_id % 4 < 2),
free AS (SELECT a.request_id, coalesce(h.attempt, 0) AS attempts FROM asked a LEFT JOIN held h USING (request_id)
  WHERE a.status = 'queued' AND a.request_id % 11 <> 0 AND NOT coalesce(h.runs_on, false)),
turns AS (SELECT *, row_number() OVER (ORDER BY attempts, request_id) - 1 AS turn FROM free)"""


@query(
    "lease_requests", ["ci_runs"], steps=_ASKED,
    sql="""SELECT request_id, ['a', 'b', 'c'][turn % 3 + 1] AS worker, (attempts + 1)::INTEGER AS attempt,
      epoch(TIMESTAMP '2024-01-02')::BIGINT AS leased_at, epoch(TIMESTAMP '2024-01-02 01:00:00')::BIGINT AS lease_until FROM turns""",
)
def lease_requests(t):
    number = F.col("run_id")
    # Every request is asked twice; some leases have run out and some go on.
    asked = t.ci_runs.select(number.alias("request_id"), F.when(number % 3 == 0, "rejected").otherwise("queued").alias("status"))
    tried = t.ci_runs.filter(number % 4 < 2).select(
        number.alias("request_id"), F.explode(F.sequence(F.lit(1), (number % 3 + 1).cast("int"))).alias("attempt"),
        F.when(number % 4 == 1, F.lit("2024-01-03")).otherwise("2024-01-02").cast("timestamp").alias("lease_until"),
    )
    done = t.ci_runs.filter(number % 11 == 0).select(number.alias("request_id"))
    now = F.lit("2024-01-02").cast("timestamp")
    leased = requests.hand_out(asked.union(asked), tried, done, ["a", "b", "c"], now, 3600)
    return leased.withColumns({c: F.unix_timestamp(c) for c in ("leased_at", "lease_until")})
