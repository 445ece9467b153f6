"""Repair requests that are worked off: leases on a queue.

A request is open until it is done. Who takes it holds a lease; a lease that
runs out gives the request back, and the next one gets it with a higher
attempt. Nothing is updated in place: leases and finished requests are tables
that rows are added to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.operators.ordered import numbered

LEASES = "request_id bigint, worker string, attempt int, leased_at timestamp, lease_until timestamp"


def open_requests(requests: DataFrame, leases: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """Valid requests that nobody holds: each once, with the number of attempts so far.

    ``requests`` (request_id, status, ...) as ``watch.repair_requests`` gives
    them; rejected ones and those without an id are never open. ``leases`` as
    ``LEASES``, ``done`` (request_id). Of repeated requests any one counts. A
    lease holds up to, and not at, its end; one without an end holds for good.
    """
    queued = requests.filter((F.col("status") == "queued") & F.col("request_id").isNotNull()).dropDuplicates(["request_id"])
    # Only the last lease of a request counts: one partial maximum, no window.
    last = leases.groupBy("request_id").agg(F.max(F.struct("attempt", F.col("lease_until").isNull().alias("endless"), "lease_until")).alias("_last"))
    free = F.col("_last").isNull() | (~F.col("_last.endless") & (F.col("_last.lease_until") <= now))
    return (
        queued.join(done.select("request_id"), "request_id", "left_anti")
        .join(last, "request_id", "left")
        .filter(free)
        .select(*requests.columns, F.coalesce("_last.attempt", F.lit(0)).alias("attempts"))
    )


def hand_out(
    requests: DataFrame,
    leases: DataFrame,
    done: DataFrame,
    workers: list[str],
    now: Column,
    seconds: int,
    each: int | None = None,
    max_attempts: int | None = None,
) -> DataFrame:
    """New leases for open requests, dealt to the workers in turn.

    Requests go by their ids, those with fewest attempts first, so that one
    that fails again and again holds up no other. With ``each`` no worker gets
    more than that many; with ``max_attempts`` a request that was tried so
    often stays where it is (see ``given_up``). The result has the columns of
    ``LEASES``; it is the caller's to add it to the leases before the workers
    get it, one caller at a time.
    """
    waiting = open_requests(requests, leases, done, now)
    if max_attempts is not None:
        waiting = waiting.filter(F.col("attempts") < max_attempts)
    dealt = numbered(waiting.select("request_id", "attempts"), ["attempts", "request_id"], "_turn")
    if each is not None:
        dealt = dealt.filter(F.col("_turn") < each * len(workers))
    who = F.element_at(F.array(*map(F.lit, workers)), (F.col("_turn") % len(workers) + 1).cast("int"))
    return dealt.select(
        F.col("request_id").cast("bigint").alias("request_id"), who.alias("worker"),
        (F.col("attempts") + 1).cast("int").alias("attempt"),
        now.alias("leased_at"), (now + F.make_dt_interval(secs=F.lit(seconds))).alias("lease_until"),
    )


def given_up(requests: DataFrame, leases: DataFrame, done: DataFrame, now: Column, max_attempts: int) -> DataFrame:
    """Open requests that were tried ``max_attempts`` times or more, as rejected ones."""
    tired = open_requests(requests, leases, done, now).filter(F.col("attempts") >= max_attempts)
    return tired.drop("attempts").withColumn("status", F.lit("rejected")).withColumn("error", F.lit("too many attempts"))
