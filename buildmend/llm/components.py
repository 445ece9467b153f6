"""Connected components by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildmend.session import durable

#: Steps between two tables: a table costs more than a step, but each step more triples the plan.
STEPS = 2


def step(both: DataFrame, now: DataFrame) -> DataFrame:
    """Take the least label among the neighbours, then the label of that label."""
    seen = both.join(now.select(F.col("v").alias("w"), "label"), "w").groupBy("v").agg(F.min("label").alias("near"))
    lower = now.join(seen, "v", "left").select("v", F.least("label", "near").alias("to"))
    jump = lower.select(F.col("v").alias("to"), F.col("to").alias("far"))
    return lower.join(jump, "to", "left").select("v", F.least("to", "far").alias("label"))


def components(links: DataFrame) -> DataFrame:
    """Least vertex reachable from each vertex of ``links`` (a, b): columns v, label.

    Steps grow with the logarithm of the longest path; lineage is cut by a
    table every few steps, and it ends when no link joins unlike labels.
    Without links the result is empty.
    """
    both = durable(links.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(links.select(F.col("b").alias("v"), F.col("a").alias("w"))))
    now = both.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("label"))
    while True:
        for _ in range(STEPS):
            now = step(both, now)
        now = durable(now)
        ends = both.join(now, "v").join(now.select(F.col("v").alias("w"), F.col("label").alias("other")), "w")
        if ends.filter("label > other").isEmpty():
            return now
