"""Sharding by sampled splitters.

Records are ordered by a key. A size-weighted sample of keys gives quantile
boundaries; the ranges between them are sorted in parallel, ranges that came
out overfull are subdivided by a further sample of their own, and exact byte
counts of the ranges place every record on the line of all bytes, which is cut
into shards. Only columns of a few bytes move; DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildmend.llm.common import range_of
from buildmend.session import durable

#: Size that a record has besides its text.
OVERHEAD = 16
LOWEST = -(1 << 63)


def draw(rows: DataFrame, n: int, seed: int) -> list[tuple[int, int]]:
    """``n`` keys, each drawn with a weight of its size (exponential clocks)."""
    u = (F.pmod(F.xxhash64(F.lit(seed), "key", "id", "crc"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    drawn = rows.orderBy(-F.log(u) / F.col("size"), "key", "id").limit(n).select("key", "id").collect()
    return sorted({(r["key"], r["id"]) for r in drawn})


def quantiles(sample: list, parts: int) -> list:
    """Up to ``parts - 1`` boundaries that cut a sorted sample evenly."""
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []


def literal(splitter: tuple[int, int]) -> Column:
    return F.struct(F.lit(splitter[0]).cast("long").alias("key"), F.lit(splitter[1]).cast("long").alias("id"))


def sharded(
    docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text",
    sample: int = 8192, ranges: int = 1024, rounds: int = 3,
) -> DataFrame:
    """Put records into ``shards`` shards of nearly equal bytes.

    The key is the first 60 bits of the text's MD5, then the id: equal texts
    are neighbours, and a hot text is cut by its ids. A shard is a run of the
    key order. It differs from an even share by less than its largest record.

    ``sample`` and ``ranges`` bound what reaches the driver and do not grow
    with the data. Null text: size 16, CRC 0. Null ids sort first. Repeated
    rows are records of their own. An empty table gives no rows. Only the id
    and the text are read, so extra columns cannot clash.

    Returns: ``<doc_id>``, size, text_crc32, shard, slot (gapless from 0).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = durable(docs.select(
        F.col(doc_id).alias("given"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST)).alias("id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"),
        F.conv(F.substring(F.md5(body.cast("binary")), 1, 15), 16, 10).cast("long").alias("key"),
    ))
    splitters = quantiles(draw(rows, sample, 0), ranges)
    for turn in range(1, rounds + 1):
        placed = rows.withColumn("range", range_of(F.struct("key", "id"), splitters, literal))
        stats = {r["range"]: (r["bytes"], r["n"]) for r in placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
        total = sum(b for b, _ in stats.values())
        even = total / ranges
        over = [k for k, (b, n) in stats.items() if b > 4 * even and n > 1]
        if not over or turn == rounds:
            break
        more = draw(placed.filter(F.col("range").isin(over)), sample, turn)
        parts = -(-sum(stats[k][0] for k in over) // max(1, int(even)))
        refined = sorted({*splitters, *quantiles(more, int(parts))})
        if refined == splitters:
            break
        splitters = refined

    n_ranges = len(splitters) + 1
    first_byte, first_row, b, n = [], [], 0, 0
    for k in range(n_ranges):
        first_byte.append(b)
        first_row.append(n)
        b, n = b + stats.get(k, (0, 0))[0], n + stats.get(k, (0, 0))[1]

    def at(values: list[int], index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), index + 1)

    inside = Window.partitionBy("range").orderBy("key", "id", "crc", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    middle = 2 * (at(first_byte, F.col("range")) + F.sum("size").over(upto)) - F.col("size")
    line = placed.withColumn("middle", middle).withColumn(
        "row", at(first_row, F.col("range")) + F.row_number().over(inside) - 1
    ).withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"middle * {shards} div {2 * max(total, 1)}")).cast("int"))
    heads = {r["shard"]: r["head"] for r in line.groupBy("shard").agg(F.min("row").alias("head")).collect()}
    return line.select(
        F.col("given").alias(doc_id), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("row") - at([heads.get(k, 0) for k in range(shards)], F.col("shard"))).alias("slot"),
    )
