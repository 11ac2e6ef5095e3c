"""Shards of even size by balanced label propagation.

Documents of equal text are linked. Every document starts in a shard by hash; a group
moves whole to the shard where most of its members are, as far as that shard's quota
goes, and asks elsewhere in the next round if it was not admitted, until none asks. A
group is the star around its text, so a round works on one row per group. Groups larger
than a quota fill whole shards first. A closing step moves single documents, which cut
no links, until all shards hold the same number of rows or one more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import hash64, rank_in_groups, text_table
from ratelake.session import materialize

SHARDS = 40
OVERHEAD = 16


def _pick(values: list[int], at: Column) -> Column:
    """The entry of a list with one number for each shard."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), at.cast("int") + 1)


def _counts(df: DataFrame, shards: int) -> list[int]:
    """Rows in each shard: one number for each, whatever the size of the table."""
    out = [0] * shards
    for shard, n in df.groupBy("shard").count().collect():
        out[shard] = n
    return out


def rows_with_texts(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, size, text_crc32, text_hash)``: what sharding needs of a document. NULL text counts as empty."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.substring(F.md5(body.cast("binary")), 1, 32).alias("text_hash"),
    )


def split_over(n: int, room: list[int]) -> list[tuple[int, int]]:
    """``(shard, rows)`` for ``n`` rows in as few shards as ``room`` allows, which it takes from: the roomiest ones, the rest where it fits best."""
    parts = []
    while n:
        fitting = [s for s, r in enumerate(room) if r >= n]
        s = min(fitting, key=room.__getitem__) if fitting else max(range(len(room)), key=room.__getitem__)
        taken = min(n, room[s])
        room[s] -= taken
        n -= taken
        parts.append((s, taken))
    return parts


def propagate(groups: DataFrame, quotas: list[int]) -> tuple[list[DataFrame], dict[str, list[tuple[int, int]]]]:
    """Shards of the ``groups (text_hash, n, votes)``: tables ``(text_hash, shard)`` of whole ones, and the parts of split ones.

    Split are groups larger than a quota, and groups that no shard has room for at the
    end: either are fewer than the shards, for together they are no more than the rows
    there are (than the room that is left). A round admits the largest askers of each
    shard as far as their running sum fits, at least one, so that rounds end.
    """
    shards = len(quotas)
    room = list(quotas)
    parts: dict[str, list[tuple[int, int]]] = {}
    large = groups.where(F.col("n") > max(quotas)).select("text_hash", "n").collect()
    for r in sorted(large, key=lambda r: (-r.n, r.text_hash)):
        parts[r.text_hash] = split_over(r.n, room)
    rest, whole, lost, turn = groups.where(F.col("n") <= max(quotas)), [], [], 0
    while True:
        able = F.filter(F.array(*[F.lit(s) for s in range(shards)]), lambda s: _pick(room, s) >= F.col("n"))
        near = F.array_max(F.filter("votes", lambda v: _pick(room, v["shard"]) >= F.col("n")))["shard"]
        # Where its members are is no room: any shard that has it.
        other = F.get(able, F.pmod(hash64("text_hash", F.lit(turn)), F.greatest(F.size(able), F.lit(1))).cast("int"))
        asking = materialize(rest.select("text_hash", "n", "votes", F.coalesce(near, other).alias("goal")), "asking")
        lost += asking.where("goal IS NULL").select("text_hash", "n").collect()
        # The running sum by size, in two steps: over cells, and inside each.
        cell = ["goal", "n", "_cell"]
        celled = asking.where("goal IS NOT NULL").withColumn("_cell", F.pmod(hash64("text_hash"), F.lit(256)))
        earlier = Window.partitionBy("goal").orderBy(F.desc("n"), "_cell").rowsBetween(Window.unboundedPreceding, -1)
        before = celled.groupBy(*cell).agg(F.sum("n").alias("_rows")).select(*cell, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
        inside = Window.partitionBy(*cell).orderBy("text_hash")
        summed = celled.withColumn("_inside", F.row_number().over(inside) * F.col("n")).join(before, cell)
        fits = F.col("_before") + F.col("_inside") <= _pick(room, F.col("goal"))
        asked = materialize(summed.select("text_hash", "n", "votes", F.col("goal").alias("shard"), fits.alias("fits")), "asked")
        moved = asked.where("fits").groupBy("shard").agg(F.sum("n").alias("n")).collect()
        if not moved:
            break
        for shard, n in moved:
            room[shard] -= n
        whole.append(asked.where("fits").select("text_hash", "shard"))
        rest = asked.where("NOT fits").select("text_hash", "n", "votes")
        turn += 1
    for r in sorted(lost, key=lambda r: (-r.n, r.text_hash)):
        parts[r.text_hash] = split_over(r.n, room)
    return whole, parts


def split_rows(rows: DataFrame, parts: dict[str, list[tuple[int, int]]]) -> DataFrame:
    """``(row, shard)`` of the rows of split groups, as many in each shard as its part says."""
    ranges = []
    for text_hash, pieces in parts.items():
        at = 0
        for shard, n in pieces:
            ranges.append((text_hash, at, at + n, shard))
            at += n
    spread = rows.where(F.col("text_hash").isin(list(parts))).withColumn("_spread", F.shiftrightunsigned(hash64("row"), 32))
    ranked = rank_in_groups(spread.select("row", "text_hash", "_spread"), "text_hash", [], "_spread", ["row"])
    named = text_table(rows.sparkSession, ranges, "text_hash string, first long, past long, shard int")
    return ranked.join(named, "text_hash").where("rank >= first AND rank < past").select("row", "shard")


def even_rows(placed: DataFrame, quotas: list[int]) -> DataFrame:
    """Adds ``slot`` and mends ``shard`` so that every shard has its quota of rows.

    Rows beyond a shard's quota, the single ones first, go to the shards below theirs in
    one fixed order. ``placed`` has ``row, shard, single``.
    """
    shards = len(quotas)
    have = _counts(placed, shards)
    surplus = [max(0, h - q) for h, q in zip(have, quotas, strict=True)]
    before = [sum(surplus[:s]) for s in range(shards)]
    spread = F.shiftrightunsigned(hash64("row"), 32)
    ranked = rank_in_groups(placed.withColumn("_spread", spread), "shard", ["single"], "_spread", ["row"]).drop("_spread")
    extra = F.col("rank") - _pick(quotas, F.col("shard"))
    place = F.col("_place")
    to, slot = F.col("shard"), F.col("rank")
    filled = 0
    for s in range(shards):
        holes = max(0, quotas[s] - have[s])
        if holes:
            here = (place >= filled) & (place < filled + holes)
            to = F.when(here, F.lit(s)).otherwise(to)
            slot = F.when(here, place - filled + have[s]).otherwise(slot)
            filled += holes
    moved = ranked.withColumn("_place", F.when(extra >= 0, extra + _pick(before, F.col("shard"))))
    return moved.withColumns({"_to": to.cast("int"), "slot": slot.cast("long")}).drop("shard", "rank", "_place").withColumnRenamed("_to", "shard")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, text_hash, shard, slot)``, one row per row of ``docs``.

    Shards hold equally many rows, or one more. Rows of equal text end in one shard
    if a quota holds them and room for them is left, else in as few as can be. A NULL text is empty; rows that repeat, and rows without
    doc_id, are rows like others; other columns play no part.
    """
    base = materialize(rows_with_texts(docs), "rows")
    total = base.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    start = F.pmod(hash64("row"), F.lit(shards)).cast("int")
    votes = base.select("text_hash", start.alias("shard")).groupBy("text_hash", "shard").agg(F.count(F.lit(1)).alias("n"))
    vote = F.struct("n", hash64("text_hash", "shard").alias("tie"), "shard")
    groups = votes.groupBy("text_hash").agg(F.sum("n").alias("n"), F.collect_list(vote).alias("votes")).where("n > 1")
    whole, parts = propagate(materialize(groups, "groups"), quotas)
    rows = base.select("row", "text_hash")
    placed = rows.where(~F.col("text_hash").isin(list(parts))) if parts else rows
    if whole:
        placed = placed.join(reduce(DataFrame.union, whole).withColumnRenamed("shard", "goal"), "text_hash", "left")
    else:
        placed = placed.withColumn("goal", F.lit(None).cast("int"))
    placed = placed.select("row", F.coalesce("goal", start).alias("shard"), F.col("goal").isNull().cast("int").alias("single"))
    if parts:
        placed = placed.union(split_rows(rows, parts).select("row", "shard", F.lit(0)))
    even = even_rows(materialize(placed, "placed"), quotas).select("row", "shard", "slot")
    return base.join(even, "row").drop("row")


def cut_links(sharded: DataFrame) -> DataFrame:
    """One row: ``links`` between each group's rows and its main shard, and how many of them are ``cut``."""
    parts = sharded.groupBy("text_hash", "shard").count().groupBy("text_hash").agg(F.sum("count").alias("n"), F.max("count").alias("most"))
    return parts.where("n > 1").agg(F.sum("n").alias("links"), F.sum(F.col("n") - F.col("most")).alias("cut"))
