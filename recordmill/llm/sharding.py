"""Resharding by minimum-cost flow: new shards of equal bytes, with the fewest bytes moved.

Documents lie in blocks, one file each. The flow from old shard sizes to new capacities costs nothing where a byte
stays in its shard and 1 where it moves; blocks are then picked to fill the flows, and only the files of moved
blocks are written again.
"""

from __future__ import annotations

import heapq
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import workspace

OLD_SHARDS = 12
NEW_SHARDS = 16
PLACES = 32  # of each old shard; a place is at least one block
BLOCK_BYTES = 512 << 20  # a place beyond it is cut into more blocks
MAX_BLOCKS = 1 << 18  # the driver holds one row per block; beyond, blocks grow instead of their number

Block = tuple[int, int]  # old shard, number


@dataclass
class Plan:
    """Where each block goes and the number of rows before it in its new shard."""

    shard: dict[Block, int]
    offset: dict[Block, int]
    moved_bytes: int
    least_bytes: int  # what the flow moves; blocks cannot be cut


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes to send from each old shard to each new one; shards of equal number are the same place.

    Successive shortest paths over source, old shards, new shards and sink; paths are found with a queue, since
    residual edges have negative costs.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards hold less than the old ones")
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    room: dict[tuple[int, int], int] = {}
    cost: dict[tuple[int, int], int] = {}
    near: dict[int, set[int]] = {v: set() for v in range(n + m + 2)}

    def edge(u: int, v: int, cap: int, price: int) -> None:
        room[u, v], room[v, u] = cap, 0
        cost[u, v], cost[v, u] = price, -price
        near[u].add(v)
        near[v].add(u)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, int(i != j))
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    while True:
        dist, before, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            u = queue.popleft()
            queued.discard(u)
            for v in near[u]:
                if room[u, v] > 0 and dist[u] + cost[u, v] < dist.get(v, 1 << 60):
                    dist[v], before[v] = dist[u] + cost[u, v], u
                    if v not in queued:
                        queue.append(v)
                        queued.add(v)
        if sink not in dist:
            break
        path, v = [], sink
        while v != source:
            path.append((before[v], v))
            v = before[v]
        push = min(room[e] for e in path)
        for u, v in path:
            room[u, v] -= push
            room[v, u] += push
    return {(i, j): room[n + j, i] for i in range(n) for j in range(m) if room[n + j, i]}


def plan(blocks: dict[Block, tuple[int, int]], old: int, new: int) -> Plan:
    """``blocks``: bytes and rows of each block.

    Every old shard deals its blocks, the largest first, to the new shard with the most bytes of its flow left.
    """
    total = sum(b for b, _ in blocks.values())
    capacity = [total // new + (j < total % new) for j in range(new)]
    supply = [sum(b for (i, _), (b, _) in blocks.items() if i == k) for k in range(old)]
    flow = min_cost_flow(supply, capacity)
    shard: dict[Block, int] = {}
    # what a shard got beyond or short of its flow is made up for by the old shards after it
    short = [0] * new
    for i in range(old):
        goals = {j: f for (a, j), f in flow.items() if a == i}
        for j in goals:
            goals[j] += short[j]
        heap = [(-g, j != i, j) for j, g in goals.items()]
        heapq.heapify(heap)
        for block in sorted((b for b in blocks if b[0] == i), key=lambda b: (-blocks[b][0], b)):
            if not heap:
                heap = [(0, False, i if i < new else 0)]
            left, far, j = heapq.heappop(heap)
            shard[block] = j
            heapq.heappush(heap, (left + blocks[block][0], far, j))
        for left, _, j in heap:
            short[j] = -left
    offset, filled = {}, [0] * new
    for block in sorted(blocks):
        offset[block] = filled[shard[block]]
        filled[shard[block]] += blocks[block][1]
    moved = sum(blocks[b][0] for b, j in shard.items() if b[0] != j)
    return Plan(shard, offset, moved, sum(f for (i, j), f in flow.items() if i != j))


def cuts(place: DataFrame, block_bytes: int, max_blocks: int) -> dict[Block, int]:
    """Blocks of each place that needs more than one: (old shard, place) to their number.

    One pass that groups by place (some hundred), summed before the shuffle.
    """
    sizes = {(r.old_shard, r.place): r.bytes for r in place.groupBy("old_shard", "place").agg(F.sum("size").alias("bytes")).collect()}
    # rounding up adds at most one block a place
    room = max(1, max_blocks - len(sizes))
    size = max(block_bytes, -(-sum(sizes.values()) // room))
    return {k: -(-b // size) for k, b in sizes.items() if b > size}


def lay_out(docs: DataFrame, folder: str, old: int, places: int, block_bytes: int, max_blocks: int) -> str:
    """Write the documents in their old shards, one file per block; text, size and checksum go along.

    A place is a hash of the row. Within a place that is cut, rows are dealt by a hash that includes their number in
    the scan, so that repeated rows, which share a place, go to all its blocks.
    """
    bits = F.xxhash64("doc_id", "text")
    place = docs.select(
        "doc_id", "text",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.pmod(bits, F.lit(old)).cast("int").alias("old_shard"),
        F.pmod(F.shiftright(bits, 20), F.lit(places)).cast("int").alias("place"),
    )
    cut = cuts(place, block_bytes, max_blocks)
    keys, parts = ["old_shard", "block"], int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if cut:
        table = docs.sparkSession.createDataFrame([(*k, n) for k, n in sorted(cut.items())], "old_shard int, place int, blocks int")
        nth = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.coalesce("blocks", F.lit(1))).cast("int")
        # at most one row per place, a fixed number
        place = place.join(F.broadcast(table), ["old_shard", "place"], "left")
        place = place.withColumn("block", F.col("place") + F.lit(places) * nth).drop("place", "blocks")
    else:
        place = place.withColumnRenamed("place", "block")
    path = f"{folder}/old"
    files = old * places + sum(cut.values())
    dealt = place.repartition(files, *keys) if files > max(parts, old * places) else place.repartition(*keys)
    dealt.write.partitionBy(*keys).parquet(path)
    return path


def resharded(
    docs: DataFrame,
    old: int = OLD_SHARDS,
    new: int = NEW_SHARDS,
    places: int = PLACES,
    block_bytes: int = BLOCK_BYTES,
    max_blocks: int = MAX_BLOCKS,
) -> tuple[DataFrame, Plan]:
    """The rows of the new layout (doc_id, text, size, text_crc32, old_shard, block, shard, before), and the plan.

    ``docs`` needs doc_id and text; other columns are not read. It should be a stored table, since its rows are
    numbered as they are scanned: a scan that is repeated after a loss gives the same numbers. A null text has size 1,
    as an empty one; repeated rows lie in one place, whose blocks share them if it has more than one; an empty table
    gives an empty table. A block holds about ``block_bytes`` at most. Only files of moved blocks are written again,
    by the tasks that read them, without a shuffle.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "shards")
    path = lay_out(docs, folder, old, places, block_bytes, max_blocks)
    schema = "doc_id long, text string, size long, text_crc32 long, old_shard int, block int"
    have = spark.read.schema(schema).option("basePath", path).parquet(path)
    counted = have.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    sizes = {(r.old_shard, r.block): (r.bytes, r.n) for r in counted}  # at most max_blocks rows
    made = plan(sizes, old, new)
    moved = sorted(b for b, j in made.shard.items() if b[0] != j)
    stay = sorted(b for b, j in made.shard.items() if b[0] == j)
    where = spark.createDataFrame(
        [(i, k, made.shard[i, k], made.offset[i, k]) for i, k in sizes], "old_shard int, block int, shard int, before long"
    )

    def files(root: str, some: list[Block]) -> DataFrame:
        return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/old_shard={i}/block={k}" for i, k in some])

    parts = []
    if stay:
        parts.append(files(path, stay))
    if moved:
        again = f"{folder}/moved"
        files(path, moved).write.partitionBy("old_shard", "block").parquet(again)
        parts.append(spark.read.schema(schema).option("basePath", again).parquet(again))
    rows = parts[0] if parts else have
    for more in parts[1:]:
        rows = rows.unionByName(more)
    # one row of 16 bytes per block, at most max_blocks of them
    return rows.join(F.broadcast(where), ["old_shard", "block"]), made
