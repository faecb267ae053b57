"""Problem 8: documents put together into containers of fixed capacity.

The plan is made from the histogram of lengths, never from documents: best-fit decreasing, where a class of containers
with equal content is placed at once. The plan says, for each length, which ranks within that length go to which
containers; documents take their slot by their rank. Only the histogram (at most ``capacity`` + 1 rows) reaches the driver.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.llm.tokens import encode
from corpuscle.session import settle
from corpuscle.sources.tables import table

CAPACITY = 2_048
#: Ranks within a length are counted in this many parts, so that no length is one task's work.
PARTS = 256


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Slots (length, first rank, first container, number): the ranks from the first on go one each to the containers from the first on.

    Lengths run from the largest down; each goes to the containers with the least room that still holds it, and to new ones
    when none does. Containers of equal content form a class with consecutive numbers, split when only part of it is
    filled. A class that takes a length as often as it fits does so at once, so work depends on distinct lengths, not counts.
    Lengths of 0 need no room: they go one by one to the containers in turn, to new ones where a container would hold more than ``capacity`` of them.
    """
    slots: list[tuple[int, int, int, int]] = []
    room: list[int] = []
    classes: dict[int, list[tuple[int, int]]] = {}
    made = 0

    def put(r: int, first: int, n: int) -> None:
        if r not in classes:
            classes[r] = []
            insort(room, r)
        classes[r].append((first, n))

    for length in sorted((x for x in histogram if x > 0), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(room, length)
            if at == len(room):
                each = capacity // length
                n = max(1, left // each)
                put(capacity, made, n)
                made += n
                continue
            r = room[at]
            first, n = classes[r].pop()
            if not classes[r]:
                del classes[r]
                room.pop(at)
            each = r // length
            full = left // each
            if full == 0:
                each, full = left, 1
            use = min(n, full)
            for k in range(each):
                slots.append((length, rank + k * use, first, use))
            rank += each * use
            left -= each * use
            put(r - each * length, first, use)
            if use < n:
                put(r, first + use, n - use)
    empties, rank = histogram.get(0, 0), 0
    made = max(made, -(-empties // capacity))
    while rank < empties:
        n = min(made, empties - rank)
        rounds = max(1, (empties - rank) // made)
        if rounds > 1:
            slots.append((0, rank, 0, -made))  # ranks from here on go round the containers 0 to made - 1
            break
        slots.append((0, rank, 0, n))
        rank += n
    return slots


def pack(df: DataFrame, key: str, size: str, capacity: int = CAPACITY, parts: int = PARTS) -> DataFrame:
    """Pieces with their containers: key, ``piece`` (from 0), ``n_pieces``, ``first_token``, ``n_tokens``, ``container``.

    Only items larger than ``capacity`` are split: into full pieces, each a container by itself, and a rest that is placed
    like any item. Null, negative and zero sizes hold nothing, and spread over the containers. Repeated keys are separate
    items. ``df`` is read several times: give it settled. An empty input gives an empty result.
    """
    n = F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0))
    items = df.select(F.col(key).alias("_key"), n.alias("_n"))
    pieces = items.withColumn("n_pieces", F.greatest(F.ceil(F.col("_n") / capacity), F.lit(1)).cast("int"))
    pieces = pieces.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    first = F.col("piece").cast("bigint") * capacity
    pieces = pieces.select("_key", "piece", "n_pieces", first.alias("first_token"), F.least(F.col("_n") - first, F.lit(capacity)).cast("int").alias("n_tokens"))

    part = F.pmod(F.xxhash64("_key", "piece"), F.lit(parts)).cast("int")
    pieces = pieces.withColumn("_part", part)
    counts = pieces.groupBy("n_tokens", "_part").agg(F.count("*").alias("_c"))
    histogram = {r.n_tokens: r.c for r in counts.groupBy("n_tokens").agg(F.sum("_c").alias("c")).collect()}
    slots = plan(histogram, capacity)

    offsets = counts.select("n_tokens", "_part", (F.sum("_c").over(Window.partitionBy("n_tokens").orderBy("_part")) - F.col("_c")).alias("_before"))
    within = Window.partitionBy("n_tokens", "_part").orderBy("_key", "piece")
    ranked = pieces.withColumn("_row", F.row_number().over(within)).join(offsets, ["n_tokens", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_row") - 1).drop("_part", "_row", "_before")

    # One row per length with its slots in order of rank: at most capacity + 1 rows. Whether they are broadcast is left to their size.
    spark = df.sparkSession
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for length, rank, container, many in slots:
        by_length.setdefault(length, []).append((rank, container, many))
    schema = "n_tokens int, _slots array<struct<rank:bigint,container:bigint,many:bigint>>, _ranks array<bigint>"
    rows = [(length, sorted(s), sorted(x[0] for x in s)) for length, s in by_length.items()]
    planned = spark.createDataFrame(rows, schema)
    lo = F.size(F.filter("_ranks", lambda x: x <= F.col("_rank")))
    placed = ranked.join(planned, "n_tokens").withColumn("_slot", F.element_at("_slots", lo))
    into = F.col("_rank") - F.col("_slot.rank")
    container = F.col("_slot.container") + F.when(F.col("_slot.many") < 0, F.pmod(into, -F.col("_slot.many"))).otherwise(into)
    return placed.select(F.col("_key").alias(key), "piece", "n_pieces", "first_token", "n_tokens", container.alias("container"))


def containers(pieces: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per container: its keys in order of piece, the number of pieces, tokens and fill."""
    part = F.struct(F.col("n_tokens").alias("n"), F.col(key).alias("k"), F.col("piece").alias("p"))
    out = pieces.groupBy("container").agg(F.sort_array(F.collect_list(part), asc=False).alias("_p"), F.sum("n_tokens").cast("bigint").alias("n_tokens"))
    return out.select("container", F.transform("_p", lambda x: x["k"]).alias(f"{key}s"), F.size("_p").alias("n_pieces"), "n_tokens", (F.col("n_tokens") / F.lit(float(capacity))).alias("fill"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = settle(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "n", count_only=True))
    return pack(sizes, "doc_id", "n")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the containers hold in several pieces."""
    return _pieces(spark, sf_dir).where("piece = 1").select("doc_id")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers(_pieces(spark, sf_dir), "doc_id")


QUERIES = {"p8_found": p8_found, "p8_containers": p8_containers}
SQL: dict[str, str] = {}
