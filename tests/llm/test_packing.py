import bisect
import random
from collections import Counter, defaultdict

from corpuscle.llm.packing import containers, pack, plan


def fill(histogram, capacity):
    load, seen = Counter(), defaultdict(set)
    for length, rank, first, many in plan(histogram, capacity):
        if many < 0:
            n, seen_to = -many, histogram[length]
            for r in range(rank, seen_to):
                load[first + (r - rank) % n] += length
                assert r not in seen[length]
                seen[length].add(r)
            continue
        for k in range(many):
            assert rank + k not in seen[length]
            seen[length].add(rank + k)
            load[first + k] += length
    assert {k: len(v) for k, v in seen.items()} == {k: v for k, v in histogram.items() if v}
    return load


def one_by_one(sizes, capacity):
    """Best-fit decreasing, item by item."""
    room = []
    for n in sorted((n for n in sizes if n), reverse=True):
        at = bisect.bisect_left(room, n)
        r = room.pop(at) if at < len(room) else capacity
        bisect.insort(room, r - n)
    return len(room)


def test_plans_hold_every_item_once_and_stay_within_capacity():
    rng = random.Random(3)
    for _ in range(300):
        cap = rng.choice([1, 7, 50, 2048])
        h = {rng.randint(0, cap): rng.choice([1, 2, 30, 5000]) for _ in range(rng.randint(0, 40))}
        load = fill(h, cap)
        assert all(v <= cap for v in load.values())
        total = sum(k * v for k, v in h.items())
        assert sum(load.values()) == total
        # Any-fit: at most one container is no more than half full.
        assert sum(v <= cap / 2 and v > 0 for v in load.values()) <= 1 or cap == 1


def test_plan_size_depends_on_distinct_lengths_not_counts():
    h = {k: 10**9 + k for k in range(0, 2049)}
    assert len(plan(h, 2048)) < 64 * 2049


def test_pieces_and_containers(spark):
    rng = random.Random(4)
    sizes = [0, None, -3, 2048, 2049, 4096, 10_000, *[rng.choice([100, 100, 100, 700, 1500, 2047]) for _ in range(500)], *[rng.randint(1, 2048) for _ in range(300)]]
    rows = [(i, n, "x") for i, n in enumerate(sizes)] + [(3, 2048, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, n int, piece string").repartition(4).cache()
    p = pack(df, "doc_id", "n", parts=3).cache()
    got = p.collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.piece, r.first_token, r.n_tokens, r.n_pieces))
    for i, n in enumerate(sizes):
        n = max(n or 0, 0)
        own = sorted(set(by[i]))
        assert sum(x[2] for x in own) == n and [x[0] for x in own] == list(range(max(1, -(-n // 2048))))
        assert all(x[1] == 2048 * x[0] and x[3] == len(own) for x in own)
    assert len(by[3]) == 2
    boxes = containers(p, "doc_id").collect()
    assert sum(b.n_pieces for b in boxes) == len(got) and all(b.n_tokens <= 2048 for b in boxes)
    assert sum(b.n_tokens for b in boxes) == sum(max(n or 0, 0) for _, n, _ in rows)
    assert len(boxes) <= one_by_one([r.n_tokens for r in got], 2048) + 1
    assert all(abs(b.fill - b.n_tokens / 2048) < 1e-12 and len(b.doc_ids) == b.n_pieces for b in boxes)


def test_empty_and_only_empties(spark):
    empty = spark.createDataFrame([], "doc_id bigint, n int")
    assert pack(empty, "doc_id", "n").count() == 0
    only = spark.createDataFrame([(i, None) for i in range(5)], "doc_id bigint, n int")
    assert {r.container for r in pack(only, "doc_id", "n").collect()} == {0}


def test_empty_items_fill_no_container_beyond_its_number():
    for empties, made in ((0, 0), (1, 1), (50, 1), (51, 2), (1_000, 20)):
        load = fill({0: empties} if empties else {}, 50)
        assert len(load) == made
