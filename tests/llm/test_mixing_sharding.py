from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakestar.llm import mixing, sharding

SCHEMA = "doc_id bigint, text string, source string"


def inverted(mean: float, u: float) -> int:
    p = c = math.exp(-mean)
    k = 0
    while c <= u and k < 10_000:
        k += 1
        p *= mean / k
        c += p
    return k


def uniform(seed, doc, part=1) -> float:
    return int(hashlib.md5(f"{seed}|{doc}|{part}".encode()).hexdigest()[:13], 16) / 2 ** 52


def test_copies_follow_the_inverted_poisson_distribution(spark):
    rows = [(i, "x" * (10 + i % 7), "a" if i % 3 else "b") for i in range(600)]
    got = Counter(r.doc_id for r in mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), {"a": 1.0, "b": 3.0}, epochs=2.0, seed=5).collect())
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text)
    for doc, _, source in rows:
        mean = {"a": 0.25, "b": 0.75}[source] * 2 * sum(sizes.values()) / sizes[source]
        assert got[doc] == inverted(mean, uniform(5, doc)), doc


def test_output_shares_match_the_weights(spark):
    rows = [(i, "word " * (1 + i % 5), f"s{min(i % 10, 3)}") for i in range(6000)]
    out = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    share = Counter()
    for r in out:
        share[r.source] += len(r.text)
    assert all(abs(v / sum(share.values()) - 0.25) < 0.02 for v in share.values())


def test_a_row_with_a_very_large_mean_is_spread(spark):
    """A mean of 300,000 in 601 parts: three groups, each on its own; rows with equal ids draw the same number."""
    rows = [(1, "x" * 10, "rare"), (100, "y" * 6_010_000, "big"), (None, None, "none")]
    out = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), seed=3)
    assert dict(out.dtypes)["copy_no"] == dict(out.dtypes)["n_copies"] == "bigint"
    mean = 6_010_010 / 2 / 10
    parts = math.ceil(mean / mixing.MAX_MEAN)
    expected = sum(inverted(mean / parts, uniform(3, 1, i + 1)) for i in range(parts))
    row = out.where("doc_id = 1").selectExpr("count(*) AS n", "count(DISTINCT copy_no) AS d", "min(copy_no) AS lo", "max(copy_no) AS hi", "min(n_copies) AS a", "max(n_copies) AS b").first()
    assert tuple(row) == (expected, expected, 1, expected, expected, expected) and parts > 2 * mixing.GROUP
    assert out.where("source = 'none'").count() == inverted(1.0, uniform(3, ""))


def test_rows_are_in_a_random_order_that_repeats(spark):
    df = spark.createDataFrame([(i, "t", "s") for i in range(200)], SCHEMA)
    one, two = ([(r.doc_id, r.copy_no) for r in mixing.mix_sources(df, epochs=3.0).collect()] for _ in range(2))
    assert one == two and one != sorted(one)


def test_large_means_are_split_into_parts(spark):
    rows = [(i, "x", "rare") for i in range(20)] + [(100, "y" * 40_000, "big")]
    got = Counter(r.doc_id for r in mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect())
    rare = [got[i] for i in range(20)]
    assert all(abs(n - 1001) < 200 for n in rare) and len(set(rare)) > 3


@pytest.mark.parametrize("rows", [
    [], [(1, None, "a"), (2, "", "a")], [(None, "abc", None), (None, "abc", None), (3, "abc", "a")],
])
def test_mixing_odd_rows(spark, rows):
    out = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), epochs=8.0).collect()
    if not any(r[1] for r in rows):  # a source without bytes: a mean of the epochs for each row
        assert Counter(r.doc_id for r in out) == Counter({r[0]: inverted(8.0, uniform(17, r[0])) for r in rows})
    else:
        assert {r.source for r in out} == {None, "a"}
        copies = Counter((r.doc_id, r.copy_no) for r in out if r.source is None)
        assert set(copies.values()) <= {2}  # equal ids draw the same number


def test_a_source_without_weight_is_left_out(spark):
    rows = [(1, "abc", "a"), (2, "abc", "b")]
    assert {r.source for r in mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), {"a": 1.0}, epochs=20.0).collect()} == {"a"}


def test_mixing_clashing_columns_give_way(spark):
    df = spark.createDataFrame([(1, "abc", "a", 7, "k", 3)], SCHEMA + ", N_COPIES int, shuffle_key string, mix_cdf int")
    out = mixing.mix_sources(df, epochs=20.0)
    assert [c.lower() for c in out.columns].count("n_copies") == 1 and out.first()["mix_cdf"] == 3 and out.first()["n_copies"] >= 1


def least_capacity(sizes, shards):
    ends = range(len(sizes) + 1)
    return min(max(sum(sizes[a:b]) for a, b in itertools.pairwise([0, *cut, len(sizes)]))
               for cut in itertools.combinations_with_replacement(ends, shards - 1))


def test_minimax_cuts_against_all_cuts():
    draw = random.Random(3)
    for _ in range(150):
        sizes = [draw.randint(1, 30) for _ in range(draw.randint(1, 9))]
        shards = draw.randint(1, 4)
        capacity, cuts = sharding.minimax_cuts(np.array(sizes), shards)
        parts = [sum(sizes[a:b]) for a, b in itertools.pairwise([0, *cuts])]
        assert cuts[-1] == len(sizes) and capacity == max(parts) == least_capacity(sizes, shards)


def check_shards(rows, out, shards):
    texts = defaultdict(set)
    slots = defaultdict(list)
    for r in out:
        texts[r.text or ""].add(r.shard)
        slots[r.shard].append(r.slot)
        assert r["size"] == len((r.text or "").encode()) + 8 and r.text_crc32 == zlib.crc32((r.text or "").encode())
        assert r.law == "bytes" and r.grown_shard is None
    assert len(out) == len(rows) and all(len(v) == 1 for v in texts.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))


def test_shards_are_near_equal_and_keep_equal_texts_together(spark):
    rows = [(i, f"text {i % 900} " * (1 + i % 40), "s") for i in range(4000)]
    out = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 24).collect()
    check_shards(rows, out, 24)
    load = Counter()
    for r in out:
        load[r.shard] += r["size"]
    group = Counter()
    for r in out:
        group[r.text] += r["size"]
    assert max(load.values()) <= sum(load.values()) / 24 + max(group.values())


def test_a_third_of_all_rows_in_one_group(spark):
    rows = [(i, "copy " * 9 if i % 3 == 0 else f"text {i}", "s") for i in range(3000)]
    out = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 8).collect()
    check_shards(rows, out, 8)
    load = Counter()
    for r in out:
        load[r.shard] += r["size"]
    hot = next(r.shard for r in out if r.text and r.text.startswith("copy"))
    rest = [v for k, v in load.items() if k != hot]
    assert len(load) == 8 and max(rest) <= 1.05 * sum(rest) / 7  # the group has a shard of its own, the others are even


def loads(out, shards):
    load = Counter({k: 0 for k in range(shards)})
    for r in out:
        load[r.shard] += r["size"]
    return [load[k] for k in range(shards)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cuts_fall_between_groups_wherever_the_capacity_needs_it(spark, monkeypatch, seed):
    """With four ranges to begin with, and leaves that are split a little at a time, the largest shard is the least possible one for the groups in hash order."""
    monkeypatch.setattr(sharding, "ATOM_BITS", 2)
    monkeypatch.setattr(sharding, "LEAVES", 64)
    draw = random.Random(seed)
    rows = [(i, f"group {draw.randrange(60)}" + " x" * draw.randint(0, 1) * 9, None) for i in range(300)]
    shards = 5
    out = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), shards).collect()
    check_shards(rows, out, shards)
    size = Counter()
    for _, text, _ in rows:
        size[text] += len(text) + 8
    keys = {r.text: r.k for r in spark.createDataFrame(rows, SCHEMA).selectExpr("text", "xxhash64(text) AS k").distinct().collect()}
    ordered = [size[t] for t in sorted(size, key=lambda t: keys[t] % 2 ** 64)]
    assert max(loads(out, shards)) == sharding.minimax_cuts(np.array(ordered), shards)[0]


def test_as_many_shards_as_groups_are_all_filled(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ATOM_BITS", 6)
    rows = [(i, f"{i:06d}", None) for i in range(3000)]
    out = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 1000).collect()
    check_shards(rows, out, 1000)
    assert set(loads(out, 1000)) == {3 * 14}


def test_place_leaves_against_all_cuts():
    draw = random.Random(9)
    for _ in range(100):
        sizes = np.array([draw.choice([1, 2, 5, 40]) for _ in range(draw.randint(1, 8))])
        shards = draw.randint(1, 4)
        placed = sharding.place_leaves(sizes, shards)
        heavy = sharding.heavy_leaves(sizes, shards)
        assert all(sum(placed == placed[i]) == 1 for i in heavy)
        rest = [int(s) for i, s in enumerate(sizes) if i not in heavy]
        load = [int(sizes[placed == k].sum()) for k in set(placed.tolist()) - {int(placed[i]) for i in heavy}]
        assert (max(load) if load else 0) == (least_capacity(rest, shards - len(heavy)) if rest else 0)


@pytest.mark.parametrize("rows", [[], [(1, None, "s"), (1, None, "s"), (None, "", None)], [(5, "x" * 300_000, "s"), (6, "ä", None)]])
def test_sharding_odd_rows(spark, rows):
    check_shards(rows, sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 3).collect(), 3)


def test_sharding_clashing_columns_give_way(spark):
    df = spark.createDataFrame([(1, "a", "s", 9, 9, 9)], SCHEMA + ", SHARD int, slot int, shard_key int")
    out = sharding.assign_shards(df, 2).first()
    assert out["slot"] == 0 and out["shard_key"] == 9
