"""Near-duplicates and substring dedup against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from lakestar.llm import components, near_dup, shingles, substring_dedup

DOC = "doc_id bigint, text string"


def shingle_sets(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or (frozenset([tuple(words)]) if words else frozenset())


def brute_groups(rows, percent):
    sets = {d: shingle_sets(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            one, two = sets[a], sets[b]
            if one and two and 100 * len(one & two) >= percent * len(one | two):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def random_corpus(seed, n=220):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[draw.choice(vocabulary) for _ in range(draw.randint(30, 160))] for _ in range(14)]
    rows = []
    for i in range(n):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 2, 3, 5, 9])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append((i, " ".join(words)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 80)])
def test_groups_of_copies_and_near_copies(spark, seed, percent):
    rows = random_corpus(seed)
    got = near_dup.near_duplicate_groups(spark.createDataFrame(rows, DOC), percent).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, percent)


def test_a_group_around_the_threshold(spark):
    """Many documents that share most of their words, linked only by some pairs: chains, hot keys, and keys of several groups."""
    draw = random.Random(5)
    shared = [f"s{i}" for i in range(60)]
    rows = []
    for i in range(160):
        own = [f"o{i}x{j}" for j in range(draw.randint(2, 12))]
        rows.append((i, " ".join(shared[:draw.randint(48, 60)] + own)))
    got = near_dup.near_duplicate_groups(spark.createDataFrame(rows, DOC), 80).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, 80)


def test_near_duplicates_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  two"), (6, "one two three"), (7, long), (8, long + " end"),
            (9, "a b c d e"), (9, "a b c d e"), (10, "A B C D E"), (None, "a b c d e"), (11, "y" * 70_000)]
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicate_groups(spark.createDataFrame(rows, DOC), 85).collect()}
    assert got == brute_groups([r for r in rows if r[0] is not None], 85)
    assert got[5][1] == 4 and got[8][1] == 7 and got[10][1] == 9 and got[2] == (0, 2)


def test_repeated_ids_are_one_document(spark):
    rows = [(1, None), (1, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f")]
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicate_groups(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {1: (2, 1), 2: (2, 1)}


@pytest.mark.parametrize("bounds", [{"BLOCK": 8}, {"BLOCK_GRAMS": 300, "STREAM": 4}])
def test_blocks_and_streams_of_any_size_give_the_same_links(spark, monkeypatch, bounds):
    """Keys of many more members than a block or a stream holds; every pair's similarity is near the threshold, so that none is missed is a recall of 1."""
    for name, value in bounds.items():
        monkeypatch.setattr(near_dup, name, value)
    draw = random.Random(15)
    shared = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(shared[:draw.randint(50, 60)] + [f"o{i}x{j}" for j in range(draw.randint(2, 12))])) for i in range(120)]
    rows += [(200 + i, t) for i, t in random_corpus(3, 100)]
    got = near_dup.near_duplicate_groups(spark.createDataFrame(rows, DOC), 80).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, 80)


def test_more_members_of_a_key_than_a_block_holds(spark):
    """600 documents that share most of their shingles and are linked by chains only."""
    draw = random.Random(17)
    shared = [f"s{i}" for i in range(50)]
    rows = [(i, " ".join(shared[:draw.randint(44, 50)] + [f"o{i}x{j}" for j in range(draw.randint(3, 9))])) for i in range(600)]
    got = near_dup.near_duplicate_groups(spark.createDataFrame(rows, DOC), 80).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, 80)


@pytest.mark.parametrize("percent", [80, 85])
def test_documents_of_a_template_are_not_compared_in_pairs(spark, monkeypatch, percent):
    """A similarity of 0.71: every key is mixed, but no two documents meet in a cell, however many there are."""
    counts, write = {}, near_dup.written

    def counted(frame, purpose):
        out = write(frame, purpose)
        counts[purpose] = out.count()
        return out

    monkeypatch.setattr(near_dup, "written", counted)
    template = [f"t{i}" for i in range(165)]
    n = 300
    rows = [(i, " ".join(template + [f"o{i}x{j}" for j in range(33)])) for i in range(n)]
    got = near_dup.near_duplicate_groups(spark.createDataFrame(rows, DOC), percent).collect()
    assert {r.component_id for r in got} == set(range(n))
    assert counts["near-rest"] == n and counts["near-able"] == 0


def test_one_of_each_group_stays_with_all_columns(spark):
    df = spark.createDataFrame([(3, "a b c d e", "x", 1), (2, "A b c d e", "y", 2), (None, "a b c d e", None, 3), (7, None, "z", 4), (7, "", "z", 5)],
                               DOC + ", label string, id int")
    out = near_dup.keep_one_of_each(df)
    assert out.columns == df.columns and sorted(r["id"] for r in out.collect()) == [2, 4, 5]
    assert near_dup.keep_one_of_each(spark.createDataFrame([], DOC)).collect() == []


def test_rows_of_one_id_or_none_are_judged_by_their_texts(spark):
    text = "one two three four five six seven"
    kept = lambda rows: sorted((str(r.doc_id), r.text) for r in near_dup.keep_one_of_each(spark.createDataFrame(rows, DOC)).collect())
    assert kept([(1, text), (2, text), (2, "another text")]) == [("1", text), ("2", "another text")]
    assert kept([(None, text), (None, text), (5, text), (5, text), (6, text)]) == [("5", text)]
    assert kept([(None, text), (None, text), (None, "other words")]) == [("None", "one two three four five six seven"), ("None", "other words")]


def test_keys_are_shared_by_all_signatures_within_the_distance():
    draw = np.random.RandomState(1)
    bound = near_dup.CHUNKS * (near_dup.ERRORS + 1) - 1
    for _ in range(300):
        one = draw.randint(0, 1 << 16, near_dup.VALUES).astype(np.uint16)
        two = one.copy()
        two[draw.choice(near_dup.VALUES, bound, replace=False)] ^= 1
        a, b = near_dup.keys(np.stack([one, two]))
        shared = np.flatnonzero(a == b)
        assert len(shared) and near_dup.first_shared((one != two)[None])[0] == shared[0]


def test_signatures_estimate_the_similarity():
    draw = np.random.RandomState(2)
    every = draw.randint(0, 1 << 63, 4000).astype(np.uint64)
    one, two = every[:3400], every[600:]  # a similarity of 0.7
    same = np.mean([(near_dup.signature(shingles.mix(one + np.uint64(i))) == near_dup.signature(shingles.mix(two + np.uint64(i)))).mean() for i in range(40)])
    assert abs(same - 2800 / 4000) < 0.05


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(10, 60)] + [(1, 2), (2, 3), (3, 1), (5, 5), (2, 1)] + [(160, 99)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 99 for i in range(99, 161)} | {i: 7 for i in [7, *range(10, 60)]} | {1: 1, 2: 1, 3: 1}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_word_hashes_of_long_texts_equal_those_of_their_parts(monkeypatch):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcXYZé ñ日".replace(" ", "")) for _ in range(draw.randint(1, 90))) for _ in range(400)]
    text = "".join(w + draw.choice([" ", "\t\n", "\x0b", "  "]) for w in words)
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "STEP", 50)
    assert (shingles.word_hashes(text) == whole).all() and len(whole) == len(words) == len(text.encode().split())
    assert len(np.unique(whole)) == len(set(words))
    assert (shingles.word_hashes("ABC é É", lower=True) == shingles.word_hashes("abc é É")).all()


def brute_kept(rows):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            if d is not None:
                key = tuple(w[i:i + 13])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 12):
            if d is not None and first[tuple(w[i:i + 13])] < d:
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return Counter(out)


def passages(seed, n=150):
    draw = random.Random(seed)
    common = [[f"p{k}x{i}" for i in range(draw.randint(11, 60))] for k in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randint(0, 5)):
            if draw.random() < 0.6:
                p = draw.choice(common)
                a = draw.randint(0, 5)
                words += p[a:len(p) - draw.randint(0, 5)]
            else:
                words += [f"own{i}x{draw.randint(0, 9)}" for _ in range(draw.randint(1, 30))]
        rows.append((i, draw.choice([" ", "\n", " \t "]).join(words)))
    return rows


def factored(df):
    return substring_dedup.factor_documents(df)


def test_repeated_passages_go(spark):
    rows = passages(1)
    got = factored(spark.createDataFrame(rows, DOC)).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_kept(rows)
    assert sum(r.n_removed for r in got) > 500
    texts = dict(rows)
    for r in got:
        own = texts[r.id].split()
        for f in r.factors:  # each window of a factor stands in its block
            block = " ".join(texts[f.block].split())
            assert f.words >= 13 and f.block < r.id
            assert all(" ".join(own[i:i + 13]) in block for i in range(f.start, f.start + f.words - 12))


def test_a_run_goes_on_over_a_factor_boundary(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(w[:30])), (2, " ".join(w[18:60])), (3, "x " + " ".join(w) + " y"), (4, " ".join(w[:12])), (5, " ".join(w[40:53]))]
    got = {r.id: (r.n_removed, len(r.factors)) for r in factored(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (60, 2), 4: (0, 0), 5: (13, 1)}


def test_substring_dedup_odd_rows(spark):
    long = " ".join(f"x{i % 977}y{i % 1009}" for i in range(50_000))
    same = " ".join(f"k{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, "\x0b \n"), (4, long), (5, long), (6, same), (6, same), (7, same), (None, same), (8, "z" * 100_000),
            (9, " ".join(["r"] * 40)), (10, " ".join(["r"] * 14)), (11, same.replace(" ", " "))]
    got = factored(spark.createDataFrame(rows, DOC)).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_kept(rows)
    assert factored(spark.createDataFrame([], DOC)).collect() == []


def test_substring_dedup_ignores_extra_columns(spark):
    df = spark.createDataFrame([(1, "a b", 1, "h", 3)], DOC + ", id int, hits string, ANCHOR int")
    assert factored(df).first().kept_text == "a b"
