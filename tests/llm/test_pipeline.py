"""Each stage of the pipeline against a brute-force version, on its own input, and the whole run."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from lakestar.llm import lang_id, queries
from test_dedup import brute_groups
from test_extract_lang_ann import told_by_hand
from test_mixing_sharding import inverted, uniform

SF = "/root/testdata/sf0.001"


def columns(rows):
    return Counter((r.doc_id, r.text) for r in rows)


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, names = [docs.collect()], docs.columns
    for name, stage in P.STAGES:
        result = stage(spark, docs, SF)
        docs = spark.createDataFrame(result.collect(), result.schema)
        assert docs.columns[:len(names)] == names and (name == "sharding" or docs.columns == names)
        out.append(docs.collect())
    return out


def test_the_stages_are_in_order():
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_language_stage(spark, stages):
    before, after = stages[0], stages[1]
    model = lang_id.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    told = {r.doc_id: told_by_hand(r.text, model) for r in before}
    assert columns(after) == columns(r for r in before if told[r.doc_id][0] != "und" and told[r.doc_id][1] >= 0.005)
    assert len(after) >= 0.97 * len(before)


def test_near_duplicate_stage(stages):
    before, after = stages[1], stages[2]
    groups = brute_groups([(r.doc_id, r.text) for r in before], 80)
    assert columns(after) == columns(r for r in before if groups[r.doc_id][1] == r.doc_id)
    assert len(after) < len(before)


def test_decontamination_stage(spark, stages):
    before, after = stages[2], stages[3]

    def grams(text):
        words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    items = [grams(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r in before if not any(len(s & grams(r.text)) >= 0.8 * len(s) for s in items if s)]
    assert columns(after) == columns(clean)


def test_mixing_stage(stages):
    before, after = stages[3], stages[4]
    size = Counter()
    for r in before:
        size[r.source] += len(r.text.encode())
    expected = Counter()
    for r in before:
        mean = sum(size.values()) / len(size) / size[r.source]
        expected[r.doc_id, r.text] += inverted(mean, uniform(17, r.doc_id))
    assert columns(after) == +expected


def test_sharding_stage(stages):
    before, after = stages[4], stages[5]
    assert columns(after) == columns(before)
    slots, shards = defaultdict(list), defaultdict(set)
    for r in after:
        slots[r.shard].append(r.slot)
        shards[r.text].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(P.SHARDS))
    assert all(len(v) == 1 for v in shards.values())


def test_the_run_equals_its_stages(spark, stages):
    got = E.queries()["pipeline"](spark, SF).collect()
    assert Counter((r.doc_id, zlib.crc32(r.text.encode()), r.shard, r.slot) for r in got) == \
        Counter((r.doc_id, zlib.crc32(r.text.encode()), r.shard, r.slot) for r in stages[-1])


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None, 1)],
    [(1, "the and of to is was in that for with by from are", "en", None, 5, 1), (1, "the and of to is was in that for with by from are", "en", None, 5, 1), (2, "", "en", "s", 0, 2),
     (3, "le la les des une dans pour avec sur qui que est " * 2000, "fr", "s", 1, 3), (None, "der die und ein das mit von den ist", "de", "t", 2, 4)],
])
def test_odd_documents_pass_all_stages(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, SHARD int")
    seen = []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append(Counter(r.text for r in docs.collect()))
    assert {"shard", "slot"} <= {c.lower() for c in docs.columns}
    # Texts with a letter have a language; of equal texts one row stays, whatever its id; nothing here is a test item; mixing only makes copies.
    assert set(seen[0]) == {r[1] for r in rows if r[1]}
    assert seen[1] == seen[2] == Counter(set(seen[0])) and set(seen[3]) <= set(seen[2]) and seen[4] == seen[3]


def test_all_queries_are_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
