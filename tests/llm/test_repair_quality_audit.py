"""Conversation repair, quality classifier and filter interaction audit against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from lakestar.llm import filter_audit, queries, quality_gam, turn_repair

SF = "/root/testdata/sf0.01"
TURN = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


# -- op11: conversation structure repair -------------------------------------------------------------------------------------------------

def cheapest_edits(tokens):
    """(cost, audit) by trying all edits of all rows with up to two insertions before, between and behind them."""
    best = None
    for inserts in itertools.product(range(3), repeat=len(tokens) + 1):
        for edits in itertools.product("KRD", repeat=len(tokens)):
            audit, open_roles, cost = "", [], 2 * sum(inserts)
            for token, edit, n in zip(tokens, edits, inserts):
                audit += "I" * n + edit
                open_roles += ["?"] * n
                if edit == "D":
                    cost += 3
                    continue
                if token == "x":
                    break
                cost += (2 if edit == "R" else 0) + (1 if token.isupper() else 0)
                open_roles.append("?" if edit == "R" else token.lower())
            else:
                audit += "I" * inserts[-1]
                open_roles += ["?"] * inserts[-1]
                pattern = "".join("[ua]" if r == "?" else r for r in open_roles)
                n = len(open_roles)
                options = [p + "ua" * (n // 2) for p in ("", "s") if (n - len(p)) % 2 == 0 and (n == 0 or n > len(p))]
                if any(re.fullmatch(pattern, o) for o in options if LEGAL.fullmatch(o)) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


@pytest.mark.parametrize("seed", range(3))
def test_parse_is_the_cheapest_edit(seed):
    draw = random.Random(seed)
    for n in (0, 1, 1, 2, 2, 3, 3, 3):
        tokens = "".join(draw.choice("xsuaoSUAO") for _ in range(n))
        assert turn_repair.best(turn_repair.parse(tokens)) == cheapest_edits(tokens), tokens


def test_every_split_of_a_span_gives_the_same_cell():
    draw = random.Random(5)
    for _ in range(10):
        tokens = "".join(draw.choice("xsuuaaoSUA") for _ in range(9))
        cells = {(i, i + 1): turn_repair.cell_of_row(t) for i, t in enumerate(tokens)}
        for size in range(2, 10):
            for i in range(10 - size):
                found = [turn_repair.combine(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
                assert all(x == found[0] for x in found)
                cells[i, i + size] = found[0]
        assert cells[0, 9] == turn_repair.parse(tokens)


def shortest_path(tokens):
    """(cost, audit) row by row, over the states."""
    follow = {"s": {"0": "s"}, "u": {"0": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}

    def insert(reached):
        for _ in range(2):
            for x in "ua":
                for p, q in follow[x].items():
                    if p in reached and (q not in reached or (reached[p][0] + 2, reached[p][1] + "I") < reached[q]):
                        reached[q] = (reached[p][0] + 2, reached[p][1] + "I")
        return reached

    reached = insert({"0": (0, "")})
    for t in tokens:
        then = {}
        for p, (cost, audit) in reached.items():
            steps = [(p, 3, "D")]
            if t != "x":
                late = int(t.isupper())
                steps += [(follow[x][p], 2 + late, "R") for x in "ua" if p in follow[x]]
                steps += [(follow[t.lower()][p], late, "K")] if p in follow.get(t.lower(), {}) else []
            for q, more, edit in steps:
                then[q] = min(then.get(q, (cost + more, audit + edit)), (cost + more, audit + edit))
        reached = insert(then)
    return min(reached[x] for x in "0a" if x in reached)


def repaired_by_hand(rows):
    """What ``digests`` returns for one conversation's rows (turn, role, text)."""
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, tokens = set(), [], ""
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "-"
        seen.add((role, text))
        faults.append(fault)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        tokens += "x" if fault in "bd" else initial.upper() if fault == "t" else initial
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = shortest_path(tokens)
    out, last, i = [], "", 0
    for edit in audit:
        row = None if edit == "I" else rows[i]
        i += edit != "I"
        if edit != "D":
            role = row[1] if edit == "K" else "assistant" if last == "u" else "user"
            last = role[:1]
            out.append(f"{role}:{row[2] if row else ''}")
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, len(out), hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_conversations_of_one_and_of_many_runs(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "BLOCK", 4)
    draw = random.Random(11)
    rows = []
    for conv, n in enumerate([1, 2, 3, 3, 5, 8, 13, 40, 130, 0, 7]):
        for turn in range(n):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = draw.choice(["Yes.", "No!", "cut", "", None, " \n", "same?", f"t {turn}. ", f"u {turn}"])
            # Equal turns hold equal rows only: ties of other rows are broken by a hash.
            rows += [(conv if conv != 10 else None, draw.choice([turn, turn * 2, None]) if n == 8 else turn, role, text)] * draw.choice([1, 1, 1, 2])
    by = {}
    for conv, *row in {r for r in rows}:
        by.setdefault((conv, row[0]), set()).add(tuple(row))
    rows = [r for r in rows if len(by[r[0], r[1]]) == 1 or r[1] is not None and len(by[r[0], r[1]]) == 1]
    frame = spark.createDataFrame(rows, TURN).repartition(5)
    got = {r.conv: tuple(r)[1:] for r in turn_repair.digests(turn_repair.repair(frame)).collect()}
    convs = {}
    for conv, *row in rows:
        convs.setdefault(conv, []).append(tuple(row))
    assert got == {c: repaired_by_hand(x) for c, x in convs.items()}
    assert None in got and 8 in got


def test_repaired_turns_alternate(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Go on"), (1, 2, "user", "Go on"), (1, 3, "system", "x."), (2, 0, "user", " ")]
    out = turn_repair.repair(spark.createDataFrame(rows, TURN)).collect()
    assert [(r.conv, r.edit, r.role, r.text) for r in out if r.place > 0 and r.conv == 1]
    for conv in (1, 2):
        assert LEGAL.fullmatch("".join(r.role[0] for r in out if r.conv == conv and r.place > 0))
    assert [(r.cost, r.audit, r.blank) for r in out if r.conv == 2 and r.place == 0] == [(3, "D", 1)]


def test_repair_of_odd_inputs(spark):
    empty = spark.createDataFrame([], TURN)
    assert turn_repair.digests(turn_repair.repair(empty)).collect() == []
    clashing = spark.createDataFrame([(1, 0, "user", "A.", 7, "z")], TURN + ", place int, audit string")
    assert [tuple(r)[6:8] for r in turn_repair.digests(turn_repair.repair(clashing)).collect()] == [(2, "KI")]
    long = spark.createDataFrame([(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "B.")], TURN)
    assert turn_repair.digests(turn_repair.repair(long)).collect()[0].audit == "KK"


def test_the_query_keeps_every_conversation(spark, tmp_path):
    """Conversations whose rows are all dropped stay, and damage is by the hash of conversation and turn."""
    rows = [(c, t, r, "Said.") for c in range(60) for t, r in ((0, "user"), (1, "assistant"))] + [(None, None, None, None)]
    spark.createDataFrame(rows, TURN).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op11_repair_turns(spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        left = []
        for c, t, role, text in rows:
            if c == conv:
                text, role = text or " ", role or " "
                fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
                said = (t, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
                left += [said] * {0: 0, 3: 2}.get(fault, 1)
        want = repaired_by_hand(left)
        assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit, row.repaired_sha256) == (*want[:7], want[8])


# -- op12: quality classifier ------------------------------------------------------------------------------------------------------------

def score_by_hand(model, row):
    total = model.intercept
    for value, edges, table in zip(row, model.edges, model.tables):
        total += table[sum(value >= e for e in edges)]
    for a, b, edges_a, edges_b, table in model.pairs:
        total += table[sum(row[a] >= e for e in edges_a)][sum(row[b] >= e for e in edges_b)]
    return 1 / (1 + np.exp(-total))


def test_scores_are_sums_of_table_entries(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_gam.fit(docs, labels)
    assert model.pairs and any(len(t) > 1 for t in model.tables)
    rated = quality_gam.rate(docs.select("doc_id", "text"), model).limit(120).collect()
    for r in rated:
        want = score_by_hand(model, quality_gam.features(r.text))
        assert r.score == pytest.approx(want) and r.predicted == int(r.score >= 0.5)


def test_features_of_a_text_by_hand():
    text = "Ab cd ab.\n\nAb 12 é#!\nAb 12 é#!"
    raw = text.encode()
    got = dict(zip(quality_gam.FEATURES, quality_gam.features(text)))
    assert got["bytes"] == pytest.approx(np.log1p(len(raw))) and got["words"] == pytest.approx(np.log1p(9))
    assert got["distinct_words"] == pytest.approx(5 / 9) and got["top_word"] == pytest.approx(3 / 9)
    assert got["lines"] == pytest.approx(np.log1p(3)) and got["distinct_lines"] == pytest.approx(2 / 3)
    for name, n in (("capitals", 3), ("digits", 4), ("punctuation", 3), ("exclamations", 2), ("symbols", 2), ("line_feeds", 3), ("beyond_ascii", 4)):
        assert got[name] == pytest.approx(n / len(raw)), name


def test_pairs_learn_what_single_tables_cannot():
    draw = np.random.RandomState(3)
    rows = draw.rand(4000, len(quality_gam.FEATURES))
    labels = ((rows[:, 2] > 0.5) ^ (rows[:, 7] > 0.5)).astype(float)
    model = quality_gam.learn(rows[:2000], labels[:2000])
    assert (2, 7) in [(a, b) for a, b, *_ in model.pairs]
    right = (model.scores(rows[2000:]) >= 0.5) == (labels[2000:] == 1)
    assert right.mean() > 0.97
    model.pairs = []
    assert ((model.scores(rows[2000:]) >= 0.5) == (labels[2000:] == 1)).mean() < 0.6


def test_tree_cuts_where_the_gain_is_greatest():
    draw = np.random.RandomState(4)
    g, h, n = draw.randn(9), draw.rand(9) + 0.5, np.full(9, 10)
    gain, at = quality_gam._best_cut(g, h, n)
    part = lambda s: g[s].sum() ** 2 / (h[s].sum() + quality_gam.PENALTY)
    by_hand = {k: part(slice(0, k)) + part(slice(k, 9)) - part(slice(0, 9)) for k in range(1, 9)}
    assert gain == pytest.approx(max(by_hand.values())) and by_hand[at] == pytest.approx(gain)
    step, _ = quality_gam.tree(g.reshape(3, 3), h.reshape(3, 3), n.reshape(3, 3))
    assert step.shape == (3, 3) and len(np.unique(step)) <= quality_gam.LEAVES


def test_held_out_quality_and_no_leak(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    told = queries.op12_quality_score(spark, SF).collect()
    assert len(told) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, known[r.doc_id]) for r in told if r.held_out and r.doc_id in known]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert {r.held_out for r in told} == {True, False} and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in told)
    # Labels of the fold that is held out, languages and sources don't matter.
    docs.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    turned = [(d, 1 - q if zlib.crc32(str(d).encode()) % 3 == 1 else q, 0) for d, q in known.items()]
    spark.createDataFrame(turned, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.doc_id: r.score for r in queries.op12_quality_score(spark, str(tmp_path)).collect()} == {r.doc_id: r.score for r in told}


def test_quality_of_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "Good text.", "c"), (4, "x " * 500_000, "d"), (4, "Good text.", "e")],
                                 "doc_id bigint, text string, score string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert [r.score for r in quality_gam.rate(docs, quality_gam.fit(docs, none)).collect()] == [0.5] * 5
    one = spark.createDataFrame([(2, 1), (4, 1), (None, 0), (1, 0), (9, 0), (4, None)], "doc_id bigint, quality int")
    rated = quality_gam.rate(docs, quality_gam.fit(docs, one)).collect()
    assert all(0 < r.score < 1 for r in rated) and rated[0].score == rated[1].score and rated[2].score == rated[4].score
    assert rated[0].asDict().keys() == {"doc_id", "text", "score", "predicted"}
    assert quality_gam.rate(docs.limit(0), quality_gam.Model()).count() == 0


def test_the_sample_holds_distinct_texts(spark, monkeypatch):
    monkeypatch.setattr(quality_gam, "SAMPLE", 10)
    docs = spark.createDataFrame([(i, "one copy" if i < 900 else f"text {i}.") for i in range(1000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1000)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality_gam, "learn", lambda rows, marks: seen.append(len(rows)))
    quality_gam.fit(docs, labels)
    assert seen == [10]


# -- op13: filter interaction audit ------------------------------------------------------------------------------------------------------

def audit_by_hand(docs, labels):
    good, bad = ({d for d, q, t in labels if d is not None and (q, t)[k] == 1} for k in (0, 1))
    ids = {}
    for d, text, _ in docs:
        if d is not None:
            ids.setdefault(text or "", set()).add(d)
    fails = []
    for d, text, part in docs:
        text = text or ""
        words = text.encode().split()
        own = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
               "D": any(c in "#$%&*|" for c in text), "E": d is not None and min(ids[text]) < d}
        fails.append((part or "", {k for k, v in own.items() if v}, d in good, d in bad))
    out = {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for i, x in enumerate(order):
                gone = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                shapley[x] += len(gone)
                out[part, "".join(order), i + 1] = [len(left), len(gone), sum(x in f[1] for f in own) - len(gone), sum(f[1] == {x} for f in own),
                                                    sum(f[2] for f in gone), sum(f[3] for f in gone)]
        for (p, order, i), row in out.items():
            if p == part:
                row.append(shapley[order[i - 1]])
    return {k: tuple(v) for k, v in out.items()}


def odd_documents():
    draw = random.Random(8)
    long = " ".join(f"w{i}" for i in range(220))
    texts = [None, "", "short", "SHOUT " * 210, "w " * 300, long, long + " #", long.upper(), "many\tcopies", long + "x", long + "|y"]
    docs = [(draw.choice([i, i, i, None, i // 2]), draw.choice(texts) if i % 3 else f"{long} {i}", draw.choice(["en", "de", None, ""])) for i in range(400)]
    docs += [(1000 + i, "many\tcopies", "en") for i in range(200)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 700, 2)] + [(4, 1, 1), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("full", [False, True])
def test_audit_equals_all_orders_by_hand(spark, monkeypatch, full):
    """Also with a sketch that is full, so that every text goes on to the exact comparison."""
    monkeypatch.setattr(filter_audit, "FLUSH", 50)
    if full:
        monkeypatch.setattr(filter_audit, "repeated_counters", lambda hashes, rows: (filter_audit.SLICE, np.full(filter_audit.SLICE // 8, 255, dtype=np.uint8)))
    docs, labels = odd_documents()
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, lang string, mask string").repartition(5)
    rows = filter_audit.filter_interactions(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows} == audit_by_hand(docs, labels)


def test_sketch_keeps_every_repeated_text(spark):
    hashes = [random.Random(i).getrandbits(63) for i in range(3000)]
    frame = spark.createDataFrame([(h,) for h in hashes + hashes[:500] * 3], "h bigint").repartition(7)
    counters, bits = filter_audit.repeated_counters(frame, 4500)
    hit = np.unpackbits(bits)[filter_audit.places(np.array(hashes), counters)].all(axis=0)
    assert hit[:500].all() and hit[500:].mean() < 0.2


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.filter_interactions(none, labels).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id bigint, text string, lang string")
    rows = filter_audit.filter_interactions(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and sum(r.removed for r in rows if r.filter_order[r.step - 1] == "A") == 120
