import random
import re

import numpy as np
import pytest

from recspark.llm import rolling as ro
from recspark.llm.components import components
from recspark.llm.minhash import crossing, near_duplicates, shingle_sets, signatures


def brute(rows, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            inter = len(sets[i] & sets[j])
            if 100 * inter >= percent * (len(sets[i]) + len(sets[j]) - inter):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=str)


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeÉß") for _ in range(r.randint(1, 4)))
    rows = []
    for g in range(12):
        base = [word() for _ in range(r.choice([3, 20, 60, 200]))]
        for _ in range(r.choice([1, 2, 12])):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                t[r.randrange(len(t))] = word()
            rows.append((len(rows) * 7 % 1009, r.choice([" ", "\n", "\t "]).join(t)))
    common = " ".join(word() for _ in range(40))
    rows += [(2000 + i, common + " " + " ".join(word() for _ in range(60))) for i in range(30)]
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_matches_brute_force(spark, percent):
    rows = corpus(percent)
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "ONE two"), (5004, "one\tTWO"), (None, "one two"), (None, None), (5003, "another text"), (5003, "one two")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), percent=percent, block=4).collect()
    assert sorted(((g.doc_id, g.n_shingles, g.component_id) for g in got), key=str) == brute(rows, percent)
    assert all(g.kept == (g.doc_id is None or g.doc_id == g.component_id) for g in got)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, id long, n long, component string")
    assert near_duplicates(df).count() == 0
    df = spark.createDataFrame([(1, "a b c", 9, 9, "x"), (2, "a b c", 9, 9, "x")], df.schema)
    assert sorted(tuple(r) for r in near_duplicates(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_large_group_meets_in_few_cells(spark):
    """3,000 members of 30 buckets: each set goes once to every block that its own one meets, and every cross pair has its cell."""
    r = random.Random(4)
    members = [(k, i, 100, i * 7, 0 if i % 100 else i) for i in range(3000) for k in r.sample(range(30), 20)]
    df = spark.createDataFrame(members, "key long, rep long, n long, s1 long, component long")
    cells = crossing(df, 512).collect()
    blocks = {c.rep: c.blk for c in cells}
    assert 6 <= len(set(blocks.values())) <= 40
    strays = {blocks[i] for i in range(3000) if i and i % 100 == 0}
    assert len(cells) <= sum(1 if i % 100 else 0 for i in range(3000)) * len(strays) + 30 * len(set(blocks.values()))
    together = {}
    for c in cells:
        together.setdefault((c.a, c.b), set()).add(c.rep)
    for i in range(100, 3000, 100):
        for j in range(3000):
            if i != j:
                a, b = sorted((blocks[i], blocks[j]))
                assert {i, j} <= together[a, b]
    few = [(c.a, c.b, c.rep) for c in crossing(df.where("rep < 400"), 512).collect()]
    assert len(few) == len(set(few)) and len(few) <= 3 * 400


def test_many_copies_of_one_text(spark):
    rows = [(i, "one text that very many documents hold word by word") for i in range(4000)] + [(5000, "and another one that is not a copy of it")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).where("kept").collect()
    assert [x.doc_id for x in got] == [0, 5000]


def test_words_across_blocks(monkeypatch):
    monkeypatch.setattr(ro, "BLOCK", 7)
    raw = b"  alpha\x0bbeta gamma alpha  supercalifragilistic x beta"
    h, at = ro.words(raw)
    seen = {}
    for m, x, s in zip(re.finditer(rb"[^\x20\x09-\x0D]+", raw), h, at, strict=True):
        assert m.start() == s and seen.setdefault(m[0], x) == x
    assert len(set(seen.values())) == len(seen)


def test_signature_agreement_estimates_similarity():
    r = np.random.default_rng(3)
    a = r.integers(0, 1 << 62, 4000).astype(np.uint64)
    b = np.concatenate([a[:3000], r.integers(0, 1 << 62, 1000).astype(np.uint64)])
    s = signatures(np.concatenate([a, b]), np.array([0, 4000, 8000]), 512)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.08


def test_long_text():
    e, off = shingle_sets([b"word " * 300_000, None, b"a b"], 5)
    assert list(np.diff(off)) == [1, 0, 1]


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_rounds_over_few_edges_take_few_tasks(spark):
    """Empty tasks of a wide session would each leave files and events in every round."""
    wide = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 12)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 7)], "a long, b long")
    try:
        for k, v in wide.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("components-tasks", "")
        got = {r.node: r.component for r in components(edges).collect()}
        status = spark.sparkContext.statusTracker()
        stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("components-tasks") for s in status.getJobInfo(j).stageIds]
        tasks = [s.numTasks for s in stages if s]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 1 for i in range(1, 13)} | {1000: 1000, 1001: 1000}
    assert len(tasks) > 10 and sum(n >= 64 for n in tasks) < len(tasks) / 4  # of the first table, and of sides that turn out to fit a broadcast
