import random
import re

import duckdb

from recspark.llm.licences import RULES, SENTENCES, _plain_sentences, oracle, scan, sentence_table

SCHEMA = "doc_id long, text string, hits string, pieces int, m long"


def brute(text, gap=3):
    known, rules = sentence_table()
    pieces = _plain_sentences(text or "")
    hits = [(k, known[s]) for k, s in enumerate(pieces) if s in known]
    found = {}
    for name, licence, seq in rules:
        step = at = n = 0
        for pos, sid in hits:
            if sid not in seq:
                continue
            k = seq.index(sid) + 1
            step = k if k == step + 1 and (step == 0 or pos - at <= gap) else (1 if k == 1 else 0)
            at = pos
            if step == len(seq):
                n, step = n + 1, 0
        if n:
            found[name] = (licence, seq, n)
    found = {r: f for r, f in found.items() if not any(o[1] != f[1] and ",".join(o[1]).startswith(",".join(f[1]) + ",") for o in found.values())}
    return len(pieces), len(hits), sum(f[2] for f in found.values()), ",".join(sorted({f[0] for f in found.values()})), ",".join(sorted(found))


def texts(seed=4):
    r = random.Random(seed)
    every = list(SENTENCES.values())
    noise = ["Lorem ipsum dolor.", "Été où ça!", "x", "1.2.3 is a version.", "(c) 2020"]
    out = [None, "", " \n\t", "!!! ... ???", "LICENSED under the apache license -- version 2.0", "All rights reserved" * 3]
    for name, _, seq in RULES:
        t = [SENTENCES[s] for s in seq]
        out += [" ".join(t), "\n".join(x.upper() for x in t), " Noise here. ".join(t), "\n\n".join(t[::-1]), (" a. b. c. d. ").join(t)]
    for _ in range(60):
        out.append(r.choice([" ", "\n", "\r\n"]).join(r.choice(every + noise * 6) for _ in range(r.randint(1, 25))))
    return out + [" ".join(every) * 30, "word " * 200_000 + "Released under the MIT License."]


def test_equals_brute_force_and_sql(spark):
    rows = list(enumerate(texts()))
    got = scan(spark.createDataFrame([(i, t, "h", 1, 2) for i, t in rows], SCHEMA).repartition(3)).collect()
    mine = {g.doc_id: (g.n_sentences, g.n_hits, g.n_matches, g.licences, g.rules) for g in got}
    assert mine == {i: brute(t) for i, t in rows}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert {r[0]: tuple(r[1:]) for r in con.execute(oracle()).fetchall()} == mine


def test_rules_are_found_and_longer_ones_win(spark):
    want = {name: lic for name, lic, _ in RULES}
    rows = [(i, "\n".join(SENTENCES[s] for s in seq), name, 0, 0) for i, (name, _, seq) in enumerate(RULES)]
    for g in scan(spark.createDataFrame(rows, SCHEMA)).collect():
        assert g.rules == rows[g.doc_id][2] and g.licences == want[g.rules]


def test_hits_carry_positions_and_edge_rows(spark):
    rows = [(None, "One. All rights reserved. Two.", "", 0, 0), (5, "All rights reserved.", "", 0, 0), (5, "All rights reserved.", "", 0, 0)]
    got = scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted([([tuple(h) for h in g.hits]) for g in got]) == [[(1, "reserved")], [(1, "reserved")], [(2, "reserved")]]
    assert scan(spark.createDataFrame([], SCHEMA)).count() == 0
    assert not re.search("Python|Arrow|Exchange", scan(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString())
