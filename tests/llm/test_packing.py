import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recspark.llm.packing import Mixture, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, window):
    t = Tokenizer.from_file(PATH)
    want = sorted(([*t.encode(x or "", add_special_tokens=False).ids, 2] for _, x, _ in rows), key=lambda v: (len(v), v))
    by_doc = {}
    for g in got:
        by_doc.setdefault((g.doc_id, g.doc_tokens), []).append(g)
    total = sum(map(len, want))
    seqs = {}
    for g in got:
        assert 0 < g.length <= window
        seqs.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for s, parts in seqs.items():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at == (window if s < total // window else total % window)
    assert sorted(seqs) == list(range(-(-total // window)))
    ids = {(i, tuple(t.encode(x or "", add_special_tokens=False).ids) + (2,)) for i, x, _ in rows}
    crcs = {}
    for i, v in ids:
        crcs.setdefault((i, len(v)), []).append(np.array(v, dtype="<u4"))
    for (i, n), pieces in by_doc.items():
        for g in pieces:
            assert any(zlib.crc32(v[g.start:g.start + g.length].tobytes()) == g.ids_crc32 for v in crcs[i, n])
        assert sum(g.length for g in pieces) % n == 0
    assert sum(g.length for g in got) == total


def corpus():
    r = random.Random(2)
    word = lambda: "".join(r.choice("théaoun") for _ in range(r.randint(1, 9)))
    rows = [(i, " ".join(word() for _ in range(r.choice([1, 5, 60, 300]))), r.choice(["hot"] * 6 + ["a", "b", None])) for i in range(150)]
    return rows + [(900, None, "a"), (901, "", None), (None, "no id", "b"), (3, "twice", "hot"), (3, "twice", "hot")]


@pytest.mark.parametrize("window,queues", [(64, 256), (50, 2)])
def test_packs_every_token_once(spark, window, queues):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    check(rows, pack(df, PATH, window=window, most_queues=queues).collect(), window)


def test_windows_hold_target_proportions(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = pack(df, PATH, window=100, targets={"hot": 0.5, "a": 0.2, "b": 0.2, None: 0.1}).collect()
    check(rows, out, 100)
    share = {}
    for g in out:
        share.setdefault(g.sequence_id, {}).setdefault(g.queue, 0)
        share[g.sequence_id][g.queue] += g.length
    dry = min(max(s for s in share if q in share[s]) for q in range(4))
    for s in range(dry):  # while no queue is dry each window is within a token of its target
        assert all(abs(share[s].get(q, 0) - w) <= 1 for q, w in enumerate([10, 20, 20, 50]))


def test_mixture_is_the_round_robin_order():
    totals, weights = [37, 5, 0, 120], [3, 1, 2, 7]
    due = sorted(((j + 1) / w, s) for s, (t, w) in enumerate(zip(totals, weights)) for j in range(t))
    m = Mixture(totals, weights)
    for n in range(len(due) + 1):
        assert m.given([n])[0].tolist() == [sum(q == s for _, q in due[:n]) for s in range(4)]


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, id long, n long, queue string")
    assert pack(df, PATH).count() == 0
    one = spark.createDataFrame([(1, "the", None, 5, 5, "x")], df.schema)
    assert [(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in pack(one, PATH).collect()] == [(1, 0, 2, 0, 0)]
