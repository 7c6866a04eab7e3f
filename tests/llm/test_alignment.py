import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recspark.llm.alignment import Chunks, Pair, align, aligned, cuts
from recspark.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "\n", "a", "the cat  sat on\tthe mat", "x<|endoftext|>y <s> </s> <unk>", "naïve café Zürich 漢字 😀", "it▁s", "a" * 400, "3.14 + 2 = 5,14", "the cat  sat on\tthe mat", "<0x41>​\x00z"]


def brute(rows):
    """Groups by comparing all ends of one text after the other, counts by a dictionary."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.no_padding()
    a.no_truncation()
    a.encode_special_tokens = True
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = dict(zip(map(chr, own), own)) | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}
    done, count = [], Counter()
    for i, text in rows:
        ia = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ba = [bytes(byte[c] for c in a.id_to_token(x)) for x in ia]
        bb = [bytes([int(b.id_to_piece(x)[1:-1], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ib]
        if not text or not b"".join(ba) == b"".join(bb) == b" " + text.encode():
            done.append((i, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        both, groups, links, pa, pb = sorted(set(ends_a) & set(ends_b)), [], [], 0, 0
        for end in both:
            qa, qb = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, ia[pa:qa])) + "|" + ",".join(map(str, ib[pb:qb])))
            links.append((ia[qa - 1], ib[qb - 1]))
            pa, pb = qa, qb
        count.update(links)
        done.append((i, len(ia), len(ib), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return sorted([(i, na, nb, len(l), len(l), sum(count[p] == best[p[1]] for p in l), sum(count[p] for p in l), sha) for i, na, nb, l, sha in done], key=str)


def test_equals_brute_force_for_any_bound(spark):
    r = random.Random(3)
    rows = list(enumerate(ODD)) + [(50 + i, " ".join("".join(r.choice("théaàoun's.,!1 ") for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 60)))) for i in range(60)] + [(None, "null id"), (3, "again")]
    want = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_a", F.lit("clash")).withColumn("pair", F.lit(1)).repartition(3)
    for bounds in ({}, {"head_rows": 7, "most_bytes": 300, "most_pairs": 20, "most_tokens": 50}, {"head_rows": 0, "piece_chars": 15}):
        got = [tuple(x) for x in aligned(df, A, B, **bounds).collect()]
        assert sorted(got, key=str) == want
    assert sum(x[3] > 1 for x in want) > 60


def test_given_documents(spark):
    got = QUERIES["op13_cross_tokenizer_alignment"](spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(x) for x in got), key=str) == brute([tuple(x) for x in rows])


def test_cuts_equal_set_intersection():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 10, 500, 4000):
        for share in (0.01, 0.3, 0.9):
            a, b = (np.unique(np.append(np.flatnonzero(r.random(n) < share) + 1, n)) for _ in range(2))
            ia, ib = cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
            assert a[ia].tolist() == b[ib].tolist() == sorted(set(a) & set(b))


def test_no_piece_crosses_a_seam():
    """What encoding in stretches rests on: no token holds a space after a visible character."""
    pair = Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert not [x for side in (pair.bytes_a, pair.bytes_b) for x in side if re.search(r"\S ", x.decode(errors="ignore"))]
    r = random.Random(9)
    texts = ["".join(r.choice(["a", "the", " ", " ", "  ", "\n", "\t", "1", "'s", ".", "\xa0", "\u3000", "\x85", "\x1c", "\u200b", "é", "漢", "😀", "Ω"]) for _ in range(r.randint(1, 60))) for _ in range(3000)]
    for piece in (1, 200):
        (a, docs_a), (b, docs_b) = Chunks(pair, 1 << 20, piece).encode([x.encode() for x in texts])
        for i, x in enumerate(texts):
            want = pair.encode(x)
            if pair.gives_back(*want, x):
                assert a[docs_a[i]:docs_a[i + 1]].tolist() == want[0].tolist() and b[docs_b[i]:docs_b[i + 1]].tolist() == want[1].tolist()
            else:
                assert docs_a[i] == docs_a[i + 1] and docs_b[i] == docs_b[i + 1]


def test_ranks_merge_as_the_library():
    pair = Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert pair.ranked
    r = random.Random(2)
    letters = [chr(c) for c in range(0x250)] + list("etaoinshr ") * 40
    for _ in range(4000):
        text = "".join(r.choices(letters, k=r.randint(1, 80)))
        assert pair.ranked.encode_ordinary(" " + text) == pair.a.encode(" " + text, add_special_tokens=False).ids


def test_very_long_text_and_no_rows(spark):
    pair = Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    text = "some words of a very long text " * 30000
    found = align(Chunks(pair, 10, 50), [text.encode(), b"", b"some words"])
    a, b = pair.encode(text)
    assert found["n_a"].tolist()[:2] == [len(a), 0] and found["n_b"].tolist()[:2] == [len(b), 0] and found["groups"][1] == b""
    assert aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
