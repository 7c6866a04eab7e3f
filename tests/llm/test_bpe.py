import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recspark.llm.bpe import Slice, decode, encode, vocabulary
from recspark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["it's we've 'sabc ''s x's't 'll've I'M don't' ' 'd", "<|endoftext|>a<|startoftext|> B <|endoftext|><|endoftext|>x", "", " \n\t",
       "aaaa aaaaa aaaaaaa" * 3, "ΑΣ ΣΑΣ İstanbul ǅ ß", "3½²٣ 12a", "é Å ẛ̣", "'s", "x'", "a" * 5000, "漢字 かな 😀😀", " ab c\x85d\x1ce", None]


def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def test_equals_library_in_slices(spark):
    r = random.Random(5)
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join("".join(r.choice("théaàoun's.,!1") for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 80)))) for i in range(120)]
    rows += [(None, "null id"), (7, "repeated id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = encode(df, PATH, most_words=40).collect()
    t = library()
    want = sorted([(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in rows], key=str)
    assert sorted([(g.doc_id, list(g.ids)) for g in ids], key=str) == want
    back = decode(encode(df, PATH), PATH).collect()
    assert sorted([(g.doc_id, g.text) for g in back], key=str) == sorted([(i, t.decode(x, skip_special_tokens=False)) for i, x in want], key=str)


def test_every_character():
    t, v = library(), vocabulary(PATH)
    codes = [c for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 'S{chr(c)}" for c in codes]
    s = Slice(v)
    s.add(texts)
    got = [ids[a:b].tolist() for ids, off in s.encoded() for a, b in zip(off, off[1:])]
    assert got == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_query_digests(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    t = library()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op6_bpe_pair_index"](spark, sf).collect()
    assert len(got) == len(docs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for g in got:
        ids = t.encode(docs[g.doc_id], add_special_tokens=False).ids
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, id string, ids int")
    assert encode(df, PATH).count() == 0 and decode(encode(df, PATH), PATH).count() == 0
    df = spark.createDataFrame([(1, "the", "x", 3)], df.schema)
    assert [tuple(r) for r in encode(df, PATH).collect()] == [(1, library().encode("the", add_special_tokens=False).ids)]
    assert decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first().text is None


def test_unsupported_file(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    spec["normalizer"]["normalizers"] = spec["normalizer"]["normalizers"][:1]
    p = tmp_path / "v.json"
    p.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        vocabulary(str(p))
