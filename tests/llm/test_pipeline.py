import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from recspark.llm.queries import vocabulary_path

from .test_minhash import brute as near_brute
from .test_packing import check as check_packed
from .test_suffix_dedup import brute as suffix_brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, ROW_KEY string"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents with planted cases, and what each stage makes of its predecessor's rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.where("doc_id = 0").first().text
    odd = [(90_000, None, "en"), (90_001, "", None), (90_002, "123 !!", "en"), (90_003, first, "en"), (90_004, first.replace(" ", "\n", 3) + " end", "en"), (None, first[:300], None), (0, first, "en"), (0, first, "en"),
           (90_005, "@@ ## $$ %% ^^ a && ** " * 40, "en")]
    more = spark.createDataFrame([(i, t, la, "src0", len(t or "")) for i, t, la in odd], docs.schema)
    docs = docs.union(more).withColumns({"id": F.lit("x"), "n": F.lit(1), "ROW_KEY": F.lit("y")})
    out = [docs.collect()]
    for _, stage in cp.STAGES:
        df = stage(spark, docs, SF)
        out.append(df.collect())
        if len(out) <= len(cp.STAGES):
            assert df.columns == docs.columns and df.schema.simpleString() == docs.schema.simpleString()
            docs = spark.createDataFrame(out[-1], docs.schema)
    return out


def test_language_id_rejects_texts_without_letters_only(stages):
    gone = {r.doc_id for r in stages[0]} - {r.doc_id for r in stages[1]}
    assert gone == {90_000, 90_001, 90_002} and len(stages[0]) - len(stages[1]) == 3


def test_quality_keeps_trusted_texts(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, before = {r.doc_id for r in stages[2]}, {r.doc_id for r in stages[1]}
    good = {i for i in before if labels.get(i) == 1}
    bad = {i for i in before if labels.get(i) == 0}
    assert good and good <= kept and 90_005 not in kept and len(bad - kept) >= len(bad) / 4  # few trusted texts at this size; see test_kneser_ney


def test_near_dedup_equals_brute_force(stages):
    groups = near_brute([(r.doc_id, r.text) for r in stages[2]], 80)
    want = sorted({i for i, _, c in groups if i is not None and i == c})
    assert sorted(r.doc_id for r in stages[3] if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in stages[3]) == sum(r.doc_id is None for r in stages[2]) == 1


def test_suffix_dedup_cuts_whole_characters(stages):
    brute = {(i, n): (gone, kept) for i, n, gone, _, kept in suffix_brute([(r.doc_id, r.text) for r in stages[3]])}
    before = {r.doc_id: r.text for r in stages[3]}
    assert len(stages[4]) == len(stages[3])
    for r in stages[4]:
        gone, kept = brute[r.doc_id, len(before[r.doc_id].encode())]
        assert r.n_chars == len(r.text) and "�" not in r.text
        assert r.text == kept.decode(errors="ignore") or 0 <= len(kept) - len(r.text.encode()) <= 6 * max(1, gone // 50)


def test_packing_holds_every_token(stages):
    check_packed([(r.doc_id, r.text, r.source) for r in stages[4]], stages[5], 4096)


def test_empty_documents_pass_all_stages(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = docs if "sequence_id" in out.columns else out


def test_run(spark):
    got = cp.run(spark, SF).collect()
    t = Tokenizer.from_file(vocabulary_path())
    assert got and sorted({g.sequence_id for g in got}) == list(range(max(g.sequence_id for g in got) + 1))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole = [g for g in got if g.start == 0 and g.length == g.doc_tokens]
    same = [g for g in whole if len(ids := t.encode(texts[g.doc_id], add_special_tokens=False).ids) + 1 == g.doc_tokens and zlib.crc32(np.array([*ids, 2], dtype="<u4").tobytes()) == g.ids_crc32]
    assert len(same) > len(whole) / 3 and cp.ORACLE_SQL is None


@pytest.mark.parametrize("langs", [["en"], ["en", "de"], ["en", "de", "es", "fr"]])
def test_language_id_rejects_unlearned_languages(spark, langs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.col("lang").isin(langs))
    finnish = ("kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on "
               "toimittava toisiaan kohtaan veljeyden hengessä jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin ja vapauksiin")
    letters = random.Random(1)
    junk = " ".join("".join(letters.choice("bcdfghjklmnpqrtvwxz") for _ in range(6)) for _ in range(60))
    odd = [(90_000, finnish, None), (90_001, junk, None), (90_002, junk[::-1], "en"), (90_003, "qzx", "en")]
    more = spark.createDataFrame([(i, t, la, "src0", len(t)) for i, t, la in odd], docs.schema)
    kept = {r.doc_id for r in cp.language_id(spark, docs.union(more), SF).collect()}
    before = {r.doc_id for r in docs.collect()}
    assert not kept & {90_000, 90_001, 90_002} and 90_003 in kept  # one word is no evidence
    assert len(before - kept) <= len(before) / 100
