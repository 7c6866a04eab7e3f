import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from recspark.llm.divergence import SCALE, audit, oracle, terms
from recspark.llm.queries import QUERIES, SQL

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least_docs=10, ranks=10):
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang].add(source)
        df[lang].update(set(found))
        count[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in df[lang].items() if n >= least_docs), key=str.encode)
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + SCALE * (count[lang, s][t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s in sources}
        all_ = sum(total.values())
        q = {t: 1 + SCALE * (sum(count[lang, s][t] for s in sources) + 2) // (all_ + 2 * len(kept)) for t in kept}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            own = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            order = lambda x: (-x[1], x[0].encode())
            out += [(lang, s, "pair", i, v, k + 1) for k, (i, v) in enumerate(sorted(pairs, key=order))]
            out += [(lang, s, "term", i, v, k + 1) for k, (i, v) in enumerate(sorted(own, key=order)[:ranks])]
    return sorted(out)


def made(n=260):
    r = random.Random(11)
    words = ["Alpha", "beta", "Épée", "ÉPÉE", "naïve", "漢字", "don't", "x2y", "a_b", "z" * 40, "😀"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        lang, source = r.choice(["en", "en", "en", "de", None]), r.choice(["hot", "hot", "hot", "s1", "s2", "ß", "", None])
        rows.append((lang, source, " ".join(r.choices(words, k=r.randint(0, 40))) + r.choice(["", "\x00\x7f{}", "\n"])))
    return rows + [("fr", "only", "un deux"), ("it", "a", None), ("it", "b", ""), ("it", "b", "..."), rows[0], rows[0], ("en", "no terms", "12 34")]


def test_equals_brute_force_for_any_bound(spark):
    rows = made()
    want = brute(rows)
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"term": F.lit(3), "n": F.lit("clash")}).repartition(5)
    for bounds in ({}, {"most_bytes": 200, "most_entries": 9, "most_pairs": 3}):
        assert sorted(tuple(x) for x in audit(df, **bounds).collect()) == want
    assert {x[2] for x in want} == {"pair", "term"} and any(x[4] == 0 for x in want)


def test_no_rows_and_parameters(spark):
    rows = made(60)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert audit(df.limit(0)).collect() == []
    assert sorted(tuple(x) for x in audit(df, least_docs=1, ranks=3).collect()) == brute(rows, 1, 3)


def test_totals_beyond_64_bits_of_product(spark):
    """SCALE times a count over 9 thousand million passes 64 bits."""
    from recspark.llm.divergence import _p

    n, total, kept = 12_345_678_901, 99_999_999_999, 1234
    got = spark.range(1).select(_p(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first()[0]
    assert got == 1 + SCALE * (n + 2) // (total + 2 * kept)


def test_long_texts_are_cut_between_terms():
    raw = ("Wörter und " * 5000).encode()
    assert [t for part in terms(raw, 7) for t in part] == raw.lower().split()


def test_given_documents(spark):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "source", "text").collect()]
    assert sorted(tuple(x) for x in QUERIES["op11_source_divergence"](spark, "/root/testdata/sf0.001").collect()) == brute(rows)
    assert SQL["op11_source_divergence"] == oracle()
