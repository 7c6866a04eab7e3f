"""Licence recognition: normalised sentences to identifiers, identifier sequences against ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.stages import plain

#: Sentences of public licence notices and texts, by identifier.
SENTENCES = {
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-licensed": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-short": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-grant-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-redistribute": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc0": "Licensed under CC0 1.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}

#: Ordered rules: (rule, licence, sentence identifiers in order).
RULES = [
    ("apache-notice", "Apache-2.0", ["apache-licensed", "apache-copy", "apache-unless", "apache-see"]),
    ("apache-short", "Apache-2.0", ["apache-short"]),
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("mit-released", "MIT", ["mit-short"]),
    ("mit-licensed", "MIT", ["mit-licensed"]),
    ("mit-brief", "MIT", ["mit-grant-notice", "as-is"]),
    ("bsd-3", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("bsd-2", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("isc", "ISC", ["isc-grant"]),
    ("gpl-3", "GPL-3.0-only", ["gpl3-work"]),
    ("gpl-3-later", "GPL-3.0-or-later", ["gpl-redistribute", "gpl-hope", "gpl-see"]),
    ("mpl-2", "MPL-2.0", ["mpl-subject"]),
    ("cc-by", "CC-BY-4.0", ["cc-by"]),
    ("cc-by-sa", "CC-BY-SA-4.0", ["cc-by-sa"]),
    ("cc-by-nc", "CC-BY-NC-4.0", ["cc-by-nc"]),
    ("cc0", "CC0-1.0", ["cc0"]),
    ("unlicense", "Unlicense", ["unlicense"]),
    ("reserved", "LicenseRef-all-rights-reserved", ["reserved"]),
]

BREAK = r"[.!?:;]+[ \t\r\n]+|[\r\n]+"
OTHER = r"[^a-z0-9\n]+"


def normalised(text: Column) -> Column:
    """Lower case; a line feed between sentences; one space for any run of other characters but a-z and 0-9."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), BREAK, "\n"), OTHER, " ")


def _plain_sentences(text: str) -> list[str]:
    import re

    return [s.strip(" ") for s in re.sub(OTHER, " ", re.sub(BREAK, "\n", text.lower())).split("\n") if s.strip(" ")]


def sentence_table(sentences: dict[str, str] | None = None, rules: list | None = None) -> tuple[dict[str, str], list]:
    """Normalised sentence to identifier, and rules over such identifiers.

    A sentence that breaks into several becomes a sequence of numbered identifiers, in the rules too.
    """
    sentences, rules = SENTENCES if sentences is None else sentences, RULES if rules is None else rules
    known: dict[str, str] = {}
    parts: dict[str, list[str]] = {}
    for key, text in sentences.items():
        for k, s in enumerate(_plain_sentences(text)):
            parts.setdefault(key, []).append(known.setdefault(s, key if k == 0 else f"{key}-{k + 1}"))
    return known, [(name, licence, [p for s in seq for p in parts[s]]) for name, licence, seq in rules]


def _matches(hits: Column, seq: list[str], gap: int) -> Column:
    """How often the identifiers of ``seq`` stand in order, at most ``gap`` sentences apart, by one fold."""
    steps = F.array(*[F.lit(s) for s in seq])
    start = F.struct(F.lit(0).alias("step"), F.lit(0).alias("at"), F.lit(0).alias("found"))

    def turn(state: Column, hit: Column) -> Column:
        k = F.array_position(steps, hit["sid"]).cast("int")
        near = (state["step"] == 0) | (hit["pos"] - state["at"] <= gap)
        step = F.when(k == 0, state["step"]).when((k == state["step"] + 1) & near, k).when(k == 1, 1).otherwise(0)
        done = (step == len(seq)) & (k > 0)
        return F.struct(F.when(done, 0).otherwise(step).cast("int").alias("step"), F.when(k > 0, hit["pos"]).otherwise(state["at"]).alias("at"),
                        (state["found"] + done.cast("int")).alias("found"))

    return F.aggregate(hits, start, turn, lambda s: s["found"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = 3, sentences: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """``id_col, n_sentences, n_hits, n_matches, licences, rules, hits`` of every row.

    Sentences end at .!?:; before white space and at line ends; they are compared in
    lower case without punctuation. ``hits`` are the known sentences with their position;
    a rule matches where its identifiers follow each other in order, each within ``gap``
    sentences of the one before and without another sentence of the rule between.
    ``licences`` and ``rules`` are the distinct matches, sorted, joined by commas.
    A rule whose identifiers begin another matching rule of more sentences gives way to it.

    One pass over the text by built-in functions, nothing is shuffled: the sentence table
    is a constant of the query. Null and blank texts have no sentences; repeated
    rows and null ids are rows like any other; an empty table gives no rows.
    """
    known, ordered = sentence_table(sentences, rules)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    pieces = F.filter(F.transform(F.split(normalised(plain(text_col)), "\n"), lambda s: F.trim(s)), lambda s: s != "")
    sizes = sorted({len(s) for s in known})
    rows = docs.select(plain(id_col).alias("id"), F.coalesce(pieces, F.array().cast("array<string>")).alias("pieces"))
    fits = lambda s: (F.length(s) >= sizes[0]) & (F.length(s) <= sizes[-1])
    found = F.transform("pieces", lambda s, i: F.struct((i + 1).alias("pos"), F.when(fits(s), F.element_at(table, s)).alias("sid")))
    rows = rows.select("id", F.size("pieces").cast("long").alias("n_sentences"), F.filter(found, lambda h: h["sid"].isNotNull()).alias("hits"))
    none = F.size("hits") == 0
    counts = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("licence"), F.lit(",".join(seq)).alias("seq"), _matches(F.col("hits"), seq, gap).alias("n"))
                       for name, licence, seq in ordered])
    rows = rows.withColumn("m", F.when(none, F.lit(None)).otherwise(F.filter(counts, lambda c: c["n"] > 0)))
    longer = lambda c: F.exists("m", lambda o: (o["seq"] != c["seq"]) & F.startswith(o["seq"], F.concat(c["seq"], F.lit(","))))
    rows = rows.withColumn("m", F.filter("m", lambda c: ~longer(c)))
    joined = lambda f: F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda c: c[f]))), ","), F.lit(""))
    total = F.coalesce(F.aggregate("m", F.lit(0).cast("long"), lambda s, c: s + c["n"]), F.lit(0).cast("long"))
    return rows.select(F.col("id").alias(id_col), "n_sentences", F.size("hits").cast("long").alias("n_hits"), total.alias("n_matches"),
                       joined("licence").alias("licences"), joined("rule").alias("rules"), "hits")


def oracle(gap: int = 3) -> str:
    """DuckDB SQL for the query: sentences as rows, rules as islands of consecutive steps."""
    known, ordered = sentence_table()
    text = lambda s: "'" + s.replace("'", "''") + "'"
    names = ", ".join(f"({text(s)}, {text(i)})" for s, i in known.items())
    steps = ", ".join(f"({text(n)}, {text(lic)}, {text(','.join(seq))}, {len(seq)}, {k + 1}, {text(i)})" for n, lic, seq in ordered for k, i in enumerate(seq))
    brk, oth = (x.replace("\\", "\\") for x in (BREAK, OTHER))
    return f"""
WITH known(s, sid) AS (VALUES {names}), steps(rule, licence, seq, size, step, sid) AS (VALUES {steps}),
t AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(lower(text), {text(brk)}, chr(10), 'g'), {text(oth)}, ' ', 'g'), chr(10)),
        lambda x: trim(x)), lambda x: x <> '') AS p FROM documents),
u AS (SELECT doc_id, unnest(p) AS s, generate_subscripts(p, 1) AS pos FROM t),
hits AS (SELECT doc_id, pos, sid FROM u JOIN known USING (s)),
w AS (SELECT h.doc_id, h.pos, r.*, lag(r.step) OVER x AS before, lag(h.pos) OVER x AS prior
      FROM hits h JOIN steps r USING (sid) WINDOW x AS (PARTITION BY h.doc_id, r.rule ORDER BY h.pos)),
i AS (SELECT *, sum(CASE WHEN before IS NOT NULL AND before < size AND step = before + 1 AND pos - prior <= {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, rule ORDER BY pos) AS island FROM w),
m AS (SELECT doc_id, rule, any_value(licence) AS licence, any_value(seq) AS seq FROM i GROUP BY doc_id, rule, island HAVING min(step) = 1 AND count(*) = any_value(size)),
n AS (SELECT * FROM m a WHERE NOT EXISTS (SELECT 1 FROM m b WHERE b.doc_id = a.doc_id AND b.seq <> a.seq AND starts_with(b.seq, a.seq || ','))),
g AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, string_agg(DISTINCT rule, ',' ORDER BY rule) AS rules FROM n GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_hits FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(t.p), 0) AS BIGINT) AS n_sentences, CAST(coalesce(c.n_hits, 0) AS BIGINT) AS n_hits, CAST(coalesce(g.n_matches, 0) AS BIGINT) AS n_matches,
       coalesce(g.licences, '') AS licences, coalesce(g.rules, '') AS rules
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)
"""
