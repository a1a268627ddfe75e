"""License scans against a plain version: phrases word by word, expressions by recursive descent."""

import random
import re

import duckdb
import pytest

from cytoloom.llm import licenses
from cytoloom.llm.licenses import continuing, evaluate, freedom, label_of, postfix

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def climb(tokens):
    """(freedom, labels) of a well-formed expression, by recursive descent."""
    at = 0

    def part(level):
        nonlocal at
        if level == 4:
            t, at = tokens[at], at + 1
            if t != "(":
                return freedom(t) or 0.0, [t]
            got, at = part(1), at + 1
            return got
        value, labels = part(level + 1)
        while at < len(tokens) and licenses.TIGHT.get(tokens[at]) == level:
            op, at = tokens[at], at + 1
            v, of = part(level + 1)
            if op == "with":
                value = 0.6 if value in (0.3, 0.4) and "exception" in of[0] else value
            else:
                value, labels = (min if op == "and" else max)(value, v), labels + of
        return value, labels

    return part(1)


def plain(text):
    """(words, base places, labels, expressions, score) of a text, slowly."""
    words = WORD.findall(lower(text))
    at = lambda phrases: [(i, i + len(p.split()), label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    base = at(licenses.BASE)
    found = []
    for i, m in enumerate(WORD.finditer(lower(text))):
        for tag in licenses.TAGS:
            k = tag.split()
            opens = re.match(r"""["']?[ \t]*[:=][ \t]*["']?""", (text or "")[m.end() :])
            if words[max(0, i + 1 - len(k)) : i + 1] == k and opens:
                rest, tokens = text[m.end() + opens.end() :], []
                while t := re.match(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)", rest):
                    tokens.append(t[1])
                    rest = rest[t.end() :]
                found.append(continuing(tokens, tag != licenses.TAGS[0]))
    places, end = [], 0
    for a, b, label, exception in sorted([(*p, False) for p in at(licenses.NOTICES) + base] + [(*p, True) for p in at(licenses.EXCEPTIONS)], key=lambda p: (p[0], -p[1])):
        if a >= end or not places:
            places.append((a, b, label, exception))
            end = b
    end = None
    for a, b, label, exception in places:
        gap = words[end:a] if end is not None and a - end <= 8 else ["?"]
        ops = [w for w in gap if w in ("or", "and", "with")]
        if len(ops) == 1 and all(w in licenses.BETWEEN or w in ops for w in gap) and exception == (ops == ["with"]):
            found[-1] = found[-1] + [ops[0], label]
        elif exception:
            continue
        else:
            found.append([label])
        end = b
    found = [f for f in found if f]
    values = [climb(f) for f in found]
    labels = sorted({p[2] for p in base} | {x for _, of in values for x in of})
    return len(words), sorted((a, label) for a, _, label in base), labels, [" ".join(f) for f in found], min((v for v, _ in values), default=0.0)


TEXTS = [
    None, "", "   ", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0, cc/by\nnc", "under the\tMIT license", "UNDER THE MIT LICENSE" + " under the mit license" * 3,
    "GNU General Public License, version 3.", "the MIT License or the Apache License, Version 2.0", "MIT License and\nthe GNU GPL v2 with the Classpath exception.", "MIT License, or whatever the Apache License says",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */\nx", 'license = "MIT OR Apache-2.0"', '"license": "ISC",', "License: GPL (>= 2)", "licence: the usual", "license: MIT made of",
    "SPDX-License-Identifier: LicenseRef-Mine OR MIT.", "spdx-license-identifier: ((MIT or", "SPDX-License-Identifier:", "license:license:MIT", "é license: MIT é", "SPDX-License-Identifier: MIT)", "cc by nc sa and cc by nc nd", "CC0", "cc by nc cc by nc nc",
]


def check(rows):
    for r in rows:
        want = plain(r["text"])
        assert (r["n_words"], sorted((p["start"], p["label"]) for p in r["base"]), r["labels"], r["expressions"], r["score"]) == want, r["text"]


def test_texts_equal_a_plain_version(spark):
    rng = random.Random(11)
    bits = sorted({w for p, _ in licenses.BASE + licenses.NOTICES + licenses.EXCEPTIONS for w in [p, p.split()[0], p.split()[-1]]}) + ["or", "and", "with", "the", "\n", ", ", "(", ")", "SPDX-License-Identifier: ", "license: ", "MIT", "GPL-3.0-or-later", "LGPL-2.1+", "Foo-1.0", "été", "A", "or", "and"]
    texts = TEXTS + [rng.choice(["", " "]).join(x + " " for x in rng.choices(bits, k=rng.randint(1, 30))) for _ in range(1500)]
    got = licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)).collect()
    assert len(got) == len(texts) and sum(len(r["expressions"]) > 1 for r in got) > 300
    check(got)


def test_expressions_equal_recursive_descent():
    rng = random.Random(2)

    def made(depth):
        k = rng.random()
        if depth == 0 or k < 0.3:
            return rng.choice(["MIT", "Apache-2.0", "GPL-2.0-only", "AGPL-3.0", "Unknown", "MPL-2.0", "CC-BY-NC-4.0"])
        if k < 0.5:
            return f"({made(depth - 1)})"
        return f"{made(depth - 1)} WITH Some-exception" if k < 0.6 else f"{made(depth - 1)} {rng.choice(['AND', 'or', 'OR'])} {made(depth - 1)}"

    for _ in range(2000):
        tokens = re.findall(r"[()]|[^ ()]+", made(5))
        assert (e := continuing(tokens)) == [t.lower() if t.lower() in licenses.TIGHT or t in "()" else label_of(t) for t in tokens]
        assert evaluate(postfix(e)) == climb(e)


@pytest.mark.parametrize(("tokens", "want"), [("MIT )", "mit"), ("( ( MIT OR", "( ( mit ) )"), ("AND MIT", ""), ("MIT MIT", "mit"), ("", ""), ("(", ""), (")", ""), ("MIT OR ( AND", "mit"), ("( MIT ) ISC", "( mit )"), ("MIT WITH OR", "mit"), ("MIT WITH ( A", "mit")])
def test_malformed_expressions(tokens, want):
    assert " ".join(continuing(tokens.split())) == want


def test_identifiers_and_freedom():
    assert [label_of(x) for x in ("Apache-2.0", "GPL-3.0-or-later", "LGPL-2.1+", "CC-BY-NC-4.0", "CC0-1.0", "MIT.", "BSD-3-Clause", "Apache-1.1")] == ["apache-2", "gpl-3", "lgpl-2.1", "cc-by-nc", "cc0", "mit", "bsd-3-clause", "apache-1.1"]
    assert [freedom(x) for x in ("cc-by-nc-sa", "cc-by-sa", "cc-by", "gpl-2", "agpl-3", "mitre", "")] == [0.1, 0.4, 0.9, 0.4, 0.3, None, None]
    assert evaluate(postfix("gpl-2 with classpath-exception and mit or proprietary".split()))[0] == 0.6


def test_base_columns_equal_sql(spark, sf):
    word = r"regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in licenses.BASE)
    sql = f"""with d as (select doc_id, {word} as w from read_parquet('{sf}/documents.parquet')), p(p, label, k) as (values {phrases}),
      h as (select doc_id, label, i-1 as i from (select *, unnest(range(1, len(w)-k+2)) as i from d, p where len(w) >= k) where array_to_string(w[i:i+k-1], ' ') = p),
      g as (select doc_id, count(*) as n, min(i) as a, max(i) as b, array_to_string(list_sort(list(distinct label)), ',') as l from h group by 1)
      select d.doc_id, len(w), coalesce(n, 0), a, b, coalesce(l, '') from d left join g using (doc_id)"""
    got = licenses.op11_licenses(spark, sf).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, got), key=str) == sorted(duckdb.sql(sql).fetchall(), key=str) and any(r["n_base"] for r in got)


def test_long_texts_repeats_clashes_and_empty_tables(spark):
    n = 30_000
    long = "license: MIT or " * n + "under the mit license. " * n
    df = spark.createDataFrame([(1, long), (1, long), (2, "x" * 2_000_000 + " cc by nc"), (None, None)], "doc_id int, text string").selectExpr("doc_id", "text", "1 as SCORE", "doc_id as `a.b`", "2 as __text")
    got = licenses.scan(df, keep=["doc_id", "SCORE", "a.b", "__text"])
    assert got.columns == ["doc_id", "a.b", "__text", "n_words", "base", "labels", "expressions", "score"]
    rows = got.orderBy("doc_id").collect()
    assert rows[1][3:] == rows[2][3:] and len(rows[1]["base"]) == n and rows[1]["base"][-1]["start"] == 3 * n + 4 * (n - 1)
    assert (rows[3]["n_words"], rows[3]["base"][0]["start"]) == (4, 1) and rows[0][3:] == (0, [], [], [], 0.0)
    assert licenses.scan(df.limit(0)).count() == 0
