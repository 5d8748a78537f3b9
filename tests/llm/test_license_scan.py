"""License scan: words and phrases against regexes in plain Python, rules and suppression on sentences."""

import itertools
import re
import string

import pytest
from edge_rows import EDGE_ROWS

from tariff_engine.llm.license_scan import FAMILIES, PHRASES, license_scan, rules

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _expected(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [
        (k, k + len(p.split()) - 1, label) for p, label in PHRASES.items() for k in range(len(words))
        if words[k:k + len(p.split())] == p.split()
    ]
    starts = [p[0] for p in places]
    labels = ",".join(sorted({p[2] for p in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_base_detections(spark, documents):
    extra = [(-1, "Under the MIT license under the mit-license; CC BY-NC, apache LICENSE version 2.0"), (-2, "CC by\nnc cc BY nc")]
    df = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in df.collect()}
    found = {r.doc_id: r for r in license_scan(df).collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        r = found[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _expected(text), text[:80]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Released under the MIT license.", "mit"),
    ("SPDX-License-Identifier: MPL-2.0", "mpl"),
    ("All rights reserved. Copyright (c) 2019", "copyright,proprietary"),
    ("mit dem Hund in der Stadt", ""),
    ("licensed under the Mozilla Public License 2.0 or the BSD 3-Clause license", "bsd-3,mpl-2"),
])
def test_rules(spark, text, labels):
    row = license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == labels
    assert all(0 <= d["first"] <= d["last"] < row.n_words for d in row.detections)


def test_contained_detections_are_suppressed(spark):
    row = license_scan(spark.createDataFrame([(1, "licensed under the Apache License 2.0")], "doc_id long, text string")).first()
    spans = [(d["first"], d["last"]) for d in row.detections]
    assert not any(a != b and a[0] <= b[0] and a[1] >= b[1] for a in spans for b in spans)


def test_hundreds_of_rules_with_sound_keywords():
    listed = rules()
    assert len(listed) > 200
    assert len({(r.label, r.regex) for r in listed}) == len(listed)


def test_edge_rows(edge, nothing):
    found = license_scan(edge, carry=True).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=str)
    assert got == sorted(((i, *_expected(t)) for i, t in EDGE_ROWS), key=str)
    assert license_scan(nothing).count() == 0
    plan = license_scan(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange hash"))


#: (wording, label) of every family; those without "licen" are followed by "license" below.
WORDINGS = [
    ("MIT", "mit"), ("Expat", "mit"), ("Apache License 1.1", "apache-1"), ("Apache v1.1", "apache-1"),
    ("Apache Software License, Version 2.0", "apache-2"), ("Apache v2", "apache-2"), ("Apache", "apache"),
    ("GNU General Public License v2", "gpl-2"), ("GNU General Public License version 3", "gpl-3"),
    ("GNU General Public Licence", "gpl"), ("GPLv3", "gpl"), ("GNU GPL v2", "gpl"),
    ("GNU Lesser General Public License", "lgpl"), ("GNU Library General Public License", "lgpl"), ("LGPLv3", "lgpl"),
    ("GNU Lesser General Public License, version 2.1", "lgpl-2.1"), ("GNU Lesser General Public License v3", "lgpl-3"),
    ("GNU Affero General Public License v3", "agpl-3"), ("AGPLv3", "agpl"), ("GNU Free Documentation License", "fdl"),
    ("BSD 2-Clause", "bsd-2"), ("BSD 3-Clause", "bsd-3"), ("original BSD", "bsd-4"), ("BSD", "bsd"), ("0BSD", "0bsd"), ("ISC", "isc"),
    ("Mozilla Public License 1.1", "mpl-1.1"), ("Mozilla Public License, v. 2.0", "mpl-2"), ("Mozilla Public License", "mpl"),
    ("MPL 2.0", "mpl"), ("Eclipse Public License v1.0", "epl-1"), ("Eclipse Public License 2.0", "epl-2"),
    ("Eclipse Public License", "epl"), ("Eclipse Distribution", "edl"), ("Common Development and Distribution", "cddl"),
    ("Common Public", "cpl"), ("European Union Public", "eupl"), ("Artistic 2.0", "artistic"), ("Boost Software", "boost"),
    ("zlib", "zlib"), ("Unlicense", "unlicense"), ("WTFPL", "wtfpl"), ("CC0 1.0", "cc0"), ("CC BY 4.0", "cc-by"),
    ("CC BY-SA 4.0", "cc-by-sa"), ("CC BY-ND 4.0", "cc-by-nd"), ("CC BY-NC 4.0", "cc-by-nc"), ("CC BY-NC-SA 4.0", "cc-by-nc-sa"),
    ("CC BY-NC-ND 4.0", "cc-by-nc-nd"), ("Creative Commons Attribution NonCommercial", "creative-commons"),
    ("SIL Open Font", "ofl"), ("Python Software Foundation", "python"), ("PostgreSQL", "postgresql"), ("OpenSSL", "openssl"),
    ("Microsoft Public", "ms-pl"), ("Microsoft Reciprocal", "ms-rl"), ("Open Database", "odbl"),
]


def test_every_family_in_every_form(spark):
    assert {label for _, label in WORDINGS} == {label for label, *_ in FAMILIES}
    rows = []
    for name, label in WORDINGS:
        whole = name if "licen" in name.lower() else f"{name} licence"
        rows += [
            (f"SPDX-License-Identifier: {name}", label), (f"It is licensed under {name} today", label),
            (f"released under the {whole}", label), (f"It is distributed under the terms of the {whole}, as is.", label),
            (f"This is governed by the {whole}.", label), (f"see the {whole} for more", label),
        ]
    df = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(rows)], "doc_id long, text string").repartition(4)
    found = {r.doc_id: set(r.labels.split(",")) for r in license_scan(df).select("doc_id", "labels").collect()}
    wrong = [(text, label, found[k]) for k, (text, label) in enumerate(rows) if found[k] - {"cc-by-nc", "mit"} != {label} - {"cc-by-nc", "mit"}]
    wrong += [(text, label, found[k]) for k, (text, label) in enumerate(rows) if label not in found[k]]
    assert not wrong


def _strings(parsed):
    """Strings that a regex matches: every branch and option, repetitions at most once more than they must."""
    out = [""]
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            more = [chr(value)]
        elif op == "IN":
            more = ["a" if str(kind) == "CATEGORY" else chr(v if isinstance(v, int) else v[0]) for kind, v in value]
        elif op == "MAX_REPEAT":
            low, high, inner = value
            each = _strings(inner)
            more = ["".join(p) for n in {low, min(high, low + 1)} for p in itertools.product(each, repeat=n)]
        elif op == "SUBPATTERN":
            more = _strings(value[-1])
        elif op == "BRANCH":
            more = [s for branch in value[1] for s in _strings(branch)]
        else:
            assert op == "ASSERT_NOT", op
            more = [""]
        out = [x + y for x in out for y in more]
    return out


def test_keywords_are_in_whatever_the_regex_matches():
    for rule in rules():
        for text in _strings(re._parser.parse(rule.regex)):
            assert rule.keyword.replace(" ", "  ") in text and rule.also.replace(" ", "  ") in text, (rule, text)
