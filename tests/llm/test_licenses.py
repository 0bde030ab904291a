import textwrap
from collections import Counter

import pytest

from veritally.llm import licenses
from veritally.llm.queries import QUERIES


def by_all_templates(text):
    """Without bounds: every unit against every template."""
    best = {}
    for a, b in licenses.units(text or ""):
        words = licenses.normalised(text[a:b])
        if not words:
            continue
        own, found = licenses.bigrams(words), []
        for name, template in licenses.TEMPLATES:
            other = licenses.bigrams(licenses.normalised(template))
            dice = 2 * sum(min(n, other[g]) for g, n in own.items()) / (own.total() + other.total())
            if dice >= licenses.THRESHOLD:
                found.append((-dice, name))
        if found:
            dice, name = min(found)
            if name not in best or (-dice, -a, -b) > best[name]:
                best[name] = (-dice, -a, -b)
    return sorted((-a, -b, name, dice) for name, (dice, a, b) in best.items())


def rows(found):
    return sorted((m.start, m.end, m.license, m.dice) for m in found)


@pytest.mark.parametrize("text", [
    "Some prose.\nReleased under the MIT License.",
    "A line. Licensed under CC BY-NC 4.0. And more",
    "Copyright (c) 2020 Somebody\n" + licenses.TEMPLATES[2][1].upper(),
    licenses.TEMPLATES[6][1].replace("redistribute", "share").replace(" ", "\n "),
    "This work is licensed under the GNU General Public License, version 2.\nreleased under the mit license",
    "the license is under the software", "", "\n\n..", "MIT", None, "x " * 50_000,
])
def test_same_as_all_templates(text):
    assert rows(licenses.find_licenses(text, licenses.Templates())) == by_all_templates(text)


def wrapped(text, width, before, between):
    lines = textwrap.wrap(text, width)
    return before + between.join(lines)


@pytest.mark.parametrize("name, template", licenses.TEMPLATES)
def test_wrapped_and_embedded_copies(name, template):
    """Hard-wrapped in a comment block between other lines, and inside a longer line."""
    prose = "the quick brown fox jumps over a lazy dog while nobody in that small village looks up from their work at all"
    comments = [("/* ", "\n * ", "\n */"), ("# ", "\n# ", "\n"), ("// ", "\r\n// ", "")]
    texts = [f"{a}{prose}{b}Copyright (c) 2020 Somebody{b}{wrapped(template, w, '', b)}{b}{prose}{c}" for a, b, c in comments for w in (30, 52, 71)]
    texts += [f"{prose} {template} {prose}", f"{prose}; {template.lower().rstrip('.')}, {prose}\n{prose}"]
    known = licenses.Templates()
    for text in texts:
        found = licenses.find_licenses(text, known)
        assert [m.license for m in found] == [name] and found[0].dice == 1.0, (text, found)
        assert rows(found) == by_all_templates(text)


def test_no_passage_of_another_notice():
    known = licenses.Templates()
    prose = "and so on in this file that was made long ago by people who are no longer here"
    other = "This project is licensed under the terms of the GNU Lesser General Public License"
    assert licenses.find_licenses(f"{prose} {other} {prose}", known) == []
    both = f"{prose} {licenses.TEMPLATES[5][1]} {prose} {licenses.TEMPLATES[7][1]} {prose}"
    assert [m.license for m in licenses.find_licenses(both, known)] == ["GPL-3.0", "GPL-2.0"]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = Counter((r["doc_id"], *m) for r in docs for m in by_all_templates(r["text"]))
    got = Counter((r["doc_id"], r["start"], r["end"], r["license"], r["dice"]) for r in QUERIES["op2_license_scan"](spark, sf_dir).collect())
    assert got == expected and len(got) > 0


def test_odd_rows(spark):
    text = "Released under the MIT License."
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (None, text, None), (2, None, "c"), (3, "", "d")], "doc_id long, text string, dice string")
    assert sorted((str(r["doc_id"]), r["license"]) for r in licenses.license_matches(docs).collect()) == [("1", "MIT"), ("1", "MIT"), ("None", "MIT")]
    assert licenses.license_matches(docs.where("false")).count() == 0
    assert licenses.license_matches(docs, templates=()).count() == 0
