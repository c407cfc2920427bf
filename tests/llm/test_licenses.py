from __future__ import annotations

import math
import random
import re
from fractions import Fraction

import duckdb
import pytest

from flightlens.llm import licenses


def brute(text, templates, threshold):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    spaced = re.sub(r"[^a-z0-9\n]+", " ", lowered)
    parts = [*spaced.split("\n"), *(p for p in re.split(r"\n *\n", spaced) if "\n" in p), spaced]
    for unit in dict.fromkeys(re.sub(r"[ \n]+", " ", p).strip() for p in parts):
        words = unit.split()
        have = {tuple(words[i : i + 2]) for i in range(len(words) - 1)}
        for name, template in templates.items():
            known = {tuple(g.split()) for g in licenses.template_bigrams(template)}
            if have and known and Fraction(2 * len(have & known), len(have) + len(known)) >= threshold:
                yield name, unit, len(have & known)


@pytest.mark.parametrize("threshold", [Fraction(1, 2), Fraction(4, 5), Fraction(1)])
def test_bounds_hold_what_can_match(threshold):
    for size in range(1, 60):
        kept = set(licenses.size_bounds(size, threshold))
        can = {n for n in range(1, 300) if Fraction(2 * min(n, size), n + size) >= threshold}
        assert kept == can


@pytest.mark.parametrize("threshold", [Fraction(1, 2), Fraction(4, 5), Fraction(1)])
def test_every_match_holds_a_needle(threshold):
    rng = random.Random(4)
    for text in licenses.TEMPLATES.values():
        grams = licenses.template_bigrams(text)
        held = licenses.needles(grams, threshold)
        least = math.ceil(len(grams) * threshold / (2 - threshold))
        for _ in range(300):
            shared = rng.sample(grams, least)
            assert any(n in g for n in held for g in shared)


def test_matches_equal_brute_force_and_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(path)
    found = licenses.scan(docs)
    rows = sorted((r["doc_id"], r["license"], r["unit"], r["shared"], r["dice"]) for r in found.collect())
    wanted = [(r["doc_id"], *m) for r in docs.collect() for m in brute(r["text"], licenses.TEMPLATES, Fraction(4, 5))]
    assert [r[:4] for r in rows] == sorted(wanted)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    sql = con.execute(f"SELECT doc_id, license, unit, shared, dice FROM ({licenses.oracle()})").fetchall()
    assert sorted(sql) == rows


def test_edge_cases(spark):
    header = licenses.TEMPLATES["apache-2.0-header"]
    rows = [(1, None), (2, ""), (3, "word"), (4, "x\nReleased under the MIT license\n"), (None, "RELEASED under the MIT License!"),
            (5, "y\n\n" + " ".join(header.split()[:40]) + "\n" + " ".join(header.split()[40:]) + "\n\nz"), (6, "a b " * 50_000),
            (7, "Licensed under \n CC - BY-NC 4.0"), (4, "x\nReleased under the MIT license\n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS license", "1 AS unit")
    found = [(r["doc_id"], r["license"], r["unit"], r["shared"]) for r in licenses.scan(docs).collect()]
    wanted = [(i, *m) for i, t in rows for m in brute(t, licenses.TEMPLATES, Fraction(4, 5))]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert {f[:2] for f in found} == {(4, "mit"), (None, "mit"), (5, "apache-2.0-header"), (7, "cc-by-nc-4.0")}
    assert licenses.scan(docs.limit(0)).count() == 0
    assert licenses.scan(docs, templates={}).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = licenses.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_standard_licences_are_found(spark):
    texts = {p.stem: p.read_text("utf-8") for p in licenses._TEXTS.glob("*.txt")}
    notices = {
        "mpl-2.0-header": licenses._MPL_HEADER,
        "agpl-3.0": "Licensed under the GNU Affero General Public License v3.0",
        "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
        "gpl-2.0-header": licenses.TEMPLATES["gpl-2.0-header"],
        "lgpl-2.1-header": licenses.TEMPLATES["lgpl-2.1-header"],
    }
    assert {"apache-2.0", "gpl-3.0", "lgpl-2.1", "mpl-2.0", "mit", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "unlicense"} <= set(texts)
    wanted = {name: text for name, text in notices.items()} | {f"{name}-text": text for name, text in texts.items()}
    rows = [(name, "Copyright 2020 Somebody\n\n" + text) for name, text in wanted.items()]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    hits = {(r["doc_id"], r["license"]) for r in found}
    assert {(name, name) for name in wanted} <= hits


@pytest.mark.parametrize("threshold", [Fraction(1, 2), Fraction(4, 5), Fraction(1)])
def test_least_length_leaves_no_match_out(threshold):
    for text in licenses.TEMPLATES.values():
        words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
        grams = licenses.template_bigrams(text)
        # A prefix of the template that just reaches the coefficient.
        for n in range(2, len(words) + 1, max(1, len(words) // 50)):
            have = {f"{a} {b}" for a, b in zip(words[:n], words[1:n], strict=False)}
            if have and Fraction(2 * len(have & set(grams)), len(have) + len(grams)) >= threshold:
                assert len(" ".join(words[:n])) >= licenses.least_length(grams, threshold)
