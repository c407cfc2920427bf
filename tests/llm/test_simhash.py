from __future__ import annotations

import numpy as np
import pytest
import xxhash

from flightlens.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    n = min(3, len(words))
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near_values(rng, centres, copies, flips):
    found = set()
    for c in rng.integers(0, 2**63, centres):
        for _ in range(copies):
            v = int(c)
            for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
                v ^= 1 << int(b)
            found.add(v)
    return np.array(sorted(found), np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_counter_gives_the_distance_test(radius):
    rng = np.random.default_rng(radius)
    left = rng.integers(0, 2**63, 500).astype(np.uint64)
    right = left.copy()
    for i in range(500):
        for b in rng.choice(64, i % 9, replace=False):
            right[i] ^= np.uint64(1) << np.uint64(b)
    planes = simhash.bit_planes(left ^ right)
    near = simhash.within_radius(iter(planes), radius, simhash._lanes(500))
    wanted = [(int(a) ^ int(b)).bit_count() <= radius for a, b in zip(left, right)]
    assert simhash._set_lanes(near)[:500].tolist() == wanted


@pytest.mark.parametrize("split", [8, 1 << 12])
@pytest.mark.parametrize("radius", [1, 2, 3])
def test_runs_link_what_pairs_link(monkeypatch, split, radius):
    monkeypatch.setattr(simhash, "_SPLIT_RUN", split)
    values = near_values(np.random.default_rng(3), 6, 60, 3)
    free = simhash.bands(radius + 2)[2:]
    # One run: the values agree on the first two bands.
    mask = np.uint64(sum(((1 << w) - 1) << a for a, w in free))
    run = np.unique(values & mask)
    root = simhash._run_links(run, radius, simhash._narrower(free, radius))
    assert root.tolist() == brute_roots([int(v) for v in run], radius)


def test_classes_match_brute_force(spark):
    values = near_values(np.random.default_rng(5), 12, 25, 4).view(np.int64)
    prints = spark.createDataFrame([(int(v),) for v in values], "fp bigint")
    root = {r["node"]: r["root"] for r in simhash.classes(simhash.links(prints, 2)).collect()}
    unsigned = [int(v) for v in values.view(np.uint64)]
    wanted = brute_roots(unsigned, 2)
    groups = {}
    for v, w in zip(values.tolist(), wanted):
        groups.setdefault(w, set()).add(root.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    root = brute_roots(prints, 2)
    smallest = {}
    for r, c in zip(rows, root):
        smallest[c] = min(smallest.get(c, r["doc_id"]), r["doc_id"])
    wanted = {(r["doc_id"], p, smallest[c]) for r, p, c in zip(rows, prints, root)}
    found = simhash.near_duplicates(docs).collect()
    assert {(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in found} == wanted
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(smallest.values()))


def test_edge_cases(spark):
    long = "word " * 200_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c d"), (4, "a b c d"), (5, "A B C D"), (None, "x y"),
            (None, "x y"), (6, long)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS fp", "2 AS component_id")
    found = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert len(found) == len(rows)
    assert sorted(c for i, p, c in found if p == 0) == [1, 1, 1]
    assert {c for i, p, c in found if i in (4, 5)} == {4}
    assert {c for i, p, c in found if i is None} == {None}
    assert len(simhash.representatives(docs).collect()) == 4
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.representatives(empty).count() == 0


def test_a_clashing_column_stays(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x"), (2, "a b c d", "y")], "doc_id bigint, text string, _own_fp string")
    kept = simhash.representatives(docs)
    assert [tuple(r) for r in kept.collect()] == [(1, "a b c d", "x")] and kept.columns == docs.columns
