from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash


def brute_code(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(codes, ids):
    parent = list(range(len(codes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    smallest = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            smallest[root(i)] = min(smallest.get(root(i), doc), doc)
    return [smallest.get(root(i)) for i in range(len(codes))]


def test_rows_equal_brute_force(documents, awkward):
    base = " ".join(f"w{i}" for i in range(400))
    rows = awkward + [(30 + i, base.replace(f"w{37 * i} ", "changed ")) for i in range(9)] + [(50, base), (51, base)]
    found = simhash.near_duplicates(documents(rows)).collect()
    codes = [brute_code(r[1]) for r in rows]
    parts = brute_components(codes, [r[0] for r in rows])
    expected = sorted(map(str, zip([r[0] for r in rows], [f"{c:016x}" for c in codes], parts)))
    assert sorted(str(tuple(r)) for r in found) == expected


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize(
    "plan",
    [
        None,
        simhash.Plan(tuple(tuple(range(i, i + 16)) for i in range(0, 64, 16)), (0, 0, 0, 0)),
        simhash.Plan((tuple(range(32)), tuple(range(32, 64))), (1, 1)),
        simhash.Plan((tuple(range(20)), tuple(range(20, 40)), tuple(range(40, 64))), (1, 1, -1)),
    ],
)
def test_every_plan_links_the_same(llm, plan):
    rng = np.random.default_rng(0)
    one = np.uint64(1)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    near = base[rng.integers(0, 4, 400)]
    for low, high in ((0, 12), (12, 64), (0, 64)):
        near = near ^ (one << rng.integers(low, high, 400).astype(np.uint64))
    codes = np.unique(np.concatenate([near, rng.integers(0, 1 << 63, 300, dtype=np.uint64)]))
    plan = plan or simhash.make_plan(codes, len(codes), 3)
    assert sum(plan.limits) == 3 - len(plan.parts) + 1
    df = llm.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    found = simhash.links(df, plan, 3).toPandas()
    a, b = (np.searchsorted(codes, found[c].to_numpy().view(np.uint64)) for c in "ab")
    x, y = simhash._pairs(codes, codes, 3)
    assert (simhash._roots(a, b, len(codes)) == simhash._roots(x, y, len(codes))).all()


def test_large_group_is_parted_and_links_the_same():
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 1 << 12, 3000, dtype=np.uint64) << np.uint64(20))
    found = simhash.group_links(codes, codes[:0], tuple(range(16, 64)), 3)
    a, b = np.searchsorted(codes, found[:, 0]), np.searchsorted(codes, found[:, 1])
    x, y = simhash._pairs(codes, codes, 3)
    assert (simhash._roots(a, b, len(codes)) == simhash._roots(x, y, len(codes))).all()


def test_stage_keeps_one_of_each_group(documents):
    rows = [(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (9, "other words in here"), (None, None)]
    kept = simhash.stage(documents(rows).sparkSession, documents(rows), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == [
        (2, "a b c d"),
        (9, "other words in here"),
        (None, None),
    ]
