import random

import numpy as np
import pytest
import xxhash

from labelloom.llm import simhash, vectors
from labelloom.llm.common import connected_components
from tests.llm.helpers import SF, awkward_documents, documents, empty_documents


def plain_fingerprint(text):
    blanks = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text):
        if c in blanks:
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(values, linked):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


def test_components_match_a_plain_search(spark):
    rnd = random.Random(5)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    pairs = {frozenset(e) for e in edges}
    want = classes_of(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert got == {n: nodes[c] for n, c in zip(nodes, want)}


def test_fingerprints_are_as_defined():
    texts = ["", "One", "one TWO three", "a b c d", "É Ô x\x0by z\x1cq A b C", "a a a a a a a", "w " * 5000]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_allocation_is_the_cheapest():
    costs = [[0, 5, 50], [0, 1, 100], [0, 9, 10]]
    assert simhash.allocate(costs, 3) == (11, [-1, 0, 1])


@pytest.mark.parametrize("hot", [simhash.HOT_PLACE, 5])
def test_classes_match_brute_force(spark, hot, monkeypatch):
    rnd = random.Random(9)
    fps = [rnd.getrandbits(64) for _ in range(300)]
    for _ in range(400):
        fp = rnd.choice(fps)
        for _ in range(rnd.randint(1, 6)):
            fp ^= 1 << rnd.randrange(64)
        fps.append(fp)
    fps = sorted(set(fps))
    nodes = simhash.stored(spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp bigint"), "t")
    plan = simhash.plan_groups(nodes)
    assert sum(t + 1 for _, t in plan) == simhash.THRESHOLD + 1
    assert sorted(b for bits, _ in plan for b in bits) == list(range(64))
    places = simhash.part_hot_places(simhash.file_places(nodes, plan), plan, simhash.THRESHOLD, limit=hot)
    found = connected_components(simhash.meet(places))
    roots = {r.node: r.root for r in found.collect()}
    got = [roots.get(simhash.signed(f), simhash.signed(f)) for f in fps]
    want = classes_of(fps, lambda a, b: (a ^ b).bit_count() <= simhash.THRESHOLD)
    assert len(set(zip(got, want))) == len(set(want)) == len(set(got))


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    fps = [plain_fingerprint(r.text or "") for r in rows]
    want = classes_of(fps, lambda a, b: (a ^ b).bit_count() <= simhash.THRESHOLD)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    for r, fp, c in zip(rows, fps, want):
        assert (got[r.doc_id].fp, got[r.doc_id].component_id) == (simhash.signed(fp), rows[c].doc_id)


def test_awkward_documents(spark):
    got = simhash.near_duplicates(awkward_documents(spark)).collect()
    assert len(got) == 11
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].fp == by_id[4].fp == by_id[5].fp == 0 and by_id[5].component_id == 3
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


def test_large_group_of_copies_is_one_class(spark):
    docs = documents(spark, ["the same words in every one of these texts"] * 3000 + ["quite another text than the ones before it"])
    got = simhash.near_duplicates(docs).groupBy("component_id").count().collect()
    assert sorted((r.component_id, r["count"]) for r in got) == [(0, 3000), (3000, 1)]


# --- vectors ---


def brute(rows):
    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la is None or la != lb or any(not usable(v) for v in (a, b)):
                continue
            a, b = np.array(a, float), np.array(b, float)
            if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= vectors.MIN_COSINE:
                links[i].add(j)
                links[j].add(i)
    roots = classes_of(list(range(n)), lambda i, j: j in links[i])
    return {rows[i][0]: (len(links[i]), rows[roots[i]][0]) for i in range(n)}


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def clustered(n=600, width=64, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, width))
    rows = []
    for i in range(n):
        noise = rng.uniform(0.05, 0.6)
        v = base[i % len(base)] + noise * rng.normal(size=width)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3)))
    return rows


def test_vectors_against_brute_force(spark):
    rows = clustered()
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    want = brute(rows)
    assert sum(n for n, _ in want.values()) > 100
    assert {k: (r.n_links, r.component_id) for k, r in got.items()} == {k: tuple(x) for k, x in want.items()}


def test_blocks_of_a_large_cell(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)
    rows = clustered(240)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sum(r.n_links for r in vectors.near_vectors(table).collect())
    assert got >= 0.97 * sum(n for n, _ in brute(rows).values())


@pytest.mark.parametrize("block", [vectors.BLOCK_ROWS, 64])
def test_small_groups_beside_a_large_one(spark, block, monkeypatch):
    """Pairs near the least cosine on a grid of about 54 x 54 cells, beside a group with nearly all links."""
    monkeypatch.setattr(vectors, "CELL_ROWS", 0.5)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)

    def beside(v, cosine):
        other = rng.normal(size=len(v))
        other -= other @ v * v
        return cosine * v + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)

    base = rng.normal(size=(1201, 12))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    found = [beside(base[0], 0.99999) for _ in range(200)] + list(base[1:])
    found += [beside(v, 0.932) for v in base[1:41]]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(found)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    x = vectors.unit(found)
    want = (x @ x.T >= vectors.MIN_COSINE).sum(1) - 1
    assert want[1400:].min() >= 1 and want[:200].sum() > 0.99 * want.sum()
    assert [got[i].n_links for i in range(len(found))] == want.tolist()


def test_possible_cells_hold_every_neighbour():
    """Clusters on a 12 x 12 grid: most cells are left out, none of them with a neighbour."""
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(12, 8))
    x = vectors.unit(middles[rng.integers(0, 12, 1500)] + 0.12 * rng.normal(size=(1500, 8)))
    first, second = vectors.lloyd(x[:, :4], 12), vectors.lloyd(x[:, 4:], 12)
    plain = vectors.Grid(first, second, np.zeros(12), np.zeros(12), 1)
    a, b = plain.halves(x)
    reach = []
    for near in (a, b):
        far = np.zeros(12)
        np.maximum.at(far, near.argmin(1), np.sqrt(near.min(1)))
        reach.append(far)
    grid = vectors.Grid(first, second, *reach, 1)
    possible = grid.possible(x)
    assert possible.mean() < 0.5
    q, r = np.nonzero(x @ x.T >= vectors.MIN_COSINE)
    assert possible[q, grid.own(x)[r]].all()


def test_vectors_of_several_widths(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.01], 1), (5, [1.0], 1), (6, [2.0], 1), (7, [], 1), (8, None, 1), (9, [0.0, 0.0], 1), (10, [1.0, 0.0], None)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(table).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5), **{i: (0, i) for i in (7, 8, 9, 10)}}


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0], 1), (9, [1.0, 0.0], 1),
        (10, [float("inf"), 1.0], 1),
    ]
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, node string, copies int")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table).collect()}
    assert got == {
        (1, 3, 1, True), (2, 3, 1, False), (9, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
        (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (10, 0, 10, True),
    }
    assert vectors.near_vectors(table.limit(0)).count() == 0
