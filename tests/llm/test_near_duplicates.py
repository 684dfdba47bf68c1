"""MinHash groups and vector links against brute force on whole small tables."""

import itertools
import random

import numpy as np
import pytest

from tellerflow.llm import embeddings, minhash
from tellerflow.llm.common import components


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 60)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = roots({x for e in links for x in e}, links)
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert {r.id: r.component_id for r in found} == {k: v for k, v in want.items() if k not in loops}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def brute(texts, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {i: shingles(t) for i, t in texts}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), r) for i, r in roots(sets, links).items()}


@pytest.mark.parametrize("percent,bands,rows", [(80, 25, 5), (85, 21, 6)])
def test_minhash_groups(spark, docs, percent, bands, rows):
    """A large group of near copies at all distances, small groups, chains and short texts."""
    rng = random.Random(percent)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = [edited(rng, base, rng.randrange(6)) for _ in range(150)]
    for _ in range(30):
        own = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(1, 80))]
        texts += [" ".join(own), edited(rng, own, 1), " ".join(own).upper()]
    texts += ["", " \t ", None, "one", "ONE", "one two", "a b c d e", "a b c d e f"]
    numbered = list(enumerate(texts))
    found = minhash.near_duplicates(docs(*numbered), percent, bands, rows).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(numbered, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(texts)


def test_minhash_without_ids_repeats_and_empty(spark, docs):
    text = "a b c d e f g"
    rows = minhash.near_duplicates(docs((None, text), (3, text), (3, text), (2, text))).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("2", "2", True), ("3", "2", False), ("3", "2", False), ("None", "None", True)
    ]
    assert minhash.near_duplicates(docs()).count() == 0


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for shared in (20, 100, 180):
        pool = rng.integers(0, 2**63, 400 - shared, dtype=np.uint64)
        a, b = pool[:200], pool[200 - shared :]
        first, second = minhash.superminhash([a, b], 256)
        assert (first == minhash.superminhash([a[:0], a], 256)[1]).all()  # whatever stands beside
        same = first == second
        errors.append(abs(same.mean() - shared / len(pool)))
    assert max(errors) < 0.1
    assert len(set(minhash.superminhash([a[:1]], 256)[0].tolist())) == 256  # a slot for each level


def vectors_of(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "1 AS n_links", "'x' AS unit", "0 AS leaf")


def test_vector_links(spark):
    """Small leaves and blocks: spill, unsplittable groups, copies and block pairs all occur."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 16))
    near = x[:60] + rng.standard_normal((60, 16)) * 0.02
    hot = x[0] + rng.standard_normal((150, 16)) * 0.05
    x = np.vstack([x, near, hot, x[5:10], x[5:10]]).astype(np.float32)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15,
           [None] + [1.0] * 15, [1.0, 2.0]]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    found = embeddings.near_duplicate_vectors(
        vectors_of(spark, rows), leaf=64, block=50
    ).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    ids = range(len(x))
    want = roots([*ids, *range(1000, 1000 + len(odd))], zip(*map(list, np.nonzero(hit))))
    links = dict(enumerate(hit.sum(1).tolist()))
    assert {r.vec_id: r.component_id for r in found} == want
    assert {r.vec_id: r.n_links for r in found} == {i: links.get(i, 0) for i in want}


def test_vectors_without_ids_and_empty(spark):
    rows = [(None, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [2.0, 0.0])]
    found = embeddings.near_duplicate_vectors(vectors_of(spark, rows)).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found} == {
        (None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)
    }
    assert embeddings.near_duplicate_vectors(vectors_of(spark, [])).count() == 0


def test_repeated_rows_equal_brute_force_over_rows(spark):
    """Rows alike in id and vector, with and without neighbours."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((30, 8))
    rows = [(i, v) for i, v in enumerate(np.vstack([base, base[:6] * 2, base[:4] + 0.01]))]
    rows += [rows[0]] * 2 + [rows[7]] + [rows[33]] * 3 + [rows[37]]
    found = embeddings.near_duplicate_vectors(
        vectors_of(spark, [(i, v.tolist()) for i, v in rows])).collect()
    x = np.array([v for _, v in rows]).astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert sorted((r.vec_id, r.n_links) for r in found) == sorted(
        (i, int(n)) for (i, _), n in zip(rows, links))
    for ids, want in (((5, 5, 6), [2, 2, 2]), ((5, 5), [1, 1])):
        alike = vectors_of(spark, [(i, [1.0, 2.0]) for i in ids])
        found = embeddings.near_duplicate_vectors(alike).collect()
        assert [r.n_links for r in found] == want


def test_forest_of_several_passes(spark):
    """Small samples leave nodes open, so that later passes have to split them."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 16))
    x = np.concatenate([base, base + 0.05 * rng.standard_normal(base.shape)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = embeddings.near_duplicate_vectors(
        vectors_of(spark, rows), leaf=24, block=20, sample=60, trees=6
    ).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    assert {r.vec_id: r.n_links for r in found} == dict(enumerate(hit.sum(1).tolist()))


def test_equal_vectors_of_two_lengths_under_one_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0, 0.0, 0.0])]
    found = embeddings.near_duplicate_vectors(vectors_of(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [
        (1, 2, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1)
    ]


def test_loss_stays_below_its_bound_in_a_dense_group(spark):
    """Vectors of mean cosine 0.88 in small leaves: cuts part many pairs, so more trees are grown."""
    rng = np.random.default_rng(8)
    x = np.sqrt(0.88) * np.eye(24)[0] + np.sqrt(0.12 / 23) * rng.standard_normal((1200, 24))
    x = np.concatenate([x, rng.standard_normal((300, 24))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = embeddings.near_duplicate_vectors(vectors_of(spark, rows), leaf=64, block=256).collect()
    x = x.astype(np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    assert hit.sum() > 1000
    # Two ends for each lost pair; two pairs beyond the expected number are left to chance.
    assert 0 <= hit.sum() - sum(r.n_links for r in found) <= 1e-4 * hit.sum() + 4


def test_split_rate_of_a_normal_projection():
    rng = np.random.default_rng(9)
    p = rng.standard_normal(400_000)
    partner = p + np.sqrt(0.1) * rng.standard_normal(len(p))
    parted = ((p <= -0.16) & (partner > 0.16)) | ((p > 0.16) & (partner <= -0.16))
    assert abs(embeddings._split_rate(p, 0.16, np.sqrt(0.1)) - parted.mean()) < 1e-3
