import numpy as np
import pytest

from smeltworks.llm import embedding_dedup as dedup


def brute(vectors, threshold=0.95):
    """Links and component per vector; None for those that link with nothing."""
    sound = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n, labels = np.zeros(len(vectors), int), np.arange(len(vectors))
    pairs = []
    for i in range(len(vectors)):
        for j in range(i):
            if sound[i] and sound[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.float64(np.float32(vectors[i])), np.float64(np.float32(vectors[j]))
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    pairs.append((j, i))
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(labels[i], labels[j])
            changed |= labels[i] != low or labels[j] != low
            labels[i] = labels[j] = low
    return n.tolist(), labels.tolist()


@pytest.mark.parametrize("cell_rows", [512, 8])
def test_links_and_components_equal_brute_force(spark, cell_rows):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 24))
    near = [c + 0.1 * rng.standard_normal(24) for c in centres for _ in range(8)]
    vectors = [v.tolist() for v in [*near, *centres[:3], *centres[:3], *(5 * centres[:2])]]
    vectors += [None, [], [0.0] * 24, [1.0, None] + [0.0] * 22, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0, 2.0], [2.0, 4.0], [1e-30, 2e-30]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in dedup.embedding_dedup(df, cell_rows=cell_rows).collect())
    links, labels = brute(vectors)
    assert sum(r[1] for r in got) >= 0.97 * sum(links) and all(r[1] <= n for r, n in zip(got, links, strict=True))
    assert [r[2] for r in got] == labels and all(r[3] == (r[0] == r[2]) for r in got)


def test_odd_tables(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "'x' AS copies", "1 AS n")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in dedup.embedding_dedup(df).collect())
    assert got == [(0, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert dedup.embedding_dedup(df.where("vec_id < 0")).isEmpty()


def test_one_id_on_different_vectors(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.01]), (7, [0.01, 1.0]), (8, [0.02, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in dedup.embedding_dedup(df).collect())
    assert got == [(5, 1, 5), (5, 2, 5), (6, 1, 5), (7, 2, 5), (8, 2, 5)]


def test_estimate_is_unbiased_within_its_bound():
    rng = np.random.default_rng(0)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, 400, 64)))
    b[:200] = 0.8 * a[:200] + 0.6 * b[:200]
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    (code, _, factor), (levels, step, _) = dedup.codes(a), dedup.codes(b)
    cosines, bound = dedup.estimate(code, factor, levels, step)
    error = cosines - a @ b.T
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= bound).mean() > 0.98
    assert ((code >= 0) == (a @ dedup.rotation(64) >= 0)).all()


def test_keys_do_not_depend_on_the_batch():
    levels = dedup.codes(dedup.units(np.random.default_rng(1).standard_normal(300 * 64), 64))[0]
    whole = dedup.cell_keys(levels, 20, 30)
    assert all((dedup.cell_keys(levels[i : i + 1], 20, 30) == whole[i]).all() for i in range(300))


def test_double_components_are_not_folded_to_float(spark):
    rows = [(1, [1.0, 0.3286841051788632]), (2, [1.0, 0.0]), (3, [1.0, 1e-12])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    threshold = 1.0
    got = {r.vec_id: r.n_links for r in dedup.embedding_dedup(df, threshold=threshold - 1e-9).collect()}
    assert got == {1: 0, 2: 1, 3: 1}
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [2e300, 0.0])], "vec_id bigint, embedding array<double>")
    assert sorted(r.n_links for r in dedup.embedding_dedup(huge).collect()) == [1, 1]


def test_recall_on_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in df.collect())
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    threshold = 0.6
    want = (unit @ unit.T >= threshold).sum() - len(unit)
    got = sum(r.n_links for r in dedup.embedding_dedup(df, threshold=threshold).collect())
    assert want > 0 and 0.9 * want <= got <= want
