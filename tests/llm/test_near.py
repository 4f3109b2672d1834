import numpy as np
import pandas as pd
import plain
import pytest

from courierlake.llm import lattice, simhash
from courierlake.llm.common import components, workspace


def test_masks_cover_every_pair_within_the_radius():
    rng = np.random.default_rng(1)
    for radius in (1, 2, 4):
        masks = np.array(simhash.covering_masks(radius), np.int64).view(np.uint64)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            bits = rng.choice(64, radius, replace=False)
            flip = np.uint64(sum(1 << int(b) for b in bits))
            assert (masks & flip == 0).any()


def test_simhash_against_plain(texts, odd, documents):
    rows = [r for r in odd if r[0] not in (11, None)] + [(100 + r["doc_id"], r["text"]) for r in documents.collect()]
    want = plain.near_duplicates(pd.DataFrame(rows, columns=["doc_id", "text"]))
    got = simhash.near_duplicates(texts(rows)).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got.astype(str), want.reset_index(drop=True).astype(str))


def chain(n, radius, seed):
    rng = np.random.default_rng(seed)
    prints = [int(rng.integers(0, 2**63))]
    for _ in range(n - 1):
        p = prints[rng.integers(max(0, len(prints) - 5), len(prints))]
        for b in rng.choice(64, rng.integers(1, 2 * radius), replace=False):
            p ^= 1 << int(b)
        prints.append(p)
    return prints


@pytest.mark.parametrize("bucket", [65_536, 3, 1])  # the small ones send crowded buckets to the ball step
def test_links_whatever_the_bucket_limit(spark, bucket):
    prints = np.unique(np.array(chain(120, 4, 2), np.uint64))
    nodes = spark.createDataFrame([(int(p), i) for i, p in enumerate(prints.view(np.int64).tolist())],
                                  "fingerprint long, doc_id long")
    folder = workspace(spark)
    got = {r["node"]: r["root"] for r in components(simhash.near_links(nodes, folder, 4, bucket), folder).collect()}
    links = [(i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 4]
    assert [got.get(i, i) for i in range(len(prints))] == plain.roots(len(prints), links)


def test_simhash_odd_rows(texts, odd):
    got = simhash.near_duplicates(texts(odd)).toPandas()
    assert len(got) == len(odd)
    assert set(got[got["doc_id"].isin([1, 2, 3])]["component_id"]) == {1}
    assert got[got["doc_id"].isna()]["component_id"].isna().all()
    assert simhash.near_duplicates(texts([])).count() == 0


def test_keep_first(texts, odd):
    rows = [(*r, "x") for r in odd]
    got = simhash.keep_first(texts(rows, ", component_id string"))
    assert got.columns == ["doc_id", "text", "component_id"]
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) and {1, 10, None} <= set(ids) and not {2, 3, 11} & set(ids)


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1001 + i) for i in range(500)]
    edges = spark.createDataFrame(path + hub + [(7, 7)] + hub[:3], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges, workspace(spark)).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1501)} == {1000}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vec string")


def cloud(seed, groups, size, noise, alone, dims=64):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dims) + noise * rng.normal(size=dims) * rng.random() for _ in range(alone)]
    for _ in range(groups):
        centre = rng.normal(size=dims)
        out += [centre + noise * rng.normal(size=dims) * rng.random() * 1.4 for _ in range(size)]
    return [(i, [float(x) for x in v], i % 3, "v") for i, v in enumerate(out)]


@pytest.mark.parametrize("noise", [0.05, 0.35])  # tight groups, and groups around the threshold
def test_lattice_against_all_pairs(spark, noise):
    rows = cloud(4, 6, 60, noise, 300)
    got = lattice.similar_vectors(vectors(spark, rows)).toPandas().sort_values("vec_id").reset_index(drop=True)
    stored = pd.DataFrame([(r[0], np.array(r[1], np.float32).tolist()) for r in rows], columns=["vec_id", "embedding"])
    want = plain.similar_vectors(stored)
    assert (got["n_links"] <= want["n_links"].to_numpy()).all()
    assert got["n_links"].sum() >= 0.99 * want["n_links"].sum()
    assert (got["component_id"] == want["component_id"]).mean() > 0.98


def test_recall_at_the_threshold():
    """Pairs exactly at cosine 0.9: by tables and blocks that the operator takes for 500 to 10 million vectors."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1)[:, None] * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * y / np.linalg.norm(y, axis=1)[:, None]
    for n in (500, 50_000, 10_000_000):
        blocks = lattice.blocks_for(n)
        met = np.zeros(len(x), bool)
        for t in range(lattice.tables_for(blocks)):
            own_x, all_x = lattice.cells(x, t, blocks)
            own_y, all_y = lattice.cells(y, t, blocks)
            met |= (all_x == own_y[:, None]).any(1) | (all_y == own_x[:, None]).any(1)
        assert met.mean() > 0.99, (n, blocks, met.mean())


def test_lattice_odd_rows(spark):
    v = [1.0] + [0.0] * 7
    rows = [(1, v, 0, "a"), (2, [2.0] + [0.0] * 7, 1, "a"), (3, v, 0, "a"), (4, None, 0, "a"), (5, [0.0] * 8, 0, "a"),
            (6, [float("nan")] + v[1:], 0, "a"), (7, [float("inf")] + v[1:], 0, "a"), (8, [None] + v[1:], 0, "a"),
            (9, [], 0, "a"), (10, [1.0, 0.0], 0, "a"), (None, v, 0, "a"), (11, [-1.0] + [0.0] * 7, 0, None)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in lattice.similar_vectors(vectors(spark, rows)).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)) and got[None] == (0, None, False)
    assert lattice.similar_vectors(vectors(spark, [])).count() == 0


def test_nearest_e8_is_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)) * 2
    near = lattice.nearest_e8(x)
    gap = ((x - near) ** 2).sum(1)
    assert gap.max() <= 1 + 1e-9  # the covering radius
    around = near[:, None] + lattice.shortest_e8()[None]
    assert (((x[:, None] - around) ** 2).sum(-1) >= gap[:, None] - 1e-9).all()
