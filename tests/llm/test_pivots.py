import math

import numpy as np
import pytest

from ledgerloom.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int, nearest int, copies int, root int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 0, 0, 0) for i, v, label in rows], SCHEMA)


def brute(rows):
    links, root = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}
    sound = []
    for i, v, label in rows:
        if v is None or label is None or not len(v) or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        sound.append((i, np.asarray(v, np.float32).astype(np.float64), label))
    pairs = [
        (a, b)
        for n, (a, x, s) in enumerate(sound)
        for b, y, t in sound[n + 1 :]
        if s == t and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93
    ]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return links, root, pairs


@pytest.mark.parametrize("block,undivided", [(2048, 11), (8, 11), (8, 1)])
def test_against_brute_force(spark, monkeypatch, block, undivided):
    monkeypatch.setattr(pivots, "BLOCK", block)
    monkeypatch.setattr(pivots, "BLOCKS_UNDIVIDED", undivided)
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for group in range(60):
        center = rng.standard_normal(64)
        for _ in range(1 + group % 5):
            rows.append((n, center + rng.standard_normal(64) * 0.2, group % 3))
            n += 1
    hot = rng.standard_normal(64)
    rows += [(n + k, hot + rng.standard_normal(64) * 0.1 * (k > 10), 1) for k in range(40)]
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None] + [1.0] * 63]
    rows += [(900 + k, v, 1) for k, v in enumerate(odd)] + [(950, hot, None), (960, [1.0, 0.0], 1), (961, [1.0, 0.0], 1), (962, [-0.0, 1.0], 1), (963, [0.0, 1.0], 1)]
    links, root, pairs = brute(rows)
    found = {r["vec_id"]: r for r in pivots.near_duplicates(table(spark, rows)).collect()}
    assert len(found) == len(rows)
    got = sum(r["n_links"] for r in found.values()) / 2
    assert all(found[i]["n_links"] <= links[i] for i in links)
    assert got >= 0.95 * len(pairs) > 100
    assert np.mean([found[i]["component_id"] == root[i] for i in root]) > 0.95
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_missing_ids_repeated_rows_and_no_rows(spark):
    v = [1.0] * 8
    found = pivots.near_duplicates(table(spark, [(None, v, 1), (4, v, 1), (4, v, 1), (7, v, 1)])).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in found) == [
        (-1, 0, -1, False), (4, 2, 4, True), (4, 2, 4, True), (7, 2, 4, False)
    ]
    assert pivots.near_duplicates(table(spark, [])).count() == 0
    assert pivots.near_duplicates(table(spark, [(1, None, 1)])).collect()[0]["n_links"] == 0


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").filter("label < 3").select("vec_id", "embedding", "label")
    r = rows.collect()
    keep = [(x["vec_id"], x["embedding"], x["label"]) for x in r if x["embedding"] is not None and all(v is not None and math.isfinite(v) for v in x["embedding"])]
    total = 0
    for label in {x[2] for x in keep}:
        m = np.array([x[1] for x in keep if x[2] == label], np.float64)
        m = m[np.abs(m).sum(1) > 0]
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        total += ((m @ m.T >= 0.93).sum() - len(m)) // 2
    found = sum(x["n_links"] for x in pivots.near_duplicates(rows).collect()) / 2
    assert 0.95 * total <= found <= total + 1e-6 * total


@pytest.mark.parametrize("size,typical", [(64, 0.94), (64, 0.97), (256, 0.97)])
def test_recall_with_a_third_of_the_rows_in_one_group_of_near_copies(spark, size, typical):
    rng = np.random.default_rng(5)
    m = rng.standard_normal((6000, size))
    m[::3] = m[0] + rng.standard_normal((2000, size)) * np.sqrt((1 - typical) / typical)
    m = m.astype(np.float32)
    found = pivots.near_duplicates(table(spark, [(i, v, 1) for i, v in enumerate(m)]))
    found = {r["vec_id"]: r["n_links"] for r in found.collect()}
    units = m.astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links = (units @ units.T >= 0.93).sum(axis=1) - 1
    assert all(found[i] <= n for i, n in enumerate(links)) and links.sum() > 1_000_000
    assert sum(found.values()) >= 0.95 * links.sum()


def test_recall_over_all_labels(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding", "label")
    r = [x for x in rows.collect() if x["label"] is not None and x["embedding"] is not None and all(v is not None and math.isfinite(v) for v in x["embedding"])]
    total = 0
    for label in {x["label"] for x in r}:
        m = np.array([x["embedding"] for x in r if x["label"] == label], np.float64)
        m = m[np.abs(m).sum(1) > 0]
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        total += ((m @ m.T >= 0.93).sum() - len(m)) // 2
    found = sum(x["n_links"] for x in pivots.near_duplicates(rows).collect()) / 2
    assert 0.95 * total <= found <= total + 1e-6 * total


def test_tiny_and_huge_components_link(spark):
    rows = [(1, [1e-200, 0.0], 1), (2, [2e-200, 0.0], 1), (3, [1e200, 0.0], 1), (4, [0.0, 5e-324], 1), (5, [0.0, 1e308], 1), (6, [1e308, 1e308], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pivots.near_duplicates(vectors).collect()}
    assert found == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_pivots_grow_with_the_rows_within_their_bounds():
    assert [pivots.pivot_count(n, 64) for n in (1, 4096, 4097, 100_000, 10**9)] == [256, 256, 512, 8192, 1 << 14]
    assert pivots.pivot_count(10**9, 1024) == 2048 and pivots.pivot_count(10**9, 1 << 22) == 256


def test_candidates_stay_few_as_the_rows_grow():
    """Pairs that share enough pivots of a common list, for each vector, do not grow with the rows."""
    rng, met = np.random.default_rng(7), []
    for n in (4_000, 16_000, 64_000):
        units = pivots._units(rng.standard_normal((n, 64)))
        table = pivots._spread_out(units, pivots.pivot_count(n, 64))
        near = np.concatenate([np.argsort(-(units[i : i + 500] @ table.T), axis=1)[:, : pivots.DESCRIBED] for i in range(0, n, 500)])
        asked = near[:: n // 200]
        found = [((near[:, :, None] == a).any(axis=2).sum(axis=1) >= pivots.SHARED) & (near[:, : pivots.LISTED, None] == a[: pivots.LISTED]).any(axis=(1, 2)) for a in asked]
        met.append(np.mean([f.sum() for f in found]) - 1)
    assert max(met) < 1.2 * met[0] and met[-1] < 0.01 * 64_000, met
