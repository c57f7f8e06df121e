"""Hard negatives and near-duplicate vectors against brute force."""

from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, negatives, subspaces
from tidemark.sources.tables import read_table

SCHEMA = "vec_id bigint, embedding array<float>, label int, cos string, pack int, slot int"


def table(spark, rows, schema=SCHEMA):
    """Rows with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], schema)


def clustered(seed=3, n=400, width=24):
    """Vectors in tight and loose groups, one label holding a third, with odd rows among them."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, width))
    rows = []
    for i in range(n):
        spread = (0.02, 0.1, 0.6)[i % 3]
        vector = centres[rng.integers(30)] + spread * rng.normal(size=width) * rng.random()
        label = 0 if i % 3 == 0 else int(rng.integers(4))
        rows.append((i, [float(np.float32(x)) for x in vector * (1 + i % 5)], label))
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(0, 60, 4)]
    rows += [rows[5], rows[5], (7, rows[9][1], rows[9][2]), (None, rows[9][1], rows[9][2])]
    rows += [
        (2000, None, 1),
        (2001, [], 1),
        (2002, [0.0] * width, 1),
        (2003, [0.0] * width, 1),
        (2004, [None] + [1.0] * (width - 1), 1),
        (2005, [float("nan")] * width, 1),
        (2006, [float("inf")] + [1.0] * (width - 1), 1),
        (2007, rows[0][1], None),
        (2008, [1.0, 2.0, 3.0], 1),
        (2009, [1.0, 2.0, 3.01], 1),
        (2010, [2.0], 1),
        (2011, [-2.0], 1),
        (2012, [5.0], 1),
        (2050, [-0.0] + [1.0] * (width - 1), 2),
        (2051, [0.0] + [1.0] * (width - 1), 2),
    ]
    return rows


def usable(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector)


def brute_links(rows, cosine=0.98):
    units = [np.array(v) / np.linalg.norm(v) if usable(v) and any(v) else None for _, v, _ in rows]
    near = defaultdict(set)
    for i, (_, _, label) in enumerate(rows):
        for j in range(i):
            x, y = units[i], units[j]
            if label is not None and label == rows[j][2] and x is not None and y is not None:
                if len(x) == len(y) and x @ y >= cosine:
                    near[i].add(j)
                    near[j].add(i)
    result = []
    for i in range(len(rows)):
        group, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - group
            group |= new
            todo += new
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        first = min(ids, default=None)
        result.append((rows[i][0], len(near[i]), first, rows[i][0] == first))
    return result


@pytest.mark.parametrize("pack", [512, 7])
def test_links_of_vectors_against_brute_force(spark, monkeypatch, pack):
    monkeypatch.setattr(subspaces, "PACK", pack)
    rows = clustered()
    found = corpus.collected(subspaces.linked_vectors(table(spark, rows)))
    wanted = brute_links(rows)
    assert Counter(found) == Counter(wanted)
    assert max(n for _, n, _, _ in wanted) > 5


def test_links_of_long_narrow_and_double_vectors(spark, monkeypatch):
    monkeypatch.setattr(subspaces, "PACK", 16)
    monkeypatch.setattr(subspaces, "SAMPLE", 20)
    for width in (1, 3, 70):
        rng = np.random.default_rng(width)
        base = rng.normal(size=(20, width))
        rows = [(i, (base[i % 20] * 10.0 ** (i % 7 * 40) + (i % 2) * 1e-3).tolist(), i % 2) for i in range(120)]
        df = table(spark, rows, SCHEMA.replace("array<float>", "array<double>"))
        units = [(i, subspaces.unit_rows(np.array([v]))[0].tolist(), label) for i, v, label in rows]
        assert Counter(corpus.collected(subspaces.linked_vectors(df))) == Counter(brute_links(units))


def test_a_crowd_of_near_copies_leaves_no_pairs(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=32)
    rows = [(i, (centre + 0.01 * rng.normal(size=32)).tolist(), 1) for i in range(1500)]
    found = subspaces.linked_vectors(table(spark, rows)).collect()
    assert {r.n_links for r in found} == {1499} and {r.component_id for r in found} == {0}


def test_packs_far_apart_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(subspaces, "PACK", 50)
    met = []
    real = subspaces.pack_pairs
    monkeypatch.setattr(subspaces, "pack_pairs", lambda packs, c: met.append(real(packs, c).collect()) or real(packs, c))
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i // 50] + 0.005 * rng.normal(size=16)).tolist(), 1) for i in range(1000)]
    found = subspaces.linked_vectors(table(spark, rows)).collect()
    assert sum(r.kept for r in found) == 20
    pairs = [(r.a, r.b) for r in met[0]]
    assert len(pairs) == len(set(pairs))
    packs = len({a for a, b in pairs if a == b})
    assert len(pairs) < packs * (packs + 1) / 4


def brute_negatives(rows, wanted):
    taken = sorted(
        {(i, tuple(v), label) for i, v, label in rows if i is not None and label is not None and usable(v)}
    )
    whole = [np.floor(256 * np.array(v)).astype(object) for _, v, _ in taken]
    result = set()
    for k, (anchor, _, label) in enumerate(taken):
        if not wanted(anchor):
            continue
        scored = [
            (-int(whole[k] @ whole[j]), other, mine == label)
            for j, (other, _, mine) in enumerate(taken)
            if len(whole[j]) == len(whole[k])
        ]
        same = sorted({x[:2] for x in scored if x[2] and x[1] != anchor})[:5]
        differ = sorted({x[:2] for x in scored if not x[2]})
        for p, positive in same:
            p = -p
            fits = [(n, i) for n, i in differ if 50 * p <= -100 * n <= 95 * p][:3]
            for rank, (n, i) in enumerate(fits, 1):
                result.add((anchor, positive, rank, i, p, -n))
    return result


@pytest.mark.parametrize("pack", [512, 9])
def test_hard_negatives_against_brute_force(spark, monkeypatch, pack):
    monkeypatch.setattr(negatives, "PACK", pack)
    rows = clustered(5)
    rows += [(3000, [3e7] + [1.0] * 23, 1), (3001, [3e7] + [2.0] * 23, 2), (3005, [2e7] + [0.0] * 23, 1)]
    found = corpus.collected(negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0))
    # Anchors that agree in id but not in vector are told apart inside, not in the result.
    rows = [r for r in rows if usable(r[1]) and max(map(abs, r[1])) < 1e6]
    assert len(found) == len(set(found))
    wanted = brute_negatives(rows, lambda i: i % 5 == 0)
    assert set(found) == wanted and len(wanted) > 500


def test_hard_negatives_in_many_cells(spark, monkeypatch):
    """Several blocks of anchors and slots of rows, with most rows as anchors and exact copies among them."""
    monkeypatch.setattr(negatives, "PACK", 9)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 1 << 13)
    rows = clustered(6, 300)
    rows += [(4000 + i, rows[i % 3][1], i % 2) for i in range(60)]
    rng = np.random.default_rng(9)
    for width in (2, 3, 300):  # also longer than those whose every pair is scored
        rows += [(5000 + 100 * width + i, ((1 + rng.random(width)) * (1 + i % 4)).tolist(), i % 3) for i in range(40)]
    found = corpus.collected(negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 3 > 0))
    assert len(found) == len(set(found))
    rows = [(i, np.float32(v).tolist() if usable(v) else v, label) for i, v, label in rows]
    wanted = brute_negatives(rows, lambda i: i % 3 > 0)
    assert set(found) == wanted
    assert {row[0] // 100 for row in wanted} > {52, 53, 350}


def test_hard_negatives_keep_the_driver_small(spark, monkeypatch):
    """Copies of the anchors are not broadcast, and the tasks' shares of the sample do not meet in the driver."""
    plans, collected = {}, []
    frame = type(spark.range(0))
    real, collect = negatives.stored, frame.collect

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def spied(df):
        collected.append(plan_of(df))
        return collect(df)

    monkeypatch.setattr(negatives, "stored", lambda df, label: plans.update({label: plan_of(df)}) or real(df, label))
    monkeypatch.setattr(frame, "collect", spied)
    rows = [(i, [float(np.float32(x)) for x in v], i % 4) for i, v in enumerate(np.random.default_rng(8).normal(size=(500, 6)))]
    assert negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 9 == 0).count() > 50
    for label in ("near-rows", "window-rows"):
        assert "MapInArrow" in plans[label] and "Broadcast" not in plans[label]
    assert collected and not any("TakeOrdered" in plan for plan in collected)


def test_sample_for_references_is_whole(spark, monkeypatch):
    """The least hashes first, as if all were sorted; ids that repeat or lie above the bound leave it no shorter."""
    monkeypatch.setattr(negatives, "SAMPLE", 10)
    for ids in (list(range(500)), [7] * 500, [7] * 490 + list(range(10)), list(range(4)), []):
        taken = spark.createDataFrame([(i, [float(i), float(k)]) for k, i in enumerate(ids)], "vec_id bigint, vector array<float>")
        wanted = [x.vec_id for x in taken.select("vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(10).collect()]
        assert sorted(int(v[0]) for v in negatives._sample(taken)) == sorted(wanted)


def test_angles_bound_every_score():
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(size=(150, 8)), np.zeros((1, 8)), np.eye(8), -np.eye(8)])
    whole = negatives.quantised(vectors, 256)
    directions = negatives.references(vectors[:40].tolist())[8]

    def pack(rows):
        angles = negatives.angles_to(rows, directions)
        held = {"keys": [0] * len(rows), "ids": range(len(rows)), "labels": [0] * len(rows)}
        row = {f"{k}_a": np.array(v, np.int64).tobytes() for k, v in held.items()}
        row |= {"vectors_a": rows.astype(np.int32).tobytes(), "angles_a": angles.tobytes()}
        return negatives.Pack(row | {"windows_a": b"", "width": 8, "reach_a": 2000}, "a")

    a = pack(whole)
    low, high = negatives.bounds(a, a)
    exact = negatives.scores(a, a, np.ones(low.shape, bool))
    assert (low <= exact).all() and (exact <= high).all()
    assert (exact == (whole @ whole.T).astype(np.int64)).all()
    assert (high < low.max() / 2).mean() > 0.1  # the bounds do rule pairs out


def test_vectors_of_nothing(spark):
    empty = table(spark, [])
    assert subspaces.linked_vectors(empty).count() == 0
    assert negatives.hard_negatives(empty, F.lit(True)).count() == 0
    odd = table(spark, [(1, None, 1), (2, [None], None), (None, [], 3)])
    assert subspaces.linked_vectors(odd).count() == 3
    assert negatives.hard_negatives(odd, F.lit(True)).count() == 0


def test_registered_vector_queries(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label").collect()]
    found = corpus.collected(catalog.QUERIES["op13_embedding_dedup"](spark, sf))
    assert Counter(found) == Counter(brute_links(rows))
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    found = corpus.collected(catalog.QUERIES["op11_hard_negatives"](spark, sf))
    assert Counter(found) == Counter(brute_negatives(moved, lambda i: i % 50 == 0))
