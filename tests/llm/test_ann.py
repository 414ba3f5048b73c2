import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ann
from tidemark.llm.ann import nearest, perturbations

SCHEMA = "vec_id long, embedding array<float>, score double, cls string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.0, "x") for i, v in rows], SCHEMA)


def brute(rows, k=5):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, v in ok:
        if i % 50 == 0:
            near = sorted((-float(v @ w / np.sqrt((v @ v) * (w @ w))), j) for j, w in ok if j != i and len(w) == len(v))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def run(spark, rows, **kw):
    got = {}
    for r in nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, **kw).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 32))
    rows = [(i, [float(x) for x in centres[i % 8] + rng.standard_normal(32)]) for i in range(1500)]
    rows += [(2000 + i, rows[100][1]) for i in range(40)] + [(3000, rows[100][1])]
    got, want = run(spark, rows), brute(rows)
    assert set(got) == set(want)
    hit = sum(len({j for _, j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 5 * len(want)
    assert [j for _, j, _ in got[100]] == [2000, 2001, 2002, 2003, 2004]  # ties by id
    value = {(q, j): s for q, near in brute(rows, 2000).items() for j, s in near}
    for q, near in got.items():
        assert [r for r, *_ in near] == [1, 2, 3, 4, 5]
        assert all(abs(s - value[q, j]) < 1e-12 for _, j, s in near)


def test_split_buckets_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(50 * i if i < 60 else 50 * i + 1, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    rows += [(50 * i + 2, [float(x) for x in rng.standard_normal(9)]) for i in range(4)] + [(5000, [1.0] * 9)]
    whole = run(spark, rows)
    for name, most in (("BUCKET_ROWS", 5), ("ASK_ROWS", 7)):
        monkeypatch.setattr(ann, name, most)
    assert run(spark, rows) == whole and len(whole) == 61
    assert [j for _, j, _ in whole[5000]] == [j for j, _ in brute(rows)[5000]]


def test_odd_vectors_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (50, [0.0, 0.0]), (None, [1.0, 1.0]), (7, []), (100, [1.0, 2.0, 3.0])]
    got = run(spark, rows)
    assert [j for _, j, _ in got[0]] == [1] and set(got) == {0}
    assert run(spark, []) == {}


def test_few_unlike_candidates_are_all_returned(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k, dim in enumerate((3, 16, 40, 64, 65, 96, 128)):  # two queries and at most four others per dimension
        n = k % 4
        rows += [(i, [float(x) for x in rng.standard_normal(dim)])
                 for i in [100 * k, 100 * k + 50, *range(100 * k + 1, 100 * k + 2 + n)]]
    rows += [(2000 + i, [float(x) for x in rng.standard_normal(32)]) for i in (1, 2, 50)] + [(2003, [-1.0] * 32)] * 2
    got, want = run(spark, rows), brute(list(dict(rows).items()))
    assert {q: [j for _, j, _ in near] for q, near in got.items()} == {q: [j for j, _ in near] for q, near in want.items()}


def test_perturbations_come_in_order():
    up = np.array([0.1, 0.7, 0.45])
    cost = lambda s: sum((up[i] if d > 0 else 1 - up[i]) ** 2 for i, d in s)
    sets = perturbations(up, 26)
    assert len(sets) == 26 == len({tuple(sorted(s)) for s in sets})  # 3**3 - 1
    assert [round(cost(s), 9) for s in sets] == sorted(round(cost(s), 9) for s in sets)
