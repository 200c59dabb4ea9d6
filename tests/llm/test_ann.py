import numpy as np
from pyspark.sql import functions as F

from hexloom.llm.ann import nearest, scan


def brute(ids, x, asked, k=5):
    norms = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in np.flatnonzero(asked):
        score = (x * x[i]).sum(axis=1) / (norms * norms[i])
        rest = np.flatnonzero(ids != ids[i])
        best = rest[np.lexsort((ids[rest], -score[rest]))[:k]]
        out[int(ids[i])] = [(int(ids[b]), float(score[b])) for b in best]
    return out


def found(df, key="vec_id"):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r[key], r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(len(want[q]), 1) for q in want])


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pdf = df.toPandas()
    want = brute(pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(float), (pdf.vec_id % 50 == 0).to_numpy())
    got = found(nearest(df, F.col("vec_id") % 50 == 0))
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, rows in want.items() for i, s in rows}
    assert all(abs(s - exact[q, i]) < 1e-12 for q, rows in got.items() for i, s in rows if (q, i) in exact)


def test_copies_and_bad_vectors(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 12))
    x[100:400] = x[7]  # a hot group of copies: ties go to the smaller key
    rows = [(k, [float(v) for v in x[k]], "other") for k in range(600)]
    bad = [(1000, None, ""), (1050, [0.0] * 12, ""), (1100, [float("nan")] + [1.0] * 11, ""), (1150, [float("inf")] + [1.0] * 11, ""), (1200, [None] + [1.0] * 11, ""), (1250, [1.0], ""), (1300, [], ""), (None, [1.0] * 12, "")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score string")
    got = found(nearest(df, F.col("vec_id") % 50 == 0))
    want = brute(np.arange(600), x, np.arange(600) % 50 == 0)
    assert recall(got, want) >= 0.9
    assert [i for i, _ in got[100]] == [7, 101, 102, 103, 104]


def test_repeated_queries_magnitudes_and_dimensions(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(40, 8))
    x[3], x[4], x[5] = x[0] * 1e200, x[0] * 1e-200, x[0] + 0.1 * x[1]
    x[5] *= 1e180
    rows = [(k, [float(v) for v in x[k]]) for k in range(40)]
    rows += [rows[0], rows[7]]  # a query and a candidate given twice
    rows += [(50, [1.0, 2.0]), (51, [2.0, 1.0]), (52, [1.0, 2.5])]  # of another number of dimensions
    got = {}
    for g in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id").isin(0, 1, 50)).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    ids = np.array([*range(40), 7, 0])
    for q, copies in ((0, 2), (1, 1)):
        score = unit[ids] @ unit[q]
        best = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != q][:5]
        assert sorted(got[q]) == sorted([(k + 1, int(ids[j]), s) for k, j in enumerate(best) for s in [next(g[2] for g in got[q] if g[:2] == (k + 1, ids[j]))]] * copies)
        assert all(abs(g[2] - float(unit[g[1]] @ unit[q])) < 1e-12 for g in got[q])
    assert [g[:2] for g in sorted(got[50])] == [(1, 52), (2, 51)]


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], schema)
    got = found(nearest(df, F.col("vec_id") == 0))
    assert [i for i, _ in got[0]] == [1, 2]
    assert nearest(df.where("vec_id = 0"), F.lit(True)).count() == 0
    assert nearest(df.where(F.lit(False)), F.lit(True)).columns == ["query_id", "rank", "vec_id", "score"]
    assert nearest(df.where(F.lit(False)), F.lit(True)).count() == 0


def test_scan_abandons_far_candidates():
    r = np.random.default_rng(2)
    x = r.normal(size=(64, 2000))
    x /= np.linalg.norm(x, axis=0)
    q = x[:, 0] + 0.01 * r.normal(size=64)
    (kept,) = scan(x, q[None, :], 3)
    assert 0 in kept and len(kept) < 10
    (kept,) = scan(x, q[None, :], 3, np.arange(2000), np.array([0]))
    assert 0 not in kept and len(kept) >= 3
