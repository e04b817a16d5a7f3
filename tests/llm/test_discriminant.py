"""The discriminant against plain arithmetic, and on labels that leave it little."""

import math

import numpy as np
import pytest
from helpers import awkward_rows, table, text_of

from llm.quality_model import LEAST_VARIANCE, POOLED, SPHERE, discriminant, score_documents


def moments(x, y):
    counts = np.array([(y == k).sum() for k in (0, 1)], float)
    sums = np.stack([x[y == k].sum(axis=0) for k in (0, 1)])
    return counts, sums, np.stack([x[y == k].T @ x[y == k] for k in (0, 1)])


def inverse_and_determinant(a):
    """Gauss-Jordan on plain lists."""
    n, determinant = len(a), 1.0
    a = [[*map(float, row), *(float(i == j) for j in range(n))] for i, row in enumerate(a)]
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(a[r][i]))
        if pivot != i:
            a[i], a[pivot], determinant = a[pivot], a[i], -determinant
        determinant *= a[i][i]
        a[i] = [v / a[i][i] for v in a[i]]
        for r in range(n):
            if r != i:
                a[r] = [v - a[r][i] * w for v, w in zip(a[r], a[i])]
    return [row[n:] for row in a], determinant


def plain_scores(x, y, points):
    n, d = len(x), len(x[0])
    center = [sum(r[j] for r in x) / n for j in range(d)]
    scale = [math.sqrt(max(sum((r[j] - center[j]) ** 2 for r in x) / n, 1e-6)) for j in range(d)]
    z = [[(r[j] - center[j]) / scale[j] for j in range(d)] for r in x]
    parts = [[r for r, k in zip(z, y) if k == c] for c in (0, 1)]
    means = [[sum(r[j] for r in p) / len(p) for j in range(d)] for p in parts]
    own = [[[sum((r[i] - m[i]) * (r[j] - m[j]) for r in p) / len(p) for j in range(d)] for i in range(d)] for p, m in zip(parts, means)]
    pooled = [[sum(len(p) * c[i][j] for p, c in zip(parts, own)) / n for j in range(d)] for i in range(d)]
    sphere = max(sum(pooled[i][i] for i in range(d)) / d, LEAST_VARIANCE)
    out = []
    for point in points:
        p, density = [(point[j] - center[j]) / scale[j] for j in range(d)], []
        for part, mean, c in zip(parts, means, own):
            mixed = [[(1 - POOLED - SPHERE) * c[i][j] + POOLED * pooled[i][j] + SPHERE * sphere * (i == j) for j in range(d)] for i in range(d)]
            inverse, determinant = inverse_and_determinant(mixed)
            far = [a - b for a, b in zip(p, mean)]
            distance = sum(far[i] * inverse[i][j] * far[j] for i in range(d) for j in range(d))
            density.append(math.log(len(part) / n) - math.log(determinant) / 2 - distance / 2)
        out.append(1 / (1 + math.exp(max(-700, min(700, density[0] - density[1])))))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scores_are_those_of_plain_arithmetic(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, 4)) @ rng.normal(size=(4, 4))
    y = (x[:, 0] + rng.normal(size=60) > 0).astype(int)
    x[:, 3] = x[:, 2] if seed == 3 else x[:, 3]  # a singular covariance
    model = discriminant(*moments(x, y))
    assert np.allclose(model.scores(x[:20]), plain_scores(x.tolist(), y.tolist(), x[:20].tolist()), atol=1e-7)


def test_one_row_a_class_and_constant_features():
    x, y = np.array([[1.0, 5.0], [2.0, 5.0]]), np.array([0, 1])
    scores = discriminant(*moments(x, y)).scores(x)
    assert scores[0] < 0.5 < scores[1]
    alike = np.ones((6, 3))
    assert np.allclose(discriminant(*moments(alike, np.array([0, 1] * 3))).scores(alike), 0.5)


def test_labels_all_alike_give_scores(spark):
    rows = awkward_rows() + [(1000 + i, text_of(1, 50), "en", "a", 1) for i in range(40)]
    labels = spark.createDataFrame([(1000 + i, i % 2) for i in range(40)] + [(None, 1), (8, 5)], "doc_id long, quality int")
    out = score_documents(table(spark, rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
