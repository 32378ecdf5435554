"""The booster against plain NumPy, and what its models promise."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import boosting


def rows_of(n=900, queries=40, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 2)
    x[rng.random((n, 3)) < 0.05] = np.nan
    qid = rng.integers(0, queries, n)
    wish = np.nan_to_num(x[:, 0]) * 2 - np.abs(np.nan_to_num(x[:, 1])) + rng.normal(size=n) * 0.3
    label = (wish > 1).astype(float)
    label[qid == 1] = 0.0
    return qid, x, label


@pytest.fixture(scope="module")
def frame(spark):
    qid, x, label = rows_of()
    data = [(int(q), i, *[None if np.isnan(v) else float(v) for v in r], float(y)) for i, (q, r, y) in enumerate(zip(qid, x, label, strict=True))]
    return spark.createDataFrame(data, "qid long, item_idx long, a double, b double, c double, label double").repartition(5)


def gradients(margin, label, qid):
    g, h, loss = np.zeros_like(margin), np.zeros_like(margin), 0.0
    for q in np.unique(qid):
        own = qid == q
        p = np.exp(margin[own] - margin[own].max())
        p /= p.sum()
        t = label[own].sum()
        g[own], h[own] = label[own] - t * p, t * p * (1 - p)
        loss -= (label[own] * np.log(p)).sum()
    return g, h, loss


def plain_fit(qid, x, label, borders, trees, depth, step, ridge):
    """The same booster, row by row in one process."""
    margin, losses, out = np.zeros(len(x)), [], []
    for _ in range(trees):
        g, h, loss = gradients(margin, label, qid)
        losses.append(loss)
        leaf, splits = np.zeros(len(x), int), []
        for _ in range(depth):
            best = None
            for f, own in enumerate(borders):
                for b in own:
                    over = x[:, f] > b
                    gain = 0.0
                    for at in np.unique(leaf):
                        for side in (over, ~over):
                            m = (leaf == at) & side
                            gain += g[m].sum() ** 2 / (h[m].sum() + ridge)
                    if best is None or gain > best[0] + 1e-7:
                        best = (gain, f, b)
            splits.append(best[1:])
            leaf = 2 * leaf + (x[:, best[1]] > best[2])
        values = [step * g[leaf == k].sum() / (h[leaf == k].sum() + ridge) for k in range(1 << depth)]
        margin += np.array(values)[leaf]
        out.append((splits, values))
    losses.append(gradients(margin, label, qid)[2])
    return out, losses, margin


def test_listwise_model_is_that_of_a_plain_version(spark, frame):
    qid, x, label = rows_of()
    model = boosting.fit(frame, ["a", "b", "c"], trees=10, depth=3, step=0.3, borders=8, ridge=1.0)
    want, losses, margin = plain_fit(qid, x, label, boosting.borders_of(frame, ["a", "b", "c"], 8), 10, 3, 0.3, 1.0)
    assert [t for t, _ in want] == model.splits
    assert np.allclose([v for _, v in want], model.leaves) and np.allclose(losses, model.losses)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:], strict=False))
    got = boosting.score(model, frame).toPandas().set_index("item_idx").score.sort_index()
    assert np.allclose(got, margin)
    expression = frame.select("item_idx", boosting.margin(frame, model).alias("m")).toPandas().set_index("item_idx").m.sort_index()
    assert np.allclose(expression, margin)


def test_queries_in_parts_change_nothing(frame):
    whole = boosting.fit(frame, ["a", "b", "c"], trees=2, depth=2, borders=8)
    assert boosting.packs(frame, ["a"], [[0.0]], 20)[1]
    parts = boosting.fit(frame, ["a", "b", "c"], trees=2, depth=2, borders=8, most_rows=20)
    assert parts.splits == whole.splits and np.allclose(parts.leaves, whole.leaves) and np.allclose(parts.losses, whole.losses)


def test_gradients_of_a_table(spark, frame):
    qid, x, label = rows_of()
    margin = np.nan_to_num(x[:, 0])
    g, h, loss = gradients(margin, label, qid)
    out = boosting.softmax_gradients(frame.withColumn("margin", F.coalesce("a", F.lit(0.0)))).toPandas().sort_values("item_idx")
    assert np.allclose(out.gradient, g) and np.allclose(out.curvature, h) and out.groupby("qid").loss.first().sum() == pytest.approx(loss)


def test_log_loss_falls_and_ranks(frame):
    model = boosting.fit(frame, ["a", "b", "c"], objective="logloss", trees=8, depth=3, step=0.3)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:], strict=False)) and model.losses[0] == pytest.approx(900 * np.log(2), rel=1e-6)
    out = boosting.score(model, frame).toPandas()
    assert out[out.label == 1].score.mean() > out[out.label == 0].score.mean() + 0.5


def test_a_thousand_trees_are_one_plan_and_shrunk_models_last(spark, frame, tmp_path):
    rng = np.random.default_rng(1)
    many = boosting.Trees(["a", "b", "c"], [[(int(rng.integers(3)), float(rng.normal())) for _ in range(4)] for _ in range(1000)], rng.normal(size=(1000, 16)).tolist())
    plans = [boosting.score(m, frame)._jdf.queryExecution().executedPlan().toString() for m in (many, many.shrunk(10))]
    assert len(plans[0]) == pytest.approx(len(plans[1]), abs=200)
    staged = boosting.score(many, frame, "m", [0, 10, 999, 1000]).toPandas().sort_values("item_idx")
    cut = boosting.score(many.shrunk(999), frame).toPandas().sort_values("item_idx")
    assert np.allclose([m[2] for m in staged.m], cut.score) and all(m[0] == 0 for m in staged.m)
    model = boosting.fit(frame, ["a", "b", "c"], trees=6, depth=2, step=0.5)
    truth = frame.where("label = 1").select("qid", "item_idx")
    back, tried = boosting.keep_best(model, frame, truth, str(tmp_path / "m"), every=2, k=3)
    top = max(tried.values())
    assert sorted(tried) == [2, 4, 6] and len(back.splits) == min(n for n, r in tried.items() if r == pytest.approx(top))
    per = {}
    scored = boosting.score(model.shrunk(4), frame).toPandas()
    for q, own in scored.groupby("qid"):
        relevant = set(own[own.label == 1].item_idx)
        best = own.sort_values(["score", "item_idx"], ascending=[False, True]).item_idx.head(3)
        if relevant:
            per[q] = len(relevant & set(best)) / len(relevant)
    assert tried[4] == pytest.approx(np.mean(list(per.values())))
    with pytest.raises(ValueError):
        boosting.load(spark, str(tmp_path / "m"), ["a", "b"])


def test_odd_tables(spark, frame):
    none = boosting.fit(frame.where("false"), ["a"], trees=3)
    assert none.splits == [] and boosting.score(none, frame).select("score").distinct().collect()[0][0] == 0.0
    flat = frame.withColumn("a", F.lit(None).cast("double"))
    assert boosting.fit(flat, ["a"], trees=2).splits == []
    odd = frame.withColumns({"qid": F.when(F.col("qid") > 5, F.col("qid")), "label": F.when(F.col("item_idx") % 7 > 0, F.col("label"))})
    model = boosting.fit(odd, ["a", "b"], trees=2, depth=2)
    assert len(model.splits) == 2 and model.losses[-1] < model.losses[0]
    for wrong in (dict(objective="other"), dict(borders=300), dict(depth=0), dict(splits=("audit",))):
        with pytest.raises(ValueError):
            boosting.fit(frame, ["a"], **wrong)
    with pytest.raises(ValueError):
        boosting.score(model, frame.drop("b"))
