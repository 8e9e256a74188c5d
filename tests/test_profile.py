import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import profile


def box(values):
    """Box-plot figures by the usual rules, on the driver."""
    x = np.array(values, dtype=float)
    q1, median, q3 = np.percentile(x, [25, 50, 75])
    reach = 1.5 * (q3 - q1)
    inside = x[(x >= q1 - reach) & (x <= q3 + reach)]
    low = min(inside.min(), q1) if len(inside) else q1
    high = max(inside.max(), q3) if len(inside) else q3
    return q1, median, q3, low, high, len(x), int(((x < low) | (x > high)).sum()), x.min(), x.max(), x.mean()


@pytest.fixture(scope="module")
def counted():
    rng = np.random.default_rng(5)
    groups = {
        "hot": rng.integers(0, 300, 2000).tolist(),
        "tail": [1, 1, 2, 2, 3, 3, 500, 700],
        "one": [4],
        "gap": [0, 0, 0, 100],
        None: [0, 7, 9],
    }
    return groups


@pytest.fixture(scope="module")
def frame(spark, counted):
    rows = [(c, ["w " * n] if n else None) for c, ns in counted.items() for n in ns]
    return spark.createDataFrame(rows, "cat string, text array<string>").repartition(5)


def test_box_stats(frame, counted):
    got = {r.cat: r for r in profile.box_stats(frame, "cat", "text").collect()}
    assert set(got) == set(counted)
    for cat, values in counted.items():
        row = got[cat]
        found = [row[n] for n in ("q1", "median", "q3", "whisker_low", "whisker_high", "n_rows", "n_outliers", "min_words", "max_words", "mean_words")]
        assert found == pytest.approx(box(values)), cat


def test_words_per_category_keeps_every_row(frame, counted):
    rows = profile.words_per_category(frame, "cat", "text").collect()
    unrolled = {}
    for r in rows:
        unrolled.setdefault(r.cat, []).extend([r.num_words] * r.n_rows)
    assert {c: sorted(v) for c, v in unrolled.items()} == {c: sorted(v) for c, v in counted.items()}


def test_counts_and_means(frame, counted):
    counts = profile.category_counts(frame, "cat").collect()
    assert [r.cat for r in counts] == [None, "gap", "hot", "one", "tail"]
    assert {r.cat: r["count"] for r in counts} == {c: len(v) for c, v in counted.items()}
    means = {r.cat: r.average_num_words for r in profile.avg_words(frame, "cat", "text").collect()}
    assert means == pytest.approx({c: np.mean(v) for c, v in counted.items()})


def test_summary_counts_null_as_a_category(frame, counted):
    row = profile.summary(frame, "cat").first()
    assert row.total_rows == sum(map(len, counted.values()))
    assert row.distinct_categories == 5
    none = profile.summary(frame.filter(F.lit(False)), "cat").first()
    assert (none.total_rows, none.distinct_categories) == (0, 0)
