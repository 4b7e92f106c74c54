"""The skew-safe helpers against plain computations, with one key holding a third of the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mailsieve import scale


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 6000
    key = np.where(rng.random(n) < 0.35, "hot", rng.choice(["a", "b", "c", None], n))
    value = np.round(rng.lognormal(2, 2, n) * rng.choice([-1, 1, 0], n), 2)
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 86400 * 3, n), unit="s")
    return pd.DataFrame({"id": range(n), "key": key, "value": value, "ts": ts})


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame)


def groups(frame):
    return frame.groupby(frame["key"].fillna("<null>"))


def test_exact_quantiles_and_halves(df, frame):
    got = scale.exact_quantiles(df, ["key"], "value", {"q0": 0.0, "q1": 0.37, "q2": 0.95, "q3": 1.0}, halves=True).collect()
    assert len(got) == 5
    for r in got:
        v = np.sort(groups(frame).get_group(r["key"] or "<null>")["value"].to_numpy())
        assert np.allclose([r["q0"], r["q1"], r["q2"], r["q3"]], np.quantile(v, [0, 0.37, 0.95, 1]))
        half = len(v) // 2
        assert np.allclose([r["lower_mean"], r["upper_mean"]], [v[:half].mean(), v[half:].mean()])


def test_exact_quantiles_of_one_value(spark):
    d = spark.createDataFrame([("k", 5.0)], "key string, value double")
    r = scale.exact_quantiles(d, ["key"], "value", {"m": 0.5}, halves=True).first()
    assert (r["m"], r["lower_mean"], r["upper_mean"]) == (5.0, 5.0, 5.0)


def test_cumulative_sum(df, frame):
    out = scale.cumulative_sum(df, ["key"], scale.time_bucket(F.col("ts")), ["ts", "id"], F.col("value"), "run").toPandas()
    want = frame.sort_values(["ts", "id"])
    want["run"] = want.groupby(want["key"].fillna("<null>"))["value"].cumsum()
    both = out.set_index("id")["run"].sort_index(), want.set_index("id")["run"].sort_index()
    assert len(out) == len(frame) and np.allclose(both[0], both[1])


def test_number_rows_over_the_whole_table(df, frame):
    out = scale.number_rows(df, [], scale.range_bucket(F.col("id"), 100), ["id"], "n").toPandas()
    assert (out["n"] == out["id"] + 1).all() and len(out) == len(frame)


def test_previous_row(df, frame):
    out = scale.previous_row(df, ["key"], scale.time_bucket(F.col("ts")), ["ts", "id"], {"prev": "id"}).toPandas()
    want = frame.sort_values(["ts", "id"])
    want["prev"] = want.groupby(want["key"].fillna("<null>"))["id"].shift()
    merged = out.set_index("id")["prev"].sort_index().fillna(-1), want.set_index("id")["prev"].sort_index().fillna(-1)
    assert (merged[0] == merged[1]).all()


def test_top_per_key_limits_before_the_shuffle(df):
    top = scale.top_per_key(df, ["key"], [F.desc("value"), F.col("id")], 5)
    assert top.groupBy("key").count().where("count <> 5").count() == 0
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()


def test_ordered_fold_streams_each_key_once(df, frame):
    def start():
        seen = [0]

        def step(part):
            seen[0] += len(part)
            return part[["key"]].iloc[:1].assign(n=seen[0])

        return step

    d = df.where("key IS NOT NULL").select("key", "id")
    out = scale.ordered_fold(d, ["key"], ["id"], start, "key string, n bigint").groupBy("key").agg(F.max("n").alias("n"))
    got = {r["key"]: r["n"] for r in out.collect()}
    assert got == frame.groupby("key").size().to_dict()


def test_with_totals_keeps_null_keys(df, frame):
    out = scale.with_totals(df, ["key"], n=F.count("*"))
    assert out.count() == len(frame) and out.where("key IS NULL").first()["n"] == frame["key"].isna().sum()
