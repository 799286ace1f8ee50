"""A hot key holding most rows: results stay exact and the plans combine
map-side before every exchange on the group key."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from geoscribe.operators import groups, ranking, words
from geoscribe.sources import table

HOT = 7


@pytest.fixture(scope="module")
def skewed(spark):
    ev = table(spark, SF_SMALL, "events").select("event_id", "user_id", "value", "event_type")
    hot = ev.withColumn("user_id", F.lit(HOT).cast("bigint"))
    # The original rows plus two copies re-keyed to one user: that user holds > 2/3.
    return ev.unionByName(hot).unionByName(hot.withColumn("event_id", -F.col("event_id")))


def test_hot_key_share(skewed):
    n = skewed.count()
    hot = skewed.where(F.col("user_id") == HOT).count()
    assert hot * 3 > n


def test_counts_and_centroids_exact_under_skew(skewed):
    pdf = skewed.toPandas()
    want_n = pdf.groupby("user_id").size()
    got_n = {r.user_id: r.n for r in groups.count_by_key(skewed, "user_id").collect()}
    assert got_n == want_n.to_dict()

    kept = want_n[want_n > 60].index
    want_c = pdf[pdf.user_id.isin(kept)].groupby("user_id")["value"].mean()
    got_c = {r.user_id: r.lat for r in groups.centroid_by_join(skewed, "user_id", "value", "value", 60).collect()}
    assert set(got_c) == set(want_c.index)
    for k, v in want_c.items():
        assert abs(got_c[k] - v) <= 1e-9 * max(1.0, abs(v))


def test_peak_of_hot_key(skewed):
    pdf = skewed.toPandas()
    pdf["h"] = pdf.event_id.abs() % 24
    c = pdf.groupby(["user_id", "h"]).size().reset_index(name="n")
    want = c.sort_values(["user_id", "n", "h"], ascending=[True, False, True]).groupby("user_id").head(1)
    got = groups.peak_hour(skewed, "user_id", F.abs("event_id") % 24, "h")
    got_pdf = got.toPandas().sort_values("user_id").reset_index(drop=True)
    want = want.sort_values("user_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got_pdf[["user_id", "h", "n"]], want[["user_id", "h", "n"]], check_dtype=False)


def _partial_before_every_key_exchange(plan: str) -> bool:
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and "REPARTITION" not in line:
            # The operator feeding the exchange; a local Sort may sit between
            # a partial window limit and it.
            below = [ln for ln in lines[i + 1:i + 3] if "Sort [" not in ln][:1]
            if not below or ("partial_" not in below[0] and "Partial" not in below[0]):
                return False
    return True


def test_plans_combine_before_shuffling(spark, skewed):
    plans = [
        groups.count_by_key(skewed, "user_id"),
        groups.peak_hour(skewed, "user_id", F.abs("event_id") % 24),
        groups.group_centroid(skewed, "user_id", "value", "value", 61),
        words.word_counts(words.token_table(skewed.withColumn("t", F.col("event_type")), "t", keep=["user_id"]),
                          ["user_id"]),
        ranking.top_n_per_group(groups.count_by_key(skewed, ["user_id", "event_type"]), "user_id", "event_type", 2),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" in plan, plan
        assert _partial_before_every_key_exchange(plan), plan
