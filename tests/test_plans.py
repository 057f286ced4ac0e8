"""Allocation and plans: exact sums, order independence, published quotas, refusals."""

from fractions import Fraction
from math import floor

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as settings_of
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusledger.plans.allocate import allocate, keep_fraction
from corpusledger.plans.build import build_plans, config_dumps, dump_subset
from corpusledger.plans.config import RunConfig

# Documents per dump of 2017, the published token quotas for 1e11 tokens, and the
# published split of a 100-row sample.
YEAR_2017 = {
    "CC-MAIN-2017-04": (14757515, 8592150085, 8),
    "CC-MAIN-2017-09": (15077917, 8778695183, 9),
    "CC-MAIN-2017-13": (17739008, 10328040941, 10),
    "CC-MAIN-2017-17": (17530228, 10206484630, 10),
    "CC-MAIN-2017-22": (13014405, 7577273073, 8),
    "CC-MAIN-2017-26": (13922284, 8105860212, 8),
    "CC-MAIN-2017-30": (12899419, 7510325693, 8),
    "CC-MAIN-2017-34": (13744675, 8002452342, 8),
    "CC-MAIN-2017-39": (12816491, 7462043186, 7),
    "CC-MAIN-2017-43": (14942282, 8699725500, 9),
    "CC-MAIN-2017-47": (13165488, 7665236922, 7),
    "CC-MAIN-2017-51": (12146075, 7071712233, 8),
}
TARGET = 100_000_000_000


def settings(rule="token_budget"):
    budget = rule == "token_budget"
    return {
        "year": 2017,
        "source": {"configs": {name: row[0] for name, row in YEAR_2017.items()}},
        "target_tokens": TARGET,
        "selection": {
            "rule": rule, "shuffle": budget, "random_seed": 20170101 if budget else None,
        },
        "sample_mode": {"total_rows": 100, "shuffle": True, "random_seed": 20170101},
    }


def split(spark, total, weights):
    rows = spark.createDataFrame(list(weights.items()), "name string, weight bigint")
    parts = allocate(rows, total, key="name", weight="weight", output="part").collect()
    return {row["name"]: row["part"] for row in parts}


def plan_rows(spark, config, mode="full", rows=None):
    plans = build_plans(config_dumps(spark, config), config, mode, rows)
    return {row["source_config"]: row for row in plans.collect()}


def shares_by_hand(total, weights):
    """Every name in order ends at the whole part of what it and all before it are due."""
    ends, due = {}, Fraction(0)
    for name in sorted(weights):
        due += Fraction(total * weights[name], sum(weights.values()))
        ends[name] = floor(due)
    begins = [0, *ends.values()]
    return {name: end - begin for (name, end), begin in zip(ends.items(), begins)}


CASES = [
    ({"solo": 1}, 9), ({"x": 1, "y": 1, "z": 1}, 10), ({"x": 1, "y": 1, "z": 1}, 2),
    ({"big": 10**12, "tiny": 1}, 10**11 + 7), ({"m": 40, "k": 26, "q": 2, "none": 0}, 33),
    ({f"n{i:02d}": i * i + 1 for i in range(30)}, 12_345),
]


@pytest.mark.parametrize("weights, total", CASES)
def test_shares(spark, weights, total):
    assert split(spark, total, weights) == shares_by_hand(total, weights)


@given(
    st.dictionaries(st.text("klmnop", min_size=1, max_size=3), st.integers(1, 10**9), min_size=1, max_size=6),
    st.integers(0, 10**12),
)
@settings_of(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_shares_of_any_weights(spark, weights, total):
    parts = split(spark, total, dict(reversed(weights.items())))
    whole = sum(weights.values())
    # Nobody is a whole unit away from the exact share, and nothing is lost.
    assert sum(parts.values()) == total
    assert all(abs(parts[n] * whole - total * w) < whole for n, w in weights.items())


def test_allocate_refuses_what_has_no_share(spark):
    with pytest.raises(ValueError):
        split(spark, -4, {"x": 2})
    with pytest.raises(PySparkException, match="more than zero"):
        split(spark, 3, {"x": 0, "y": 0})
    with pytest.raises(PySparkException, match="weight must not be negative"):
        split(spark, 3, {"x": -2, "y": 9})


def test_published_quotas(spark):
    plans = plan_rows(spark, RunConfig(settings()))
    assert {name: row["token_quota"] for name, row in plans.items()} == {
        name: row[1] for name, row in YEAR_2017.items()
    }
    assert sum(row["token_quota"] for row in plans.values()) == TARGET
    assert all(row["row_target"] is None and row["shuffle"] for row in plans.values())
    assert {row["seed"] for row in plans.values()} == {20170101}


def test_published_sample_split(spark):
    plans = plan_rows(spark, RunConfig(settings()), "sample")
    assert {name: row["row_target"] for name, row in plans.items()} == {
        name: row[2] for name, row in YEAR_2017.items()
    }
    assert {row["row_target"] for row in plan_rows(spark, RunConfig(settings()), "sample", 7).values()} == {7}


def test_retain_all_targets_every_row(spark):
    config = RunConfig(settings("retain_all"))
    plans = plan_rows(spark, config)
    assert {name: row["row_target"] for name, row in plans.items()} == config.dumps
    assert all(row["token_quota"] is None and not row["shuffle"] for row in plans.values())


def test_rows_per_config_sample(spark):
    changed = settings("retain_all")
    changed["sample_mode"] = {"rows_per_config": 50, "shuffle": False}
    plans = plan_rows(spark, RunConfig(changed), "sample")
    assert {row["row_target"] for row in plans.values()} == {50}
    assert not any(row["shuffle"] for row in plans.values())


@pytest.mark.parametrize(
    "broken, says",
    [
        ({"rule": "best"}, "selection.rule"), ({"random_seed": None}, "random_seed is missing"),
        ({"shuffle": False}, "shuffle must be true"),
    ],
)
def test_settings_that_cannot_be_planned(spark, broken, says):
    changed = settings()
    changed["selection"] |= broken
    with pytest.raises(ValueError, match=says):
        plan_rows(spark, RunConfig(changed))
    # None of this binds a year that keeps everything, but the rule must be known.
    whole = settings("retain_all")
    whole["selection"] |= {key: value for key, value in broken.items() if key != "rule"}
    assert len(plan_rows(spark, RunConfig(whole))) == len(YEAR_2017)


def test_subset_keeps_quotas_and_order(spark):
    config = RunConfig(settings())
    plans = build_plans(config_dumps(spark, config), config, "full")
    names = ["CC-MAIN-2017-51", "CC-MAIN-2017-04"]
    rows = dump_subset(plans, names).orderBy("position").collect()
    assert [row["source_config"] for row in rows] == names
    assert [row["token_quota"] for row in rows] == [YEAR_2017[name][1] for name in names]
    with pytest.raises(ValueError, match="CC-MAIN-1999-01"):
        dump_subset(plans, ["CC-MAIN-1999-01"])


def test_keep_fraction_published(spark):
    # Projected tokens and rows of three years, and what 1e11 tokens keeps of them.
    published = [
        (2017, 168148323869.73367, 171755787, 0.5947130348885968, 102145405.3464494),
        (2018, 153211036805.40695, 162307975, 0.652694493067166, 105937521.46338324),
        (2019, 151496810271.17236, 152599285, 0.6600799041313449, 100727721.41331178),
        (2013, 22636440020.134262, 21800204, 1.0, 21800204.0),
    ]
    years = spark.createDataFrame(
        [row[:3] for row in published], "year int, projected double, rows bigint"
    )
    kept = keep_fraction(years, TARGET, projected="projected", rows="rows").orderBy(F.desc("year"))
    expected = {row[0]: row[3:] for row in published}
    for row in kept.collect():
        assert row["keep_fraction"] == pytest.approx(expected[row["year"]][0], rel=1e-12)
        assert row["rows_to_keep"] == pytest.approx(expected[row["year"]][1], rel=1e-12)
