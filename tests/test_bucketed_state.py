"""The running state in buckets by user against the state worked out whole."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larkmetric.config import EventNames
from larkmetric.operators import ltv
from larkmetric.sources import scans, sinks

NAMES = EventNames()
SCHEMA = "event string, distinct_id string, revenue double, revenue_from_brand double, revenue_from_challenge double"
DEVICE = "12345678-1234-1234-1234-12345678901{}"


def day_of(n):
    rng = random.Random(n)
    ids = [f"u{k}" for k in range(20)] + [DEVICE.format(k) for k in range(6)] + [None, "", "="]
    kinds = [NAMES.brand, NAMES.challenge, NAMES.store, "view"]
    amounts = [0.1, 0.2, 1e15, 1e-9, None, float("nan"), -3.3]
    return [(rng.choice(kinds), rng.choice(ids), *rng.choices(amounts, k=3)) for _ in range(80)]


def owners_of(n):
    """More devices get an owner as days pass; some have several, or one that is missing."""
    rows = [(DEVICE.format(k), f"u{k}") for k in range(min(n, 5))] + [(DEVICE.format(0), "u00"), (DEVICE.format(5), None), ("plain", "u9")]
    return rows


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """The path, and for three days the date, the plan, the state as kept and as worked out whole."""
    path, start, out = str(tmp_path_factory.mktemp("state") / "ltv"), dt.date(2024, 1, 27), []
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "7"}
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    whole = ltv.empty_state(spark)
    kept = ltv.keyed_state(whole)
    for n in range(3):
        date = start + dt.timedelta(n)
        events = spark.createDataFrame(day_of(n), SCHEMA)
        info = spark.createDataFrame(owners_of(2 * n), "device_id string, distinct_id string")
        whole = spark.createDataFrame(ltv.accumulate(whole, events, info, date).collect(), ltv.STATE_SCHEMA)
        new = ltv.advance(kept, events, info, date)
        sinks.save_bucketed_day(new, path, date, ltv.STATE_KEY, 4)
        kept = scans.read_state(spark, path, date)
        out.append((date, new._jdf.queryExecution().executedPlan().toString(), kept, whole))
    for k, v in saved.items():
        spark.conf.set(k, v)
    return path, out


def test_same_states_on_each_day(rows, chain):
    columns = [f.split()[0] for f in ltv.STATE_SCHEMA.split(", ")]
    for _, _, kept, whole in chain[1]:
        assert rows(kept, *columns) == rows(whole, *columns) != []
        assert kept.count() == kept.select(ltv.STATE_KEY).distinct().count()


def test_the_state_is_not_shuffled(chain):
    for date, plan, _, _ in chain[1][1:]:
        assert "Bucketed: true" in plan
        assert f"hashpartitioning({ltv.STATE_KEY}#" not in plan and "hashpartitioning(_to#" in plan
        assert len(list(Path(chain[0]).glob(f"data/*/date={date}/*.parquet"))) == 4, "one file a bucket"


def test_a_state_read_as_a_plain_table(spark, rows, chain):
    for date, _, kept, _ in chain[1]:
        plain = scans.read_period(spark, chain[0], date, date)
        assert rows(plain, "distinct_id", "store_value", "date") == rows(kept, "distinct_id", "store_value", "date")


def test_failed_days_leave_the_state(spark, rows, tmp_path):
    path = str(tmp_path / "ltv")
    state = ltv.keyed_state(spark.createDataFrame([("u1", 1, 2, 1.0, 2.0, 3.0, 4.0, 5.0, dt.date(2024, 1, 1))], ltv.STATE_SCHEMA))
    sinks.save_bucketed_day(state, path, "2024-01-01", ltv.STATE_KEY, 4)
    bad = state.withColumn("store_value", F.raise_error(F.lit("half-way")).cast("double"))
    with pytest.raises(Exception, match="half-way"):
        sinks.save_bucketed_day(bad, path, "2024-01-01", ltv.STATE_KEY, 4)
    assert rows(scans.read_state(spark, path, "2024-01-01"), "distinct_id", "store_value") == [("u1", 5.0)]
    with pytest.raises(LookupError):
        scans.read_state(spark, path, "2024-01-02")
