"""Funnel and lifetime value."""

import datetime as dt
import random
import shutil

import pytest

from larkmetric.config import LTV_COUNTS, LTV_VALUES
from larkmetric.operators import funnel, ltv
from larkmetric.streaming.ltv_stream import compact_ltv, read_ltv, run_ltv_stream

AS_OF = "2024-01-30"
AF = "event string, appsflyer_id string, user_id string, event_date date"
KINDS = ["install", "signup", "af_content_view", "apply_complete_payment_server", "store_complete_checkout", "x"]


def af_rows(seed, first_day=dt.date(2024, 1, 1), n=600):
    rng = random.Random(seed)
    data = [("x", "d0", "u0", first_day)]
    for _ in range(n):
        hot = rng.random() < 0.34
        day = first_day + dt.timedelta(rng.randrange((dt.date(2024, 1, 30) - first_day).days + 1))
        who = 0 if hot else rng.randrange(80)
        data.append((rng.choice(KINDS), f"d{who}", rng.choice([f"u{who}", None]), day))
    return data


def brute(data, start):
    inside = [r for r in data if r[3] >= start]
    out = {}
    for col, suffix, plural in ((1, "", "ids"), (2, "_uid", "uids")):

        def ids(event):
            return {r[col] for r in inside if r[0] == event and r[col] is not None}

        install, signup, view, buy, store = (ids(k) for k in KINDS[:5])
        out[f"total_visit{suffix}"] = len({r[col] for r in inside} - {None})
        out[f"total_install{suffix}"] = out[f"install_{plural}_len"] = len(install)
        out[f"signup_{plural}_len"], out[f"view_{plural}_len"] = len(signup), len(view)
        for name, a, b in (
            ("install_signup", install, signup),
            ("signup_view", signup, view),
            ("view_purchase", view, buy),
            ("view_store_purchase", view, store),
        ):
            out[f"total_{name}{suffix}"] = len(a & b)
            out[f"{name}{suffix}"] = len(a & b) / len(a) * 100 if a else 0
    return out


def test_funnel_against_brute_force(spark):
    data = af_rows(4)
    out = funnel.funnel(spark.createDataFrame(data, AF), AS_OF)
    assert len(out.columns) == 28  # 27 and the period
    starts = {"monthly": dt.date(2024, 1, 1), "weekly": dt.date(2024, 1, 24), "daily": dt.date(2024, 1, 30)}
    got = {r.period: r.asDict() for r in out.collect()}
    assert set(got) == set(starts)
    for period, start in starts.items():
        for name, value in brute(data, start).items():
            assert got[period][name] == pytest.approx(value), (period, name)
        row = got[period]
        assert row["total_install_signup"] <= min(row["total_install"], row["signup_ids_len"])


@pytest.mark.parametrize(
    "first_day,periods",
    [(dt.date(2024, 1, 2), {"weekly", "daily"}), (dt.date(2024, 1, 25), {"daily"}), (dt.date(2024, 1, 1), {"monthly", "weekly", "daily"})],
)
def test_periods_need_old_enough_data(spark, first_day, periods):
    df = spark.createDataFrame(af_rows(1, first_day, 30), AF)
    assert {r.period for r in funnel.funnel(df, AS_OF).collect()} == periods


def test_missing_ids_can_count_as_one(spark):
    df = spark.createDataFrame([("install", "d1", None, dt.date(2024, 1, 1)), ("install", None, None, dt.date(2024, 1, 2))], AF)
    plain = funnel.funnel(df, AS_OF).where("period = 'monthly'").first()
    old = funnel.funnel(df, AS_OF, null_as_value=True).where("period = 'monthly'").first()
    assert (plain.total_visit, plain.total_visit_uid) == (1, 0)
    assert (old.total_visit, old.total_visit_uid, old.install_uids_len) == (2, 1, 1)


def test_flags_equal_intersection(spark, rows):
    df = spark.createDataFrame(af_rows(9), AF)
    members = funnel.step_members(df, "user_id", "install", "signup").count()
    month = funnel.funnel(df, AS_OF).where("period = 'monthly'").first()
    assert members == month.total_install_signup_uid


DAY = "distinct_id string, event string, revenue_from_brand double, revenue_from_challenge double, revenue double"
BRAND, PLAIN, STORE = "brand_challenge_complete_checkout", "challenge_complete_checkout", "store_complete_checkout"


def day_rows(seed, n=200):
    rng = random.Random(seed)
    return [
        (
            rng.choice([f"u{rng.randrange(20)}", f"d-{rng.randrange(6)}", "u0", "u0"]),
            rng.choice([BRAND, PLAIN, STORE, "other"]),
            *[rng.choice([None, rng.randrange(10**6) / 100]) for _ in range(3)],
        )
        for _ in range(n)
    ]


def user_info(spark):
    return spark.createDataFrame([("d-1", "u1"), ("d-2", "u5"), ("d-2", "u2")], "device_id string, distinct_id string")


def test_contributions(spark, rows):
    df = spark.createDataFrame([("a", BRAND, 1.0, None, 9.0), ("b", PLAIN, None, 2.0, 9.0), ("c", STORE, 5.0, 5.0, None), ("d", "x", 1.0, 1.0, 1.0)], DAY)
    c = ltv.challenge_rows(df)
    assert rows(c) == [("a", 1.0, 1.0, 0.0, 0.0, 1, 0), ("b", 0.0, 0.0, 2.0, 1.0, 0, 1)]
    assert rows(ltv.store_rows(df)) == [("c", 0.0)]
    both = c.unionByName(ltv.store_rows(df), allowMissingColumns=True)
    one = ltv.contributions(df)
    assert rows(ltv.sum_per_user(one)) == rows(ltv.sum_per_user(both))


def test_no_checkouts_still_have_a_type(spark):
    out = ltv.accumulate(ltv.empty_state(spark), spark.createDataFrame([], DAY), user_info(spark), AS_OF)
    assert out.count() == 0
    assert dict(out.dtypes) == dict(ltv.empty_state(spark).dtypes)


def test_days_one_by_one_equal_one_batch(spark, rows):
    days = [day_rows(i) for i in range(3)]
    state, info = ltv.empty_state(spark), user_info(spark)
    for i, data in enumerate(days):
        state = ltv.accumulate(state, spark.createDataFrame(data, DAY), info, dt.date(2024, 1, 28 + i))
    batch = ltv.accumulate(ltv.empty_state(spark), spark.createDataFrame(sum(days, []), DAY), info, AS_OF)
    assert rows(state) == rows(batch.select(state.columns))
    ids = {r.distinct_id for r in state.collect()}
    assert "d-1" not in ids and "d-2" not in ids and "d-3" in ids


def test_a_device_meets_its_user_later(spark):
    info = user_info(spark)
    no_info = info.where("false")
    first = ltv.accumulate(ltv.empty_state(spark), spark.createDataFrame([("d-1", STORE, None, None, 5.0)], DAY), no_info, "2024-01-29")
    assert first.first().distinct_id == "d-1"
    second = ltv.accumulate(first, spark.createDataFrame([("u1", STORE, None, None, 2.0)], DAY), info, AS_OF)
    assert [(r.distinct_id, r.store_value) for r in second.collect()] == [("u1", 7.0)]


def test_stream_equals_batch(spark, rows, tmp_path):
    days = [day_rows(i + 10) for i in range(3)]
    base, info = str(tmp_path), user_info(spark)
    for data in days:
        df = spark.createDataFrame(data, DAY)
        df.write.mode("append").parquet(f"{base}/in")
        run_ltv_stream(spark.readStream.schema(df.schema).parquet(f"{base}/in"), f"{base}/out", f"{base}/cp")
    batch = ltv.accumulate(ltv.empty_state(spark), spark.createDataFrame(sum(days, []), DAY), info, AS_OF)
    names = ["distinct_id", *LTV_COUNTS, *LTV_VALUES]
    assert rows(read_ltv(spark, f"{base}/out", info).select(names)) == rows(batch.select(names))


def test_stream_with_nothing_new_changes_nothing(spark, rows, tmp_path):
    base, info = str(tmp_path), user_info(spark)
    df = spark.createDataFrame(day_rows(3), DAY)
    df.write.parquet(f"{base}/in")
    results = []
    for _ in range(2):
        run_ltv_stream(spark.readStream.schema(df.schema).parquet(f"{base}/in"), f"{base}/out", f"{base}/cp")
        results.append(rows(read_ltv(spark, f"{base}/out", info)))
    assert results[0] == results[1]


def test_stream_compaction_changes_nothing(spark, rows, tmp_path):
    schema = "distinct_id string, event string, revenue_from_brand double, revenue_from_challenge double, revenue double"
    arriving, out = str(tmp_path / "in"), str(tmp_path / "out")
    info = spark.createDataFrame([("d-1", "u1")], "device_id string, distinct_id string")

    def take_in(lot):
        spark.createDataFrame(lot, schema).write.mode("append").parquet(arriving)
        run_ltv_stream(spark.readStream.schema(schema).parquet(arriving), out, str(tmp_path / "checkpoint"))

    take_in([("u1", "store_complete_checkout", None, None, 5.0), ("d-1", "store_complete_checkout", None, None, 2.0)])
    take_in([("u2", "store_complete_checkout", None, None, 1.0)])
    before = rows(read_ltv(spark, out, info))
    compact_ltv(spark, out)
    assert rows(read_ltv(spark, out, info)) == before
    take_in([("u1", "store_complete_checkout", None, None, 10.0)])
    got = {r.distinct_id: r.store_value for r in read_ltv(spark, out, info).collect()}
    assert got == {"u1": 17.0, "u2": 1.0}

    compact_ltv(spark, out)
    after = rows(read_ltv(spark, out, info))
    folders = sorted(f.name for f in (tmp_path / "out-base").iterdir())
    compact_ltv(spark, out)
    assert sorted(f.name for f in (tmp_path / "out-base").iterdir()) == folders, "nothing new, nothing written"
    # A base without its note, as a killed run leaves it, does not count.
    spark.createDataFrame([("u9", 0, 0, 1.0, 1.0, 1.0, 1.0, 1.0)], ["distinct_id", *LTV_COUNTS, *LTV_VALUES]).write.parquet(f"{out}-base/upto=99-left")
    assert rows(read_ltv(spark, out, info)) == after
    for batch in (tmp_path / "out").glob("batch=*"):
        shutil.rmtree(batch)
    compact_ltv(spark, out)
    assert rows(read_ltv(spark, out, info)) == after, "covered batches may be deleted, all of them"
    take_in([("u2", "store_complete_checkout", None, None, 4.0)])
    got = {r.distinct_id: r.store_value for r in read_ltv(spark, out, info).collect()}
    assert got == {"u1": 17.0, "u2": 5.0}
