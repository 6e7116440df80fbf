from conftest import at
from pyspark.sql import functions as F

from upkeep.functions import expressions as ex


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_times_parse_unpadded_numbers_and_never_raise(spark):
    rows = spark.createDataFrame([("5/1/2025 9:05",), ("05/01/2025 09:05",), ("",), ("n/a",), (None,)], "t string")
    got = [r[0] for r in rows.select(ex.parse_time("t", ex.ORDER_TIME_FORMAT)).collect()]
    assert got == [at("2025-01-05 09:05"), at("2025-01-05 09:05"), None, None, None]
    mixed = spark.createDataFrame([("2025-01-05",), ("2025-01-05 09:05:01",), ("1/5/2025 9:05",), ("x",)], "t string")
    got = [r[0] for r in mixed.select(ex.parse_mixed_time("t")).collect()]
    assert got == [at("2025-01-05"), at("2025-01-05 09:05:01"), at("2025-01-05 09:05"), None]


def test_mixed_times_know_days_first_and_month_names(spark):
    known = {
        "25/12/2025 10:00": "2025-12-25 10:00",
        "25/12/2025": "2025-12-25",
        "12/5/2025": "2025-12-05",  # month first wherever that is a date
        "25 Dec 2025": "2025-12-25",
        "25 December 2025 08:09:10": "2025-12-25 08:09:10",
        "Dec 25, 2025": "2025-12-25",
        "31/31/2025": None,
    }
    rows = spark.createDataFrame([(t,) for t in known], "t string").select("t", ex.parse_mixed_time("t").alias("v"))
    assert {r.t: r.v for r in rows.collect()} == {t: at(v) for t, v in known.items()}


def test_whole_days_are_completed_24_hour_periods(spark):
    rows = spark.createDataFrame([(at("2025-01-01 23:00"), at("2025-02-18 22:00"))], "a timestamp, b timestamp")
    assert rows.select(ex.whole_days_between("a", "b"), F.datediff("b", "a")).first()[:] == (47, 48)


def test_ratios_survive_zero(spark):
    got = one(
        spark,
        safe=ex.safe_ratio(F.lit(1.0), F.lit(0.0)),
        guarded=ex.guarded_ratio(F.lit(1.0), F.lit(0.0)),
        negative=ex.guarded_ratio(F.lit(1.0), F.lit(-2.0)),
        plain=ex.guarded_ratio(F.lit(1.0), F.lit(2.0)),
    )
    assert got == {"safe": None, "guarded": 0.0, "negative": 0.0, "plain": 0.5}


def test_flags_bands_and_labels(spark):
    flags = spark.createDataFrame([("Oui",), ("non",), ("peut-etre",), (None,)], "f string")
    assert [r[0] for r in flags.select(ex.parse_flag("f")).collect()] == [True, False, None, None]
    bands = spark.createDataFrame([(0.51,), (0.5,), (0.3,), (None,)], "p double")
    assert [r[0] for r in bands.select(ex.risk_band("p")).collect()] == ["high", "medium", "low", None]
    saturday = spark.createDataFrame([(at("2025-01-04"),)], "t timestamp").select(F.weekday("t").alias("d"))
    assert saturday.select("d", ex.weekday_label("d")).first()[:] == (5, "Sam")
    assert ex.flag_name("anomaly", "Brèche à la clôture ") == "anomaly_brèche_à_la_clôture_"
    assert len(ex.flag_name("anomaly", "x" * 80)) == 50


def test_finite_drops_nan_and_infinities(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,), (None,)], "v double")
    assert [r[0] for r in rows.select(ex.finite("v")).collect()] == [None, None, None, 1.5, None]
    assert one(spark, a=ex.clamp_unit(F.lit(1.7)), b=ex.clamp_unit(F.lit(-1.0))) == {"a": 1.0, "b": 0.0}
