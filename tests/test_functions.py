import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from fleetdw.functions.dates import calendar, calendar_days, date_key, sentinel_row, whole_days
from fleetdw.functions.numeric import avg_round, pct2


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_whole_days_vs_calendar_days(spark):
    df = spark.createDataFrame(
        [(ts("2026-01-01 12:00:00"), ts("2026-01-03 10:00:00")),
         (ts("2026-01-03 12:00:00"), ts("2026-01-01 11:00:00")),
         (ts("2026-01-01 09:00:00"), ts("2026-01-01 18:00:00")),
         (ts("2026-01-01 09:00:00"), None)],
        "a timestamp_ntz, b timestamp_ntz")
    out = df.select(whole_days(F.col("b"), F.col("a")).alias("w"),
                    calendar_days(F.col("b").cast("date"), F.col("a").cast("date")).alias("c")).collect()
    assert [(r.w, r.c) for r in out] == [(1, 2), (-2, -2), (0, 0), (None, None)]


def test_date_key(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 3),), (None,)], "d date")
    assert [r[0] for r in df.select(date_key(F.col("d"))).collect()] == [20260103, None]


def test_calendar_year_edge_and_sentinel(spark):
    bounds = spark.createDataFrame([(dt.date(2026, 12, 31), dt.date(2027, 1, 1))], "dt_ini date, dt_fim date")
    rows = calendar(bounds).orderBy("sk_tempo").collect()
    assert [r.sk_tempo for r in rows] == [20261231, 20270101]
    assert [r.semana_ano for r in rows] == [53, 53]
    assert [r.nome_dia for r in rows] == ["Quinta-Feira", "Sexta-Feira"]
    assert [r.dia_semana for r in rows] == [4, 5]
    assert [r.semestre for r in rows] == [2, 1]
    s = sentinel_row(spark).collect()[0]
    assert (s.sk_tempo, s.dt_ref, s.nome_dia, s.semana_ano, s.nome_mes) == (
        99991231, dt.date(9999, 12, 31), "Sexta-Feira", 52, "Dezembro")


def test_calendar_empty_input_gives_no_days(spark):
    bounds = spark.createDataFrame([(None, None)], "dt_ini date, dt_fim date")
    assert calendar(bounds.where(F.col("dt_ini").isNotNull())).count() == 0


def test_exact_rounding(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(pct2(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("33.33"), Decimal("66.67"), Decimal("12.50"), Decimal("0.00"), None]
    # ROUND(AVG) half away from zero on exact decimals: 61.725 -> 61.73
    avg = spark.createDataFrame([(12345, 2)], "s long, c long").select(
        avg_round(F.col("s"), F.col("c"), 2, in_scale=2)).collect()[0][0]
    assert avg == Decimal("61.73")


def test_scale_conf_sizes_partitions_from_input():
    from fleetdw.session import scale_conf

    assert scale_conf(100 * 2**40, 8000)["spark.sql.shuffle.partitions"] == "20000"  # bounded
    assert scale_conf(2**40, 8)["spark.sql.shuffle.partitions"] == "4096"
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"  # floor: two per core
    assert scale_conf(1 << 30, 1, target_partition_bytes=128 << 20)["spark.sql.files.maxPartitionBytes"] == str(128 << 20)


def test_calendar_of_a_long_span(spark):
    """An outlier date costs its rows, nothing else."""
    bounds = spark.createDataFrame([(dt.date(1800, 3, 1), dt.date(2100, 1, 2))], "dt_ini date, dt_fim date")
    got = calendar(bounds).agg(F.count("*"), F.countDistinct("dt_ref"), F.min("dt_ref"), F.max("dt_ref")).first()
    days = (dt.date(2100, 1, 2) - dt.date(1800, 3, 1)).days + 1
    assert tuple(got) == (days, days, dt.date(1800, 3, 1), dt.date(2100, 1, 2))
    one = spark.createDataFrame([(dt.date(2024, 5, 5), dt.date(2024, 5, 5))], "dt_ini date, dt_fim date")
    assert [r.sk_tempo for r in calendar(one).collect()] == [20240505]


def test_rounding_below_zero(spark):
    """ROUND goes half away from zero on both sides of it."""
    df = spark.createDataFrame([(-26, 1), (-175, 1), (-25, 1), (25, 1), (-24, 1), (-1, 3)], "s long, c long")
    got = [r[0] for r in df.select(avg_round(F.col("s"), F.col("c"), 1, in_scale=2)).collect()]
    assert got == [Decimal(x) for x in ("-0.3", "-1.8", "-0.3", "0.3", "-0.2", "0.0")]
    pct = [r[0] for r in df.select(pct2(F.col("s"), F.col("c") * 800)).collect()]
    assert pct[0] == Decimal("-3.25") and pct[5] == Decimal("-0.04")
