"""Date and duration expressions.

Two duration notions coexist and must not be mixed:

* ``whole_days(end, start)``: number of complete 24-hour periods between two
  timestamps, truncated toward zero (lead time, rental days).
* ``calendar_days(end, start)``: difference of calendar dates (report horizons).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetdw.schemas import SENTINEL_DATE, SENTINEL_KEY

# Portuguese day names, ISO day of week 1 (Monday) .. 7 (Sunday).
DAY_NAMES = ["Segunda-Feira", "Terça-Feira", "Quarta-Feira", "Quinta-Feira",
             "Sexta-Feira", "Sábado", "Domingo"]
# Portuguese month names, January .. December.
MONTH_NAMES = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho",
               "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]



def whole_days(end: Column, start: Column) -> Column:
    """Complete 24h periods in ``end - start`` (NULL if either is NULL)."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def calendar_days(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def date_key(c: Column) -> Column:
    """Smart key yyyymmdd as INT, computed arithmetically (no string formatting)."""
    d = c.cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_to_date(c: Column) -> Column:
    return F.make_date((c / 10000).cast("int"), ((c / 100) % 100).cast("int"), (c % 100).cast("int"))


def iso_dow(d: Column) -> Column:
    return (F.weekday(d) + 1).cast("short")


def day_name(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.weekday(d) + 1)


def month_name(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(d))


CALENDAR_COLUMNS = ["sk_tempo", "dt_ref", "dia", "mes", "trimestre", "semestre", "ano",
                    "dia_semana", "nome_dia", "nome_mes", "semana_ano", "is_feriado"]


def calendar_attributes(d: Column) -> list[Column]:
    """The 12 dim_tempo columns derived from one DATE column."""
    return [
        date_key(d).alias("sk_tempo"),
        d.alias("dt_ref"),
        F.dayofmonth(d).cast("short").alias("dia"),
        F.month(d).cast("short").alias("mes"),
        F.quarter(d).cast("short").alias("trimestre"),
        F.when(F.month(d) <= 6, 1).otherwise(2).cast("short").alias("semestre"),
        F.year(d).cast("short").alias("ano"),
        iso_dow(d).alias("dia_semana"),
        day_name(d).alias("nome_dia"),
        month_name(d).alias("nome_mes"),
        F.weekofyear(d).cast("int").alias("semana_ano"),
        F.lit(False).alias("is_feriado"),
    ]


def sentinel_row(spark: SparkSession) -> DataFrame:
    """The single 'planned return unknown' member (99991231 / 9999-12-31)."""
    df = spark.range(1).select(F.lit(SENTINEL_DATE).cast("date").alias("d"))
    out = df.select(*calendar_attributes(F.col("d")))
    return out.withColumn("sk_tempo", F.lit(SENTINEL_KEY).cast("int"))


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between ``dt_ini`` and ``dt_fim`` of a one-row frame.

    Years are generated first and dealt to the partitions, each makes its own
    days: an outlier date costs its rows, and no task makes them all.
    """
    years = bounds.select("dt_ini", "dt_fim", F.explode(F.sequence(F.year("dt_ini"), F.year("dt_fim"))).alias("y"))
    years = years.repartition("y").select(
        F.greatest("dt_ini", F.make_date("y", F.lit(1), F.lit(1))).alias("lo"),
        F.least("dt_fim", F.make_date("y", F.lit(12), F.lit(31))).alias("hi"))
    days = years.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_attributes(F.col("d")))


def as_date_lit(d: _dt.date) -> Column:
    return F.lit(d).cast(T.DateType())
