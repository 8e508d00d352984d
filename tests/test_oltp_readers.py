"""Source readers: the JDBC reader's pushed-down projection and range partitioning
(checked with a stub reader; no database is started in tests)."""

from fleetdw.sources.oltp import SOURCE_SCHEMAS, jdbc_sources


class _Reader:
    def __init__(self):
        self.calls = []

    def jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None,
             properties=None):
        self.calls.append(dict(url=url, table=table, column=column, lower=lowerBound, upper=upperBound,
                               n=numPartitions, props=properties))
        return table


class _Spark:
    def __init__(self):
        self.read = _Reader()


def test_jdbc_reader_projects_declared_columns_and_partitions_big_tables():
    spark = _Spark()
    src = jdbc_sources(spark, "jdbc:postgresql://db/oltp", {"A": "src_a", "B": "src_b", "C": "src_c", "D": "src_d"},
                       {"user": "etl"}, partitioning={("C", "locacao"): ("id_locacao", 0, 10_000_000, 64)})
    assert set(src) == {"A", "B", "C", "D"} and set(src["C"]) == set(SOURCE_SCHEMAS["C"])
    assert spark.read.calls == []  # lazy: nothing is read until a table is used
    q = src["C"]["locacao"]
    call = spark.read.calls[-1]
    assert q.startswith("(SELECT id_locacao, reserva_id, cliente_id") and "FROM src_c.locacao" in q
    assert (call["column"], call["lower"], call["upper"], call["n"]) == ("id_locacao", 0, 10_000_000, 64)
    src["A"]["patio"]
    assert spark.read.calls[-1]["column"] is None and "FROM src_a.patio" in spark.read.calls[-1]["table"]


def test_timestamps_arrive_zone_free(spark, tmp_path):
    from fleetdw.sources.oltp import parquet_sources

    stub = _Spark()
    jdbc_sources(stub, "jdbc:postgresql://db/oltp", dict.fromkeys("ABCD", "x"), {"user": "etl"})["A"]["locacao"]
    assert stub.read.calls[-1]["props"] == {"preferTimestampNTZ": "true", "user": "etl"}
    zoned = spark.sql("""SELECT '1' AS idmovimentacao, timestamp '2024-01-01 10:00:00' AS dtchegada, current_timestamp() AS dtretirada,
                                1 AS idveiculo, 2 AS idvagaorigem, 3 AS idvagadestino, 'x' AS more""")
    zoned.write.parquet(str(tmp_path / "A" / "movimentacao"))
    got = parquet_sources(spark, str(tmp_path))["A"]["movimentacao"]
    assert dict(got.dtypes)["dtchegada"] == "timestamp_ntz" and dict(got.dtypes)["idveiculo"] == "bigint"
    assert "more" not in got.columns
