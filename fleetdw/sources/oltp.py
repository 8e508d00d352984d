"""The four operational sources: declared table shapes and readers.

Only the columns the extracts read are declared (FIXTURES.md §1). A source is a
mapping ``table -> DataFrame``; the readers below build one lazily per table,
with the declared schema, from a Parquet folder layout or over JDBC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.sources.lazy import Lazy

TS = "timestamp_ntz"

# Declared shapes of the source tables read by the extracts (DDL strings).
SOURCE_SCHEMAS = {
    "A": {
        "endereco": "idendereco long, uf string, cidade string, bairro string, logradouro string, numero string",
        "patio": "idpatio long, cdpatio string, idendereco long",
        "vaga": "idvaga long, idpatio long",
        "categoria": "idcategoria string, classificacao string",
        "veiculo": "idveiculo long, placa string, chassi string, modelo string, ano int, arcondicionado boolean, "
                   "idcategoria string",
        "pessoafisica": "idfisica long, nome string, idendereco long",
        "empresa": "idempresa long, razaosocial string, idendereco long",
        "centrocusto": "idcentrocusto long, idempresa long, idfisica long",
        "reserva": f"idreserva long, qtveiculossolicitados int, dtreserva {TS}, dtretiradaprevista {TS}, "
                   f"dtlimiteretirada {TS}, status string, idcentrocusto long",
        "locacao": f"idlocacao string, valordiaria decimal(10,2), dtretirada {TS}, dtchegada {TS}, "
                   f"idvagaretirada long, idvagadevolvida long, idveiculo long, idreserva long",
        "movimentacao": f"idmovimentacao string, dtchegada {TS}, dtretirada {TS}, idveiculo long, "
                        f"idvagaorigem long, idvagadestino long",
    },
    "B": {
        "cliente": "id long, nome string, tipo string, cidade string",
        "condutor": "id long, cliente_id long",
        "grupo_veiculo": "id string, nome string",
        "veiculo": "id long, placa string, chassi string, modelo string, marca string, cor string, "
                   "tipo_mecanizacao string, ar_condicionado boolean, grupo_id string",
        "patio": "id long, nome string, cidade string",
        "reserva": "id long, cliente_id long, grupo_id string, patio_retirada_id long, patio_devolucao_id long, "
                   "data_inicio date, data_fim date, status string",
        "locacao": f"id string, reserva_id long, veiculo_id long, condutor_id long, patio_retirada_id long, "
                   f"patio_devolucao_id long, data_retirada_realizada {TS}, data_devolucao_realizada {TS}",
        "cobranca": "locacao_id string, valor decimal(10,2)",
        "movimentacao_patio": f"id string, veiculo_id long, origem_patio_id long, destino_patio_id long, "
                              f"data_movimentacao {TS}",
    },
    "C": {
        "patio": "id_patio long, nome string, endereco string",
        "grupo": "id_grupo string, nome string, codigo string",
        "veiculo": "id_veiculo long, grupo_id string, placa string, chassi string, marca string, modelo string, "
                   "cor string, ano_fabricacao int, mecanizacao string, tem_ar_condicionado boolean, "
                   "patio_origem_id long, situacao string",
        "cliente": "id_cliente long, tipo_pessoa string, nome string, cidade_origem string",
        "reserva": f"id_reserva long, cliente_id long, grupo_id string, patio_retirada_id long, "
                   f"patio_devolucao_id long, data_reserva {TS}, data_retirada_prevista {TS}, "
                   f"data_devolucao_prevista {TS}, estado string",
        "locacao": f"id_locacao string, reserva_id long, cliente_id long, veiculo_id long, patio_retirada_id long, "
                   f"patio_devolucao_id long, data_retirada_real {TS}, data_devolucao_real {TS}, "
                   f"valor_diaria_aplicada decimal(10,2), status string",
    },
    "D": {
        "patio": "id_patio long, nome_patio string, localizacao string",
        "grupo_veiculo": "id_grupo string, nome_grupo string",
        "cliente": "id_cliente long, tipo_cliente string, nome_razao_social string, cidade string, estado string",
        "veiculo": "id_veiculo long, placa string, chassi string, marca string, modelo string, cor string, "
                   "mecanizacao string, ar_condicionado boolean, id_grupo string",
        "reserva": "id_reserva long, data_reserva date, data_prev_retirada date, data_prev_devolucao date, "
                   "status_reserva string, id_cliente long, id_grupo string, id_patio_retirada long, "
                   "id_patio_devolucao_previsto long",
        "locacao": f"id_locacao string, data_hora_retirada {TS}, data_hora_real_devolucao {TS}, "
                   f"valor_previsto decimal(10,2), valor_final decimal(10,2), id_reserva long, id_cliente long, "
                   f"id_veiculo long, id_patio_retirada long, id_patio_devolucao_real long",
        "movimentacao_patio": f"id_movimentacao string, data_hora_movimentacao {TS}, motivo_movimentacao string, "
                              f"id_veiculo long, id_patio_origem long, id_patio_destino long",
    },
}


def declared(df: DataFrame, letter: str, table: str) -> DataFrame:
    """The declared columns of a source table, in their declared types."""
    fields = [f.split(" ", 1) for f in SOURCE_SCHEMAS[letter][table].split(", ")]
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])


def parquet_sources(spark: SparkSession, root: str) -> dict[str, Lazy]:
    """Sources laid out as ``{root}/{A|B|C|D}/{table}`` Parquet folders.

    Only the declared columns are selected (pruned at the scan), in their declared
    types: a zoned timestamp in a file becomes the zone-free one of the schema.
    """
    def reader(letter: str, table: str) -> Callable[[], DataFrame]:
        return lambda: declared(spark.read.parquet(f"{root.rstrip('/')}/{letter}/{table}"), letter, table)

    return {p: Lazy({t: reader(p, t) for t in tables}) for p, tables in SOURCE_SCHEMAS.items()}


def jdbc_sources(spark: SparkSession, url: str, schemas: dict[str, str], properties: dict[str, str],
                 partitioning: dict[tuple[str, str], tuple[str, int, int, int]] | None = None) -> dict[str, Lazy]:
    """Sources read straight from the operational databases over JDBC.

    ``schemas`` maps a source letter to its database schema name. ``partitioning``
    maps (letter, table) to (column, lower, upper, num_partitions) so large tables
    (rentals, reservations, movements) are read by many tasks in parallel ranges
    instead of one connection.
    """
    partitioning = partitioning or {}

    def reader(letter: str, table: str) -> Callable[[], DataFrame]:
        def read() -> DataFrame:
            cols = ", ".join(f.split()[0] for f in SOURCE_SCHEMAS[letter][table].split(", "))
            query = f"(SELECT {cols} FROM {schemas[letter]}.{table}) AS t"
            opts = {"preferTimestampNTZ": "true", **properties}  # zone-free, as the schema declares
            if (letter, table) in partitioning:
                col, lo, hi, n = partitioning[(letter, table)]
                return spark.read.jdbc(url, query, column=col, lowerBound=lo, upperBound=hi,
                                       numPartitions=n, properties=opts)
            return spark.read.jdbc(url, query, properties=opts)
        return read

    return {p: Lazy({t: reader(p, t) for t in tables}) for p, tables in SOURCE_SCHEMAS.items()}


def write_parquet_sources(sources: dict[str, dict[str, DataFrame]], root: str) -> None:
    """Land source tables as the Parquet layout read by :func:`parquet_sources`."""
    for letter, tables in sources.items():
        for table in tables:
            tables[table].write.mode("overwrite").parquet(f"{root.rstrip('/')}/{letter}/{table}")
