"""Test-data adapters: shape the driver's TPC-H-like tables as the four source
OLTP schemas so the real extract -> transform -> load -> report path runs on them.

Mapping (same rules as the SQL oracle in ``fleetdw.checks.oracle``):

* source p (A..D = 0..3) owns orders with ``o_orderkey % 4 = p`` and their
  lineitems; every source sees all customers, parts and suppliers;
* yard = supplier (city = nation), customer = customer (PJ when key % 3 = 0),
  vehicle group = part type, vehicle = part, reservation = order,
  rental = lineitem, movement = lineitem with return flag 'R';
* ``n`` = supplier count; destination yard of a rental/movement = ``l_partkey % n``.

Only this module knows about the driver tables; everything downstream sees the
source shapes listed in FIXTURES §1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.functions.dates import date_key
from fleetdw.schemas import MONEY
from fleetdw.sources.lazy import Lazy
from fleetdw.sources.tpch import Tables

SOURCE_INDEX = {"A": 0, "B": 1, "C": 2, "D": 3}
BAYS_PER_YARD = 7


def _c(name: str) -> Column:
    return F.col(name)


def rental_id() -> Column:
    return F.concat_ws(
        "-",
        _c("l_orderkey").cast("string"),
        _c("l_linenumber").cast("string"),
        _c("l_partkey").cast("string"),
        _c("l_suppkey").cast("string"),
        date_key(_c("l_shipdate")).cast("string"),  # yyyymmdd without a per-row formatter
    )


def pickup_ts() -> Column:
    return _c("l_shipdate") + F.expr("INTERVAL 12 HOURS")


def return_ts() -> Column:
    span = F.make_dt_interval(_c("l_quantity").cast("int"), _c("l_linenumber"), F.lit(0), F.lit(0))
    return F.when(_c("l_linestatus") == "F", _c("l_shipdate") + span)


def is_returned() -> Column:
    return _c("l_linestatus") == "F"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def walk_in_reservation() -> Column:
    """B, C, D: the first line of an order is a walk-in (no reservation)."""
    return F.when(_c("l_linenumber") != 1, _c("l_orderkey"))


def plate(letter: str) -> Column:
    shared = _c("p_partkey") % 50 == 0
    return F.when(shared, F.concat(F.lit("X"), _c("p_partkey").cast("string"))).otherwise(
        F.concat(F.lit(letter), _c("p_partkey").cast("string"))
    )


def chassis(letter: str) -> Column:
    return F.concat(F.lit(letter), F.lpad(_c("p_partkey").cast("string"), 16, "0"))


def colour() -> Column:
    return F.concat(F.lit("COR"), (_c("p_size") % 7).cast("string"))


def air_con() -> Column:
    return _c("p_size") % 3 != 0


def is_manual() -> Column:
    return _c("p_partkey") % 2 == 0


def is_company() -> Column:
    return _c("c_custkey") % 3 == 0


@dataclass
class Shapes:
    """The driver tables seen as the four source schemas (lazy DataFrames)."""

    spark: SparkSession
    sf_dir: str
    _n: int | None = field(default=None, repr=False)

    def __post_init__(self):
        self.t = Tables(self.spark, self.sf_dir)

    # -- shared pieces -----------------------------------------------------
    @property
    def n_yards(self) -> int:
        if self._n is None:
            # one scalar from a metadata-sized table; drives the yard arithmetic
            self._n = int(self.t.supplier.count())
        return self._n

    def orders(self, p: str) -> DataFrame:
        return self.t.orders.where(_c("o_orderkey") % 4 == SOURCE_INDEX[p])

    def lines(self, p: str) -> DataFrame:
        return self.t.lineitem.where(_c("l_orderkey") % 4 == SOURCE_INDEX[p])

    def lines_with_orders(self, p: str) -> DataFrame:
        o = self.orders(p).select("o_orderkey", "o_custkey", "o_orderpriority")
        return self.lines(p).join(o, _c("l_orderkey") == _c("o_orderkey"), "inner")

    def dest_yard(self) -> Column:
        return _c("l_partkey") % F.lit(self.n_yards)

    def yards(self) -> DataFrame:
        n = self.t.nation.select("n_nationkey", "n_name", "n_regionkey")
        r = self.t.region.select("r_regionkey", "r_name")
        return (self.t.supplier.select("s_suppkey", "s_name", "s_nationkey")
                .join(n, _c("s_nationkey") == _c("n_nationkey"))
                .join(r, _c("n_regionkey") == _c("r_regionkey")))

    def customers(self) -> DataFrame:
        n = self.t.nation.select("n_nationkey", "n_name", "n_regionkey")
        return self.t.customer.select("c_custkey", "c_name", "c_nationkey").join(
            n, _c("c_nationkey") == _c("n_nationkey"))

    def reservation_group(self, o: DataFrame) -> DataFrame:
        """Reserved group = type of the part whose key equals the customer key."""
        p = self.t.part.select(_c("p_partkey"), _c("p_type").alias("res_group"))
        return o.join(p, _c("o_custkey") == _c("p_partkey"), "left").drop("p_partkey")

    def groups(self) -> DataFrame:
        return self.t.part.select("p_type").distinct()

    # -- source A: bay_level ------------------------------------------------
    def source_a(self) -> Lazy:
        t = self.t

        def endereco():
            return t.nation.join(t.region, _c("n_regionkey") == _c("r_regionkey")).select(
                _c("n_nationkey").alias("idendereco"),
                F.concat(F.lit("R"), _c("n_regionkey").cast("string")).alias("uf"),
                _c("n_name").alias("cidade"), _c("r_name").alias("bairro"), _c("n_name").alias("logradouro"),
                _c("n_nationkey").cast("string").alias("numero"))

        def patio():
            return t.supplier.select(_c("s_suppkey").alias("idpatio"), _c("s_name").alias("cdpatio"),
                                     _c("s_nationkey").alias("idendereco"))

        def vaga():
            bays = t.supplier.select(F.explode(F.sequence(F.lit(0), F.lit(BAYS_PER_YARD - 1))).alias("k"),
                                     "s_suppkey")
            return bays.select((_c("s_suppkey") * BAYS_PER_YARD + _c("k")).alias("idvaga"),
                               _c("s_suppkey").alias("idpatio"))

        def categoria():
            return self.groups().select(_c("p_type").alias("idcategoria"), _c("p_type").alias("classificacao"))

        def veiculo():
            return t.part.select(
                _c("p_partkey").alias("idveiculo"), plate("A").alias("placa"), chassis("A").alias("chassi"),
                _c("p_name").alias("modelo"), (F.lit(1990) + _c("p_size")).alias("ano"),
                air_con().alias("arcondicionado"), _c("p_type").alias("idcategoria"))

        def cust():
            return t.customer.select("c_custkey", "c_name", "c_nationkey")

        def pessoafisica():
            return cust().where(~is_company()).select(
                _c("c_custkey").alias("idfisica"), _c("c_name").alias("nome"), _c("c_nationkey").alias("idendereco"))

        def empresa():
            return cust().where(is_company()).select(
                _c("c_custkey").alias("idempresa"), _c("c_name").alias("razaosocial"),
                _c("c_nationkey").alias("idendereco"))

        def centrocusto():
            return cust().select(
                _c("c_custkey").alias("idcentrocusto"),
                F.when(is_company(), _c("c_custkey")).alias("idempresa"),
                F.when(~is_company(), _c("c_custkey")).alias("idfisica"))

        def reserva():
            return self.orders("A").select(
                _c("o_orderkey").alias("idreserva"),
                (F.lit(1) + _c("o_orderkey") % 3).cast("int").alias("qtveiculossolicitados"),
                (_c("o_orderdate") - F.make_dt_interval(F.lit(0), (_c("o_orderkey") % 97).cast("int")))
                .alias("dtreserva"),
                _c("o_orderdate").alias("dtretiradaprevista"),
                (_c("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("dtlimiteretirada"),
                F.when(_c("o_orderstatus") == "P", "Cancelada")
                .when(_c("o_orderstatus") == "F", "Atendida").otherwise("Confirmada").alias("status"),
                _c("o_custkey").alias("idcentrocusto"))

        def locacao():
            dest = self.dest_yard()
            return self.lines("A").select(
                rental_id().alias("idlocacao"), money(_c("l_extendedprice")).alias("valordiaria"),
                pickup_ts().alias("dtretirada"), return_ts().alias("dtchegada"),
                (_c("l_suppkey") * BAYS_PER_YARD + _c("l_linenumber") - 1).alias("idvagaretirada"),
                F.when(is_returned(), dest * BAYS_PER_YARD).alias("idvagadevolvida"),
                _c("l_partkey").alias("idveiculo"), _c("l_orderkey").alias("idreserva"))

        def movimentacao():
            dest = self.dest_yard()
            return self.lines("A").where(_c("l_returnflag") == "R").select(
                rental_id().alias("idmovimentacao"),
                (_c("l_shipdate") + F.expr("INTERVAL 1 DAYS")).alias("dtchegada"),
                _c("l_shipdate").alias("dtretirada"), _c("l_partkey").alias("idveiculo"),
                (_c("l_suppkey") * BAYS_PER_YARD + _c("l_linenumber") - 1).alias("idvagaorigem"),
                F.when(_c("l_linenumber") != 7, dest * BAYS_PER_YARD).alias("idvagadestino"))

        return Lazy(dict(endereco=endereco, patio=patio, vaga=vaga, categoria=categoria, veiculo=veiculo,
                         pessoafisica=pessoafisica, empresa=empresa, centrocusto=centrocusto, reserva=reserva,
                         locacao=locacao, movimentacao=movimentacao))

    # -- source B: charge_total ---------------------------------------------
    def source_b(self) -> Lazy:
        t = self.t

        def cliente():
            return self.customers().select(
                _c("c_custkey").alias("id"), _c("c_name").alias("nome"),
                F.when(is_company(), "PJ").otherwise("PF").alias("tipo"), _c("n_name").alias("cidade"))

        def condutor():
            return t.customer.select(_c("c_custkey").alias("id"), _c("c_custkey").alias("cliente_id"))

        def grupo_veiculo():
            return self.groups().select(_c("p_type").alias("id"), _c("p_type").alias("nome"))

        def veiculo():
            return t.part.select(
                _c("p_partkey").alias("id"), plate("B").alias("placa"), chassis("B").alias("chassi"),
                _c("p_name").alias("modelo"), _c("p_brand").alias("marca"), colour().alias("cor"),
                F.when(is_manual(), "manual").otherwise("automatico").alias("tipo_mecanizacao"),
                air_con().alias("ar_condicionado"), _c("p_type").alias("grupo_id"))

        def patio():
            return self.yards().select(_c("s_suppkey").alias("id"), _c("s_name").alias("nome"),
                                       _c("n_name").alias("cidade"))

        def reserva():
            n = F.lit(self.n_yards)
            return self.reservation_group(self.orders("B")).select(
                _c("o_orderkey").alias("id"), _c("o_custkey").alias("cliente_id"), _c("res_group").alias("grupo_id"),
                (_c("o_orderkey") % n).alias("patio_retirada_id"), (_c("o_custkey") % n).alias("patio_devolucao_id"),
                _c("o_orderdate").cast("date").alias("data_inicio"),
                F.date_add(_c("o_orderdate").cast("date"), (_c("o_orderkey") % 20).cast("int")).alias("data_fim"),
                F.when(_c("o_orderstatus") == "P", "cancelada")
                .when(_c("o_orderstatus") == "F", "confirmada").otherwise("ativa").alias("status"))

        def locacao():
            return self.lines_with_orders("B").select(
                rental_id().alias("id"), walk_in_reservation().alias("reserva_id"),
                _c("l_partkey").alias("veiculo_id"), _c("o_custkey").alias("condutor_id"),
                _c("l_suppkey").alias("patio_retirada_id"), self.dest_yard().alias("patio_devolucao_id"),
                pickup_ts().alias("data_retirada_realizada"), return_ts().alias("data_devolucao_realizada"))

        def cobranca():
            return self.lines("B").where(_c("l_returnflag") != "N").select(
                rental_id().alias("locacao_id"), money(_c("l_extendedprice")).alias("valor"))

        def movimentacao_patio():
            dest = self.dest_yard()
            return self.lines("B").where((_c("l_returnflag") == "R") & (_c("l_suppkey") != dest)).select(
                rental_id().alias("id"), _c("l_partkey").alias("veiculo_id"),
                _c("l_suppkey").alias("origem_patio_id"), dest.alias("destino_patio_id"),
                _c("l_shipdate").alias("data_movimentacao"))

        return Lazy(dict(cliente=cliente, condutor=condutor, grupo_veiculo=grupo_veiculo, veiculo=veiculo,
                         patio=patio, reserva=reserva, locacao=locacao, cobranca=cobranca,
                         movimentacao_patio=movimentacao_patio))

    # -- source C: derived_moves --------------------------------------------
    def source_c(self) -> Lazy:
        t = self.t

        def patio():
            return self.yards().select(
                _c("s_suppkey").alias("id_patio"), _c("s_name").alias("nome"),
                F.concat(_c("n_name"), F.lit(" - "), _c("r_name")).alias("endereco"))

        def grupo():
            return self.groups().select(
                _c("p_type").alias("id_grupo"), _c("p_type").alias("nome"),
                F.upper(F.substring(_c("p_type"), 1, 3)).alias("codigo"))

        def veiculo():
            return t.part.select(
                _c("p_partkey").alias("id_veiculo"), _c("p_type").alias("grupo_id"), plate("C").alias("placa"),
                chassis("C").alias("chassi"), _c("p_brand").alias("marca"), _c("p_name").alias("modelo"),
                colour().alias("cor"), (F.lit(1990) + _c("p_size")).alias("ano_fabricacao"),
                F.when(is_manual(), "MANUAL").otherwise("AUTOMATICA").alias("mecanizacao"),
                air_con().alias("tem_ar_condicionado"), (_c("p_partkey") % F.lit(self.n_yards)).alias("patio_origem_id"),
                F.when(_c("p_size") % 2 == 0, "DISPONIVEL").otherwise("LOCADO").alias("situacao"))

        def cliente():
            return self.customers().select(
                _c("c_custkey").alias("id_cliente"), F.when(is_company(), "PJ").otherwise("PF").alias("tipo_pessoa"),
                _c("c_name").alias("nome"), _c("n_name").alias("cidade_origem"))

        def reserva():
            n = F.lit(self.n_yards)
            return self.reservation_group(self.orders("C")).select(
                _c("o_orderkey").alias("id_reserva"), _c("o_custkey").alias("cliente_id"),
                _c("res_group").alias("grupo_id"), (_c("o_orderkey") % n).alias("patio_retirada_id"),
                (_c("o_custkey") % n).alias("patio_devolucao_id"),
                (_c("o_orderdate") - F.make_dt_interval(F.lit(0), (_c("o_orderkey") % 97).cast("int")))
                .alias("data_reserva"),
                _c("o_orderdate").alias("data_retirada_prevista"),
                (_c("o_orderdate") + F.make_dt_interval((_c("o_orderkey") % 20).cast("int")))
                .alias("data_devolucao_prevista"),
                F.when(_c("o_orderstatus") == "P", "CANCELADA").when(_c("o_orderstatus") == "F", "CONCRETIZADA")
                .when(_c("o_orderkey") % 5 == 0, "EM_FILA_ESPERA").otherwise("CONFIRMADA").alias("estado"))

        def locacao():
            return self.lines_with_orders("C").select(
                rental_id().alias("id_locacao"), walk_in_reservation().alias("reserva_id"),
                _c("o_custkey").alias("cliente_id"), _c("l_partkey").alias("veiculo_id"),
                _c("l_suppkey").alias("patio_retirada_id"), self.dest_yard().alias("patio_devolucao_id"),
                pickup_ts().alias("data_retirada_real"), return_ts().alias("data_devolucao_real"),
                money(_c("l_extendedprice")).alias("valor_diaria_aplicada"),
                F.when(is_returned(), "CONCLUIDA").when(_c("l_returnflag") == "A", "CANCELADA")
                .otherwise("EM_ANDAMENTO").alias("status"))

        return Lazy(dict(patio=patio, grupo=grupo, veiculo=veiculo, cliente=cliente, reserva=reserva,
                         locacao=locacao))

    # -- source D: quoted_total ---------------------------------------------
    def source_d(self) -> Lazy:
        t = self.t

        def patio():
            return self.yards().select(
                _c("s_suppkey").alias("id_patio"), _c("s_name").alias("nome_patio"),
                F.concat(_c("n_name"), F.lit(" - "), _c("r_name")).alias("localizacao"))

        def grupo_veiculo():
            return self.groups().select(_c("p_type").alias("id_grupo"), _c("p_type").alias("nome_grupo"))

        def cliente():
            return self.customers().select(
                _c("c_custkey").alias("id_cliente"), F.when(is_company(), "PJ").otherwise("PF").alias("tipo_cliente"),
                _c("c_name").alias("nome_razao_social"), _c("n_name").alias("cidade"),
                F.concat(F.lit("R"), _c("n_regionkey").cast("string")).alias("estado"))

        def veiculo():
            return t.part.select(
                _c("p_partkey").alias("id_veiculo"), plate("D").alias("placa"),
                F.concat(F.lit("D-"), _c("p_name")).alias("chassi"), _c("p_brand").alias("marca"),
                _c("p_name").alias("modelo"), colour().alias("cor"),
                F.when(is_manual(), "MANUAL").otherwise("AUTOMATICO").alias("mecanizacao"),
                air_con().alias("ar_condicionado"), _c("p_type").alias("id_grupo"))

        def reserva():
            n = F.lit(self.n_yards)
            day = _c("o_orderdate").cast("date")
            return self.reservation_group(self.orders("D")).select(
                _c("o_orderkey").alias("id_reserva"),
                (_c("o_orderdate") - F.make_dt_interval(F.lit(0), (_c("o_orderkey") % 97).cast("int")))
                .cast("date").alias("data_reserva"),
                day.alias("data_prev_retirada"),
                F.date_add(day, (_c("o_orderkey") % 20).cast("int")).alias("data_prev_devolucao"),
                F.when(_c("o_orderstatus") == "P", "CANCELADA")
                .when(_c("o_orderstatus") == "F", "CONVERTIDA").otherwise("ATIVA").alias("status_reserva"),
                _c("o_custkey").alias("id_cliente"), _c("res_group").alias("id_grupo"),
                (_c("o_orderkey") % n).alias("id_patio_retirada"),
                (_c("o_custkey") % n).alias("id_patio_devolucao_previsto"))

        def locacao():
            dest = self.dest_yard()
            price = money(_c("l_extendedprice"))
            return self.lines_with_orders("D").select(
                rental_id().alias("id_locacao"), pickup_ts().alias("data_hora_retirada"),
                return_ts().alias("data_hora_real_devolucao"), price.alias("valor_previsto"),
                F.when(is_returned(), (price + _c("l_quantity").cast("int")).cast(MONEY)).alias("valor_final"),
                walk_in_reservation().alias("id_reserva"), _c("o_custkey").alias("id_cliente"),
                _c("l_partkey").alias("id_veiculo"), _c("l_suppkey").alias("id_patio_retirada"),
                F.when(is_returned(), dest).alias("id_patio_devolucao_real"))

        def movimentacao_patio():
            dest = self.dest_yard()
            moves = self.lines_with_orders("D").where((_c("l_returnflag") == "R") & (_c("l_suppkey") != dest))
            return moves.select(
                rental_id().alias("id_movimentacao"), _c("l_shipdate").alias("data_hora_movimentacao"),
                _c("o_orderpriority").alias("motivo_movimentacao"), _c("l_partkey").alias("id_veiculo"),
                _c("l_suppkey").alias("id_patio_origem"), dest.alias("id_patio_destino"))

        return Lazy(dict(patio=patio, grupo_veiculo=grupo_veiculo, cliente=cliente, veiculo=veiculo,
                         reserva=reserva, locacao=locacao, movimentacao_patio=movimentacao_patio))

    def all_sources(self) -> dict[str, Lazy]:
        return {"A": self.source_a(), "B": self.source_b(), "C": self.source_c(), "D": self.source_d()}
