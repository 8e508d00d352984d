"""Constants and declared schemas shared across the pipeline."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# One lineage tag (id_sistema_origem) per source profile.
# A = yard only reachable through a parking bay; customer is a cost centre
# B = lower-case enums, no reservation-creation date, only a charge total
# C = no movement table (movements derived from completed rentals)
# D = explicit movements with reason; quoted and final totals, no daily rate
SYS_A = "bay_level"
SYS_B = "charge_total"
SYS_C = "derived_moves"
SYS_D = "quoted_total"
SYSTEMS = (SYS_A, SYS_B, SYS_C, SYS_D)

# Report "today": replaces CURRENT_DATE so results are reproducible.
AS_OF = _dt.date(1998, 6, 1)

# Sentinel member of dim_tempo meaning "planned return unknown".
SENTINEL_KEY = 99991231
SENTINEL_DATE = _dt.date(9999, 12, 31)

# Label used by reports for missing attributes.
NOT_INFORMED = "(não informado)"

MONEY = T.DecimalType(10, 2)

# Declared column widths of the star store (VARCHAR(n)), checked by dq_width.
DW_WIDTHS = {
    "dim_patio": {"nome_patio": 100, "cidade": 100, "localizacao": 100},
    "dim_cliente": {"nome_cliente": 255, "cidade_origem": 100, "estado_origem": 2},
    "dim_grupo": {"nome_grupo": 100, "mecanizacao": 20},
    "dim_veiculo": {"placa": 10, "chassi": 30, "marca": 50, "modelo": 100, "cor": 30},
}

# Column order of the staging-standard tables (FIXTURES §2).
STD_COLUMNS = {
    "std_patio": ["id_patio_origem", "nome_patio", "cidade", "localizacao", "id_sistema_origem"],
    "std_cliente": ["id_cliente_origem", "nome_cliente", "tipo_cliente", "cidade_origem",
                    "estado_origem", "id_sistema_origem"],
    "std_grupo": ["id_grupo_origem", "nome_grupo", "mecanizacao", "classe_luxo",
                  "valor_diaria_base", "id_sistema_origem"],
    "std_veiculo": ["id_veiculo_origem", "placa", "chassi", "marca", "modelo", "ano", "cor",
                    "ar_condicionado", "nome_grupo", "mecanizacao", "id_sistema_origem"],
    "std_reserva": ["id_reserva_origem", "id_cliente_origem", "id_grupo_origem",
                    "id_patio_retirada_origem", "id_patio_devolucao_origem", "dt_reserva",
                    "dt_retirada_prevista", "dt_devolucao_prevista", "antecedencia_dias",
                    "qt_veiculos_solicitados", "status", "id_sistema_origem"],
    "std_locacao": ["id_locacao_origem", "id_reserva_origem", "id_cliente_origem",
                    "id_veiculo_origem", "nome_grupo", "id_patio_retirada_origem",
                    "id_patio_devolucao_origem", "dt_retirada", "dt_devolucao_real",
                    "dt_devolucao_prevista", "valor_diaria", "valor_total", "dias_locacao",
                    "km_rodados", "status", "id_sistema_origem"],
    "std_movimentacao": ["id_movimentacao_origem", "id_veiculo_origem", "id_patio_origem_origem",
                         "id_patio_destino_origem", "dt_saida_origem", "dt_chegada_destino",
                         "motivo", "id_sistema_origem"],
}

# Natural keys of the star store tables (insert-ignore conflict targets).
NATURAL_KEYS = {
    "dim_tempo": ["sk_tempo"],
    "dim_patio": ["id_sistema_origem", "id_patio_origem"],
    "dim_cliente": ["id_sistema_origem", "id_cliente_origem"],
    "dim_grupo": ["id_sistema_origem", "nome_grupo"],
    "dim_veiculo": ["placa"],
    "fato_locacao": ["id_sistema_origem", "id_locacao_origem"],
    "fato_reserva": ["id_sistema_origem", "id_reserva_origem"],
    "fato_movimentacao_patio": ["id_sistema_origem", "id_movimentacao_origem"],
}
