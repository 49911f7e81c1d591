"""What ingestion has to know about a table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    name          label used in results
    key           columns that identify a row; a row with a null in one is rejected
    partition_by  directory columns of the stored Parquet, outermost first
    latest_by     among rows with one key, the greatest of these wins (nulls lose)
    schema        column types as DDL; ``None`` means the batch's own types are used
    stable        columns whose value never changes for a key.  Naming a partition
                  column here lets ingestion skip history partitions outside the
                  batch's range.  Leave empty when unsure: a wrong entry would let
                  a stored key in twice.
    """

    name: str
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    latest_by: tuple[str, ...] = ()
    schema: str | None = None
    stable: tuple[str, ...] = ()

    def with_load_columns(self) -> TableSpec:
        """The same table, stored together with the load-history columns."""
        if self.schema is None:
            return self
        return replace(
            self, schema=f"{self.schema}, _batch_id string, _source_file string, _ingested_at timestamp"
        )

    def preference(self) -> list[Column]:
        return [F.col(c).desc_nulls_last() for c in self.latest_by]


# Table, column and partition names of the stored shop tables.
RETURNS = TableSpec(
    name="devolucoes",
    key=("devolucao_id",),
    partition_by=("data_devolucao", "status_devolucao"),
    latest_by=("data_devolucao",),
    schema=(
        "devolucao_id int, pedido_id int, data_devolucao date, cliente_id int, produto_id int, "
        "quantidade_devolvida int, valor_devolvido double, motivo_devolucao string, status_devolucao string"
    ),
)
STOCK = TableSpec(
    name="estoque",
    key=("produto_id",),
    partition_by=("centro_distribuicao", "categoria"),
    schema=(
        "produto_id int, produto string, categoria string, marca string, fornecedor string, "
        "estoque_inicial int, entradas_periodo int, estoque_atual int, estoque_minimo int, "
        "custo_unitario double, centro_distribuicao string"
    ),
)
# The full column list of sales is not known, so its types come from the batch.
SALES = TableSpec(
    name="vendas",
    key=("pedido_id",),
    partition_by=("data_pedido", "estado", "status_pedido"),
    latest_by=("data_pedido",),
)
