"""Cleaned and star-schema tables of the shop: returns and stock.

Sales are left out: their columns are not fully known.  ``gold.sales_by_month`` and
``gold.return_rate`` take the column names of whatever sales table there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe
from tidemark.plans import gold
from tidemark.plans.silver import Field, clean, split_rejects
from tidemark.tables import RETURNS, STOCK, TableSpec

# The columns of the stored tables, with the types they get when cleaned.
RETURN_FIELDS = (
    Field("devolucao_id", "int", required=True),
    Field("pedido_id", "int", required=True),
    Field("data_devolucao", "date", required=True),
    Field("cliente_id", "int"),
    Field("produto_id", "int", required=True),
    Field("quantidade_devolvida", "int", required=True),
    Field("valor_devolvido", "decimal(12,2)", required=True),
    Field("motivo_devolucao"),
    Field("status_devolucao"),
)
STOCK_FIELDS = (
    Field("produto_id", "int", required=True),
    Field("produto"),
    Field("categoria"),
    Field("marca"),
    Field("fornecedor"),
    Field("estoque_inicial", "int"),
    Field("entradas_periodo", "int"),
    Field("estoque_atual", "int"),
    Field("estoque_minimo", "int"),
    Field("custo_unitario", "decimal(12,2)"),
    Field("centro_distribuicao"),
)
FIELDS = {RETURNS.name: RETURN_FIELDS, STOCK.name: STOCK_FIELDS}


def silver(bronze: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """The cleaned table, one row per key, and the rows that did not qualify."""
    fit, rejects = split_rejects(clean(bronze, FIELDS[spec.name]))
    return dedupe(fit, spec.key, spec.preference()), rejects


def star(returns: DataFrame, stock: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and facts from the cleaned tables, by table name."""
    return {
        "dim_produto": gold.dimension(stock, ["produto_id"], ["produto", "categoria", "marca", "fornecedor"]),
        "dim_cliente": returns.select("cliente_id").where("cliente_id IS NOT NULL").distinct(),
        "dim_data": gold.calendar(returns, "data_devolucao"),
        "fato_devolucoes": returns.select(
            "devolucao_id", "pedido_id", gold.date_key("data_devolucao").alias("date_key"), "data_devolucao",
            "cliente_id", "produto_id", "quantidade_devolvida", "valor_devolvido", "motivo_devolucao",
            "status_devolucao",
        ),
        "fato_estoque": stock.select(
            "produto_id", "centro_distribuicao", "estoque_inicial", "entradas_periodo", "estoque_atual",
            "estoque_minimo", (F.col("estoque_atual") * F.col("custo_unitario")).alias("valor_estoque"),
            (F.col("estoque_atual") < F.col("estoque_minimo")).alias("abaixo_minimo"),
        ),
    }


#: The keys of the tables of ``star``. Their rows follow from single cleaned rows, which never change.
STAR_KEYS = {
    "dim_produto": ("produto_id",),
    "dim_cliente": ("cliente_id",),
    "dim_data": ("date_key",),
    "fato_devolucoes": ("devolucao_id",),
    "fato_estoque": ("produto_id",),
}


def month_directory() -> dict[str, Column]:
    """Where a return's rows of ``returns_per_month`` lie."""
    return {"mes": gold.month_of("data_devolucao")}


def returns_per_month(returns: DataFrame) -> DataFrame:
    """Returns, pieces and value per month and product; the month is the directory."""
    found = gold.returns_by_month(
        returns, date="data_devolucao", product="produto_id",
        quantity=F.col("quantidade_devolvida"), value=F.col("valor_devolvido"),
    )
    return found.select(
        F.col("product").alias("produto_id"), F.col("returned_lines").alias("devolucoes"),
        F.col("returned_quantity").alias("quantidade"), F.col("returned_value").alias("valor"),
        F.col("month").alias("mes"),
    )


def returns_by(facts: DataFrame, groups: dict[str, Column]) -> DataFrame:
    """Returns, pieces and value per group, such as reason or month."""
    totals = {"pieces": F.col("quantidade_devolvida"), "value": F.col("valor_devolvido")}
    found = gold.fact(facts, groups, totals)
    return found.select(*groups, F.col("rows").alias("returns"), "pieces", "value")
