"""The shop's tables from raw CSV to the star schema, through the command line."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.plans import gold, shop

RETURNS_CSV = """\
devolucao_id,pedido_id,data_devolucao,cliente_id,produto_id,quantidade_devolvida,valor_devolvido,motivo_devolucao,status_devolucao
1,71,2024-03-02,9001,205,1,10.25,Cor errada,Fechada
1,71,2024-03-03,9001,205,1,10.25,Cor errada,Aberta
2,72,2024-02-11,,202,1,20.50, Peça solta ,Fechada
3,73,2024-04-09,9002,202,2,,Peça solta,Aberta
,74,2024-05-01,9003,202,1,30.75,Peça solta,Aberta
"""
STOCK_CSV = """\
produto_id,produto,categoria,marca,fornecedor,estoque_inicial,entradas_periodo,estoque_atual,estoque_minimo,custo_unitario,centro_distribuicao
202,Mesa,Móveis,Pinho,Casa Pinho,50,10,40,8,12.5,CD Leste
205,Vaso,Jardim,N/A,Casa Verde,30,10,20,21,7.45,CD Oeste
"""


def test_raw_to_gold(spark, tmp_path, capsys):
    for name, text in (("devolucoes", RETURNS_CSV), ("estoque", STOCK_CSV)):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        for _ in range(2):
            main(["ingest", name, str(tmp_path / f"{name}.csv"), str(tmp_path / "bronze" / name),
                  "--rejects", str(tmp_path / "rejects" / name), "--batch-id", "monday"])
    printed = capsys.readouterr().out
    assert "first_load=True, read=5, rejected=1, appended=3" in printed
    assert "first_load=False, read=5, rejected=1, appended=0" in printed
    assert spark.read.parquet(str(tmp_path / "rejects" / "devolucoes")).count() == 1
    assert {r._batch_id for r in spark.read.parquet(str(tmp_path / "bronze" / "estoque")).collect()} == {"monday"}

    main(["refine", *(str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))])
    tables = {n: spark.read.parquet(str(tmp_path / "gold" / n)) for n in
              ("dim_produto", "dim_cliente", "dim_data", "fato_devolucoes", "fato_estoque")}
    assert {r.produto_id: (r.marca, r.categoria) for r in tables["dim_produto"].collect()} == {
        202: ("Pinho", "Móveis"), 205: (None, "Jardim"),
    }
    assert [r.cliente_id for r in tables["dim_cliente"].collect()] == [9001]
    # The later of the two rows of return 1 was ingested; return 3 has no value.
    assert {r.date_key for r in tables["dim_data"].collect()} == {20240303, 20240211}
    assert spark.read.parquet(str(tmp_path / "silver" / "devolucoes_rejects")).first()._problems == [
        "missing: valor_devolvido"
    ]
    stock = {r.produto_id: r for r in tables["fato_estoque"].collect()}
    assert stock[202].valor_estoque == Decimal("500.00") and not stock[202].abaixo_minimo
    assert stock[205].abaixo_minimo

    facts = tables["fato_devolucoes"]
    by_reason = shop.returns_by(facts, {"reason": F.col("motivo_devolucao")}).collect()
    assert {tuple(r) for r in by_reason} == {
        ("Cor errada", 1, 1, Decimal("10.25")), ("Peça solta", 1, 1, Decimal("20.50")),
    }
    by_month = shop.returns_by(facts, {"month": gold.month_of("data_devolucao")}).collect()
    assert {r.month for r in by_month} == {"2024-02", "2024-03"}


def test_daily_command(spark, tmp_path, capsys):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    command = ["daily", "estoque", *(str(tmp_path / part) for part in ("inbox", "bronze", "progress"))]
    header, first, second = STOCK_CSV.splitlines()
    (inbox / "monday.csv").write_text(f"{header}\n{first}\n", encoding="utf-8")
    main(command)
    (inbox / "tuesday.csv").write_text(f"{header}\n{first}\n{second}\n", encoding="utf-8")
    main(command)
    main(command)
    printed = capsys.readouterr().out
    assert [line.split("read=")[1] for line in printed.splitlines() if "read=" in line] == [
        "1, rejected=0, appended=1)", "2, rejected=0, appended=1)",
    ]


def test_profile_command(spark, tmp_path, capfd):
    path = tmp_path / "estoque.csv"
    path.write_text(STOCK_CSV, encoding="utf-8")
    main(["profile", str(path), "--count", "centro_distribuicao"])
    printed = capfd.readouterr().out
    assert "CD Leste" in printed and "custo_unitario" in printed


def test_refine_adds_what_is_not_cleaned_yet(spark, tmp_path, capsys):
    path = tmp_path / "devolucoes.csv"
    header, *rows = RETURNS_CSV.splitlines()
    (tmp_path / "estoque.csv").write_text(STOCK_CSV, encoding="utf-8")
    layers = [str(tmp_path / layer) for layer in ("bronze", "silver", "gold")]
    main(["ingest", "estoque", str(tmp_path / "estoque.csv"), f"{layers[0]}/estoque"])
    for part, appended in ((rows[:1], 1), (rows[1:3], 1)):
        path.write_text("\n".join([header, *part]) + "\n", encoding="utf-8")
        main(["ingest", "devolucoes", str(path), f"{layers[0]}/devolucoes"])
        capsys.readouterr()
        main(["refine", *layers])
        assert f"appended={appended}" in capsys.readouterr().out.splitlines()[0]
    main(["refine", *layers, "--rebuild"])
    assert spark.read.parquet(f"{layers[1]}/devolucoes").count() == 2


SALES_CSV = """\
pedido_id,data_pedido,estado,status_pedido,total
1,2024-01-02,PR,Fechado,10.5
2,2024-01-03,SC,Aberto,x
"""


def test_sales_with_a_schema_of_the_caller(spark, tmp_path, capsys):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "day.csv").write_text(SALES_CSV, encoding="utf-8")
    schema = "pedido_id bigint, data_pedido date, estado string, status_pedido string, total double"
    bronze, rejects = str(tmp_path / "bronze" / "vendas"), str(tmp_path / "rejects")
    main(["ingest", "vendas", str(inbox / "day.csv"), bronze, "--schema", schema, "--rejects", rejects])
    main(["daily", "vendas", str(inbox), bronze, str(tmp_path / "progress"), "--schema", schema, "--rejects", rejects + "2"])
    printed = capsys.readouterr().out.splitlines()
    assert "read=2, rejected=1, appended=1" in printed[0] and "read=2, rejected=1, appended=0" in printed[1]


def test_profile_writes_whole_reports(spark, tmp_path, capfd):
    path = tmp_path / "many.csv"
    path.write_text("a\n" + "".join(f"v{i}\n" for i in range(500)))
    main(["profile", str(path), "--count", "a", "--out", str(tmp_path / "out"), "--rows", "3"])
    assert spark.read.parquet(str(tmp_path / "out" / "values")).count() == 500
    assert spark.read.parquet(str(tmp_path / "out" / "head")).count() == 5
    assert "only showing top 3 rows" in capfd.readouterr().out
