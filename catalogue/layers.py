"""Bronze load history, silver cleaning, gold dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.common import EARLIER, ORDERS, Entries, orders, table
from tidemark.functions import money, to_amount
from tidemark.operators import dedupe
from tidemark.plans import Field, clean, gold, ignored_values, ingest, split_rejects, with_load_columns
from tidemark.plans.gold import month_of
from tidemark.plans.increment import read_silver, refresh_fact, refresh_silver
from tidemark.plans.spellings import standard_spellings, with_standard
from tidemark.plans.versions import as_of, dimension_history
from tidemark.sources import read_csv, read_history
from tidemark.tables import TableSpec
from tidemark.workspace import fresh_dir


# --- bronze and silver -------------------------------------------------------------------------


def bronze_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, spec, uri = orders(spark, sf_dir), ORDERS.with_load_columns(), fresh_dir(spark, "orders")
    for batch_id, rows in (("first", every.where(EARLIER)), ("second", every)):
        source = fresh_dir(spark, "orders_csv")
        rows.drop("month").write.csv(source, header=True)
        batch = with_load_columns(read_csv(spark, source, rows.drop("month").schema), batch_id)
        ingest(spark, batch.withColumn("month", month_of("o_orderdate")), spec, uri)
    return (
        read_history(spark, uri, spec.schema)
        .groupBy("_batch_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_source_file").like("%.csv")).alias("with_file"),
            F.count("_ingested_at").alias("with_time"),
        )
    )


_PART_FIELDS = (
    Field("p_partkey", "bigint", required=True),
    Field("p_name"),
    Field("p_brand", upper=True),
    Field("p_type"),
    Field("p_size", "int"),
    Field("p_retailprice", "double"),
)


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    untidy = part.select(
        F.col("p_partkey").cast("string"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        F.concat(F.lit(" "), F.lower("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") == 7, "NA").otherwise(F.col("p_type")).alias("p_type"),
        F.col("p_size").cast("string"),
        F.when(F.col("p_size") <= 10, "unknown")
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("p_retailprice"),
    )
    fit, _ = split_rejects(clean(untidy.unionByName(untidy), _PART_FIELDS))
    return dedupe(fit, ["p_partkey"])


def silver_standard_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands written with other cases, accents, orders and slips come back as the spelling most rows have."""
    way, brand = F.pmod("p_partkey", F.lit(60)), F.col("p_brand")
    number = F.regexp_extract("p_brand", "[0-9]+", 0)
    dirty = (
        F.when(way == 1, F.upper(brand)).when(way == 2, F.concat(F.lit(" BRÁND "), number)).when(way == 3, F.concat(number, F.lit("-brand")))
        .when(way == 4, F.concat(F.lit("Brnd#"), number)).when(way == 5, F.concat(F.lit("Brandd#"), number))
        .when(way == 6, F.concat(F.lit("Brend#"), number)).otherwise(brand)
    )
    untidy = table(spark, sf_dir, "part").select("p_partkey", dirty.alias("p_brand"))
    return with_standard(untidy, "p_brand", standard_spellings(untidy, "p_brand"))


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    untidy = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "5-LOW", " n/a ").otherwise(F.col("o_orderkey").cast("string")).alias(
            "o_orderkey"
        ),
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", "?")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
    )
    fields = (
        Field("o_orderkey", "bigint", required=True),
        Field("o_orderstatus"),
        Field("o_totalprice", "double", required=True),
    )
    _, rejects = split_rejects(clean(untidy, fields))
    return rejects.select("o_orderkey", "o_orderstatus", "o_totalprice", F.explode("_problems").alias("problem"))


def silver_optional_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of optional columns that were left out, with their texts; their rows stay."""
    part = table(spark, sf_dir, "part")
    untidy = part.select(
        F.col("p_partkey").cast("string"),
        "p_name",
        "p_brand",
        "p_type",
        F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") == 7, " un").otherwise("")).alias("p_size"),
        F.when(F.col("p_size") <= 10, "unknown")
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("p_retailprice"),
    )
    return ignored_values(clean(untidy, _PART_FIELDS), ["p_partkey"])


_RAW_ORDERS = TableSpec(
    name="raw orders",
    key=("o_orderkey",),
    partition_by=("month",),
    schema=(
        "o_orderkey string, o_custkey string, o_orderstatus string, o_totalprice string, o_orderdate string, month string"
    ),
)
_ORDER_FIELDS = (
    Field("o_orderkey", "bigint", required=True),
    Field("o_custkey", "bigint"),
    Field("o_orderstatus", upper=True),
    Field("o_totalprice", "double", required=True),
    Field("o_orderdate", "timestamp_ntz", required=True),
    Field("month"),
)


class _DailyLayers:
    """Raw and cleaned orders that take in one load after the other."""

    def __init__(self, spark: SparkSession, sf_dir: str, unusable: Column) -> None:
        self.spark = spark
        self.raw, self.silver, self.rejects = (fresh_dir(spark, label) for label in ("raw", "silver", "rejects"))
        untidy = orders(spark, sf_dir).select(
            F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("o_orderkey"),
            F.col("o_custkey").cast("string"),
            F.lower("o_orderstatus").alias("o_orderstatus"),
            F.when(unusable, "?").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
            F.col("o_orderdate").cast("string"),
            "month",
        )
        late = ~F.expr("o_orderdate < '1998-01-01'")
        # The last load brings all rows again.
        self.loads = {"first": untidy.where(~late), "second": untidy.where(late & (F.col("o_orderstatus") != "p")), "third": untidy}

    def load(self, name: str) -> DataFrame:
        batch = with_load_columns(self.loads[name], name, from_files=False)
        ingest(self.spark, batch, _RAW_ORDERS.with_load_columns(), self.raw)
        refresh_silver(self.spark, self.raw, self.silver, _RAW_ORDERS, _ORDER_FIELDS, rejects_uri=self.rejects)
        return read_silver(self.spark, self.silver, _RAW_ORDERS, _ORDER_FIELDS)


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and rejected orders after three loads, each followed by a refresh that takes up what is new."""
    layers = _DailyLayers(spark, sf_dir, F.col("o_orderpriority") == "5-LOW")
    for name in layers.loads:
        cleaned = layers.load(name)
    kept = cleaned.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", F.lit("").alias("problem"))
    refused = spark.read.parquet(layers.rejects).select(
        F.trim("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint"), "o_orderstatus",
        F.lit(None).cast("double").alias("o_totalprice"), F.col("o_orderdate").cast("timestamp_ntz"),
        F.array_join("_problems", ",").alias("problem"),
    )
    return kept.unionByName(refused)


# --- gold --------------------------------------------------------------------------------------


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dimension(
        table(spark, sf_dir, "part"), ["p_partkey"], ["p_name", "p_brand", "p_type", "p_retailprice"]
    )


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.calendar(table(spark, sf_dir, "orders"), "o_orderdate").drop("cal_date")


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = gold.dimension(
        table(spark, sf_dir, "customer"), ["c_custkey"], ["c_name", "c_nationkey", "c_mktsegment"]
    )
    return customers.join(nation, "c_nationkey", "left").select("c_custkey", "c_name", "c_mktsegment", "n_name")


def _as_doubles(found: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals as doubles, to face the SQL's."""
    return found.withColumns({c: to_amount(F.col(c)) for c in columns})


def fact_sales_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gold.sales_by_month(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "nation"),
        date="o_orderdate",
        status="o_orderstatus",
        value=money("o_totalprice"),
        customer=("o_custkey", "c_custkey"),
        place=("c_nationkey", "n_nationkey"),
        place_name="n_name",
    )
    return _as_doubles(found, "revenue")


def fact_sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after three loads; each rebuilds only the months that its new rows touch."""
    layers, uri = _DailyLayers(spark, sf_dir, F.lit(False)), fresh_dir(spark, "fact")
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")

    def build(rows: DataFrame) -> DataFrame:
        return gold.sales_by_month(
            rows, customers, nations, date="o_orderdate", status="o_orderstatus", value=money("o_totalprice"),
            customer=("o_custkey", "c_custkey"), place=("c_nationkey", "n_nationkey"), place_name="n_name",
        )

    for name in layers.loads:
        refresh_fact(spark, layers.load(name), build, uri, {"month": F.col("month")})
    schema = "place string, status string, orders bigint, revenue decimal(38,2), month string"
    found = read_history(spark, uri, schema)
    return _as_doubles(found, "revenue")


def _net_price() -> Column:
    return money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))


def fact_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gold.returns_by_month(
        table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"),
        date="l_shipdate",
        product="l_partkey",
        quantity=F.col("l_quantity").cast("decimal(12,2)"),
        value=_net_price(),
    )
    return _as_doubles(found, "returned_quantity", "returned_value")


def _product_history(lines: DataFrame, **options: int) -> DataFrame:
    """How a product was taxed and discounted; the last line of a day counts."""
    last = [F.desc("l_orderkey"), F.desc("l_linenumber"), F.desc("l_tax"), F.desc("l_discount")]
    return dimension_history(lines, ["l_partkey"], ["l_tax", "l_discount"], "l_shipdate", last, **options)


def dim_product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_partkey", "l_shipdate", "l_tax", "l_discount", "l_orderkey", "l_linenumber"]
    return _product_history(table(spark, sf_dir, "lineitem").select(columns))


def fact_returns_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines with the tax and discount that their product had in sold lines up to then."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_tax", "l_discount", "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    history = _product_history(lines.where("l_returnflag <> 'R'"))
    versions = history.select(
        "l_partkey", "valid_from", F.col("l_tax").alias("tax"), F.col("l_discount").alias("discount"), "version"
    )
    returned = lines.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")
    return as_of(returned, versions, ["l_partkey"], "l_shipdate", ["tax", "discount", "version"], split=20)


def return_rate_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gold.return_rate(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "part"),
        product=("l_partkey", "p_partkey"),
        group="p_brand",
        returned=F.col("l_returnflag") == "R",
        value=_net_price(),
    )
    return _as_doubles(found, "returned_value")


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of products that left the product table (here: the small ones)."""
    remaining = table(spark, sf_dir, "part").where("p_size > 10")
    return gold.orphan_keys(table(spark, sf_dir, "lineitem"), "l_partkey", remaining, "p_partkey")


_NET_SQL = "l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2))"
_HISTORY_SQL = """
    SELECT l_partkey, l_tax, l_discount, valid_from,
           lead(valid_from) OVER (PARTITION BY l_partkey ORDER BY valid_from) AS valid_until,
           row_number() OVER (PARTITION BY l_partkey ORDER BY valid_from)::INT AS version,
           lead(valid_from) OVER (PARTITION BY l_partkey ORDER BY valid_from) IS NULL AS is_current
    FROM (
        SELECT l_partkey, l_tax, l_discount, l_shipdate AS valid_from,
               lag(l_tax) OVER w AS tax_before, lag(l_discount) OVER w AS discount_before, row_number() OVER w AS place
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey DESC, l_linenumber DESC, l_tax DESC, l_discount DESC
            ) AS rn
            FROM lineitem {where}
        )
        WHERE rn = 1 WINDOW w AS (PARTITION BY l_partkey ORDER BY l_shipdate)
    )
    WHERE place = 1 OR l_tax IS DISTINCT FROM tax_before OR l_discount IS DISTINCT FROM discount_before
"""
_SALES_SQL = """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name AS place, o_orderstatus AS status,
           count(*) AS orders, sum(o_totalprice::DECIMAL(12,2))::DOUBLE AS revenue
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2, 3
"""

ENTRIES: Entries = {
    "bronze_load_history": (
        bronze_load_history,
        """
        SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'first' ELSE 'second' END AS _batch_id,
               count(*) AS rows, count(*) AS with_file, count(*) AS with_time
        FROM orders GROUP BY 1
        """,
    ),
    "silver_clean": (
        silver_clean,
        """
        SELECT p_partkey, p_name, upper(p_brand) AS p_brand, CASE WHEN p_size <> 7 THEN p_type END AS p_type, p_size,
               CASE WHEN p_size > 10 THEN p_retailprice END AS p_retailprice
        FROM part
        """,
    ),
    "silver_rejects": (
        silver_rejects,
        """
        WITH untidy AS (
          SELECT CASE WHEN o_orderpriority = '5-LOW' THEN ' n/a ' ELSE o_orderkey::VARCHAR END AS o_orderkey,
                 o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN '?' ELSE o_totalprice::VARCHAR END AS o_totalprice
          FROM orders)
        SELECT *, 'missing: o_orderkey' AS problem FROM untidy WHERE o_orderkey = ' n/a '
        UNION ALL SELECT *, 'invalid: o_totalprice' FROM untidy WHERE o_totalprice = '?'
        """,
    ),
    "silver_standard_values": (silver_standard_values, "SELECT p_partkey, p_brand FROM part"),
    "silver_incremental": (
        silver_incremental,
        """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, '' AS problem FROM orders
        WHERE o_orderpriority IS DISTINCT FROM '5-LOW'
        UNION ALL SELECT o_orderkey, o_custkey, lower(o_orderstatus), NULL, o_orderdate, 'invalid: o_totalprice' FROM orders
        WHERE o_orderpriority = '5-LOW'
        """,
    ),
    "silver_optional_problems": (
        silver_optional_problems,
        """
        SELECT p_partkey, 'p_size' AS "column", '7 un' AS text FROM part WHERE p_size = 7
        UNION ALL SELECT p_partkey, 'p_retailprice', 'unknown' FROM part WHERE p_size <= 10
        """,
    ),
    "dim_product": (dim_product, "SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part"),
    "dim_date": (
        dim_date,
        """
        SELECT DISTINCT strftime(o_orderdate, '%Y%m%d')::INT AS date_key, year(o_orderdate)::INT AS cal_year,
               quarter(o_orderdate)::INT AS cal_quarter, month(o_orderdate)::INT AS cal_month
        FROM orders
        """,
    ),
    "dim_customer": (
        dim_customer,
        """
        SELECT c_custkey, c_name, c_mktsegment, n_name
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "fact_sales_month": (fact_sales_month, _SALES_SQL),
    "fact_sales_incremental": (fact_sales_incremental, _SALES_SQL),
    "fact_returns": (
        fact_returns,
        f"""
        SELECT strftime(l_shipdate, '%Y-%m') AS month, l_partkey AS product, count(*) AS returned_lines,
               sum(l_quantity::DECIMAL(12,2))::DOUBLE AS returned_quantity, sum({_NET_SQL})::DOUBLE AS returned_value
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2
        """,
    ),
    "dim_product_history": (dim_product_history, _HISTORY_SQL.format(where="")),
    "fact_returns_as_of": (
        fact_returns_as_of,
        f"""
        WITH history AS ({_HISTORY_SQL.format(where="WHERE l_returnflag <> 'R'")})
        SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_shipdate, f.l_extendedprice, h.l_tax AS tax,
               h.l_discount AS discount, h.version
        FROM (SELECT * FROM lineitem WHERE l_returnflag = 'R') f
             ASOF LEFT JOIN history h ON f.l_partkey = h.l_partkey AND f.l_shipdate >= h.valid_from
        """,
    ),
    "return_rate_by_brand": (
        return_rate_by_brand,
        f"""
        SELECT p_brand, count(*) AS lines, count(*) FILTER (WHERE l_returnflag = 'R') AS returned_lines,
               coalesce(sum({_NET_SQL}) FILTER (WHERE l_returnflag = 'R'), 0)::DOUBLE AS returned_value,
               count(*) FILTER (WHERE l_returnflag = 'R') / count(*) AS return_rate
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
        GROUP BY p_brand
        """,
    ),
    "orphan_keys": (
        orphan_keys,
        """
        SELECT l_partkey, count(*) AS rows FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10) GROUP BY l_partkey
        """,
    ),
}
