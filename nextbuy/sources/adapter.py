"""Derive a client x quarter ownership panel from the TPC-H-like tables.

The reference works on a monthly bank panel (one row per client and
snapshot, 24 ownership flags, a handful of profile columns).  The driver
tables have no such panel, so it is derived deterministically:

* client = ``o_custkey``; snapshot = calendar quarter of ``o_orderdate``
  (index ``q = (year - 1995) * 4 + quarter - 1``, date = first day of it);
* product code = number in ``p_brand`` (``Brand#1`` .. ``Brand#25``);
* a client owns product ``c`` in quarter ``q`` if it ordered that brand in
  one of the quarters ``q-3 .. q`` (trailing year), and is present in ``q``
  when it owns anything - so clients leave and come back;
* profile: country = nation key, segment = market segment, income =
  account balance (NULL for every fifth client), tenure = 3 months per
  quarter since the first order (``-999999`` sentinel now and then), age
  from the key (NULL for every 41st client), join date and channel = date
  and priority of the first order.

Plan shape: lineitem joins orders on the order key and part on the part key
(sort-merge or, when AQE measures the part side under the broadcast
threshold, broadcast); the brands bought per (client, quarter) are OR-ed into a
64-bit mask with a map-side partial aggregate before the shuffle, so a client
holding a third of all order lines still ships at most one row per quarter
from each map task.  Profiles are per-client aggregates joined on the client key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..products import N_PRODUCTS, PRODUCT_CODES, PRODUCTS, TENURE_MISSING
from ..session import spread
from .tables import table

BASE_YEAR = 1995
OWNERSHIP_QUARTERS = 4
assert N_PRODUCTS <= 62, "brand masks are 64-bit"

PROFILE_COLUMNS = ["age", "fecha_alta", "antiguedad", "renta", "segmento",
                   "pais_residencia", "canal_entrada"]
PANEL_COLUMNS = ["ncodpers", "fecha_dato", "q"] + PROFILE_COLUMNS + PRODUCTS


def quarter_index(ts: Column) -> Column:
    return ((F.year(ts) - BASE_YEAR) * 4 + F.quarter(ts) - 1).cast("int")


def quarter_start(q: Column) -> Column:
    """First day of quarter ``q`` (``q`` is a non-negative int column)."""
    year = F.lit(BASE_YEAR) + F.floor(q / 4).cast("int")
    month = F.pmod(q, F.lit(4)) * 3 + 1
    return F.make_date(year, month, F.lit(1))


def owned_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ncodpers, q, mask) - bit ``c`` of ``mask`` set when brand ``c`` is held in q.

    Ownership is a 64-bit brand mask combined with ``bit_or``: a primitive
    aggregate with a map-side partial step, one row per (client, quarter)
    instead of one per (client, quarter, brand).  Brands outside the product
    catalogue are not products and are ignored.
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    lineitem = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    code = F.regexp_extract("p_brand", r"([0-9]{1,9})$", 1).try_cast("int")  # the whole number, of any length
    brand = (table(spark, sf_dir, "part", "p_partkey", "p_brand")
             .filter(code.between(1, N_PRODUCTS))
             .select(F.col("p_partkey").alias("l_partkey"),
                     F.call_function("shiftleft", F.lit(1).cast("bigint"), code).alias("bit")))
    lines = (lineitem
             .join(orders, lineitem.l_orderkey == orders.o_orderkey)
             .join(brand, "l_partkey")
             .select(F.col("o_custkey").alias("ncodpers"),
                     quarter_index(F.col("o_orderdate")).alias("q0"), "bit"))
    # brands bought per (client, quarter): partial aggregate before the shuffle
    bought = lines.groupBy("ncodpers", "q0").agg(F.bit_or("bit").alias("m0"))
    return (spread(bought, "ncodpers", rows=OWNERSHIP_QUARTERS * orders.count())  # an order makes that many rows at most
            .select("ncodpers", "m0",
                    F.explode(F.sequence(F.col("q0"),
                                         F.col("q0") + OWNERSHIP_QUARTERS - 1)).alias("q"))
            .groupBy("ncodpers", "q")
            .agg(F.bit_or("m0").alias("mask")))


def holds(mask: Column, code: int) -> Column:
    """1 when brand ``code`` is set in ``mask``, else 0."""
    return F.shiftright(mask, code).bitwiseAND(F.lit(1)).cast("int")


def owned_array(mask: Column) -> Column:
    """Sorted brand codes set in ``mask`` (array<int>, built without lambdas)."""
    slots = F.array(*[F.when(holds(mask, c) == 1, F.lit(c)) for c in PRODUCT_CODES])
    return F.array_except(slots, F.array(F.lit(None).cast("int")))


def client_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per client that ever ordered: static profile + first order."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                   "o_orderpriority")
    first = (orders.groupBy(F.col("o_custkey").alias("ncodpers"))
             .agg(F.min_by(F.struct("o_orderdate", "o_orderpriority"),
                           F.struct("o_orderdate", "o_orderkey")).alias("first")))
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal",
                     "c_mktsegment")
    return first.join(customer, first.ncodpers == customer.c_custkey).select(
        "ncodpers",
        F.col("first.o_orderdate").alias("first_ts"),
        F.col("first.o_orderpriority").alias("canal_entrada"),
        "c_nationkey", "c_acctbal", "c_mktsegment")


def build_panel(spark: SparkSession, sf_dir: str, with_owned: bool = True) -> DataFrame:
    """The wide panel: PANEL_COLUMNS (+ ``owned`` array when ``with_owned``)."""
    cells = owned_cells(spark, sf_dir)
    prof = client_profiles(spark, sf_dir)
    key = F.col("ncodpers")
    first_q = quarter_index(F.col("first_ts"))
    flags = [holds(F.col("mask"), code).alias(name)
             for code, name in zip(PRODUCT_CODES, PRODUCTS)]
    cols = [
        "ncodpers",
        quarter_start(F.col("q")).alias("fecha_dato"),
        "q",
        F.when(key % 41 == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(18) + (key * 7) % 70).cast("double")).alias("age"),
        F.to_date("first_ts").alias("fecha_alta"),
        F.when((key + F.col("q")) % 97 == 0, F.lit(float(TENURE_MISSING)))
         .otherwise((3 * (F.col("q") - first_q)).cast("double")).alias("antiguedad"),
        F.when(key % 5 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal")).alias("renta"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("c_nationkey").cast("string").alias("pais_residencia"),
        "canal_entrada",
        *flags,
    ]
    if with_owned:
        cols.append(owned_array(F.col("mask")).alias("owned"))
    return cells.join(prof, "ncodpers").select(*cols)


# ---------------------------------------------------------------------------
# SQL twin of the adapter (DuckDB dialect) used by the oracle queries.

def _flag_sql() -> str:
    return ",\n    ".join(
        f"max(CASE WHEN code = {code} THEN 1 ELSE 0 END) AS {name}"
        for code, name in zip(PRODUCT_CODES, PRODUCTS))


PANEL_CTES = f"""
adapter_lines AS (
  SELECT o.o_custkey AS ncodpers,
         CAST((year(o.o_orderdate) - {BASE_YEAR}) * 4 + quarter(o.o_orderdate) - 1 AS INTEGER) AS q0,
         CAST(substr(p.p_brand, 7) AS INTEGER) AS code
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey
  WHERE CAST(substr(p.p_brand, 7) AS INTEGER) BETWEEN 1 AND {N_PRODUCTS}
),
adapter_cells AS (
  SELECT DISTINCT ncodpers, CAST(q0 + k AS INTEGER) AS q, code
  FROM adapter_lines CROSS JOIN (SELECT range AS k FROM range({OWNERSHIP_QUARTERS})) ks
),
adapter_first AS (
  SELECT ncodpers, first_ts, canal_entrada FROM (
    SELECT o_custkey AS ncodpers, o_orderdate AS first_ts, o_orderpriority AS canal_entrada,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders) WHERE rn = 1
),
adapter_held AS (
  SELECT ncodpers, q,
    {_flag_sql()},
    list_sort(list(code)) AS owned
  FROM adapter_cells GROUP BY ncodpers, q
),
panel AS (
  SELECT h.ncodpers,
    make_date({BASE_YEAR} + h.q // 4, (h.q % 4) * 3 + 1, 1) AS fecha_dato,
    h.q,
    CASE WHEN h.ncodpers % 41 = 0 THEN NULL
         ELSE CAST(18 + (h.ncodpers * 7) % 70 AS DOUBLE) END AS age,
    CAST(f.first_ts AS DATE) AS fecha_alta,
    CASE WHEN (h.ncodpers + h.q) % 97 = 0 THEN {float(TENURE_MISSING)}
         ELSE CAST(3 * (h.q - ((year(f.first_ts) - {BASE_YEAR}) * 4 + quarter(f.first_ts) - 1)) AS DOUBLE)
    END AS antiguedad,
    CASE WHEN h.ncodpers % 5 = 0 THEN NULL ELSE c.c_acctbal END AS renta,
    c.c_mktsegment AS segmento,
    CAST(c.c_nationkey AS VARCHAR) AS pais_residencia,
    f.canal_entrada,
    {", ".join("h." + p for p in PRODUCTS)},
    h.owned
  FROM adapter_held h
  JOIN adapter_first f ON f.ncodpers = h.ncodpers
  JOIN customer c ON c.c_custkey = h.ncodpers
)"""
