"""Views over the test tables. The SQL text is shared by Spark and the checking engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.operators.network import Network
from tabloom.sources.roles import Roles

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

NUMERIC = ["price", "bal", "rare_null", "spike", "few", "const"]
CATEGORIES = ["status", "segment", "flag01"]
HEADER = Roles(
    {
        "o_orderkey": "K",
        **{c: "N" for c in NUMERIC},
        **{c: "C" for c in CATEGORIES},
        "target": "L",
    }
)

TRAIN = """
SELECT o_orderkey,
  o_totalprice AS price,
  CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE c_acctbal END AS bal,
  CASE WHEN o_orderkey % 1000 = 1 THEN NULL ELSE o_totalprice / 1000 END AS rare_null,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS spike,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(0 AS DOUBLE) ELSE CAST(o_orderkey % 30 AS DOUBLE) END AS few,
  CAST(1 AS DOUBLE) AS const,
  o_orderstatus AS status,
  CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE c_mktsegment END AS segment,
  CAST(o_orderkey % 2 AS STRING) AS flag01,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS target
FROM orders JOIN customer ON o_custkey = c_custkey
"""

# a numeric table in network units: data n1, n2 and conditions g1, g2; the odd divisors keep values off
# the rounding grid
GRID = """
SELECT o_orderkey,
  o_totalprice / CAST(270001 AS DOUBLE) - 1 AS n1,
  c_acctbal / CAST(5003 AS DOUBLE) - 1 AS n2,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(0.5 AS DOUBLE) ELSE CAST(-0.5 AS DOUBLE) END AS g1,
  CAST(o_orderkey % 2 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS g2
FROM orders JOIN customer ON o_custkey = c_custkey
"""

LINES = """
SELECT o_orderkey,
  floor(o_totalprice / 50000) * 5 AS final_line,
  CAST((o_orderkey % 5) * 10 AS DOUBLE) AS opt_line,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_totalprice / 100 END AS cmv
FROM orders
"""

LOG = """
SELECT concat('Iter: ', CAST(o_orderkey AS STRING), '; D loss: ', CAST(o_totalprice AS STRING),
  '; G loss: ', CAST(o_custkey AS STRING),
  CASE WHEN o_orderkey % 7 = 0 THEN '; penalty: 1' ELSE concat('; similarity: ', CAST(o_totalprice / 4 AS STRING)) END) AS value
FROM orders
"""

CHECKPOINTS = """
SELECT CASE WHEN o_orderstatus = 'F' THEN concat('models/check_point_', CAST(o_orderkey AS STRING), '.ckpt.meta')
  ELSE concat('models/check_point_', CAST(o_orderkey AS STRING), '.ckpt.index') END AS path
FROM orders
"""

# one dump line per part; features 0..2 get ranges, feature 3 always the same threshold
DUMP = """
SELECT concat(CAST(p_partkey AS STRING), ':[f', CAST(p_size % 4 AS STRING), '<',
  CASE WHEN p_size % 4 = 3 THEN '0.5' WHEN p_size % 4 = 0 THEN CAST(p_retailprice * 250 AS STRING)
       ELSE CAST(p_retailprice AS STRING) END,
  '] yes=1,no=2,missing=1,gain=', CAST(p_size AS STRING), ',cover=16') AS value
FROM part
"""
DUMP_FEATURES = ["price", "bal", "rare_null", "flag"]

CAPPED = """
SELECT o_orderkey, o_totalprice AS price, c_acctbal AS bal, o_totalprice / 250 AS rare_null,
  CAST(o_orderkey % 2 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS flag
FROM orders JOIN customer ON o_custkey = c_custkey
"""

PARTS = """
SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 1 ELSE 2 END AS sample,
  p_retailprice AS x, CAST(p_size AS DOUBLE) AS y
FROM part
"""

DOMAIN_A = """
SELECT p_partkey, CAST(p_size AS DOUBLE) / 25 - 1 AS a1, p_retailprice / 950 - 1 AS a2 FROM part
"""
DOMAIN_B = """
SELECT s_suppkey, s_acctbal / 5000 - 1 AS b1, CAST(s_nationkey AS DOUBLE) / 12 - 1 AS b2 FROM supplier
"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run shared SQL text on the tables it names, passed in as arguments, without registering views."""
    used = {t: read(spark, sf_dir, t) for t in TABLES if t in sql.replace("\n", " ").split()}
    text = sql
    for t in used:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **used)


def tiny_weight(layer: int, i: int, j: int) -> float:
    return ((layer * 7 + i * 3 + j * 5) % 11 - 5) / 10.0


def tiny_bias(j: int) -> float:
    return (j - 1) / 10.0


TINY_CONFIG = {
    "layer1": {"type": "dense", "previous": "input", "size": 3},
    "layer2": {"type": "relu", "previous": "layer1"},
    "output": {"type": "dense", "previous": "layer2"},
}


def tiny_net(first_layer: int, inputs: int, outputs: int, shift: float = 0.0) -> Network:
    """inputs -> 3 (relu) -> outputs with weights from a formula; `shift` is added to the last bias."""
    w = lambda layer, rows, cols: [[tiny_weight(layer, i, j) for j in range(cols)] for i in range(rows)]
    return Network.from_weights(
        TINY_CONFIG,
        {
            "layer1": (w(first_layer, inputs, 3), [tiny_bias(j) for j in range(3)]),
            "output": (w(first_layer + 1, 3, outputs), [tiny_bias(j) + shift for j in range(outputs)]),
        },
    )
