"""Finance tables derived from the shared benchmark tables.

The household-finance inputs (transactions, accounts, positions, rules, ...)
are derived from the TPC-H-like Parquet tables with one SQL text per table.
The same text runs on Spark (through temp views over the Parquet files) and
on the DuckDB oracle (as ``WITH`` entries), so both engines see identical
inputs.  Every derived table grows with the base tables except the small
literal configuration tables (rules, overrides, categories, budgets,
assumptions, tax inputs), which are user configuration by nature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
FACT_TABLES = ("lineitem", "orders", "customer")     # inputs that grow with the data
POSITION_TASKS = 16     # tasks that the lines of one scanned split are dealt to

# name -> (sql text, base tables / fixtures it reads)
FIXTURE_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "transactions": ("""
WITH b AS (
  SELECT CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) AS txn_id,
         CAST(l.l_shipdate AS DATE) AS date, 'S' || CAST(l.l_suppkey AS STRING) AS account_id,
         CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) * CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE -1 END AS amount_cents,
         p.p_brand || ' ' || p.p_type || ' ' || p.p_name AS description, l.l_linenumber AS ln, l.l_returnflag AS rf
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
u AS (
  SELECT txn_id, date, account_id, amount_cents, CASE WHEN ln = 7 THEN 'ORIG CO NAME: ' || description ELSE description END AS description FROM b
  UNION ALL SELECT txn_id || '-d', date, account_id, CASE WHEN rf = 'A' THEN -amount_cents ELSE amount_cents END, description FROM b WHERE ln = 2
  UNION ALL SELECT txn_id || '-oc', date, account_id, amount_cents, 'ORIG CO NAME: ' || description FROM b WHERE ln = 1)
SELECT txn_id, date, account_id, amount_cents, CAST(amount_cents AS DOUBLE) / 100 AS amount, description,
       CAST(NULL AS STRING) AS category, CAST(NULL AS STRING) AS memo, CAST(NULL AS STRING) AS tags, FALSE AS is_transfer
FROM u""", ("lineitem", "part")),
    "account_dim": ("""
SELECT 'S' || CAST(s_suppkey AS STRING) AS account_id, s_name AS account_name,
       CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS owner,
       CASE WHEN s_suppkey % 5 = 0 THEN 'Liability' ELSE 'Asset' END AS type,
       CASE s_suppkey % 3 WHEN 0 THEN 'Liquid' WHEN 1 THEN 'Retirement' ELSE 'RealEstate' END AS acct_group,
       CASE s_suppkey % 3 WHEN 0 THEN 'Taxable' WHEN 1 THEN 'Roth' ELSE 'Trad' END AS tax_bucket,
       CASE WHEN s_suppkey % 4 = 0 THEN 'illiquid' ELSE 'investable' END AS liquidity,
       s_suppkey % 7 <> 0 AS include_networth, s_suppkey % 3 = 0 AS include_liquid
FROM supplier WHERE s_suppkey % 10 <> 9""", ("supplier",)),
    "positions": ("""
SELECT last_day(CAST(l_shipdate AS DATE)) AS as_of_date, 'S' || CAST(l_suppkey AS STRING) AS account_id,
       'P' || CAST(l_partkey AS STRING) AS symbol, SUM(l_quantity) AS shares,
       SUM(l_extendedprice) / SUM(l_quantity) AS price, SUM(l_extendedprice) AS market_value
FROM lineitem GROUP BY 1, 2, 3""", ("lineitem",)),
    "security_dim": ("""
SELECT 'P' || CAST(p_partkey AS STRING) AS symbol, p_type AS asset_class, p_brand AS region,
       CASE p_partkey % 3 WHEN 0 THEN 'Growth' WHEN 1 THEN 'Value' ELSE 'Blend' END AS style,
       CASE WHEN p_size < 17 THEN 'Small' WHEN p_size < 34 THEN 'Mid' ELSE 'Large' END AS size,
       CAST(p_size AS DOUBLE) / 10000 AS expense_ratio,
       CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) / 1000 END AS dividend_yield,
       CAST(p_partkey % 11 AS DOUBLE) / 10 AS qualified_ratio,
       CASE WHEN p_partkey % 6 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS federal_taxable_ratio
FROM part WHERE p_partkey % 10 <> 9""", ("part",)),
    "security_yields": ("""
SELECT 'P' || CAST(p_partkey AS STRING) AS symbol, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 1000 END AS yield_forward,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 2000 END AS yield_trailing,
       CASE p_partkey % 5 WHEN 0 THEN 'muni' WHEN 1 THEN 'treasury' WHEN 2 THEN ' Standard ' END AS tax_treatment,
       CASE WHEN p_partkey % 7 = 0 THEN CAST(999 AS DOUBLE) ELSE CAST(p_partkey % 11 AS DOUBLE) / 10 END AS qualified_ratio
FROM part WHERE p_partkey % 10 <> 9""", ("part",)),
    "target_allocation": ("""
SELECT asset_class, CAST(1 AS DOUBLE) / CAST(COUNT(*) OVER () AS DOUBLE) AS target_weight FROM (SELECT DISTINCT p_type AS asset_class FROM part WHERE p_type <> 'SMALL') q""",
                          ("part",)),
    "balance_snapshot": ("""
SELECT last_day(CAST(o_orderdate AS DATE)) AS as_of_date, 'S' || CAST(o_custkey % 100 AS STRING) AS account_id, SUM(o_totalprice) AS balance FROM orders GROUP BY 1, 2""",
                         ("orders",)),
    "category_rules": ("""
SELECT * FROM (VALUES ('contains', 'ring', 'Jewelry', 10, 'false'), ('regex', 'brand#1[0-9]', 'HouseBrand', 20, 'yes'), ('contains', 'bolt', 'Hardware', 20, 'no'), ('regex', '(red|blue) widget', 'Widgets', 5, 'true'), ('contains', 'economy', 'Economy', CAST(NULL AS INT), NULL), ('merchant_norm', 'gear', 'Ignored', 1, 'true')) AS t(match_type, pattern, category, priority, subscription)""",
                       ()),
    "category_overrides": ("""
SELECT * FROM (VALUES (TRUE, CAST(NULL AS DATE), 'hot anvil', CAST(NULL AS DOUBLE), 'OverrideAnvil', TRUE), (TRUE, DATE '1998-06-15', 'small', CAST(NULL AS DOUBLE), 'OverrideDay', FALSE), (FALSE, CAST(NULL AS DATE), '.*', CAST(NULL AS DOUBLE), 'Inactive', FALSE)) AS t(active, date, description_regex, amount, category, subscription)""",
                           ()),
    "category_dim": ("""
SELECT * FROM (VALUES ('Jewelry', 'Luxury', 'Discretionary', FALSE, 'Wants', 'Wear', 'G1'), ('Widgets', 'Tools', 'Discretionary', FALSE, 'Wants', 'Home', 'G1'), ('Hardware', 'Tools', 'Fixed', FALSE, 'Needs', 'Home', CAST(NULL AS STRING)), ('HouseBrand', 'Staples', 'Fixed', FALSE, 'Needs', 'Food', 'G2'), ('Economy', 'Staples', 'Income', FALSE, 'Needs', 'Food', 'G2'), ('OverrideAnvil', 'Transfers', 'Transfer', TRUE, 'None', 'None', 'G3')) AS t(category, parent_category, top_bucket, is_transfer, level1, level2, group_1)""",
                     ()),
    "budgets": ("""
SELECT * FROM (VALUES (1, 'Luxury', 199711, CAST(500 AS DOUBLE)), (2, 'Luxury', 199802, CAST(900 AS DOUBLE)), (3, 'Tools', 199812, CAST(300 AS DOUBLE)), (4, 'Luxury', 199802, CAST(650 AS DOUBLE)), (5, 'Staples', 202001, CAST(1 AS DOUBLE))) AS t(row_idx, parent_category, yyyymm, budget_amount)
UNION ALL SELECT 100 + MIN(o_orderkey), 'Clerk ' || CAST(o_custkey % 40 AS STRING), CAST(EXTRACT(year FROM o_orderdate) * 100 + 1 + 3 * (o_custkey % 4) AS INT), CAST(MIN(o_orderkey) % 1000 AS DOUBLE)
          FROM orders GROUP BY o_custkey % 40, o_custkey % 4, EXTRACT(year FROM o_orderdate), o_custkey % 3""",
                ("orders",)),
    "retirement_assumptions": ("""
SELECT * FROM (VALUES
  ('Global', 'current_year', '2025', NULL, NULL, NULL), ('Global', 'inflation_rate', '0.02', NULL, NULL, NULL),
  ('Global', 'real_return_rate', '0.03', NULL, NULL, NULL), ('Global', 'death_year', '2060', NULL, NULL, NULL),
  ('Global', 'retirement_year', '2035', NULL, NULL, NULL), ('Global', 'tax_rate_working', '0.28', NULL, NULL, NULL),
  ('Contribution', 'S0', '30000', '2025', '10', NULL), ('Contribution', 'extra_monthly', '500', '2026', '5', 'S3'),
  ('Contribution', 'SocialSecurity_Jo', '24000', '2037', 'lifetime', NULL), ('Withdrawal', 'living', '60000', '2035', 'lifetime', NULL),
  ('Withdrawal', 'roof', '15000', '2040', NULL, NULL), ('Other', 'ignored', '1', '2030', '2', NULL), ('Contribution', 'bonus_pct', '0.05', '2027', '3', NULL)
) AS t(category, variable, value, start_year, duration, applies_to)
UNION ALL SELECT 'Global', 'fee_' || CAST(n_nationkey AS STRING), CAST(n_nationkey AS STRING), NULL, NULL, NULL FROM nation
UNION ALL SELECT 'Contribution', 'plan_' || CAST(s_suppkey AS STRING), CAST(100 * (s_suppkey % 90) + 500 AS STRING),
                 CAST(2025 + s_suppkey % 12 AS STRING), CAST(1 + s_suppkey % 7 AS STRING), 'S' || CAST(s_suppkey AS STRING)
          FROM supplier WHERE s_suppkey % 4 = 1
UNION ALL SELECT 'Withdrawal', 'care_' || CAST(s_suppkey AS STRING), CAST(10 * (s_suppkey % 50) + 20 AS STRING),
                 CAST(2040 + s_suppkey % 9 AS STRING), CASE WHEN s_suppkey % 3 = 0 THEN 'lifetime' ELSE '4' END, NULL
          FROM supplier WHERE s_suppkey % 10 = 2""", ("nation", "supplier")),
    "annual_tax_est": ("""
SELECT * FROM (VALUES ('w2_income', 300000), ('deductions', -31500), ('loss_offset_ordinary', -3000), ('w2_taxes', 42000), ('est_tax_payments', 4000)) AS t(metric, value)""",
                       ()),
    "filers": ("""
SELECT c_custkey AS filer_id, c_acctbal * 100 AS taxable_income FROM customer""", ("customer",)),
}


def _deps(names) -> list[str]:
    """Fixture names plus the fixtures they read, dependencies first."""
    out: list[str] = []

    def visit(n):
        if n in out or n in BASE_TABLES:
            return
        for d in FIXTURE_SQL[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet input with a parallelism guard.

    A file written as one row group is scanned by a single task, which would
    leave every map-side expression before the first shuffle on one core.
    When the scan yields fewer partitions than the session's default
    parallelism the input is rebalanced once (round-robin); inputs already
    split that finely — every large table — are returned untouched, so no
    shuffle is added at scale."""
    df = spark.read.parquet(path)
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        df = df.repartition(want)
    return df


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_table(spark, path) if name in FACT_TABLES else spark.read.parquet(path)


def register_base(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for n in names:
        base_table(spark, sf_dir, n).createOrReplaceTempView(n)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived finance table as a lazy DataFrame over ``sf_dir``."""
    base = [d for d in FIXTURE_SQL[name][1] if d in BASE_TABLES]
    register_base(spark, sf_dir, base)
    return spark.sql(FIXTURE_SQL[name][0])


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).transactions`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def memo(self, key: str, build):
        """Build a derived frame once per accessor (plans reference it again
        instead of re-analyzing a copy)."""
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def _transactions(self) -> DataFrame:
        """Same rows as the ``transactions`` fixture SQL, built with one scan
        of lineitem and one join: the three variants of a line (itself, the
        duplicate of line 2, the pending twin of line 1) are an explode of an
        array of structs instead of three scans in a UNION ALL."""
        from pyspark.sql import functions as F
        li = read_table(self.spark, f"{self.sf_dir}/lineitem.parquet")
        pt = self.spark.read.parquet(f"{self.sf_dir}/part.parquet")
        # days, cents and a flag are made before the join: they travel in fewer bytes than what they are made of
        keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        li = li.select(*keys, F.col("l_shipdate").cast("date").alias("date"),
                       (F.round(F.col("l_extendedprice") * 100).cast("long")
                        * F.when(F.col("l_returnflag") == "R", 1).otherwise(-1)).alias("cents"),
                       (F.col("l_returnflag") == "A").alias("back"))
        b = li.join(pt, li["l_partkey"] == pt["p_partkey"]).select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in keys]).alias("txn_id"), "date",
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("account_id"), "cents",
            F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("desc"), F.col("l_linenumber").alias("ln"), "back")
        oc = F.concat(F.lit("ORIG CO NAME: "), F.col("desc"))
        v = F.array(
            F.struct(F.col("txn_id").alias("t"), F.col("cents").alias("c"),
                     F.when(F.col("ln") == 7, oc).otherwise(F.col("desc")).alias("d")),
            F.when(F.col("ln") == 2, F.struct(F.concat(F.col("txn_id"), F.lit("-d")).alias("t"),
                                              F.when(F.col("back"), -F.col("cents")).otherwise(F.col("cents")).alias("c"),
                                              F.col("desc").alias("d"))),
            F.when(F.col("ln") == 1, F.struct(F.concat(F.col("txn_id"), F.lit("-oc")).alias("t"),
                                              F.col("cents").alias("c"), oc.alias("d"))))
        x = b.select("date", "account_id", F.explode(v).alias("v")).filter(F.col("v").isNotNull())
        return x.select(F.col("v.t").alias("txn_id"), "date", "account_id", F.col("v.c").alias("amount_cents"),
                        (F.col("v.c").cast("double") / 100).alias("amount"), F.col("v.d").alias("description"),
                        F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("memo"),
                        F.lit(None).cast("string").alias("tags"), F.lit(False).alias("is_transfer"))

    def _positions(self) -> DataFrame:
        """Same rows as the ``positions`` fixture SQL.  Lines are dealt once by account
        and symbol, which the aggregates by day and those of the latest holdings
        share, into tasks that grow in number with the scanned bytes (adaptive
        execution merges a grouping's own exchange into few large ones)."""
        from pyspark.sql import functions as F
        li = self.spark.read.parquet(f"{self.sf_dir}/lineitem.parquet")
        lines = li.select(F.last_day(F.col("l_shipdate").cast("date")).alias("as_of_date"),
                          F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("account_id"),
                          F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"), "l_quantity", "l_extendedprice")
        dealt = lines.repartition(POSITION_TASKS * max(1, li.rdd.getNumPartitions()), "account_id", "symbol")
        shares, value = F.sum("l_quantity"), F.sum("l_extendedprice")
        return dealt.groupBy("as_of_date", "account_id", "symbol").agg(
            shares.alias("shares"), (value / shares).alias("price"), value.alias("market_value"))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in FIXTURE_SQL and name not in BASE_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            if name in BASE_TABLES:
                self._cache[name] = base_table(self.spark, self.sf_dir, name)
            elif name in ("transactions", "positions"):
                self._cache[name] = getattr(self, f"_{name}")()
            else:
                self._cache[name] = fixture(self.spark, self.sf_dir, name)
        return self._cache[name]


def with_clause(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the oracle SQL (DuckDB)."""
    parts = [f"{n} AS ({FIXTURE_SQL[n][0].strip()})" for n in _deps(names)]
    return "WITH " + ",\n".join(parts) + "\n"
