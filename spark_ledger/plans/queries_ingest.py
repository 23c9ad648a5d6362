"""Loading queries: upserts, snapshot replace, newest-file-wins, batch
dedupe, column update by key — over inputs derived from the full tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_ledger.functions import normalize_merchant_v1
from spark_ledger.operators import identity, upsert
from spark_ledger.plans.registry import register
from spark_ledger.plans.sql_snippets import first_match_ctes, merchant_norm_sql
from spark_ledger.sources.fixtures import Tables, with_clause

TXN_COLS = ["txn_id", "date", "account_id", "amount_cents", "amount", "description", "category", "memo", "tags",
            "is_transfer"]


def _orderkey(c="txn_id"):
    return F.split_part(F.col(c), F.lit("-"), F.lit(1)).cast("long")


def _target_staging(t: Tables):
    """Every transaction takes part.  Target: those that are settled.  Staging:
    two rows for each id, in row order ``row_idx``: the first with the category
    'early' and, for the last digit 5 and more of the amount, a later 'late'."""
    tx = t.transactions
    target = tx.filter(~identity.is_orig_co())
    late = F.abs(F.col("amount_cents")) % 10 >= 5
    # both rows of an id are made where it is read: one scan, and one of them goes before the shuffle
    staging = tx.withColumn("row_idx", F.explode(F.when(late, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return target, staging.withColumn("category", F.when(F.col("row_idx") == 1, "early").otherwise("late"))


TS_SQL = with_clause("transactions") + """,
tgt AS (SELECT * FROM transactions WHERE NOT contains(UPPER(description), 'ORIG CO')),
labelled AS (SELECT * EXCLUDE (category), row_idx, CASE row_idx WHEN 1 THEN 'early' ELSE 'late' END AS category
             FROM transactions JOIN (VALUES (1), (2)) AS v(row_idx) ON row_idx = 1 OR ABS(amount_cents) % 10 >= 5),
stg AS (SELECT DISTINCT ON (txn_id) txn_id, date, account_id, amount_cents, amount, description, category, memo, tags, is_transfer
        FROM labelled ORDER BY txn_id, row_idx DESC, date DESC, account_id DESC, amount_cents DESC, description DESC),
first_stg AS (SELECT DISTINCT ON (txn_id) txn_id, date, account_id, amount_cents, amount, description, category, memo, tags, is_transfer
              FROM labelled ORDER BY txn_id, row_idx, date, account_id, amount_cents, description)"""


@register("upsert_txns", TS_SQL + """
SELECT * FROM tgt WHERE txn_id NOT IN (SELECT txn_id FROM stg) UNION ALL SELECT * FROM stg""")
def q_upsert_txns(spark, sf_dir):
    target, staging = _target_staging(Tables(spark, sf_dir))
    return upsert.upsert(target, staging, ["txn_id"])


@register("upsert_idempotent", TS_SQL + """
SELECT * FROM tgt WHERE txn_id NOT IN (SELECT txn_id FROM stg) UNION ALL SELECT * FROM stg""")
def q_upsert_idempotent(spark, sf_dir):
    """Upsert applied twice equals upsert applied once."""
    target, staging = _target_staging(Tables(spark, sf_dir))
    once = upsert.upsert(target, staging, ["txn_id"])
    return upsert.upsert(once, staging, ["txn_id"])


@register("insert_ignore", TS_SQL + """
SELECT * FROM tgt UNION ALL SELECT * FROM first_stg WHERE txn_id NOT IN (SELECT txn_id FROM tgt)""")
def q_insert_ignore(spark, sf_dir):
    target, staging = _target_staging(Tables(spark, sf_dir))
    return upsert.insert_ignore(target, staging, ["txn_id"])


# ------------------------------------------------------------ C-13 --------
@register("snapshot_replace", with_clause("positions") + """,
stg AS (SELECT as_of_date, account_id, symbol, shares, price, market_value * 1.01 AS market_value FROM positions
        WHERE month(as_of_date) IN (1, 6) AND symbol NOT LIKE 'P1%'),
k AS (SELECT DISTINCT as_of_date, account_id FROM stg)
SELECT p.as_of_date, p.account_id, p.symbol, p.shares, ROUND(p.price * 1000000) / 1000000 AS price,
       ROUND(p.market_value * 100) / 100 AS market_value
FROM positions p WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.as_of_date = p.as_of_date AND k.account_id = p.account_id)
UNION ALL SELECT as_of_date, account_id, symbol, shares, ROUND(price * 1000000) / 1000000, ROUND(market_value * 100) / 100 FROM stg""")
def q_snapshot_replace(spark, sf_dir):
    """Snapshots of January and June are re-staged without the P1* symbols
    (sold) and revalued; those snapshots are replaced as a whole."""
    pos = Tables(spark, sf_dir).positions
    stg = pos.filter(F.month("as_of_date").isin(1, 6) & ~F.col("symbol").startswith("P1")) \
             .withColumn("market_value", F.col("market_value") * 1.01)
    r = upsert.snapshot_replace(pos, stg)
    return (r.withColumn("price", F.round(F.col("price") * 1000000) / 1000000)
             .withColumn("market_value", F.round(F.col("market_value") * 100) / 100))


# ------------------------------------------------------------ C-9 ---------
NEWEST_SRC_SQL = """
SELECT last_day(CAST(l_shipdate AS DATE)) AS as_of_date, 'S' || CAST(l_suppkey AS STRING) AS account_id,
       'P' || CAST(l_partkey % 50 AS STRING) AS symbol, l_quantity AS shares, l_extendedprice / l_quantity AS price,
       l_extendedprice AS market_value, 'positions_' || CAST(l_orderkey % 3 AS STRING) || '.csv' AS source_file,
       CAST(l_orderkey % 3 AS BIGINT) AS file_mtime, l_orderkey * 10 + l_linenumber AS row_idx
FROM lineitem"""


@register("newest_file_wins", "WITH src AS (" + NEWEST_SRC_SQL + """),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY as_of_date, account_id, symbol
                                   ORDER BY file_mtime DESC, source_file DESC, row_idx) AS rn FROM src)
SELECT as_of_date, account_id, symbol, shares, price, market_value, source_file FROM r WHERE rn = 1""")
def q_newest_file_wins(spark, sf_dir):
    """Position rows staged from several files (file = order mod 3, newer
    mtime for a higher number); per (date, account, symbol) the newest file
    wins, ties broken by path and then row order."""
    li = Tables(spark, sf_dir).lineitem
    src = li.select(
        F.last_day(F.col("l_shipdate").cast("date")).alias("as_of_date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("account_id"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 50).cast("string")).alias("symbol"),
        F.col("l_quantity").alias("shares"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_extendedprice").alias("market_value"),
        F.concat(F.lit("positions_"), (F.col("l_orderkey") % 3).cast("string"), F.lit(".csv")).alias("source_file"),
        (F.col("l_orderkey") % 3).cast("long").alias("file_mtime"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_idx"))
    r = identity.newest_file_wins(src, row_col="row_idx")
    return r.select("as_of_date", "account_id", "symbol", "shares", "price", "market_value", "source_file")


# ------------------------------------------------------------ C-4 / C-5 ---
@register("dedupe_batch", with_clause("transactions") + f""",
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, account_id, ROUND(amount, 2), {merchant_norm_sql('description')}
                                   ORDER BY txn_id) AS rn FROM transactions)
SELECT txn_id, date, account_id, amount, description FROM k WHERE rn = 1""")
def q_dedupe_batch(spark, sf_dir):
    """Intra-batch dedupe on (date, account, round(amount,2), merchant); the
    txn_id order stands in for file row order."""
    t = Tables(spark, sf_dir).transactions
    return identity.dedupe_batch(t, order_col="txn_id").select("txn_id", "date", "account_id", "amount", "description")


@register("anti_batch_dedupe", with_clause("transactions") + f""",
k AS (SELECT *, hash(date, account_id, ROUND(amount, 2), shop) AS key
      FROM (SELECT *, {merchant_norm_sql('description')} AS shop FROM transactions)),
known AS (SELECT DISTINCT key FROM k WHERE ABS(amount_cents) % 2 = 0)
SELECT txn_id, date, account_id, amount, description FROM k WHERE key NOT IN (SELECT key FROM known)""")
def q_anti_batch_dedupe(spark, sf_dir):
    """All transactions as a new batch against a store that holds those of even
    amounts: rows already present by the batch key are dropped."""
    tx = Tables(spark, sf_dir).transactions
    known = tx.filter(F.abs(F.col("amount_cents")) % 2 == 0)
    return identity.anti_batch_dedupe(tx, known).select("txn_id", "date", "account_id", "amount", "description")


# ------------------------------------------------------------ C-6 ---------
@register("pending_in_file", with_clause("transactions") + """,
f AS (SELECT *, 'file_' || CAST(CAST(split_part(txn_id, '-', 1) AS BIGINT) % 4 AS VARCHAR) AS source_file,
             COALESCE(contains(UPPER(description), 'ORIG CO'), FALSE) AS oc FROM transactions),
g AS (SELECT *, MAX(CAST(oc AS INT)) OVER (PARTITION BY source_file, account_id, date, amount_cents) AS any_p,
             MIN(CAST(oc AS INT)) OVER (PARTITION BY source_file, account_id, date, amount_cents) AS all_p FROM f)
SELECT txn_id, source_file, account_id, date, amount_cents FROM g WHERE NOT (oc AND any_p = 1 AND all_p = 0)""")
def q_pending_in_file(spark, sf_dir):
    """Per file, pending 'ORIG CO' rows are dropped when a settled row of the
    same (account, date, cents) exists in that file (files = order mod 4)."""
    tx = Tables(spark, sf_dir).transactions.withColumn(
        "source_file", F.concat(F.lit("file_"), (_orderkey() % 4).cast("string")))
    return identity.drop_pending_in_file(tx).select("txn_id", "source_file", "account_id", "date", "amount_cents")


# ------------------------------------------------------------ C-12 --------
BAL_STAGE_SQL = """
SELECT last_day(CAST(o_orderdate AS DATE)) AS as_of_date, 'S' || CAST(o_custkey % 100 AS STRING) AS account_id,
       o_totalprice AS balance, 'balances_' || o_orderpriority || '.csv' AS source_file, o_orderkey AS row_idx
FROM orders"""


@register("balances_upsert", with_clause("balance_snapshot") + ", stg0 AS (" + BAL_STAGE_SQL + """),
stg AS (SELECT as_of_date, account_id, balance FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY as_of_date, account_id ORDER BY source_file DESC, row_idx DESC) AS rn
          FROM stg0 WHERE month(as_of_date) IN (3, 9)) q WHERE rn = 1)
SELECT as_of_date, account_id, ROUND(balance * 100) / 100 AS balance FROM balance_snapshot b
WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.as_of_date = b.as_of_date AND s.account_id = b.account_id)
UNION ALL SELECT as_of_date, account_id, ROUND(balance * 100) / 100 FROM stg""")
def q_balances_upsert(spark, sf_dir):
    """Balance files (one per order priority) for March and September; per
    (date, account) the last file in name order (then last row) wins and is
    upserted into the balance snapshot."""
    t = Tables(spark, sf_dir)
    o = t.orders
    stg = o.select(
        F.last_day(F.col("o_orderdate").cast("date")).alias("as_of_date"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 100).cast("string")).alias("account_id"),
        F.col("o_totalprice").alias("balance"),
        F.concat(F.lit("balances_"), F.col("o_orderpriority"), F.lit(".csv")).alias("source_file"),
        F.col("o_orderkey").alias("row_idx")).filter(F.month("as_of_date").isin(3, 9))
    last = upsert.last_per_key(stg, ["as_of_date", "account_id"], ["source_file", "row_idx"])
    r = upsert.upsert(t.balance_snapshot, last.select("as_of_date", "account_id", "balance"), ["as_of_date", "account_id"])
    return r.withColumn("balance", F.round(F.col("balance") * 100) / 100)


# ------------------------------------------------------------ C-14 --------
UPD_SQL = """
SELECT CASE WHEN p_partkey % 2 = 0 THEN 'p' ELSE 'P' END || CAST(p_partkey AS STRING) AS symbol,
       p_retailprice / 100000 AS dividend_yield,
       CASE WHEN p_partkey % 10 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS qualified_ratio
FROM part WHERE p_partkey % 5 = 0"""


@register("update_by_key", with_clause("security_dim") + ", upd AS (" + UPD_SQL + """)
SELECT s.symbol, s.asset_class, s.region, s.style, s.size, s.expense_ratio,
       CASE WHEN u.symbol IS NOT NULL THEN u.dividend_yield ELSE s.dividend_yield END AS dividend_yield,
       CASE WHEN u.symbol IS NOT NULL THEN u.qualified_ratio ELSE s.qualified_ratio END AS qualified_ratio,
       s.federal_taxable_ratio
FROM security_dim s LEFT JOIN upd u ON lower(u.symbol) = lower(s.symbol)""")
def q_update_by_key(spark, sf_dir):
    """Security attributes updated from a file keyed by symbol in any case;
    a matched row takes the file's value even when it is null."""
    t = Tables(spark, sf_dir)
    p = t.part
    upd = p.filter(F.col("p_partkey") % 5 == 0).select(
        F.concat(F.when(F.col("p_partkey") % 2 == 0, F.lit("p")).otherwise(F.lit("P")),
                 F.col("p_partkey").cast("string")).alias("symbol"),
        (F.col("p_retailprice") / 100000).alias("dividend_yield"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit(None).cast("double")).otherwise(F.lit(0.5)).alias("qualified_ratio"))
    return upsert.update_columns_by_key(t.security_dim, upd, "symbol", ["dividend_yield", "qualified_ratio"])


# ------------------------------------------------------------ B-5/C-3 -----
@register("txn_id_v1", with_clause("transactions") + """,
mn AS (SELECT txn_id AS src_id, date, account_id, amount_cents,
              trim(regexp_replace(regexp_replace(lower(COALESCE(description, '')), '[^a-z0-9 ]+', '', 'g'), '\\s+', ' ', 'g')) AS merchant_norm
       FROM transactions),
sq AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, account_id, merchant_norm, amount_cents ORDER BY src_id) - 1 AS dup_seq FROM mn)
SELECT src_id, merchant_norm, CAST(dup_seq AS BIGINT) AS dup_seq,
       sha1(CAST(date AS VARCHAR) || '|' || account_id || '|' || merchant_norm || '|' || CAST(amount_cents AS VARCHAR) || '|' || CAST(dup_seq AS VARCHAR)) AS txn_id
FROM sq""")
def q_txn_id_v1(spark, sf_dir):
    """Older loader: punctuation deleted (not spaced), 0-based dup_seq, sha1."""
    t = Tables(spark, sf_dir).transactions
    src = t.select(F.col("txn_id").alias("src_id"), "date", "account_id", "amount_cents",
                   normalize_merchant_v1("description").alias("merchant_norm"))
    out = identity.assign_txn_ids_v1(src, order_col="src_id")
    return out.select("src_id", "merchant_norm", "dup_seq", "txn_id")



# ------------------------------------------------------------ B-1 / A-3 / A-11 / A-12 / A-14
@register("normalize_bank_exports", with_clause("transactions") + """,
x AS (SELECT *, CAST(substr(account_id, 2) AS INT) AS s FROM transactions)
SELECT date,
       CASE WHEN s % 2 = 0 THEN 'CHECKING' || CAST(s % 4 AS VARCHAR) ELSE 'CARD_GOLD' || CAST(s % 3 AS VARCHAR) END AS account_id,
       CAST(amount_cents AS DOUBLE) / 100 AS amount, description,
       CASE WHEN s % 2 = 1 THEN CASE WHEN amount_cents < 0 THEN 'Shopping' ELSE 'Payment' END END AS category,
       txn_id AS memo,
       CASE WHEN s % 2 = 0 THEN 'chase' ELSE 'amex' END AS vendor,
       CASE WHEN s % 2 = 0 THEN 'checking' || CAST(s % 4 AS VARCHAR) ELSE 'card/gold' || CAST(s % 3 AS VARCHAR) END AS route
FROM x""")
def q_normalize_bank_exports(spark, sf_dir):
    """Bank and card exports (two header layouts, Debit/Credit vs one signed
    amount in parentheses, nested routes) written from the transactions
    fixture, then normalized back: date, account from the route, amount,
    description, category, memo."""
    from spark_ledger.plans.raw_exports import write_bank_exports
    from spark_ledger.sources import vendors
    t = Tables(spark, sf_dir)
    root = write_bank_exports(t)
    n = vendors.normalize_transactions(spark, root)
    return n.select("date", "account_id", "amount", "description", "category", "memo", "vendor", "route")


@register("normalize_position_exports", with_clause("positions") + """,
x AS (SELECT *, CAST(substr(account_id, 2) AS INT) AS s FROM positions),
y AS (
  SELECT MIN(as_of_date) OVER (PARTITION BY account_id) AS as_of_date,
         CASE s % 3 WHEN 0 THEN 'BRK' WHEN 1 THEN 'PLAN' ELSE 'IRA' END || CAST(s AS VARCHAR) AS account_id,
         CASE s % 3 WHEN 0 THEN 'chase' WHEN 1 THEN 'alight' ELSE 'fidelity' END AS vendor,
         CASE s % 3 WHEN 0 THEN 'brk' WHEN 1 THEN 'plan' ELSE 'ira' END || CAST(s AS VARCHAR) AS route,
         CASE WHEN s % 3 = 1 THEN 'FUND_' || upper(symbol)
              WHEN s % 3 = 2 AND symbol LIKE '%7' THEN 'FUND_' || upper(symbol) ELSE symbol END AS symbol,
         CASE WHEN s % 3 = 1 AND length(symbol) = 2 THEN market_value ELSE shares END AS shares,
         market_value
  FROM x),
z AS (SELECT as_of_date, account_id, vendor, route, symbol, SUM(shares) AS shares, SUM(market_value) AS mv
      FROM y GROUP BY ALL),
r AS (SELECT as_of_date, account_id, vendor, route, symbol, ROUND(shares * 1000000) / 1000000 AS sh,
            ROUND(mv * 100) / 100 AS mv FROM z)
SELECT as_of_date, account_id, vendor, route, symbol, sh AS shares,
       ROUND(CASE WHEN sh > 0 THEN mv / sh END * 1000000) / 1000000 AS price, mv AS market_value
FROM r""")
def q_normalize_position_exports(spark, sf_dir):
    """Three brokerage layouts (exact headers with a FOOTNOTES sentinel and
    junk after it; token-matched headers with unitless balances; blank
    symbols falling back to the description slug), one export file per
    account written from the positions fixture, then normalized, dispatched
    by vendor and collapsed per symbol under the file's as-of date."""
    from spark_ledger.plans.raw_exports import write_position_exports
    from spark_ledger.sources import vendors
    t = Tables(spark, sf_dir)
    root = write_position_exports(t)
    n = vendors.normalize_positions(spark, root, glob="*.csv")
    mv = F.round(F.col("market_value") * 100) / 100
    sh = F.round(F.col("shares") * 1000000) / 1000000
    # the reported price is value / shares of the reported (rounded) figures
    return n.select("as_of_date", "account_id", "vendor", "route", "symbol", sh.alias("shares"),
                    (F.round(F.when(sh > 0, mv / sh) * 1000000) / 1000000).alias("price"), mv.alias("market_value"))


# ------------------------------------------------------------ 2.M streaming
@register("incremental_load", with_clause("transactions", "category_rules") + f""",
x AS (SELECT *, CAST(substr(account_id, 2) AS INT) AS s, CAST(split_part(txn_id, '-', 2) AS INT) AS line FROM transactions),
f AS (SELECT date, amount_cents, description, {merchant_norm_sql('description')} AS shop, line, s % 2 = 1 AS card,
             CASE WHEN s % 2 = 0 THEN 'CHECKING' || CAST(s % 4 AS VARCHAR) ELSE 'CARD_GOLD' || CAST(s % 3 AS VARCHAR) END AS account_id
      FROM x),
keys AS (SELECT date, account_id, amount_cents, shop, MIN(description) AS description, BOOL_OR(line = 4) AS again, BOOL_OR(card) AS card,
                contains(UPPER(MIN(description)), 'ORIG CO') AS pending FROM f GROUP BY ALL),
{first_match_ctes('keys')}
SELECT sha256(k.date::VARCHAR || '|' || k.account_id || '|' || k.amount_cents || '|' || shop || '|1') AS txn_id, k.date, k.account_id,
       CAST(k.amount_cents AS DOUBLE) / 100 AS amount, k.amount_cents, k.description,
       CASE WHEN again THEN CASE WHEN card THEN 'Corrected' END
            ELSE COALESCE(won.category, CASE WHEN card THEN CASE WHEN k.amount_cents < 0 THEN 'Shopping' ELSE 'Payment' END END) END AS category
FROM keys k LEFT JOIN won USING (description)
WHERE NOT (pending AND EXISTS (SELECT 1 FROM keys o WHERE NOT o.pending AND o.date = k.date AND o.account_id = k.account_id
                                                      AND o.amount_cents = k.amount_cents))""")
def q_incremental_load(spark, sf_dir):
    """Raw bank exports loaded by file-source streams (availableNow) in three
    drops: all rows without the settled rows of first lines, whose pending twins
    are there already; those settled rows, and third lines once more; then fourth
    lines exported again with a corrected category, loaded as an update."""
    from spark_ledger.operators.versions import TableStore
    from spark_ledger.plans.raw_exports import export_root, write_bank_exports
    from spark_ledger.session import release
    from spark_ledger.streaming.incremental import TRANSACTIONS, run_incremental
    t = Tables(spark, sf_dir)
    line = F.split_part("txn_id", F.lit("-"), F.lit(2)).cast("int")
    later = (line == 1) & ~F.col("txn_id").endswith("-oc")
    root = export_root(t, "incremental")
    tx = t.transactions
    for n, (rows, category, rules) in enumerate([(tx.filter(~later), None, t.category_rules),
                                                 (tx.filter(later | (line == 3)), None, t.category_rules),
                                                 (tx.filter(line == 4), "Corrected", None)]):
        raw = write_bank_exports(t, rows, category)
        release(spark)
        run_incremental(spark, raw, f"{root}/tables", f"{root}/_checkpoint{n}", rules, reprocess=category is not None)
        release(spark, raw)                                     # a drop that is loaded is not read again
        TableStore(spark, f"{root}/tables").recover(1)          # nor are versions that later ones replace
    return TableStore(spark, f"{root}/tables").read(TRANSACTIONS).select(
        "txn_id", "date", "account_id", "amount", "amount_cents", "description", "category")
