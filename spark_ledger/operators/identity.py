"""Transaction identity and duplicate handling (C-1 ... C-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from spark_ledger.functions import desc_norm, normalize_merchant, txn_id_sha1, txn_id_sha256
from spark_ledger.operators.common import first_present, keep_first
from spark_ledger.operators.ranking import numbered

DESC_CANDIDATES = ("clean_description", "description", "memo", "payee", "name")
ACCOUNT_CANDIDATES = ("account_id", "account", "account_name", "institution", "card_last4",
                      "account_last4", "source", "source_file")
DATE_CANDIDATES = ("post_date", "transaction_date", "date")
TXN_ID_CANDIDATES = ("txn_id", "transaction_id", "reference_id", "id")
SETTLED_STATUSES = ("posted", "complete", "final", "settled")


def _coalesce_cols(df: DataFrame, candidates, default=None):
    cols = [F.col(c) for c in first_present(df, candidates)]
    if default is not None:
        cols.append(F.lit(default))
    if not cols:
        return F.lit(None)
    return F.coalesce(*cols) if len(cols) > 1 else cols[0]


def description_source(df: DataFrame):
    """``COALESCE(<description-like columns>, '')``."""
    return _coalesce_cols(df, DESC_CANDIDATES, "")


def with_dedupe_key(df: DataFrame, norm_mode: str = "first") -> DataFrame:
    """Add desc_norm, amount_key, account_key, date_key and the md5 dupe_key.

    The key uses |amount|, so a same-day refund collapses with its charge,
    and a null date gives a null key (all such rows form one group).
    """
    dn = desc_norm(description_source(df), norm_mode)
    if "amount_cents" in df.columns:
        amount_key = F.abs(F.col("amount_cents"))
    elif "amount" in df.columns:
        amount_key = F.round(F.abs(F.col("amount")) * 100).cast("long")
    else:
        amount_key = F.lit(0).cast("long")
    acct = _coalesce_cols(df, ACCOUNT_CANDIDATES, "")
    dates = first_present(df, DATE_CANDIDATES)
    date_key = F.coalesce(*[F.col(c) for c in dates]) if dates else F.lit("1970-01-01").cast("date")
    out = (df.withColumn("desc_norm", dn)
             .withColumn("amount_key", amount_key)
             .withColumn("account_key", acct)
             .withColumn("date_key", date_key))
    key = F.md5(F.concat(F.col("account_key"), F.lit("|"), F.col("date_key").cast("string"), F.lit("|"),
                         F.col("amount_key").cast("string"), F.lit("|"), F.col("desc_norm")))
    return out.withColumn("dupe_key", key)


def dedupe_transactions(txns: DataFrame, norm_mode: str = "first") -> DataFrame:
    """C-8: collapse export/pending duplicates, one row per dupe_key.

    Order inside a key: settled status first, rows whose normalized text
    mentions 'pending' last, latest date, then ids ascending (nulls last).
    """
    df = with_dedupe_key(txns, norm_mode)
    rank = F.lit(0)
    if "status" in df.columns:
        rank = F.when(F.lower(F.col("status")).isin(*SETTLED_STATUSES), 0).otherwise(1)
    rank = rank + F.when(F.col("desc_norm").like("%pending%"), 1).otherwise(0)
    order = [rank.asc(), F.col("date_key").desc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in first_present(df, TXN_ID_CANDIDATES)]
    # the key's 16 bytes travel, not their 32 digits
    out = keep_first(df.withColumn("__key", F.unhex("dupe_key")).drop("dupe_key"), ["__key"], order)
    return out.select(*(F.lower(F.hex("__key")).alias(c) if c == "dupe_key" else c for c in df.columns))


def is_orig_co(desc_col="description"):
    return F.coalesce(F.upper(F.col(desc_col)).contains("ORIG CO"), F.lit(False))


def drop_pending_with_settled(txns: DataFrame) -> DataFrame:
    """C-7: delete 'ORIG CO' pending rows that have a settled row with the same
    (account_id, amount_cents, date).

    Written as distinct settled keys (partially aggregated, so a hot key
    costs one row per map task) and a left-anti join of the pending rows;
    AQE splits a skewed pending side.
    """
    keys = ["account_id", "amount_cents", "date"]
    pend = is_orig_co()
    settled = txns.filter(~pend).select(*keys).dropDuplicates()
    pending_kept = txns.filter(pend).join(settled, keys, "left_anti")
    return txns.filter(~pend).unionByName(pending_kept)


def drop_pending_in_file(txns: DataFrame, file_col: str = "source_file") -> DataFrame:
    """C-6: inside one file, drop pending rows of a (account, date, cents) group
    that also holds a non-pending row.

    The group flags are a partial (map-side) aggregate joined back on the
    group key, so even a group holding a large share of the rows is reduced
    to one row per map task before the shuffle (AQE splits a hot join key)."""
    keys = [c for c in (file_col,) if c in txns.columns] + ["account_id", "date", "amount_cents"]
    t = txns.withColumn("__p", is_orig_co().cast("int"))
    flags = t.groupBy(*keys).agg(F.max("__p").alias("__any"), F.min("__p").alias("__all"))
    mixed = flags.filter((F.col("__any") == 1) & (F.col("__all") == 0)).select(*keys)
    pending = t.filter(F.col("__p") == 1).join(mixed, keys, "left_anti")
    return t.filter(F.col("__p") == 0).unionByName(pending).drop("__p")


#: groups are counted in this many buckets; one with more rows than both of these is hot
BUCKETS, HOT_ROWS, HOT_SHARE = 65_536, 10_000, 1 / 200


def _hot_buckets(df: DataFrame, bucket) -> list[int]:
    """Buckets with more rows than an ordinary task should get (at most 200)."""
    n = df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    r = n.agg(F.sum("n").alias("total"), F.collect_list(F.when(F.col("n") > HOT_ROWS, F.struct("b", "n"))).alias("large")).first()
    return sorted(x["b"] for x in r["large"] if x["n"] > r["total"] * HOT_SHARE)


def sequence_within(df: DataFrame, keys: list[str], order_col, name: str, base: int = 1, spread_by: list[str] | None = None) -> DataFrame:
    """Row number (starting at ``base``) within each ``keys`` group, null keys
    included, by one order column or several; a column of any type.

    Groups are counted first, in buckets of ``spread_by`` (keys that are cheap to
    compute, else all of them).  Rows of hot buckets are numbered in ranges of the
    order (``operators.ranking``), so a group that holds a third of all rows is
    spread over many tasks; all others take one shuffle and nothing is written.
    Rows that are equal in all order columns may come in any order."""
    columns = [order_col] if isinstance(order_col, str) else list(order_col)
    order = [F.col(c).asc_nulls_last() for c in columns]
    bucket = F.pmod(F.xxhash64(*(spread_by or keys)), F.lit(BUCKETS))
    hot = _hot_buckets(df, bucket)
    df = df.drop(name)

    def plain(rows):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn(name, place.cast("long") + F.lit(base - 1))
    if not hot:
        return plain(df)
    return plain(df.where(~bucket.isin(hot))).unionByName(numbered(df.where(bucket.isin(hot)), keys, order, name, base))


def assign_txn_ids(df: DataFrame, order_col: str = "row_idx", file_col: str = "source_file") -> DataFrame:
    """C-1 + C-2: 1-based dup_seq within (file, date, account, cents, merchant)
    in row order, then txn_id = sha256 of the five fields."""
    if "merchant_norm" not in df.columns:
        df = df.withColumn("merchant_norm", normalize_merchant("description"))
    keys = [c for c in (file_col,) if c in df.columns] + ["date", "account_id", "amount_cents", "merchant_norm"]
    df = sequence_within(df, keys, order_col, "dup_seq", base=1, spread_by=keys[:-1])     # all but the merchant
    return df.withColumn("txn_id", txn_id_sha256("date", "account_id", "amount_cents", "merchant_norm", "dup_seq"))


def assign_txn_ids_v1(df: DataFrame, order_col: str = "row_idx", file_col: str = "source_file") -> DataFrame:
    """C-3: 0-based dup_seq and sha1 id over (date, account, merchant, cents);
    rows of several files come in file order, then in row order."""
    keys = ["date", "account_id", "merchant_norm", "amount_cents"]
    df = sequence_within(df, keys, [*(c for c in (file_col,) if c in df.columns), order_col], "dup_seq", base=0,
                         spread_by=[k for k in keys if k != "merchant_norm"])
    return df.withColumn("txn_id", txn_id_sha1("date", "account_id", "merchant_norm", "amount_cents", "dup_seq"))


def batch_key(df: DataFrame) -> DataFrame:
    """C-4 key: date | account | round(amount, 2) | merchant_norm(description)."""
    return (df.withColumn("_k_amount", F.round(F.col("amount"), 2))
              .withColumn("_k_merchant", normalize_merchant("description")))


BATCH_KEY = ["date", "account_id", "_k_amount", "_k_merchant"]


def dedupe_batch(df: DataFrame, order_col: str | list[str] = "row_idx") -> DataFrame:
    """C-4: keep the first row of each batch key (row order; of several files, file
    order first)."""
    order = [order_col] if isinstance(order_col, str) else order_col
    return keep_first(batch_key(df), BATCH_KEY, [F.col(c).asc_nulls_last() for c in order]).drop("_k_amount", "_k_merchant")


def anti_batch_dedupe(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """C-5: drop batch rows whose key already exists in the normalized store.

    Null keys never match (SQL equality), as in a join."""
    ek = batch_key(existing).select(*BATCH_KEY).dropDuplicates()
    return batch_key(batch).join(ek, BATCH_KEY, "left_anti").drop("_k_amount", "_k_merchant")


def newest_file_wins(df: DataFrame, keys=("as_of_date", "account_id", "symbol"), mtime_col: str = "file_mtime",
                     path_col: str = "source_file", row_col: str | None = None) -> DataFrame:
    """C-9: per key keep the row from the newest file (ties: larger path, then
    the first row by ``row_col``)."""
    order = [F.col(mtime_col).desc_nulls_last(), F.col(path_col).desc_nulls_last()]
    return keep_first(df, list(keys), order + ([F.col(row_col).asc_nulls_last()] if row_col else []))
