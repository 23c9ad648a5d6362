"""Category assignment: ingest-time first-match rules (J-1), the full
override > rule > base categorization (J-2) and the override diagnostic (J-19).

Rules and overrides are user configuration.  ``method="compiled"`` reads them
on the driver and compiles them into one ``CASE WHEN`` chain, so matching is a
map-only projection without join or shuffle.  ``method="join"`` keeps them
distributed: an index over q-grams (``operators.text_match``) proposes pairs of
distinct descriptions and patterns, checked hits are joined back by description.  Both take any number of rules and give
the same rows; the caller chooses, nothing depends on the table's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spark_ledger.functions import normalize_merchant, parse_bool
from spark_ledger.functions.flags import flexible_date
from spark_ledger.functions.money import parse_money
from spark_ledger.operators.identity import DESC_CANDIDATES
from spark_ledger.operators.text_match import match_texts

HELPER_COLS = ("desc_norm", "amount_key", "account_key", "date_key", "dupe_key", "rn")


# ---------------------------------------------------------------- J-2 -----

def prepare_rules(rules: DataFrame) -> DataFrame:
    """Normalized rule table: match_type, pattern (trim+lower), category,
    prio (a number; missing or not a number -> 9999), subscription (bool); blank categories removed."""
    cols = rules.columns
    prio = F.coalesce(F.col("priority").cast("string").try_cast("double"), F.lit(9999.0)) \
        if "priority" in cols else F.lit(9999.0)
    sub = parse_bool("subscription") if "subscription" in cols else F.lit(False)
    return (rules
            .filter(F.col("category").isNotNull() & (F.trim(F.col("category")) != ""))
            .select(F.coalesce(F.lower(F.col("match_type")), F.lit("contains")).alias("match_type"),
                    F.trim(F.lower(F.col("pattern"))).alias("pattern"),
                    F.col("category"),
                    prio.alias("prio"),
                    sub.alias("subscription")))


def _rule_sort_key(r):
    pat = r["pattern"]
    return (r["prio"], -(len(pat) if pat is not None else -1), r["category"], pat or "", r["subscription"])


def _rule_match(desc: Column, match_type: str, pattern) -> Column | None:
    if pattern is None:
        return None
    if match_type == "regex":
        return desc.rlike(pattern)
    if match_type == "contains":
        return F.locate(pattern, desc) > 0 if pattern != "" else F.lit(True)
    return None


def _first_hit(pairs) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... END over (cond, value) pairs."""
    expr = None
    for cond, val in pairs:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr if expr is not None else F.lit(None)


def prepare_overrides(overrides: DataFrame) -> DataFrame:
    """Typed override table: text flags, ISO or m/d/Y dates, amounts with ``$``,
    commas or parentheses."""
    def of(name, make):
        return make(name) if name in overrides.columns else F.lit(None)
    return overrides.select(
        parse_bool("active").alias("active"),
        of("date", flexible_date).cast("date").alias("date"),
        F.col("description_regex"),
        of("amount", parse_money).cast("double").alias("amount"),
        F.col("category"),
        (parse_bool("subscription") if "subscription" in overrides.columns else F.lit(False)).alias("subscription"))


def _override_match(df: DataFrame, desc: Column, o) -> Column | None:
    if o["description_regex"] is None:
        return None
    cond = desc.rlike(o["description_regex"])
    if o["date"] is not None and "date" in df.columns:
        cond = cond & (F.col("date") == F.lit(o["date"]))
    if o["amount"] is not None:
        if "amount_cents" in df.columns:
            cents = int(_round_half_away(abs(o["amount"]) * 100))
            cond = cond & (F.abs(F.col("amount_cents")) == F.lit(cents))
        elif "amount" in df.columns:
            cond = cond & (F.abs(F.col("amount")) == F.lit(abs(o["amount"])))
    return cond


def _round_half_away(x: float) -> float:
    import math
    return math.floor(x + 0.5) if x >= 0 else -math.floor(-x + 0.5)


def categorize(txns: DataFrame, rules: DataFrame | None = None, overrides: DataFrame | None = None,
               method: str = "compiled", texts_of: DataFrame | None = None) -> DataFrame:
    """J-2: ``transactions_with_category``.

    ``texts_of`` (method ``join``): rows with the same description columns that
    hold every description of ``txns``, maybe more, and are cheaper to read (those
    before a dedupe); the distinct descriptions are taken from them.

    category = best active override (by category name) > best rule
    (priority, longer pattern, category) > the row's own category >
    'Uncategorized'; is_subscription follows the same precedence, default
    FALSE.  Only ``regex`` (partial match) and ``contains`` rules apply.
    ``subcategory``/``is_transfer`` are dropped from the output.
    """
    src_cols = [c for c in txns.columns if c not in HELPER_COLS]
    out_cols = [c for c in src_cols if c not in ("subcategory", "is_transfer", "category")]
    descs = [F.col(c) for c in DESC_CANDIDATES if c in src_cols]
    desc_src = F.lower(F.coalesce(*descs, F.lit(""))) if descs else F.lit("")
    base_cat = F.col("category") if "category" in src_cols else F.lit("Uncategorized")

    df = txns.select(*src_cols).withColumn("__desc_src", desc_src)
    none = F.lit(None).cast("struct<category:string,subscription:boolean>")
    rule_hit, ov_hit = none, none
    prepared = prepare_rules(rules) if rules is not None and all(
        c in rules.columns for c in ("match_type", "pattern", "category")) else None
    active = prepare_overrides(overrides).where("active") if overrides is not None and all(
        c in overrides.columns for c in ("active", "description_regex", "amount", "category")) else None
    if method == "join":
        texts = (df if texts_of is None else texts_of.select(desc_src.alias("__desc_src"))).select("__desc_src").distinct()
        if prepared is not None:
            df, rule_hit = _rules_by_join(df, texts, prepared), F.col("__rule_hit")
        if active is not None:
            df, ov_hit = _overrides_by_join(df, texts, active), F.col("__ov_hit")
    elif method == "compiled":
        if prepared is not None:
            pairs = [(_rule_match(F.col("__desc_src"), r["match_type"], r["pattern"]), _hit(r))
                     for r in sorted(prepared.collect(), key=_rule_sort_key)]
            rule_hit = F.coalesce(_first_hit([x for x in pairs if x[0] is not None]), none)
        if active is not None:
            ovs = sorted(active.collect(), key=lambda o: (o["category"] is None, o["category"] or "", o["subscription"]))
            pairs = [(_override_match(df, F.col("__desc_src"), o), _hit(o)) for o in ovs]
            ov_hit = F.coalesce(_first_hit([x for x in pairs if x[0] is not None]), none)
    else:
        raise ValueError(f"method {method!r} is neither 'compiled' nor 'join'")

    df = df.withColumn("__ov", ov_hit).withColumn("__rule", rule_hit)
    category = F.coalesce(F.col("__ov.category"), F.col("__rule.category"), base_cat, F.lit("Uncategorized"))
    is_sub = F.coalesce(F.col("__ov.subscription"), F.col("__rule.subscription"), F.lit(False))
    return df.select(category.alias("category"), is_sub.alias("is_subscription"), *out_cols)


def _hit(r) -> Column:
    return F.struct(F.lit(r["category"]).cast("string").alias("category"), F.lit(bool(r["subscription"])).alias("subscription"))


def _rules_by_join(df: DataFrame, texts: DataFrame, prepared: DataFrame) -> DataFrame:
    """Best rule per distinct description, joined back by the description."""
    patterns = prepared.withColumnRenamed("match_type", "kind").withColumn("pattern", F.col("pattern").cast("string"))
    found = match_texts(texts, "__desc_src", patterns)
    rank = F.struct("p.prio", -F.length("p.pattern"), "p.category", "p.pattern", "p.subscription")
    hit = F.struct(F.col("p.category").alias("category"), F.col("p.subscription").alias("subscription"))
    return df.join(found.groupBy("__desc_src").agg(F.min_by(hit, rank).alias("__rule_hit")), "__desc_src", "left")


def _overrides_by_join(df: DataFrame, texts: DataFrame, active: DataFrame) -> DataFrame:
    """Overrides whose pattern fits, per distinct description and in their
    order; each row takes the first one whose date and amount fit too."""
    patterns = active.withColumnRenamed("description_regex", "pattern").withColumn("kind", F.lit("regex"))
    found = match_texts(texts, "__desc_src", patterns)
    entry = F.struct(F.col("p.category").isNull().alias("last"), F.col("p.category").alias("category"),
                     F.col("p.subscription").alias("subscription"), F.col("p.date").alias("date"), F.col("p.amount").alias("amount"))
    fits = found.groupBy("__desc_src").agg(F.sort_array(F.collect_list(entry)).alias("__ovs"))

    def ok(e):
        cond = F.lit(True)
        if "date" in df.columns:
            cond = cond & (e["date"].isNull() | (e["date"] == F.col("date")))
        if "amount_cents" in df.columns:
            cond = cond & (e["amount"].isNull() | (F.floor(F.abs(e["amount"]) * 100 + 0.5) == F.abs(F.col("amount_cents"))))
        elif "amount" in df.columns:
            cond = cond & (e["amount"].isNull() | (F.abs(e["amount"]) == F.abs(F.col("amount"))))
        return cond
    first = F.get(F.filter("__ovs", ok), F.lit(0))
    return df.join(fits, "__desc_src", "left").withColumn("__ov_hit", F.when(first.isNotNull(), F.struct(
        first["category"].alias("category"), first["subscription"].alias("subscription")))).drop("__ovs")


# ---------------------------------------------------------------- J-1 -----

def prepare_ingest_rules(rules: DataFrame) -> list[dict]:
    """Ingest rules: priority (bad/missing -> 1000), lower match_type, sign
    ('any' default), optional account; sorted by priority, ties in table order."""
    rows = rules.collect()
    out = []
    for i, r in enumerate(rows):
        d = r.asDict()

        def txt(k, default=""):
            v = d.get(k)
            return default if v is None else str(v)
        try:
            prio = float(txt("priority", ""))
        except ValueError:
            prio = 1000
        sign = txt("sign", "any").strip().lower() or "any"
        acct = txt("account_id").strip() or None
        out.append(dict(idx=i, priority=prio, match_type=txt("match_type", "contains").strip().lower(),
                        pattern=txt("pattern"), category=txt("category").strip(), sign=sign, account_id=acct))
    out.sort(key=lambda r: (r["priority"], r["idx"]))
    return out


def apply_rules_first_match(txns: DataFrame, rules: DataFrame) -> DataFrame:
    """J-1: first matching rule (priority order) overwrites ``category``.

    ``contains`` and ``regex`` are case-insensitive regex searches on the
    description; ``merchant_norm`` is a literal search of the lower-cased
    pattern in the normalized merchant; optional account and sign filters.
    """
    desc = F.col("description")
    merchant = normalize_merchant("description")
    pairs = []
    for r in prepare_ingest_rules(rules):
        mt, pat = r["match_type"], r["pattern"]
        if mt in ("contains", "regex"):
            cond = F.coalesce(desc.rlike("(?i)" + pat), F.lit(False))
        elif mt == "merchant_norm":
            cond = F.locate(pat.lower(), merchant) > 0 if pat else F.lit(True)
        else:
            continue
        if r["account_id"]:
            cond = cond & (F.upper(F.col("account_id").cast("string")) == r["account_id"].upper())
        if r["sign"] == "positive":
            cond = cond & (F.col("amount") > 0)
        elif r["sign"] == "negative":
            cond = cond & (F.col("amount") < 0)
        pairs.append((F.coalesce(cond, F.lit(False)), F.lit(r["category"])))
    base = F.col("category") if "category" in txns.columns else F.lit(None).cast("string")
    if not pairs:
        return txns if "category" in txns.columns else txns.withColumn("category", base)
    return txns.withColumn("category", F.coalesce(_first_hit(pairs), base))


# ---------------------------------------------------------------- J-19 ----

def override_diagnostics(txns: DataFrame, overrides: DataFrame) -> DataFrame:
    """J-19: each transaction with every active override whose date is null or
    equal, plus the individual match flags.

    The override list is compiled into an array literal; each row keeps the
    applicable entries and explodes them — map-only, no join."""
    ovs = prepare_overrides(overrides).where("active").collect()
    descs = [F.col(c) for c in DESC_CANDIDATES if c in txns.columns]
    desc_src = F.lower(F.coalesce(*descs, F.lit("")))
    if not ovs:
        return txns.sparkSession.createDataFrame([], "txn_id string")
    b = txns.select("txn_id", F.col("date").alias("b_date"), F.col("amount").alias("b_amount"),
                    desc_src.alias("desc_src"))
    # Each override's regex is a literal, so it is compiled once per task.
    arr = F.array(*[F.struct(F.lit(o["date"]).cast("date").alias("o_date"),
                             F.lit(o["amount"]).cast("double").alias("o_amount"),
                             F.lit(o["description_regex"]).cast("string").alias("description_regex"),
                             F.lit(o["category"]).cast("string").alias("o_category"),
                             (F.col("desc_src").rlike(o["description_regex"]) if o["description_regex"] is not None
                              else F.lit(None).cast("boolean")).alias("m_regex")) for o in ovs])
    applicable = F.filter(arr, lambda o: o["o_date"].isNull() | (o["o_date"] == F.col("b_date")))
    x = b.withColumn("o", F.explode(applicable)).select("txn_id", "b_date", "b_amount", "desc_src", "o.*")
    return x.select(
        "txn_id", "b_date", "b_amount", "desc_src", "o_date", "o_amount", "description_regex", "o_category",
        "m_regex",
        (F.col("o_date").isNull() | (F.col("b_date") == F.col("o_date"))).alias("m_date"),
        (F.col("b_amount") == F.col("o_amount")).alias("m_amt_exact"),
        (F.abs(F.col("b_amount")) == F.abs(F.col("o_amount"))).alias("m_amt_abs"))
