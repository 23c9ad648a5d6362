from spark_ledger.functions.text import (  # noqa: F401
    normalize_merchant, normalize_merchant_v1, regexp_replace_first, desc_norm, slug_symbol, nullif_blank,
)
from spark_ledger.functions.money import (  # noqa: F401
    parse_money, to_cents, cents_to_amount, round_money, round_to, bround_money,
)
from spark_ledger.functions.flags import (  # noqa: F401
    parse_bool, flexible_date, date_from_filename, month_label, yyyymm, yyyymm_to_index, index_to_yyyymm,
)
from spark_ledger.functions.hashing import txn_id_sha256, txn_id_sha1  # noqa: F401
