"""Boolean and date parsing helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted truthy spellings.
TRUTHY = ["1", "true", "t", "yes", "y"]
TRUTHY_NARROW = ["1", "true"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_bool(c, truthy=TRUTHY) -> Column:
    """Text/number/bool -> BOOLEAN; anything not truthy (incl. null) -> FALSE."""
    s = F.lower(F.trim(_c(c).cast("string")))
    return F.coalesce(s.isin(*truthy), F.lit(False))


#: accepted date forms besides ISO ("/" and blanks count as "-", a time of day
#: is ignored): shape of the text -> the same as year-month-day
DATE_FORMS = {
    r"^(\d{1,2})-(\d{1,2})-(\d{4})$": "$3-$1-$2",
    r"^(\d{1,2})-(\d{1,2})-(\d{2})$": "20$3-$1-$2",
    r"^(\d{4})(\d{2})(\d{2})$": "$1-$2-$3",
    r"^([A-Za-z]{3})[A-Za-z]{0,6}-(\d{1,2}),-(\d{4})$": "$3-$1-$2",
    r"^(\d{1,2})-([A-Za-z]{3})-(\d{4})$": "$3-$2-$1",
}


def _other_date(s: Column) -> Column:
    s = F.translate(F.regexp_replace(s, r"[ T]\d{1,2}:\d{2}.*$", ""), "/ ", "--")
    for shape, form in DATE_FORMS.items():
        s = F.regexp_replace(s, shape, form)
    s = F.when(s.rlike(r"^\d{4}-\w{1,3}-\d{1,2}$"), s)
    return F.coalesce(s.try_cast("date"), F.try_to_date(F.initcap(s), "yyyy-MMM-d"))


def flexible_date(c) -> Column:
    """A full date in ISO form or one of ``DATE_FORMS``; anything else (a bare
    year, an impossible day) is null.  ISO and month/day/year texts, nearly all
    there are, are cast at once; the other forms are tried only for the rest."""
    s = F.trim(_c(c).cast("string"))
    iso = (F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
    parts = F.split(s, "/")
    slashed = (F.size(parts) == 3) & (F.length(F.try_element_at(parts, F.lit(3))) == 4) & (F.length(F.try_element_at(parts, F.lit(1))) <= 2)
    return F.when(iso, s.try_cast("date")).when(slashed, F.try_to_date(s, "M/d/yyyy")).otherwise(F.when(s != "", _other_date(s)))


def date_from_filename(path) -> Column:
    """Date in a file name: YYYY-MM-DD, then MM-DD-YYYY, then YYYYMMDD."""
    name = F.regexp_extract(_c(path), "([^/]*)$", 1)

    def ymd(pat: str, y: int, m: int, d: int) -> Column:
        got = F.regexp_extract(name, pat, 0)
        return F.when(got != "", F.try_to_date(
            F.concat_ws("-", F.regexp_extract(name, pat, y), F.regexp_extract(name, pat, m),
                        F.regexp_extract(name, pat, d)), "yyyy-MM-dd"))

    return F.coalesce(
        ymd(r"(\d{4})-(\d{2})-(\d{2})", 1, 2, 3),
        ymd(r"(\d{2})-(\d{2})-(\d{4})", 3, 1, 2),
        ymd(r"(\d{4})(\d{2})(\d{2})", 1, 2, 3),
    )


def month_label(c) -> Column:
    """DATE -> 'YYYY-MM'."""
    return F.date_format(_c(c), "yyyy-MM")


def yyyymm(c) -> Column:
    return (F.year(_c(c)) * 100 + F.month(_c(c))).cast("int")


def yyyymm_to_index(c) -> Column:
    """yyyymm -> months since year 0 (so +1 is the next month)."""
    return (F.floor(_c(c) / 100) * 12 + (_c(c) % 100) - 1).cast("int")


def index_to_yyyymm(c) -> Column:
    return (F.floor(_c(c) / 12) * 100 + (_c(c) % 12) + 1).cast("int")
