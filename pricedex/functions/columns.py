"""Column-level building blocks. All are native Spark expressions (codegen, no Python at run time)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricedex import reference_data as R


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- parsing
def period_to_date(period) -> Column:
    """'YYYY-MM' -> first day of month; anything unparsable -> null."""
    return F.try_to_date(F.concat(F.trim(col_(period)), F.lit("-01")), "yyyy-MM-dd")


def flagged_number(raw) -> Column:
    """'119.8 p' -> 119.8, ':' / '' / junk -> null (P04). Letters and spaces are quality flags."""
    cleaned = F.trim(F.regexp_replace(col_(raw), r"[a-zA-Z\s]+", ""))
    return F.when(cleaned == "", F.lit(None).cast("double")).otherwise(cleaned.try_cast("double"))


def to_number(raw) -> Column:
    """Coerce to double, bad -> null."""
    return F.trim(col_(raw).cast("string")).try_cast("double")


def zero_pad(code, width: int = 6) -> Column:
    """Left-pad with zeros like str.zfill: never truncates a longer code."""
    s = F.trim(col_(code).cast("string"))
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


# ---------------------------------------------------------------- labels
def short_label(title) -> Column:
    """Short category label from a long series title."""
    t = col_(title)
    after_coicop = F.substring_index(t, R.TITLE_COICOP_MARKER, -1)
    after_country = F.substring_index(t, R.TITLE_COUNTRY_MARKER, -1)
    strip = lambda c: F.trim(F.replace(c, F.lit(R.TITLE_DISCONTINUED_SUFFIX), F.lit("")))
    return (
        F.when(t.isNull() | (t == ""), F.lit(R.UNKNOWN_LABEL))
        .when(F.instr(t, R.TITLE_COICOP_MARKER) > 0, strip(after_coicop))
        .when(F.instr(t, R.TITLE_COUNTRY_MARKER) > 0, strip(after_country))
        .otherwise(F.substring(t, 1, 100))
    )


def truncate100(c) -> Column:
    return F.substring(col_(c), 1, 100)


def category_from_tag(tag) -> Column:
    """'en:sweetened-spreads' -> 'sweetened-spreads'; null, or empty/'nan'/'None' once stripped -> 'non-classe' (P19)."""
    t = col_(tag)
    stripped = F.regexp_replace(t.cast("string"), r"^[a-z]{2}:", "")
    return F.when(t.isNull() | stripped.isin("", "nan", "None"), F.lit(R.UNCLASSIFIED_CATEGORY)).otherwise(stripped)


def slug(name) -> Column:
    """'00 - Ensemble' -> '00_ensemble' (F15)."""
    return F.regexp_replace(F.regexp_replace(F.lower(col_(name)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


# ---------------------------------------------------------------- predicates
def ilike_contains(c, pattern: str) -> Column:
    """Case-insensitive contains; '%' and '_' typed by the user keep their wildcard meaning."""
    return col_(c).ilike(f"%{pattern}%")


def all_of(preds) -> Column:
    """Conjunction of optional predicates; no predicate -> true."""
    preds = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def index_filters(source=None, category=None, date_from=None, date_to=None,
                  date_col="obs_date", category_col="category", source_col="source") -> Column:
    """The dynamic filter set of the index endpoints: source upper-cased, category contains, date bounds."""
    return all_of([
        (F.col(source_col) == source.upper()) if source else None,
        ilike_contains(category_col, category) if category else None,
        (F.col(date_col) >= F.lit(date_from).cast("date")) if date_from else None,
        (F.col(date_col) <= F.lit(date_to).cast("date")) if date_to else None,
    ])


# ---------------------------------------------------------------- exact rounding
def half_up_mean(c, digits: int) -> Column:
    """round(avg(c), digits) with decimal semantics (HALF_UP on the exact quotient).

    ``c`` must be a decimal column: sum is exact, the quotient keeps 14 fractional digits, so the result
    equals rounding the exact mean (what a numeric database returns) instead of rounding a double.
    """
    return F.round(F.sum(col_(c)) / F.count(col_(c)), digits)


# ---------------------------------------------------------------- request log
API_ENDPOINTS = tuple(label for _, _, label in R.ENDPOINT_RULES)


def endpoint_label(path) -> Column:
    """Normalise a request path to an endpoint label (M01); a path that no rule names is its own label."""
    p = col_(path)
    label = None
    for kind, value, name in R.ENDPOINT_RULES:
        hit = (p == value) if kind == "is" else p.startswith(value)
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return label.otherwise(p)


def error_class(status, path) -> Column:
    """HTTP status -> error type, null when the request is not an error."""
    s, p = col_(status), col_(path)
    return (
        F.when(s >= 500, F.lit("server_error"))
        .when((s == 404) & p.startswith("/api/"), F.lit("not_found"))
        .when(s == 422, F.lit("validation"))
        .when(s == 403, F.lit("unauthorized"))
    )


def half_even(c: Column, digits: int) -> Column:
    """A double rounded half to even by scaling it, in the same three steps wherever it runs."""
    scale = F.lit(float(10 ** digits))
    return F.rint(c * scale) / scale
