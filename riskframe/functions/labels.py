"""Label and recoding expressions (E7–E10, E13, E15, B10) — pure Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.core import col

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# loan-status substrings, checked in this order (good first, then bad)
GOOD_STATUS = ["fully paid", "current", "good loan", "no default", "paid", "completed"]
BAD_STATUS = ["charged off", "default", "late", "bad loan", "delinquent", "chargedoff", "defaulted"]
# short variant: only these are good, everything else (null included) is bad
GOOD_STATUS_SHORT = ["fully paid", "current", "good loan"]
# form translations (Russian form values -> API values); unknown values pass through
EMP_LENGTH_RU = {"< 1 года": "< 1 year", "1 год": "1 year", "2 года": "2 years", "3 года": "3 years",
                 "4 года": "4 years", "5 лет": "5 years", "6 лет": "6 years", "7 лет": "7 years",
                 "8 лет": "8 years", "9 лет": "9 years", "10+ лет": "10+ years", "н/д": "n/a"}
HOME_OWNERSHIP_RU = {"АРЕНДА": "RENT", "СОБСТВЕННОСТЬ": "OWN", "ИПОТЕКА": "MORTGAGE", "ДРУГОЕ": "OTHER"}
PURPOSE_RU = {"Консолидация долгов": "debt_consolidation", "Кредитная карта": "credit_card",
              "Ремонт дома": "home_improvement", "Крупная покупка": "major_purchase",
              "Малый бизнес": "small_business", "Другое": "other"}
# card form values -> codes (unknown -> null, the caller rejects them)
SEX_RU = {"Мужской": 1, "Женский": 2}
MARRIAGE_RU = {"Неизвестно": 0, "Женат/Замужем": 1, "Не женат/Не замужем": 2, "Другое": 3}
EDUCATION_RU = {"Аспирантура": 1, "Университет": 2, "Средняя школа": 3, "Другое": 4}
# association-strength scales (English renderings of the reference's labels)
CHEDDOCK_SCALE = [(0.1, "very weak"), (0.3, "weak"), (0.5, "moderate"), (0.7, "noticeable"),
                  (0.9, "high"), (1.0, "very high")]          # value < bound -> label; else "perfect"
CRAMERS_SCALE = [(0.2, "weak"), (0.6, "moderate")]            # value <= bound -> label; > 0.6 "strong"
PHIK_SCALE = [(0.2, "weak"), (0.4, "moderate"), (0.6, "noticeable"), (0.8, "high")]  # <=; else "very high"
# pay-status columns of the card table
PAY_COLUMNS = ["pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6"]


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def loan_status_target(c: Column) -> Column:
    """0 = good, 1 = bad.  Good substrings win over bad ones (so 'unpaid'
    is good, as in the reference); '0'/'0.0' -> 0; null and unknown -> 1."""
    s = F.lower(F.trim(c.cast("string")))
    expr = F.when(c.isNull(), 1)
    for w in GOOD_STATUS:
        expr = expr.when(s.contains(w), 0)
    for w in BAD_STATUS:
        expr = expr.when(s.contains(w), 1)
    return expr.when(s.isin("0", "0.0"), 0).when(s.isin("1", "1.0"), 1).otherwise(1).cast("int")


def loan_status_target_short(c: Column) -> Column:
    """Good only for the three short-list substrings; everything else 1."""
    s = F.lower(F.trim(c.cast("string")))
    good = None
    for w in GOOD_STATUS_SHORT:
        good = s.contains(w) if good is None else good | s.contains(w)
    return F.when(F.coalesce(good, F.lit(False)), 0).otherwise(1).cast("int")


def binary_numeric_target(c: Column, is_subset_01: Column | bool) -> Column:
    """E10 numeric branch: keep when the column is ⊆ {0,1}, else ``x > 0``."""
    flag = F.lit(is_subset_01) if isinstance(is_subset_01, bool) else is_subset_01
    return F.when(flag, c.cast("int")).otherwise((c > 0).cast("int"))


def cap(c: Column, top: int) -> Column:
    """Values >= top become top, others unchanged (null stays null)."""
    return F.when(c >= top, F.lit(top)).otherwise(c)


def marriage_code(c: Column) -> Column:
    """E7b marriage: 0..3 kept, anything else 0."""
    return F.when(c.isin(0, 1, 2, 3), c).otherwise(0).cast("int")


def education_code(c: Column) -> Column:
    """E7b education: 1..4 kept, 5, 6 and anything else 0."""
    return F.when(c.isin(1, 2, 3, 4), c).otherwise(0).cast("int")


def pay_status_cast(c: Column) -> Column:
    """The latest pay status as a whole number."""
    return c.cast("int")


def pay_status(columns: list[str]) -> Column:
    """Any pay column > 0 -> 1; else any == 0 -> 0; else -1 (null-safe);
    no pay column at all -> 0."""
    if not columns:
        return F.lit(0)
    pos = [F.coalesce(col(c) > 0, F.lit(False)) for c in columns]
    zero = [F.coalesce(col(c) == 0, F.lit(False)) for c in columns]
    any_pos = pos[0]
    for p in pos[1:]:
        any_pos = any_pos | p
    any_zero = zero[0]
    for z in zero[1:]:
        any_zero = any_zero | z
    return F.when(any_pos, 1).when(any_zero, 0).otherwise(-1).cast("int")


def as_category_text(c: Column) -> Column:
    """Truncate to int, then text (the categorical encoding of codes)."""
    return c.cast("int").cast("string")


def translate(c: Column, mapping: dict, passthrough: bool = True) -> Column:
    """Dictionary lookup; unknown values pass through (or become null)."""
    hit = F.element_at(_map(mapping), c)
    return F.coalesce(hit, c) if passthrough else hit


def cheddock(c: Column) -> Column:
    """E15 Cheddock label of |r|."""
    expr = None
    for bound, label in CHEDDOCK_SCALE:
        expr = F.when(c < bound, label) if expr is None else expr.when(c < bound, label)
    return F.when(c.isNull(), F.lit(None)).otherwise(expr.otherwise("perfect"))


def cramers_label(c: Column) -> Column:
    expr = None
    for bound, label in CRAMERS_SCALE:
        expr = F.when(c <= bound, label) if expr is None else expr.when(c <= bound, label)
    return expr.when(c > 0.6, "strong").otherwise("none")


def phik_label(c: Column) -> Column:
    expr = None
    for bound, label in PHIK_SCALE:
        expr = F.when(c <= bound, label) if expr is None else expr.when(c <= bound, label)
    return F.when(c.isNull(), F.lit(None)).otherwise(expr.otherwise("very high"))
