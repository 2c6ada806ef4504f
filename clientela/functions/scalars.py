"""Scalar rules of a sale line. Every function maps Columns to a Column and works on
batch and streaming frames alike."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientela import contracts as C


def coerce_int(col: Column, default: int | None = None, strict: bool = False) -> Column:
    """Integer cast. Strict casts raise on bad input; lenient ones fall back to `default`.
    Text with a fraction ("12.7") is truncated, as numbers read back from CSV carry ".0"."""
    if strict:
        return col.cast("long")
    whole = F.coalesce(col.try_cast("long"), col.try_cast("double").try_cast("long"))
    return whole if default is None else F.coalesce(whole, F.lit(default).cast("long"))


def coerce_double(col: Column) -> Column:
    """Number or null; NaN counts as missing."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def coerce_ts(col: Column, *formats: str) -> Column:
    """Timestamp or null. Formats are tried in turn; without any, the ISO cast is used."""
    if not formats:
        return col.try_cast("timestamp_ntz")
    tries = [F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def full_text(title: Column, descr: Column, null_safe: bool = True) -> Column:
    """Title and description in one text; `null_safe=False` gives null if either is null."""
    if null_safe:
        title, descr = F.coalesce(title, F.lit("")), F.coalesce(descr, F.lit(""))
    return F.concat(title, F.lit(" "), descr)


def contains(text: Column, part: str) -> Column:
    """Substring test that is false, not null, on null text."""
    return F.coalesce(text.contains(part), F.lit(False))


def pack_units(text: Column, kind: Column, default: int | None = 1) -> Column:
    """Units per pack, read off the text; other products always count as 1."""
    rule = F.when(kind == C.KIND_OTHER, 1)
    for mark, units in C.PACK_MARKS:
        rule = rule.when(contains(text, mark), units)
    return rule.otherwise(F.lit(default).cast("int"))


def presentation(text: Column, kind: Column, null_text: str | None = "Soft_pack") -> Column:
    """Box / Soft_pack / Otros Productos. `null_text=None` leaves null text unlabelled."""
    return (
        F.when(kind == C.KIND_OTHER, "Otros Productos")
        .when(text.isNull(), F.lit(null_text))
        .when(text.rlike(C.BOX_PATTERN), "Box")
        .otherwise("Soft_pack")
    )


def combo_flag(qty: Column, exclude_one: bool = True) -> Column:
    """1 for quantities that no full pack explains."""
    exempt = (*C.COMBO_EXEMPT, 1) if exclude_one else C.COMBO_EXEMPT
    odd_lot = ((qty < 10) | (qty % 2 != 0)) & ~qty.isin(*exempt)
    return F.when(odd_lot, 1).otherwise(0)


def period(ts: Column) -> Column:
    """Calendar month as YYYY-MM, cut from the ISO date, which is cheaper than a formatter."""
    return F.substring(ts.cast("date").cast("string"), 1, 7)


def carton_size(kind: Column, text: Column, special: str | None = None,
                exact: bool = False) -> Column:
    """Packs per carton. `special` names the one product sold in larger cartons.
    `exact` selects the older rule: only main products have a size and the special
    text must match whole."""
    hit = F.lit(False)
    if special is not None:
        hit = F.coalesce(text == special, F.lit(False)) if exact else contains(text, special)
    rule = F.when(hit, C.SPECIAL_CARTON_UNITS)
    if exact:
        return rule.when(kind == C.KIND_MAIN, C.CARTON_UNITS).otherwise(0)
    return rule.when(kind == C.KIND_OTHER, 1).otherwise(C.CARTON_UNITS)


def carton_count(qty: Column, size: Column) -> Column:
    """Cartons bought; a carton of size 0 counts as none."""
    return F.when(size > 0, qty.cast("double") / size).otherwise(F.lit(0.0))


def clean_title(col: Column) -> Column:
    """Drop leftovers of HTML escapes: a literal 'amp;' and the non-breaking space."""
    plain = F.replace(col, F.lit("amp;"), F.lit(""))
    return F.replace(plain, F.lit("\u00a0"), F.lit(" "))


def line_value(price: Column, qty: Column) -> Column:
    return (price * qty).cast("double")


def unit_price(total: Column, qty: Column) -> Column:
    """Price of one unit; 0 where there is no positive quantity."""
    return F.when(qty > 0, total.cast("double") / qty).otherwise(F.lit(0.0))


def round_money(col: Column, digits: int = 2) -> Column:
    """Half-even rounding to cents."""
    return F.bround(col, digits)


def map_codes(col: Column, mapping: dict) -> Column:
    """Small fixed code -> label mapping; unmapped codes give null."""
    rule = None
    for code, label in mapping.items():
        rule = F.when(col == code, label) if rule is None else rule.when(col == code, label)
    return rule if rule is not None else F.lit(None).cast("string")


def pattern_label(multi: Column, ff: Column, default: str | None = "Indefinido") -> Column:
    """The four consumption patterns: full-flavour or not, one brand or several."""
    return (
        F.when((multi == 0) & (ff == 1), "FF - Monomarca")
        .when((multi == 1) & (ff == 1), "FF - Multimarca")
        .when((multi == 0) & (ff == 0), "No FF - Monomarca")
        .when((multi == 1) & (ff == 0), "No FF - Multimarca")
        .otherwise(F.lit(default))
    )


def gap_bucket(days: Column) -> Column:
    """Band of the days between two purchases."""
    rule = F.when(days.isNull(), C.GAP_FIRST)
    for bound, label in C.GAP_BOUNDS:
        rule = rule.when(days <= bound, label)
    return rule.otherwise(C.GAP_LONGEST)


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from start to end, which is not the calendar-day difference."""
    return F.extract(F.lit("DAY"), end - start)


def snapshot_date(col: Column) -> Column:
    """Segmentation dates were stored as 2024-09, 2024-11-01 or a timestamp: read them all.
    A bare month means its first day."""
    text = col.cast("string")
    month = F.when(text.rlike(r"^\d{4}-\d{2}$"), F.concat(text, F.lit("-01"))).otherwise(text)
    return month.try_cast("timestamp_ntz").cast("date")


def month_tag(date: Column, names: tuple = C.MONTH_ABBR_ES) -> Column:
    """File tag of a month, such as AGO_2024."""
    labels = F.array(*[F.lit(n) for n in names])
    return F.concat(F.element_at(labels, F.month(date)), F.lit("_"), F.year(date).cast("string"))


def run_calendar(as_of: Column, names: tuple = C.MONTH_ABBR_ES) -> dict[str, Column]:
    """Labels of a monthly run started on `as_of`: it processes the month of the day before
    and reads the history of the month before that."""
    process = F.date_sub(as_of.cast("date"), 1)
    previous = F.date_sub(F.trunc(process, "month"), 1)
    return {
        "process_date": process,
        "process_month": period(process),
        "process_tag": month_tag(process, names),
        "previous_month": period(previous),
        "previous_tag": month_tag(previous, names),
    }
