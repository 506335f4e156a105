"""Scalar column functions.

All of them compose ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Whole-value recodes applied to the case facts.
DISTRICT_CODE_RECODE = {"05354": "05334"}
DISTRICT_NAME_RECODE = {
    "LK Göttingen (alt)": "LK Göttingen",
    "LK Aachen": "StadtRegion Aachen",
}
UNKNOWN_TEXT = "unbekannt"
UNKNOWN_LABEL = "keine Information"
# Representative age per age band.
AGE_MIDPOINTS = {
    "A00-A04": 2.0,
    "A05-A14": 9.5,
    "A15-A34": 24.5,
    "A35-A59": 47.0,
    "A60-A79": 69.5,
    "A80+": 85.0,
    "keine Information": 44.5,
}
# Period buckets: (label, exclusive upper bound). An int bound means
# "max date minus that many days"; the first matching bucket wins.
PERIOD_BOUNDS = [
    ("1: 01.2020 - 02.2020", dt.date(2020, 3, 1)),
    ("2: 03.2020 - 05.2020", dt.date(2020, 6, 1)),
    ("3: 06.2020 - 09.2020", dt.date(2020, 10, 1)),
    ("4: 10.2020 - 02.2021", dt.date(2021, 3, 1)),
    ("5: 03.2021 - 05.2021", dt.date(2021, 6, 1)),
    ("6: 06.2021 - 09.2021", dt.date(2021, 10, 1)),
    ("7: 09.2021 - vor 4 Wochen", 27),
    ("8: vor 4 Wochen - vor 1er Woche", 6),
]
PERIOD_LAST_LABEL = "9: letze Woche"
# ---------------------------------------------------------------------------

# Date layouts accepted by ``parse_date``; single letters accept unpadded
# fields the way ``strptime`` does.
DATE_LAYOUTS = {
    "Y/m/d H:M:S": "yyyy/M/d H:m:s",
    "Y-m-d": "yyyy-M-d",
    "Ymd": "yyyyMMdd",
    "m/d/y": "M/d/yy",
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_code(c: str | Column, width: int = 5) -> Column:
    """Integer code -> text left-padded with zeros, never truncated.

    ``lpad`` cuts longer values, so those pass through unchanged. NULL stays
    NULL (the reference would print the text ``00nan``).
    """
    s = _col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def recode(c: str | Column, mapping: Mapping) -> Column:
    """Whole-value replacement through a dictionary (O13); others unchanged."""
    col = _col(c)
    if not mapping:
        return col
    out = None
    for old, new in mapping.items():
        cond = col == F.lit(old)
        out = F.when(cond, F.lit(new)) if out is None else out.when(cond, F.lit(new))
    return out.otherwise(col)


def strip_token(c: str | Column, token: str) -> Column:
    """Remove every occurrence of ``token`` from the text."""
    return F.replace(_col(c), F.lit(token), F.lit(""))


def parse_date(c: str | Column, layout: str = "Y/m/d H:M:S",
               on_error: str = "raise") -> Column:
    """Text or integer -> DATE in one of four layouts.

    ``on_error='raise'`` fails the job on a bad value (ANSI parsing), the
    way the reference does; ``'null'`` yields NULL so a caller can route the
    row to a reject table instead.
    """
    pattern = DATE_LAYOUTS.get(layout, layout)
    s = _col(c).cast("string")
    if on_error == "null":
        d = F.try_to_timestamp(s, F.lit(pattern)).cast("date")
    elif on_error == "raise":
        d = F.to_timestamp(s, pattern).cast("date")
    else:
        raise ValueError("on_error must be 'raise' or 'null'")
    if "yy" in pattern and "yyyy" not in pattern:
        # Two-digit years pivot like strptime: 69-99 -> 19xx, 00-68 -> 20xx.
        d = F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)
    return d


def midpoint(c: str | Column, mapping: Mapping[str, float] = AGE_MIDPOINTS) -> Column:
    """Category -> representative number (O16); NULL when unmapped."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(float(v))]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def period_bucket(c: str | Column, max_date: Column,
                  bounds=PERIOD_BOUNDS, last_label: str = PERIOD_LAST_LABEL) -> Column:
    """Date -> ordered period label (O17): right-open, first match wins.

    ``bounds`` holds (label, bound) pairs; a ``date`` bound is fixed, an
    ``int`` bound is ``max_date`` minus that many days.
    """
    d = _col(c)
    out = None
    for label, bound in bounds:
        upper = F.date_sub(max_date, bound) if isinstance(bound, int) else F.lit(bound)
        cond = d < upper
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(last_label))


def active_of(cases: str | Column, deaths: str | Column, recovered: str | Column) -> Column:
    """Null-safe ``cases - deaths - recovered``."""
    z = F.lit(0)
    return (F.coalesce(_col(cases), z) - F.coalesce(_col(deaths), z)
            - F.coalesce(_col(recovered), z))


def zero_as_null(c: str | Column) -> Column:
    """0 -> NULL so zero reports do not anchor interpolation."""
    return F.nullif(_col(c), F.lit(0))


def rekey_properties(geoms: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace each array element's ``properties`` by ``{new: old}`` fields.

    ``mapping`` is ``{new_name: old_field}``; all other fields of the element
    are kept.
    """
    def one(g: Column) -> Column:
        props = F.struct(*[g["properties"][old].alias(new) for new, old in mapping.items()])
        return g.withField("properties", props)

    return F.transform(_col(geoms), one)


def filter_coords(coords: str | Column, pred: Callable[[Column], Column]) -> Column:
    """Keep array elements that satisfy ``pred`` (O22), evaluated per element."""
    return F.filter(_col(coords), pred)


def filter_rings(geometry: str | Column, pred: Callable[[Column, Column], Column]) -> Column:
    """A document's geometry without the rings whose first point fails ``pred(lat, lng)``
    (O22); every other member of the geometry stays. A ring is a list of [lng, lat]."""
    g = _col(geometry)
    kept = F.filter(g["coordinates"], lambda ring: pred(ring[0][1], ring[0][0]))
    return g.withField("coordinates", kept)


def filter_features(features: str | Column, pred: Callable[[Column, Column], Column]) -> Column:
    """``filter_rings`` on the geometry of every feature of a document."""
    return F.transform(_col(features), lambda f: f.withField("geometry", filter_rings(f["geometry"], pred)))
