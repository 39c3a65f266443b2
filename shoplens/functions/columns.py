"""Scalar helpers as Column -> Column functions (all JVM-side, no Python rows).

They replace the reference's per-row string utilities (date formatting, ratio
rounding, CSV and ``k=v|k=v`` handling, the JSON field getter and the two
registered UDFs). Each one compiles into whole-stage codegen.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the action log (the hour is not zero-padded in the data, and
# a single ``H`` accepts one or two digits).
ACTION_TIME_PATTERN = "yyyy-MM-dd H:mm:ss"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time
def parse_action_time(c) -> Column:
    """Parse ``yyyy-MM-dd H:mm:ss`` into a timestamp."""
    return F.to_timestamp(_c(c), ACTION_TIME_PATTERN)


def action_seconds(c) -> Column:
    """Epoch seconds of an action-time string (long; cheap to min/max/compare)."""
    return F.unix_timestamp(_c(c), ACTION_TIME_PATTERN)


def format_time(ts) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(ts), TIME_FORMAT)


def format_seconds(sec) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.from_unixtime(_c(sec), TIME_FORMAT)


def format_date(ts) -> Column:
    """Timestamp -> ``yyyy-MM-dd``."""
    return F.date_format(_c(ts), DATE_FORMAT)


def date_hour(ts) -> Column:
    """Timestamp -> ``yyyy-MM-dd_HH``."""
    return F.date_format(_c(ts), DATE_HOUR_FORMAT)


def date_key(ts) -> Column:
    """Timestamp -> ``yyyyMMdd``."""
    return F.date_format(_c(ts), DATE_KEY_FORMAT)


def parse_date_key(c) -> Column:
    """``yyyyMMdd`` -> date."""
    return F.to_date(_c(c), DATE_KEY_FORMAT)


def minute_key(ts) -> Column:
    """Timestamp -> ``yyyyMMddHHmm``."""
    return F.date_format(_c(ts), MINUTE_KEY_FORMAT)


def is_before(t1, t2) -> Column:
    """Action time ``t1`` strictly before ``t2``."""
    return action_seconds(t1) < action_seconds(t2)


def is_after(t1, t2) -> Column:
    """Action time ``t1`` strictly after ``t2``."""
    return action_seconds(t1) > action_seconds(t2)


def seconds_between(t1, t2) -> Column:
    """Whole seconds ``t1 - t2`` of two action-time strings."""
    return action_seconds(t1) - action_seconds(t2)


def today() -> Column:
    """today's date as ``yyyy-MM-dd``."""
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    """yesterday's date as ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)


# ---------------------------------------------------------------- numbers (X11)
def round_half_up(c, digits: int = 2) -> Column:
    """X11: round HALF_UP to ``digits`` decimals (Spark's ``round`` is HALF_UP)."""
    return F.round(_c(c), digits)


def ratio_half_up(num, den, digits: int = 2) -> Column:
    """``num / den`` rounded HALF_UP, computed exactly in integers.

    ``floor((num * 2 * 10^d + den) / (2 * den)) / 10^d`` for non-negative
    integer counts; a zero denominator gives NULL instead of raising.
    """
    num, den = _c(num).cast("bigint"), _c(den).cast("bigint")
    scale = 10 ** digits
    x = num * (2 * scale) + den
    y = den * 2
    q = (x - x % y) / y  # exact integer quotient as double
    return F.when(den != 0, q / F.lit(scale))


# ---------------------------------------------------------------- strings
def is_blank(c) -> Column:
    """NULL or empty string."""
    c = _c(c)
    return c.isNull() | (c == "")


def is_not_blank(c) -> Column:
    return ~is_blank(c)


def trim_comma(c) -> Column:
    """Drop one comma at the start and one at the end, independently."""
    return F.regexp_replace(_c(c), "^,|,$", "")


def pad2(c) -> Column:
    """Left-pad a string shorter than two characters with zeros; longer ones stay as they are."""
    c = _c(c)
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def _re_quote(text: str) -> str:
    """Quote literal text for a Java regular expression."""
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/-" else ch for ch in text)


def packed_field(c, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in ``k=v<delim>k=v``; the first well-formed match wins.

    A part matches when it splits on ``=`` into exactly two pieces, the key
    equals ``field`` and the value is not empty; otherwise NULL. Written as one
    regular expression so it stays in generated code.
    """
    d, f = _re_quote(delimiter), _re_quote(field)
    pattern = f"(?:^|{d}){f}=([^={d}]+)(?={d}|$)"
    return F.nullif(F.regexp_extract(_c(c), pattern, 1), F.lit(""))


def set_packed_field(c, field: str, value, delimiter: str = "|") -> Column:
    """Replace the value of every part keyed ``field``; order of parts kept.

    A part is keyed ``field`` when the text before its first ``=`` (or the
    whole part) equals ``field``.
    """
    d, f = _re_quote(delimiter), _re_quote(field)
    if isinstance(value, Column):
        raise TypeError("set_packed_field takes a literal value")
    repl = (field + "=" + str(value)).replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(c), f"(^|{d}){f}(?:=[^{d}]*)?(?={d}|$)", "$1" + repl)


def split_ids(c) -> Column:
    """CSV id list -> array<bigint>; NULL or blank -> empty array.

    A malformed id raises (ANSI cast), as the reference's ``toLong`` does.
    """
    c = _c(c)
    return F.when(c.isNull() | (F.trim(c) == ""), F.array().cast("array<bigint>")).otherwise(
        F.split(c, ",").cast("array<bigint>")
    )


# ---------------------------------------------------------------- area / product
# The reference's area grades. Areas 华北 and 华东 are grade A,
# 华中 and 华南 grade B, 西南 and 西北 grade C; every other area is grade D.
REFERENCE_AREA_LEVELS: Mapping[str, Sequence[str]] = {
    "A_Level": ("华北", "华东"),
    "B_Level": ("华中", "华南"),
    "C_Level": ("西南", "西北"),
}
DEFAULT_AREA_LEVEL = "D_Level"


def area_level(c, levels: Mapping[str, Sequence[str]] = REFERENCE_AREA_LEVELS,
               default: str = DEFAULT_AREA_LEVEL) -> Column:
    """CASE area -> level; unmatched areas get ``default``."""
    c = _c(c)
    expr = None
    for level, areas in levels.items():
        cond = c.isin(list(areas))
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def json_field(c, field: str) -> Column:
    """One top-level field of a JSON string (numbers come back as text)."""
    return F.get_json_object(_c(c), f"$.{field}")


def product_status(extend_info) -> Column:
    """``Self`` when ``product_status`` is 0, else ``Third Party`` (also for a
    missing field or NULL JSON)."""
    return F.when(json_field(extend_info, "product_status") == "0", F.lit("Self")).otherwise(F.lit("Third Party"))


def concat_long_string(v1, v2, sep: str = ":") -> Column:
    """G1: ``v1 <sep> v2`` (NULL when either side is NULL)."""
    return F.concat(_c(v1).cast("string"), F.lit(sep), _c(v2))


def group_concat_distinct(c, sep: str = ",") -> Column:
    """G2 (aggregate): distinct non-NULL strings, sorted as strings, joined."""
    return F.array_join(F.array_sort(F.collect_set(_c(c))), sep)
