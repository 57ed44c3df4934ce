"""Column expressions over values and text: signs, casts, encodings, labels, escapes, hashes, colours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number at the start of a text, as browsers read it (fixed pattern).
NUMBER_PREFIX = r"^[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?)"


def clean(x: Column) -> Column:
    """NaN becomes null: nodata is always null inside the engine."""
    return F.nanvl(x, F.lit(None).cast("double"))


def depth_down(primary: Column, other: Column | None = None) -> Column:
    """Depth as negative metres, whatever the sign of the source."""
    return -F.abs(primary if other is None else F.coalesce(primary, other))


def confidence_floor(label: Column) -> Column:
    """Threshold of a named confidence level; 0.6 for an unknown one (fixed values)."""
    return F.when(label == "low", 0.3).when(label == "medium", 0.6).when(label == "high", 0.8).otherwise(0.6)


def reflectance(dn: Column) -> Column:
    """Digital number times 1e-4; 0 is nodata."""
    return F.nullif(dn, F.lit(0)) * F.lit(1e-4)


def log_floor(b: Column, floor: float = 1e-6) -> Column:
    """Logarithm with a floor; null stays null."""
    return F.when(b.isNotNull(), F.log(F.greatest(b, F.lit(floor))))


def stumpf(b2: Column, b3: Column, floor: float = 1e-6) -> Column:
    """Ratio of logarithms of two bands."""
    return log_floor(b2, floor) / (log_floor(b3, floor) + F.lit(floor))


def number(x: Column) -> Column:
    """Double, or null where the text is none."""
    return x.try_cast("double")


def whole(x: Column) -> Column:
    """Integer by way of a double; empty and unreadable texts are 0."""
    return F.coalesce(F.nullif(x, F.lit("")).try_cast("double").cast("int"), F.lit(0))


def number_prefix(x: Column) -> Column:
    """Number at the start of a text (``1.5x`` is 1.5), else null."""
    return F.nullif(F.regexp_extract(F.trim(x), NUMBER_PREFIX, 0), F.lit("")).try_cast("double")


def first_number(x: Column) -> Column:
    """First number anywhere in a text, else null."""
    return F.nullif(F.regexp_extract(x, r"-?\d+(\.\d+)?", 0), F.lit("")).try_cast("double")


def demojibake(x: Column) -> Column:
    """UTF-8 that was read as Latin-1, put right; any other text is unchanged."""
    latin = F.encode(F.when(x.rlike(r"^[\x{00}-\x{FF}]*$"), x), "ISO-8859-1").cast("string")
    return F.coalesce(F.when(F.is_valid_utf8(latin), latin), x)


def band(depth: Column) -> Column:
    """Depth band by magnitude, upper edges included; null for no depth."""
    d = F.abs(depth)
    return F.when(d <= 15, "validated").when(d <= 25, "optical-wall").when(d.isNotNull(), "coarse")


def valid_depth(x: Column) -> Column:
    return F.coalesce((x > -2500) & (x < 5), F.lit(False))


def half_up(x: Column, digits: int) -> Column:
    """Rounding with halves toward plus infinity, as browsers do."""
    scale = F.lit(float(10**digits))
    return F.floor(x * scale + 0.5) / scale


def depth_label(x: Column) -> Column:
    """Depth with one decimal and a true minus sign; positive depths are minus zero, invalid ones a minus alone."""
    shown = F.format_string("%.1f m", F.abs(half_up(F.least(x, F.lit(0.0)), 1)))
    return F.when(valid_depth(x), F.concat(F.lit("−"), shown)).otherwise("−")


def heading(x: Column) -> Column:
    """Whole degrees in three digits with a degree sign."""
    return F.concat(F.lpad(F.pmod(half_up(x, 0), F.lit(360.0)).cast("int").cast("string"), 3, "0"), F.lit("°"))


def minutes(x: Column, positive: str, negative: str) -> Column:
    """Decimal degrees as hemisphere, whole degrees and decimal minutes."""
    a = F.abs(x)
    return F.concat(F.when(x < 0, negative).otherwise(positive), F.floor(a).cast("string"), F.lit("°"), F.format_string("%.3f", (a - F.floor(a)) * 60), F.lit("'"))


def xml_escape(x: Column, apostrophe: str = "&apos;") -> Column:
    """Text for XML; HTML has ``&#39;`` for the apostrophe."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", apostrophe)):
        x = F.replace(x, F.lit(raw), F.lit(safe))
    return x


def csv_field(x: Column) -> Column:
    """A field as CSV has it: quoted where it holds a quote, a comma or a line end; null is empty."""
    quoted = F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(x.rlike('[",\n]'), quoted).otherwise(x), F.lit(""))


def hash_share(key: Column, seed: int) -> Column:
    """A key's place in [0, 1), in steps of 1e-4: the MD5 of ``seed:key`` modulo 10000, taken over four parts of 32 bits."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    total = F.lit(0).cast("long")
    for i in range(4):
        part = F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
        total = F.pmod(total * (2**32 % 10_000) + F.pmod(part, F.lit(10_000)), F.lit(10_000))
    return total / F.lit(10_000.0)


def terrarium(z: Column, empty: float = 10.0) -> tuple[Column, Column, Column]:
    """Red, green and blue of a height: 256 R + G + B / 256 - 32768; nodata is ``empty`` metres."""
    v = F.greatest(F.lit(0.0), F.least(F.lit(65535.999), F.coalesce(z, F.lit(empty)) + 32768.0))
    r = F.floor(v / 256.0)
    return r.cast("int"), F.floor(v - r * 256.0).cast("int"), F.floor((v - F.floor(v)) * 256.0).cast("int")


def terrarium_height(r: Column, g: Column, b: Column) -> Column:
    return r * 256.0 + g + b / 256.0 - 32768.0


def ramp(x: Column, stops: Sequence[tuple[float, float]]) -> Column:
    """Piecewise linear between stops in ascending order, constant outside."""
    out = F.when(x <= stops[0][0], stops[0][1])
    for (a, u), (b, v) in zip(stops, stops[1:]):
        out = out.when(x <= b, F.lit(u) + (x - F.lit(a)) / F.lit(b - a) * F.lit(v - u))
    return out.when(x.isNotNull(), stops[-1][1])


def depth_range(low: Column, high: Column) -> Column:
    """Text of a depth range: one number if both are equal, a dash if both are missing."""
    a, b = F.least(low, high), F.greatest(low, high)
    text = lambda v: F.format_string("%.1f", v)
    return F.when(a.isNull(), "—").when(a == b, text(a)).otherwise(F.concat(text(a), F.lit(" to "), text(b)))


def new_id() -> Column:
    """A random identifier."""
    return F.uuid()


def stable_id(*parts: Column) -> Column:
    """An identifier from a row's own values, equal whenever it is computed."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *parts).cast("binary"), 256), 1, 16)


def date_stamp() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")
