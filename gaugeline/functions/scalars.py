"""Row-level parsing and formatting, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.schemas import NULLABLE_TEXT, TEXT_COLUMNS

# The Unicode White_Space characters.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Accepted number texts (decimal, hexadecimal with exponent, special).
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
HEX_TEXT = r"^[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?\d+\z"
SPECIAL_TEXT = r"^([+-]?(?i:inf|infinity)|(?i:nan))\z"

# RFC 3339. The first form is what Spark's own cast reads exactly; the second
# also has a comma before the fraction, one-digit hours and offsets beyond 18 hours.
RFC3339_PLAIN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-](0\d|1[0-7]):[0-5]\d)\z"
RFC3339_LOOSE = (
    r"^\d{4}-\d\d-\d\dT\d{1,2}:\d\d:\d\d([.,]\d+)?"
    r"(Z|[+-]([01]\d|2[0-4]):([0-5]\d|60))\z"
)

#: Doubles below this have fewer than 53 bits.
SUBNORMAL = 2.0**-1022


def trim_text(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def trim_fields(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Trim every text field; NULL counts as the empty text."""
    wanted = [c for c in (columns or TEXT_COLUMNS) if c in df.columns]
    return df.withColumns({c: trim_text(F.coalesce(F.col(c), F.lit(""))) for c in wanted})


def parse_value(c: Column) -> Column:
    """Number text to double; what cannot be read is 0.0, what is too large is infinite."""
    text = trim_text(c)
    readable = text.rlike(DECIMAL_TEXT) | text.rlike(HEX_TEXT) | text.rlike(SPECIAL_TEXT)
    return F.coalesce(F.when(readable, text.try_cast("double")), F.lit(0.0))


def read_rfc3339(text: Column) -> Column:
    """RFC 3339 text without surrounding white space to timestamp, else NULL."""
    filled = F.regexp_replace(F.regexp_replace(text, "T(\\d):", "T0$1:"), ",", ".")
    local = F.concat(F.regexp_extract(filled, r"^.{19}(\.\d{1,6})?", 0), F.lit("Z"))
    seconds = (
        F.substring(text, -5, 2).try_cast("long") * 3600
        + F.substring(text, -2, 2).try_cast("long") * 60
    )
    offset = F.when(text.endswith("Z"), F.lit(0).cast("long")).otherwise(
        F.when(F.substring(text, -6, 1) == "-", -seconds).otherwise(seconds)
    )
    shifted = F.timestamp_micros(F.unix_micros(local.try_cast("timestamp")) - offset * 1_000_000)
    return (
        F.when(text.rlike(RFC3339_PLAIN), text.try_cast("timestamp"))
        .when(text.rlike(RFC3339_LOOSE), shifted)
    )


def parse_rfc3339(c: Column) -> Column:
    """RFC 3339 text to timestamp; NULL stands for the zero time."""
    return read_rfc3339(trim_text(c))


def format_rfc3339nano(c: Column) -> Column:
    """Timestamp to text with the fraction's trailing zeros removed; NULL gives ``""``."""
    text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    # The point is always there, so zeros of the seconds are out of reach.
    short = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.coalesce(F.concat(short, F.lit("Z")), F.lit(""))


def _shortest(c: Column, text: Column) -> Column:
    """Plain text of the fewest digits that read back as ``c``, from the exact but perhaps longer ``text`` that Java prints.

    Of numbers with k digits, if any reads back, then one of the two next to the printed one does. Different numbers of
    up to 15 digits never read alike unless they are subnormal, for which all lengths are tried.
    """
    plain = F.regexp_replace(F.substring_index(text, "E", 1), "^-", "")
    tail = F.substring_index(plain, ".", -1)
    exponent = F.coalesce(F.when(text.contains("E"), F.substring_index(text, "E", -1)).try_cast("int"), F.lit(0))
    # From 2^53 on numbers are whole, and up to 2^96, where printed digits may be cut instead of rounded, all their digits
    # come by exact arithmetic: a number below 2^63 times a power of two that divides it.
    size, whole = F.abs(c), F.lit(None).cast("string")
    for shift in (33, 22, 11, 0):
        product = (size / 2.0**shift).cast("bigint").cast("decimal(20,0)") * F.lit(2**shift).cast("decimal(11,0)")
        whole = F.when((size >= 2.0 ** max(53, 52 + shift)) & (size < 2.0 ** (63 + shift)), product.cast("string")).otherwise(whole)
    printed = F.struct(
        F.coalesce(whole, F.ltrim(F.regexp_replace(plain, r"\.", ""), F.lit("0"))).alias("digits"),
        F.when(whole.isNull(), exponent - F.length(tail)).otherwise(0).alias("scale"),
    )
    fewest = F.when(F.abs(c) < SUBNORMAL, 1).otherwise(15)

    def cut(x: Column, k: Column) -> Column:
        """The numbers of k digits below and above, those that read back, the nearer first."""
        scale = x["scale"] + F.length(x["digits"]) - k
        low = x["digits"].substr(F.lit(1), k).cast("bigint")
        up = x["digits"].substr(k + 1, F.lit(1)) >= "5"
        both = F.when(up, F.array(low + 1, low)).otherwise(F.array(low, low + 1))
        numbers = F.transform(both, lambda m: F.struct(m.cast("string").alias("digits"), scale.alias("scale")))
        return F.filter(numbers, lambda m: F.concat(m["digits"], F.lit("E"), m["scale"].cast("string")).cast("double") == F.abs(c))

    def shorter(x: Column) -> Column:
        last = F.least(F.length(x["digits"]) - 1, F.lit(17))  # 17 digits always do
        tried = F.when(fewest <= last, F.flatten(F.transform(F.sequence(fewest, last), lambda k: cut(x, k))))
        return F.coalesce(F.get(tried, F.lit(0)), x)

    def plainly(x: Column) -> Column:
        point = F.length(x["digits"]) + x["scale"]
        digits = F.rtrim(x["digits"], F.lit("0"))
        return (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .when(F.length(digits) <= point, F.rpad(digits, point, "0"))
            .otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1)))
        )

    # Lambdas bind what is used more than once.
    found = F.transform(F.transform(F.array(printed), shorter), plainly)
    return F.concat(F.when(c < 0, "-").otherwise(""), F.get(found, F.lit(0)))


def format_float(c: Column) -> Column:
    """Double to its shortest decimal text, never with an exponent."""
    text = c.cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), "^-", "")
    whole = F.substring_index(mantissa, ".", 1)
    tail = F.regexp_replace(F.substring_index(mantissa, ".", -1), "^0$", "")
    digits = F.concat(whole, tail)
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    point = exponent + 1  # the mantissa has one digit before its point
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    large = F.when(F.length(digits) <= point, F.rpad(digits, point, "0")).otherwise(
        F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1))
    )
    return (
        F.when(F.isnan(c), "NaN")
        .when(c == float("inf"), "+Inf")
        .when(c == float("-inf"), "-Inf")
        # Older Javas print now and then more digits than are needed, but then at least 16, or of a subnormal number.
        .when((F.length(text) > 16) | ((F.abs(c) < SUBNORMAL) & (c != 0)), _shortest(c, text))
        .when(~text.contains("E"), F.regexp_replace(text, r"\.0$", ""))
        .when(exponent < 0, F.concat(sign, small))
        .otherwise(F.concat(sign, large))
    )


def stamp_processed_at(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Overwrite ``timestamp`` with ``at``, or with the time of the (micro-)batch."""
    return df.withColumn("timestamp", at if at is not None else F.current_timestamp())


def null_if_empty(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    wanted = [c for c in (columns or NULLABLE_TEXT) if c in df.columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in wanted})


def default_value(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.coalesce(F.col("value"), F.lit(0.0)))


def parse_range(c: Column, default_start: int, default_end: int) -> Column:
    """``"a-b"`` to ``struct(start, end)``; anything else gives the defaults."""
    parts = F.split(c, "-", 2)
    integer = r"^[+-]?\d+\z"
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    start = F.when(first.rlike(integer), first.try_cast("bigint"))
    end = F.when(second.rlike(integer), second.try_cast("bigint"))
    usable = start.isNotNull() & end.isNotNull()
    return F.struct(
        F.when(usable, start).otherwise(F.lit(default_start).cast("bigint")).alias("start"),
        F.when(usable, end).otherwise(F.lit(default_end).cast("bigint")).alias("end"),
    )
