"""Checked casts: a source column in, a typed target value out.

``conform(col, src_type, target, name)`` returns a :class:`Conformed` pair of
Column expressions: the typed value and an error message (NULL when the value
is fine). Everything is built from JVM-side functions, so a whole binding list
compiles into one whole-stage-codegen projection; no Python runs per row.

Modes (applied by :func:`apply_mode`):

* ``strict`` - the first error raises (``raise_error``) and fails the task.
* ``report`` - the value becomes NULL and the error is kept in a column.

Null rules (the target's documented behaviour, see README):

1. NULL into a non-nullable column is an error naming the column.
2. NULL into a nullable column stays NULL (no default substitution).
3. UInt8/16/32 NULL becomes 0, also when nullable (``null_unsigned="zero"``,
   the default); ``null_unsigned="null"`` turns that off.
4. UInt64 NULL is an error when non-nullable and NULL when nullable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.types import (
    DATE_BOUNDS,
    DATETIME_BOUNDS,
    INT_BOUNDS,
    SMALL_UNSIGNED,
    WIDE_INTS,
    TargetType,
    parse_type,
)

# The error text for a NULL in a non-nullable column (the column
# name follows), as the target reports it.
NULL_MSG = "Null value for non-nullable column: "
_UUID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


@dataclass
class Conformed:
    value: Column
    error: Column  # NULL when fine, else a message


def _fractional(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType)) or (isinstance(dt, T.DecimalType) and dt.scale > 0)


def _not_integral(c: Column, dt: T.DataType) -> Column:
    """True where a fractional input holds a non-whole or non-finite number."""
    if not _fractional(dt):
        return F.lit(False)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.isnan(c) | (F.abs(c) == float("inf")) | (c != F.floor(c))
    return c != F.floor(c)


def canonical_integer(c: Column) -> tuple[Column, Column]:
    """(canonical digit string, is_negative) of an integer text; NULL if not an integer."""
    s = F.trim(c.cast("string"))
    ok = s.rlike(r"^[+-]?[0-9]+$")
    digits = F.regexp_replace(s, r"^[+-]?0*", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    neg = s.startswith("-") & (digits != "0")
    return F.when(ok, digits), neg


def _digits_le(d: Column, bound: str) -> Column:
    """Unsigned digit string d <= bound (both without leading zeros)."""
    n = len(bound)
    return (F.length(d) < n) | ((F.length(d) == n) & (d <= F.lit(bound)))


def _conform_wide_int(c: Column, t: TargetType) -> tuple[Column, Column]:
    lo, hi = INT_BOUNDS[t.name]
    digits, neg = canonical_integer(c)
    in_range = F.when(neg, _digits_le(digits, str(-lo)) if lo < 0 else F.lit(False)).otherwise(_digits_le(digits, str(hi)))
    value = F.when(neg, F.concat(F.lit("-"), digits)).otherwise(digits)
    ok = digits.isNotNull() & in_range
    return F.when(ok, value), ok


def _conform_wide_decimal(c: Column, t: TargetType) -> tuple[Column, Column]:
    """Decimal with precision above 38: exact digit strings, rounded half up to the scale as Spark's own decimals are, and canonical text."""
    p, s = t.precision, t.scale
    txt = F.trim(c.cast("string"))
    ok_fmt = txt.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$")
    unsigned = F.regexp_replace(txt, r"^[+-]", "")
    frac = F.split_part(unsigned, F.lit("."), F.lit(2))
    # The digits without a point, as far as the scale goes; rounding up turns the nines at the end to zeros and adds one before.
    digits = F.concat(F.lit("0"), F.split_part(unsigned, F.lit("."), F.lit(1)), F.rpad(F.substring(frac, 1, s), s, "0") if s else F.lit(""))
    kept = F.regexp_replace(digits, "9+$", "")
    raised = F.concat(F.substring(kept, F.lit(1), F.length(kept) - 1), (F.substring(kept, -1, 1).cast("int") + 1).cast("string"),
                      F.repeat(F.lit("0"), F.length(digits) - F.length(kept)))
    rounded = F.when(F.substring(frac, s + 1, 1) >= "5", raised).otherwise(digits)
    # Most values have no digits beyond the scale: nothing of the rounding is worked out for them.
    beyond = F.substring(frac, s + 1, p).rlike("[1-9]")
    int_part = F.regexp_replace(F.when(beyond, F.substring(rounded, F.lit(1), F.length(rounded) - s)).otherwise(F.split_part(unsigned, F.lit("."), F.lit(1))), r"^0+", "")
    frac_part = F.regexp_replace(F.when(beyond, F.substring(rounded, F.length(rounded) - s + 1, F.lit(s))).otherwise(F.substring(frac, 1, s)), r"0+$", "") if s else F.lit("")
    fits = F.length(int_part) <= p - s
    int_txt = F.when(int_part == "", F.lit("0")).otherwise(int_part)
    body = int_txt if s == 0 else F.concat(int_txt, F.lit("."), F.rpad(frac_part, s, "0"))
    is_zero = (int_part == "") & (frac_part == "")
    neg = txt.startswith("-") & ~is_zero
    ok = ok_fmt & fits
    return F.when(ok, F.when(neg, F.concat(F.lit("-"), body)).otherwise(body)), ok


def json_valid(s: Column) -> Column:
    """True where ``s`` is exactly one JSON value, by one parse.

    The VARIANT parser is strict (about quotes, control characters, and an object's
    keys: each may occur once), but stops after the first value and ignores what
    follows. So the text is parsed as the first entry of an array whose second is its own
    digest: more than one value, or a bracket that closes the array early, puts
    something else in that place.
    """
    digest = F.md5(s)
    parsed = F.try_parse_json(F.concat(F.lit("["), s, F.lit(',"'), digest, F.lit('"]')))
    return F.coalesce(F.try_variant_get(parsed, "$[1]", "string") == digest, F.lit(False))


def _session_is_utc() -> bool:
    """Whether casts between TIMESTAMP and TIMESTAMP_NTZ keep the micros (the cheap way) in this session."""
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros_since_epoch(ts_ntz: Column) -> Column:
    """Wall-clock microseconds since 1970-01-01 of a TIMESTAMP_NTZ, whatever the session's time zone."""
    if _session_is_utc():
        return F.unix_micros(ts_ntz.cast("timestamp"))
    return ((ts_ntz - _epoch()).cast("interval second").cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint")


def ntz_from_micros(m: Column) -> Column:
    """The TIMESTAMP_NTZ that many microseconds after 1970-01-01, whatever the session's time zone."""
    if _session_is_utc():
        return F.timestamp_micros(m).cast("timestamp_ntz")
    seconds = (m.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _utc_wall_clock(ts: Column) -> Column:
    """An instant's wall clock in UTC."""
    return ts.cast("timestamp_ntz") if _session_is_utc() else ntz_from_micros(F.unix_micros(ts))


def _to_ntz(c: Column, dt: T.DataType) -> Column:
    """Source value as a UTC wall-clock TIMESTAMP_NTZ, whatever the session's time zone.

    Text with a zone (``Z``, ``+02:00``) is converted to UTC; text without one
    is taken as UTC. Other types (numbers) are not date-times: NULL, i.e. a
    rejected value.
    """
    if isinstance(dt, T.TimestampNTZType):
        return c
    if isinstance(dt, T.DateType):
        return c.cast("timestamp_ntz")
    if isinstance(dt, T.TimestampType):
        return _utc_wall_clock(c)
    if isinstance(dt, T.StringType):
        text = F.trim(c)
        if _session_is_utc():
            return text.try_cast("timestamp").cast("timestamp_ntz")
        # A text that takes another zone behind it has none of its own.
        instant = F.coalesce(F.concat(text, F.lit("Z")).try_cast("timestamp"), text.try_cast("timestamp"))
        return F.when(text.rlike(r"^[+-]?[0-9]+(-[0-9]{1,2}){0,2}$"), text.try_cast("timestamp_ntz")).otherwise(_utc_wall_clock(instant))
    return F.lit(None).cast("timestamp_ntz")


def _floor_to_scale(ts: Column, scale: int) -> Column:
    if scale >= 6:
        return ts
    if scale in (0, 3) and _session_is_utc():
        unit = "second" if scale == 0 else "millisecond"
        return F.date_trunc(unit, ts.cast("timestamp")).cast("timestamp_ntz")
    m = micros_since_epoch(ts)
    unit = 10 ** (6 - scale)
    return ntz_from_micros(m - F.pmod(m, F.lit(unit)))


def datetime64_ticks(c: Column, dt: T.DataType, scale: int) -> Column:
    """Ticks of 10^-scale seconds since epoch; keeps nanoseconds of text input."""
    if isinstance(dt, T.StringType):
        s = F.regexp_replace(F.regexp_replace(F.trim(c), "T", " "), "Z$", "")
        whole = F.split_part(s, F.lit("."), F.lit(1)).try_cast("timestamp_ntz")
        frac = F.rpad(F.split_part(s, F.lit("."), F.lit(2)), 9, "0")
        micros = micros_since_epoch(whole)  # of whole seconds
        secs = ((micros - F.pmod(micros, F.lit(1_000_000))).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("bigint")
        return F.try_add(F.try_multiply(secs, F.lit(10**scale)), F.substring(frac, 1, scale).try_cast("bigint"))
    m = micros_since_epoch(_to_ntz(c, dt))
    return F.try_multiply(m, F.lit(10 ** (scale - 6)))


def conform(c: Column, src: T.DataType, t: TargetType | str, name: str,
            null_unsigned: str = "zero") -> Conformed:
    """Checked cast of ``c`` (Spark type ``src``) to target type ``t``."""
    t = parse_type(t)
    value, ok = _conform_value(c, src, t, name, null_unsigned)
    is_null = c.isNull()
    if t.name in SMALL_UNSIGNED and null_unsigned == "zero":
        value = F.when(is_null, F.lit(0).cast(t.spark_type())).otherwise(value)
        null_err = F.lit(None).cast("string")
    elif t.nullable:
        null_err = F.lit(None).cast("string")
    else:
        null_err = F.when(is_null, F.lit(NULL_MSG + name))
    bad_err = F.when(~is_null & ~ok, F.lit(f"Cannot convert value of column {name} to {t.inner().ddl()}"))
    return Conformed(value, F.coalesce(null_err, bad_err))


def _conform_value(c: Column, src: T.DataType, t: TargetType, name: str, null_unsigned: str) -> tuple[Column, Column]:
    """(typed value, ok) for a non-null input; ok is ignored where input is NULL."""
    n = t.name
    st = t.spark_type()
    if n in ("Int8", "Int16", "Int32", "Int64"):
        v = c.try_cast(st)
        ok = v.isNotNull() & ~_not_integral(c, src)
        return F.when(ok, v), ok
    if n in SMALL_UNSIGNED or n == "UInt64":
        if n == "UInt64" and isinstance(src, (T.FloatType, T.DoubleType)):
            # double -> decimal goes through the shortest decimal text and is
            # inexact above 2^53; via bigint it is exact (2^63.. shifted down first).
            d = c.cast("double")
            two63 = F.lit(float(2**63))
            big = (d - two63).try_cast("bigint").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
            wide = F.when(d >= two63, big).otherwise(d.try_cast("bigint").cast("decimal(20,0)"))
        else:
            wide = c.try_cast("decimal(20,0)") if n == "UInt64" else c.try_cast("bigint")
        lo, hi = INT_BOUNDS[n]
        lo_c, hi_c = ((F.lit(str(lo)).cast("decimal(20,0)"), F.lit(str(hi)).cast("decimal(20,0)")) if n == "UInt64"
                      else (F.lit(lo), F.lit(hi)))
        ok = wide.isNotNull() & wide.between(lo_c, hi_c)
        ok = ok & ~_not_integral(c, src)
        return F.when(ok, wide.cast(st)), ok
    if n in WIDE_INTS:
        if isinstance(src, (T.FloatType, T.DoubleType)):
            # Exact through bigint inside the 64-bit range; beyond it Spark's
            # decimal text of the double is used.
            d = c.cast("double")
            in_long = F.abs(d) < F.lit(float(2**63))
            c = F.when(~_not_integral(c, src),
                       F.when(in_long, d.try_cast("bigint").cast("string")).otherwise(d.try_cast("decimal(38,0)").cast("string")))
        elif _fractional(src):
            c = F.when(~_not_integral(c, src), c.cast("decimal(38,0)"))
        return _conform_wide_int(c, t)
    if n in ("Float32", "Float64"):
        v = c.try_cast("double")
        if n == "Float32":
            finite_in = ~F.isnan(v) & (F.abs(v) != float("inf"))
            ok = v.isNotNull() & ~(finite_in & (F.abs(v) > F.lit(3.4028234663852886e38)))
            return F.when(ok, v.cast("float")), ok
        ok = v.isNotNull()
        return v, ok
    if n == "Bool":
        if isinstance(src, T.BooleanType):
            return c, F.lit(True)
        if isinstance(src, T.StringType):
            s = F.lower(F.trim(c))
            v = F.when(s.isin("true", "1"), F.lit(True)).when(s.isin("false", "0"), F.lit(False))
            return v, v.isNotNull()
        v = F.when(c == 1, F.lit(True)).when(c == 0, F.lit(False))
        return v, v.isNotNull()
    if n == "Decimal":
        if t.is_wide_decimal:
            return _conform_wide_decimal(c, t)
        # Spark's cast rounds half-up to the declared scale; overflow is an error.
        v = c.try_cast(st)
        return v, v.isNotNull()
    if n == "String":
        return c.cast("string"), F.lit(True)
    if n == "FixedString":
        s = c.cast("string")
        ok = F.octet_length(s) <= F.lit(t.size)
        return F.when(ok, s), ok
    if n == "JSON":
        s = c.cast("string")
        ok = json_valid(s)
        return F.when(ok, s), ok
    if n == "UUID":
        s = F.trim(c.cast("string"))
        ok = s.rlike(_UUID_RE)
        return F.when(ok, F.lower(s)), ok
    if n in ("Date", "Date32"):
        if isinstance(src, T.DateType):
            d = c
        elif isinstance(src, T.StringType):
            d = F.try_to_date(F.trim(c), "yyyy-MM-dd")
        else:
            d = _to_ntz(c, src).cast("date")
        lo, hi = DATE_BOUNDS[n]
        ok = d.isNotNull() & d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        return F.when(ok, d), ok
    if n == "DateTime":
        ts = _floor_to_scale(_to_ntz(c, src), 0)
        lo, hi = DATETIME_BOUNDS[n]
        ok = ts.isNotNull() & ts.between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))
        return F.when(ok, ts), ok
    if n == "DateTime64":
        lo, hi = DATETIME_BOUNDS[n]
        s = t.scale if t.scale is not None else 3
        if s <= 6:
            ts = _floor_to_scale(_to_ntz(c, src), s)
            ok = ts.isNotNull() & ts.between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))
            return F.when(ok, ts), ok
        ticks = datetime64_ticks(c, src, s)
        import datetime as _dt
        lo_s = int((_dt.datetime.fromisoformat(lo) - _dt.datetime(1970, 1, 1)).total_seconds())
        hi_s = int((_dt.datetime(2299, 12, 31, 23, 59, 59) - _dt.datetime(1970, 1, 1)).total_seconds())
        lo_t = F.lit(max(lo_s * 10**s, -(2**63)))
        hi_t = F.lit(min((hi_s + 1) * 10**s - 1, 2**63 - 1))
        ok = ticks.isNotNull() & ticks.between(lo_t, hi_t)
        return F.when(ok, ticks), ok
    if n == "Array":
        et = t.args[0]
        src_el = src.elementType if isinstance(src, T.ArrayType) else T.StringType()
        conv = lambda x: conform(x, src_el, et, name + "[]", null_unsigned)
        v = F.transform(c, lambda x: conv(x).value)
        ok = ~F.exists(c, lambda x: conv(x).error.isNotNull())
        return F.when(ok, v), ok
    if n == "Map":
        kt, vt = t.args
        sk = src.keyType if isinstance(src, T.MapType) else T.StringType()
        sv = src.valueType if isinstance(src, T.MapType) else T.StringType()
        ck = lambda x: conform(x, sk, kt, name + ".key", null_unsigned)
        cv = lambda x: conform(x, sv, vt, name + ".value", null_unsigned)
        v = F.transform_values(F.transform_keys(c, lambda k, _: ck(k).value), lambda _, x: cv(x).value)
        # Keys that become equal (such as 1 and 01) would raise when the map is built.
        distinct = F.size(F.array_distinct(F.transform(F.map_keys(c), lambda k: ck(k).value))) == F.size(c)
        ok = ~F.exists(F.map_keys(c), lambda k: ck(k).error.isNotNull()) & ~F.exists(
            F.map_values(c), lambda x: cv(x).error.isNotNull()) & distinct
        return F.when(ok, v), ok
    if n == "Tuple":
        parts, oks = [], []
        for i, at in enumerate(t.args):
            if isinstance(src, T.StructType):
                fld = src.fields[i]
                el, el_t = c.getField(fld.name), fld.dataType
            else:
                el = c.getItem(i)
                el_t = src.elementType if isinstance(src, T.ArrayType) else T.StringType()
            r = conform(el, el_t, at, f"{name}._{i + 1}", null_unsigned)
            parts.append(r.value.alias(f"_{i + 1}"))
            oks.append(r.error.isNull())
        ok = oks[0]
        for o in oks[1:]:
            ok = ok & o
        return F.when(ok, F.struct(*parts)), ok
    raise ValueError(f"Unsupported target type: {n}")


def coerce_to_integer(c: Column, src: T.DataType, name: str = "value") -> Conformed:
    """Integer from a number (truncated), digit string or boolean (1/0); else an error."""
    if isinstance(src, T.BooleanType):
        v = F.when(c, F.lit(1)).otherwise(F.lit(0))
    elif isinstance(src, T.StringType):
        v = c.try_cast("int")
    elif isinstance(src, (T.ByteType, T.ShortType, T.IntegerType)):
        v = c.cast("int")
    elif isinstance(src, (T.FloatType, T.DoubleType)):
        # Java (int) of a floating value: NaN -> 0, saturating, truncated toward zero.
        d = c.cast("double")
        v = F.when(F.isnan(d), F.lit(0)).otherwise(
            F.greatest(F.least(d, F.lit(2147483647.0)), F.lit(-2147483648.0)).cast("int"))
    elif isinstance(src, (T.LongType, T.DecimalType)):
        # Java intValue() of a long / big number keeps the low 32 bits.
        whole = c.cast("decimal(38,0)") if isinstance(src, T.DecimalType) else c.cast("decimal(38,0)")
        low = F.pmod(whole + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)
        v = low.cast("int")
    else:
        v = F.lit(None).cast("int")
    err = F.when(c.isNotNull() & v.isNull(), F.lit(f"Cannot convert value of column {name} to Integer"))
    return Conformed(v, err)


def apply_mode(value: Column, error: Column, mode: str) -> Column:
    """Strict: raise on error. Report: NULL on error (error kept elsewhere)."""
    if mode == "strict":
        return F.when(error.isNotNull(), F.raise_error(error)).otherwise(value)
    if mode == "report":
        return F.when(error.isNull(), value)
    raise ValueError(f"mode must be 'strict' or 'report', not {mode!r}")
