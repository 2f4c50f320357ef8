"""Text forms of types that are exported as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utf8_lossy(value: Column) -> Column:
    """Bytes to text; malformed sequences become U+FFFD instead of failing."""
    return F.make_valid_utf8(value.cast("string"))


def has_bad_utf8(value: Column) -> Column:
    return ~F.is_valid_utf8(value.cast("string"))


def plain_number(value: Column) -> Column:
    """Text of a floating number: plain digits from 1e-4 up to below 1e16, an exponent of two digits beyond, ``nan`` and ``inf``."""
    text = value.cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    bare = F.ltrim(text, F.lit("-"))
    mantissa = F.substring_index(bare, "E", 1)
    exponent = F.substring_index(bare, "E", -1).try_cast("int")
    digits = F.regexp_replace(F.replace(mantissa, F.lit(".")), "(?<=.)0$", "")
    zeros = F.repeat(F.lit("0"), F.greatest(exponent + 1 - F.length(digits), F.lit(0)))
    whole = F.concat(F.substr(digits, F.lit(1), exponent + 1), zeros)
    fraction = F.substr(digits, exponent + 2)
    large = F.concat(whole, F.lit("."), F.when(fraction == "", "0").otherwise(fraction))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    power = F.concat(
        F.regexp_replace(mantissa, r"\.0$", ""),
        F.lit("e"),
        F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.length(F.abs(exponent).cast("string")), F.lit(2)), F.lit("0")),
    )
    finite = (
        F.when(~bare.contains("E"), bare)
        .when((exponent >= 0) & (exponent < 16), large)
        .when((exponent < 0) & (exponent >= -4), small)
        .otherwise(power)
    )
    special = F.when(bare == "NaN", "nan").when(bare == "Infinity", "inf")
    return F.when(value.isNotNull(), F.concat(sign, F.coalesce(special, finite)))


def iso_local(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MI:SS.fffffffff`` of a zone-less timestamp.

    Built from the plain cast, so it never passes through the session zone.
    """
    text = ts.cast("timestamp_ntz").cast("string")
    time = F.split_part(text, F.lit(" "), F.lit(2))
    return F.concat(
        F.split_part(text, F.lit(" "), F.lit(1)),
        F.lit("T"),
        F.substring(time, 1, 8),
        F.lit("."),
        F.rpad(F.substring(time, 10, 9), 9, "0"),
    )


def iso_zoned(utc: Column, zone: Column) -> Column:
    """Same with the zone: ``utc`` is the zone-less UTC reading, ``zone`` its region."""
    local = F.convert_timezone(F.lit("UTC"), zone, utc.cast("timestamp_ntz"))
    return F.concat(iso_local(local), F.lit(" "), zone)


def iso_instant(ts: Column) -> Column:
    """An instant in the session zone, followed by the name of that zone."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS VV")


def day_second_text(interval: Column, day_digits: int = 2, fraction_digits: int = 6) -> Column:
    """``+DD HH:MI:SS.ffffff``; days wider than ``day_digits`` keep all their digits."""
    size = F.abs(interval)

    def part(name: str) -> Column:
        return F.extract(F.lit(name), size)

    seconds = F.lpad(part("SECOND").cast("decimal(8,6)").cast("string"), 9, "0")
    shown = 2 if fraction_digits == 0 else 3 + min(fraction_digits, 6)
    return F.concat(
        F.when(F.extract(F.lit("DAY"), interval) < 0, "-")
        .when(F.extract(F.lit("HOUR"), interval) < 0, "-")
        .when(F.extract(F.lit("MINUTE"), interval) < 0, "-")
        .when(F.extract(F.lit("SECOND"), interval) < 0, "-")
        .otherwise("+"),
        F.format_string(f"%0{day_digits}d", part("DAY").cast("long")),
        F.lit(" "),
        F.format_string("%02d:%02d:", part("HOUR").cast("int"), part("MINUTE").cast("int")),
        F.substring(seconds, 1, shown),
    )


def year_month_text(interval: Column, year_digits: int = 2) -> Column:
    """``+YY-MM``."""
    years = F.extract(F.lit("YEAR"), interval)
    months = F.extract(F.lit("MONTH"), interval)
    return F.concat(
        F.when((years < 0) | (months < 0), "-").otherwise("+"),
        F.format_string(
            f"%0{year_digits}d-%02d", F.abs(years).cast("int"), F.abs(months).cast("int")
        ),
    )


def json_text(value: Column, canonical: bool = False, attempt: bool = False) -> Column:
    """JSON document text as it is, whatever its numbers and repeated keys; text that is no JSON fails the job, or with ``attempt``
    is NULL.

    ``canonical`` gives the compact form with sorted keys instead, for documents whose numbers Spark can hold.
    """
    if canonical:
        return F.to_json(F.parse_json(value))
    valid = F.get_json_object(value, "$").isNotNull() | (F.trim(value) == "null")
    refused = F.lit(None) if attempt else F.raise_error(F.concat(F.lit("not JSON: "), value))
    return F.when(value.isNull() | valid, value).otherwise(refused.cast("string"))


def xml_text(value: Column, data_type: T.DataType, row_tag: str = "ROW") -> Column:
    """XML document text: text passes through, a struct is rendered element by element."""
    if isinstance(data_type, T.StructType):
        return F.regexp_replace(F.to_xml(value, {"rowTag": row_tag, "indent": ""}), r"\s+$", "")
    return value.cast("string")


def geometry_wkt(geometry: Column, attempt: bool = False) -> Column:
    """Well-Known Text of a spatial struct ``(gtype, elem_info, ordinates)``.

    ``gtype`` is ``d00t``: ``d`` ordinates per point, ``t`` 1 point, 2 line, 3 polygon. ``elem_info`` holds triplets: the 1-based
    start of each element, its type, whose last digit is that of the shape, and its interpretation: 1 for straight lines, 3 for a
    rectangle given by two corners, which is written out. Circles, arcs and other shapes fail the job rather than lose data; with
    ``attempt`` they are NULL.
    """
    dims = F.floor(geometry.gtype / 1000).cast("int")
    ordinates = geometry.ordinates
    kind = geometry.gtype % 1000

    def joined(values: Column) -> Column:
        return F.array_join(F.transform(values, lambda v: plain_number(v.cast("double"))), " ")

    def points(start: Column, stop: Column) -> Column:
        starts = F.sequence(start, stop - dims, dims)
        return F.array_join(F.transform(starts, lambda i: joined(F.slice(ordinates, i, dims))), ", ")

    def rectangle(start: Column) -> Column:
        x, y, right, top = (F.get(ordinates, start - 1 + i) for i in range(4))
        corners = [(x, y), (right, y), (right, top), (x, top), (x, y)]
        return F.concat_ws(", ", *[joined(F.array(a, b)) for a, b in corners])

    end = F.size(ordinates) + 1
    info = geometry.elem_info
    elements = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor(F.size(info) / 3).cast("int") - 1, F.lit(0))),
        lambda i: F.struct(
            F.get(info, 3 * i).alias("start"),
            F.get(info, 3 * i + 1).alias("type"),
            F.get(info, 3 * i + 2).alias("way"),
            F.coalesce(F.get(info, 3 * i + 3), end).alias("stop"),
        ),
    )

    def ring(e: Column) -> Column:
        text = F.when(e["way"] == 3, rectangle(e["start"])).otherwise(points(e["start"], e["stop"]))
        return F.concat(F.lit("("), text, F.lit(")"))

    box = (kind == 3) & (dims == 2)
    known = F.forall(elements, lambda e: (e["type"] % 1000 == kind) & ((e["way"] == 1) | (box & (e["way"] == 3))))
    single = F.size(info) == 3
    first = F.lit(1)
    return (
        F.when(geometry.isNull(), F.lit(None).cast("string"))
        .when(known & single & (kind == 1), F.concat(F.lit("POINT ("), points(first, end), F.lit(")")))
        .when(known & single & (kind == 2), F.concat(F.lit("LINESTRING ("), points(first, end), F.lit(")")))
        .when(known & (kind == 3), F.concat(F.lit("POLYGON ("), F.array_join(F.transform(elements, ring), ", "), F.lit(")")))
        .otherwise(
            F.lit(None).cast("string") if attempt else F.raise_error(
                F.concat(F.lit("unsupported geometry: type "), geometry.gtype.cast("string"), F.lit(", elements "), F.array_join(info.cast("array<string>"), ","))
            )
        )
    )


def _json_ready(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StructType):
        fields = sorted(data_type.fields, key=lambda f: f.name)
        inner = [_json_ready(value[f.name], f.dataType).alias(f.name) for f in fields]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda item: _json_ready(item, data_type.elementType))
    if isinstance(data_type, T.MapType):
        entries = F.array_sort(F.map_entries(value))
        pairs = F.transform(
            entries,
            lambda e: F.struct(
                e.key.cast("string").alias("key"),
                _json_ready(e.value, data_type.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(pairs)
    if isinstance(data_type, T.BinaryType):
        return utf8_lossy(value)
    if isinstance(data_type, T.DecimalType):
        return value.cast("string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = F.regexp_replace(value.cast("string"), " ", "T")
        return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
    if isinstance(data_type, T.DateType):
        return value.cast("string")
    return value


def nested_json(value: Column, data_type: T.DataType) -> Column:
    """JSON text of a struct, array or map: keys sorted, nulls kept, exact decimals as strings."""
    return F.to_json(_json_ready(value, data_type), {"ignoreNullFields": "false"})
