"""Text keys: object names, content types, addresses, field names, sizes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Content type by file extension.
CONTENT_TYPES = {
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "gif": "image/gif",
    "webp": "image/webp",
    "bmp": "image/bmp",
    "tiff": "image/tiff",
    "svg": "image/svg+xml",
}
DEFAULT_CONTENT_TYPE = "image/png"

# File types accepted for upload, and scanned in folders.
UPLOAD_TYPES = ["png", "jpg", "jpeg", "bmp", "tiff"]


def extension(name: Column) -> Column:
    """Lower-cased text after the last dot; NULL when there is no dot."""
    return F.when(F.contains(name, F.lit(".")), F.substring_index(F.lower(name), ".", -1))


def media_type(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, extension(name)), F.lit(DEFAULT_CONTENT_TYPE))


def base_name(path: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def object_key(stamp: Column, filename: Column) -> Column:
    """uploads/{epoch ms}_{filename}"""
    return F.concat(F.lit("uploads/"), epoch_ms(stamp), F.lit("_"), filename)


def epoch_ms(stamp: Column) -> Column:
    return F.unix_millis(stamp.cast("timestamp")).cast("string")


def uploaded_name(key: Column) -> Column:
    """The file name inside an upload key: the text behind the first '_' after the prefix."""
    found = F.regexp_extract(key, r"(?s)^uploads/[^_]*_(.*)$", 1)
    return F.when(F.startswith(key, F.lit("uploads/")) & F.rlike(key, F.lit(r"(?s)^uploads/[^_]*_")), found)


def iso_text(stamp: Column) -> Column:
    """ISO-8601 text; the fraction is left out when it is zero."""
    return F.regexp_replace(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")


def id_json(name: str = "id") -> Column:
    """A record reduced to its id, e.g. {"id": 7}."""
    return F.regexp_replace(F.to_json(F.struct(F.col(name).alias("id"))), '^\\{"id":', '{"id": ')


def client_ip(forwarded: Column, host: Column) -> Column:
    """First hop of the proxy header, else the peer's address."""
    return F.when(F.length(forwarded) > 0, F.trim(F.substring_index(forwarded, ",", 1))).otherwise(host)


def is_local_ip(ip: Column) -> Column:
    """Loopback, 192.168/16 and 10/8. (172.16/12 does not count.)"""
    return ip.isin("127.0.0.1", "::1", "localhost") | F.startswith(ip, F.lit("192.168.")) | F.startswith(ip, F.lit("10."))


def ipv4_number(ip: Column) -> Column:
    """Dotted IPv4 as a number, NULL for anything else."""
    byte = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
    part = F.split(ip, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(part, F.lit(i)).cast("bigint")
    return F.when(F.rlike(ip, F.lit(rf"^{byte}(\.{byte}){{3}}$")), number)


def is_local_number(number: Column) -> Column:
    """`is_local_ip` of an IPv4 number."""
    return (number == 0x7F000001) | (F.shiftright(number, 16) == 0xC0A8) | (F.shiftright(number, 24) == 10)


_GROUP = "[0-9a-f]{1,4}"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _ipv6_digits(ip: Column) -> Column:
    """An IPv6 address in any spelling as 32 hexadecimal digits; NULL for anything else."""

    def hexed(plain: Column) -> Column:
        """The four numbers of an IPv4 address at the end as two groups."""

        def with_tail(four: Column) -> Column:
            as_hex = F.lpad(F.lower(F.hex(four)), 8, "0")
            return F.concat(F.regexp_replace(plain, r"[^:]*$", ""), F.substr(as_hex, F.lit(1), F.lit(4)), F.lit(":"), F.substr(as_hex, F.lit(5), F.lit(4)))

        return F.when(~F.contains(plain, F.lit(".")), plain).otherwise(_once(ipv4_number(F.substring_index(plain, ":", -1)), with_tail))

    def digits(text: Column) -> Column:
        """The groups on either side of '::', which stands for one group of zeros or more, filled up."""
        sides = F.transform(F.split(text, "::"), lambda side: F.array_join(F.transform(F.split(side, ":"), lambda g: F.when(F.length(g) > 0, F.lpad(g, 4, "0")).otherwise("")), ""))

        def filled(side: Column) -> Column:
            left, right = F.get(side, F.lit(0)), F.get(side, F.lit(1))
            missing = 32 - F.length(left) - F.length(right)
            return F.when(F.size(side) == 1, left).when(missing >= 4, F.concat(left, F.repeat(F.lit("0"), missing), right))

        spelt = F.rlike(text, F.lit(f"^({_GROUP}(:{_GROUP}){{7}}|(({_GROUP}(:{_GROUP})*)?::({_GROUP}(:{_GROUP})*)?))$"))
        return F.when(spelt, _once(sides, filled))

    # Brackets with a port, and the zone, are no part of the address.
    plain = F.lower(F.regexp_replace(ip, r"^\[|\](:\d+)?$|%.*$", ""))
    return F.when(F.contains(ip, F.lit(":")), _once(plain, lambda p: _once(hexed(p), digits)))


def ipv6_halves(ip: Column) -> Column:
    """The upper and the lower 64 bits (`high`, `low`) of an IPv6 address as signed numbers, NULL for anything else."""
    half = lambda digits, start: F.conv(F.substr(digits, F.lit(start), F.lit(16)), 16, -10).cast("bigint")
    return _once(_ipv6_digits(ip), lambda d: F.when(d.isNotNull(), F.struct(half(d, 1).alias("high"), half(d, 17).alias("low"))))


def inner_ipv4(high: Column, low: Column) -> Column:
    """The IPv4 number that an IPv6 address carries (::ffff:a.b.c.d), else NULL."""
    return F.when((high == 0) & (F.shiftright(low, 32) == 0xFFFF), low.bitwiseAND(F.lit(0xFFFFFFFF)))


def fixed(value: Column, places: int) -> Column:
    """A number as text with fixed places; exact ties go to the even digit, without separators."""
    return F.replace(F.format_number(value.cast("double"), places), F.lit(","), F.lit(""))


def size_text(size: Column) -> Column:
    """Bytes as short text, rounded half up; a unit is used below 10,240 of it."""
    out = F.when(size < 10240, F.concat(size.cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(["kB", "MB", "GB", "TB"], start=1):
        halves = F.shiftright(size, 10 * power - 1)
        text = F.concat(F.shiftright(halves + 1, 1).cast("string"), F.lit(f" {unit}"))
        out = out.when(halves < 20479, text) if unit != "TB" else out.otherwise(text)
    return out


def _clean(name: str) -> str:
    return name.replace(" ", "_").lower()


def _renamed(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        names = [_clean(f.name) for f in dtype.fields]
        if len(set(names)) < len(names):
            raise ValueError(f"field names collide after normalising: {sorted(names)}")
        return T.StructType([T.StructField(n, _renamed(f.dataType), f.nullable) for n, f in zip(names, dtype.fields)])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_renamed(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, _renamed(dtype.valueType), dtype.valueContainsNull)
    return dtype


def normalise_names(df: DataFrame) -> DataFrame:
    """All field names, at any depth, with spaces as '_' and in lower case."""
    target = _renamed(df.schema)
    return df.select(
        *[F.col(f"`{old.name}`").cast(new.dataType).alias(new.name) for old, new in zip(df.schema.fields, target.fields)]
    )
