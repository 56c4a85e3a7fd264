"""Column functions. Every function takes and returns ``Column`` and stays inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp layouts in trial order, history alphabet and length.
TIMESTAMP_FORMATS = ("d/M/yyyy H:m", "d/M/yyyy H:m:s", "yyyy-M-d H:m:s")
HISTORY_ALPHABET = "shadfrcgtwiqSHADFRCGTWIQ-^"
HISTORY_LENGTH = 23
# The constant of harmonic numbers, and the number of 32-bit values.
EULER = 0.5772156649
TWO32 = 1 << 32


def _let(value: Column, build) -> Column:
    """Evaluate ``value`` once and hand it to ``build``, so that nested uses do not multiply."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


# --- time -----------------------------------------------------------------------------------


def parse_timestamp(text: Column, formats=TIMESTAMP_FORMATS) -> Column:
    """First layout that fits wins; text that fits none is null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def slot_seconds(spec: str) -> int:
    """``"30s"`` or ``"2m"`` to seconds."""
    match = re.fullmatch(r"(\d+)([sm])", spec)
    if not match:
        raise ValueError(f"slot length must look like 30s or 2m, got {spec!r}")
    return int(match[1]) * (60 if match[2] == "m" else 1)


def slot_number(epoch: Column, origin: Column | int, length: Column | int) -> Column:
    """Slots count from 1 at the origin."""
    origin = F.lit(origin) if isinstance(origin, int) else origin
    length = F.lit(length) if isinstance(length, int) else length
    return F.floor((epoch - origin) / length).cast("bigint") + 1


# --- addresses and ports ----------------------------------------------------------------------

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def ipv4_to_long(ip: Column) -> Column:
    parts = F.split(ip, r"\.")
    octets = [F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint") for i in range(4)]
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(ip.rlike(IPV4_PATTERN), value)


def _hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


def ipv6_low32(ip: Column) -> Column:
    """Low 32 bits of an IPv6 address, null if the text is not one."""
    pieces = lambda text: F.filter(F.split(text, ":"), lambda p: p != "")
    tail = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"

    def from_groups(groups: Column, hexed: Column, dotted: Column) -> Column:
        count = F.size(groups["left"]) + F.size(groups["right"])
        valid = (
            F.forall(F.concat(groups["left"], groups["right"]), lambda p: p.rlike("^[0-9a-f]{1,4}$"))
            & ~hexed.rlike(":::|::.*::|^:[^:]|[^:]:$")
            & F.when(hexed.contains("::"), count <= 7).otherwise(count == 8)
            & ((dotted == "") | dotted.rlike(IPV4_PATTERN))
        )
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - count, F.lit(0)))
        full = F.concat(groups["left"], zeros, groups["right"])
        low = _let(full, lambda g: _hex(F.try_element_at(g, F.lit(-2))) * 65536 + _hex(F.try_element_at(g, F.lit(-1))))
        return F.when(valid, F.when(dotted != "", ipv4_to_long(dotted)).otherwise(low))

    def from_text(parts: Column) -> Column:
        hexed, dotted = parts["hexed"], parts["dotted"]
        gap = hexed.contains("::")
        groups = F.struct(
            pieces(F.when(gap, F.substring_index(hexed, "::", 1)).otherwise(hexed)).alias("left"),
            F.when(gap, pieces(F.substring_index(hexed, "::", -1))).otherwise(F.array().cast("array<string>")).alias("right"),
        )
        return _let(groups, lambda g: from_groups(g, hexed, dotted))

    bare = F.lower(F.regexp_replace(ip, "%.*$", ""))
    both = lambda text: F.struct(
        F.regexp_extract(text, ":(" + tail[:-1] + ")$", 1).alias("dotted"),
        F.when(text.rlike(":" + tail), F.regexp_replace(text, tail, "0:0")).otherwise(text).alias("hexed"),
    )
    return _let(bare, lambda text: _let(both(text), from_text))


def ip_to_long32(ip: Column) -> Column:
    """Address modulo 2^32 for both families."""
    return F.coalesce(ipv4_to_long(ip), ipv6_low32(ip))


def ipv6_hextet_sum(ip: Column) -> Column:
    """Older encoding: the hextets added up, modulo 2^32."""
    pieces = F.filter(F.split(ip, ":"), lambda p: p != "")
    return F.aggregate(pieces, F.lit(0).cast("bigint"), lambda acc, p: acc + _hex(p)) % TWO32


def ip_to_long_unchecked(ip: Column) -> Column:
    """Older encoding: four dotted numbers of any size shifted and added up, else the hextets added up; null if neither."""
    parts = F.split(ip, r"\.")
    numbers = [F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint") for i in range(4)]
    dotted = numbers[0] * 16777216 + numbers[1] * 65536 + numbers[2] * 256 + numbers[3]
    return F.when(ip.rlike(r"^[0-9]{1,9}(\.[0-9]{1,9}){3}$"), dotted).when(ip.rlike("^[0-9a-fA-F]{0,4}(:[0-9a-fA-F]{0,4})+$"), ipv6_hextet_sum(ip))


def port_number(text: Column) -> Column:
    """Decimal text, else hexadecimal text with or without ``0x``, else null."""
    hexed = F.when(
        text.rlike("^(0[xX])?[0-9a-fA-F]{1,8}$"),
        F.conv(F.regexp_replace(text, "^0[xX]", ""), 16, 10).try_cast("bigint"),
    )
    return F.coalesce(text.try_cast("bigint"), hexed)


# --- text -------------------------------------------------------------------------------------

# The layout of a syslog line.
SYSLOG_PATTERN = (
    r"^\s*([A-Z][a-z]{2})(?![a-z])\s*(\d+)\s*(\d+:\d+:\d+)\s*([A-Za-z0-9_.\-]+)\s*"
    r"(?:([A-Za-z/\-_.()]+)\s*\[\s*(\d+)\s*\]|([A-Za-z/\-_.]+))?\s*:\s*([\s\S]*)$"
)
_SEP = "\u0001"


def syslog_fields(line: Column, year: int = 2020) -> Column:
    """Struct (timestamp, hostname, appname, pid, message); null when the line does not parse.

    A message may span several lines.

    One regular-expression pass rewrites the line into separated groups, the rest are splits.
    """
    def from_groups(groups: Column) -> Column:
        stamp = F.try_to_timestamp(
            F.concat_ws(" ", F.lit(str(year)), groups[0], groups[1], groups[2]), F.lit("yyyy MMM d H:m:s")
        )
        fields = F.struct(
            stamp.alias("timestamp"),
            groups[3].alias("hostname"),
            F.when(groups[4] != "", groups[4]).otherwise(groups[6]).alias("appname"),
            groups[5].alias("pid"),
            groups[7].alias("message"),
        )
        return F.when(F.size(groups) == 8, F.when(stamp.isNotNull(), fields))

    # A line without a match comes back whole: its separators, if any, must not look like groups.
    clean = F.translate(line, _SEP, " ")
    groups = F.split(F.regexp_replace(clean, SYSLOG_PATTERN, _SEP.join(f"${i}" for i in range(1, 9))), _SEP)
    return _let(groups, from_groups)


def utf8_or_null(value: Column) -> Column:
    """Binary to text, null when the bytes are not valid UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def sha1_key(fields: list[Column], digits: int | None = None) -> Column:
    """Flow key: SHA-1 over the concatenated fields (null as empty), optionally shortened."""
    digest = F.sha1(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in fields]))
    return F.substring(digest, 1, digits) if digits else digest


# --- arrays -----------------------------------------------------------------------------------


def history_fits(history: Column, length: int = HISTORY_LENGTH) -> Column:
    """Whether a history has letters of the alphabet only and not more of them than the encoding holds."""
    text = F.coalesce(history, F.lit(""))
    return (F.length(text) <= length) & (F.translate(text, HISTORY_ALPHABET, "") == "")


def history_codes(history: Column, length: int = HISTORY_LENGTH) -> Column:
    """Alphabet positions of a connection history, padded with ``-`` to the length; null if it does not fit."""
    text = F.coalesce(history, F.lit(""))
    padded = F.when(history_fits(history, length), F.rpad(text, length, "-"))
    return F.transform(F.split(padded, ""), lambda c: F.instr(F.lit(HISTORY_ALPHABET), c) - 1)


def one_hot(code: Column, size: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == code.cast("int"), 1.0).otherwise(0.0)
    )


def history_one_hot(history: Column, length: int = HISTORY_LENGTH) -> Column:
    # Codes are places of the alphabet, so every row of the encoding is one of a few constant arrays.
    size = len(HISTORY_ALPHABET)
    letters = F.array(*[F.array(*[F.lit(float(i == code)) for i in range(size)]) for code in range(size)])
    return F.transform(history_codes(history, length), lambda c: F.get(letters, c))


def argmax(values: Column) -> Column:
    """Zero-based position of the first maximum."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def _pairwise_sum(x: Column, y: Column, term) -> Column:
    return F.aggregate(F.zip_with(x, y, term), F.lit(0.0), lambda acc, v: acc + v)


def mean_square_error(x: Column, y: Column) -> Column:
    return _pairwise_sum(x, y, lambda a, b: (a - b) * (a - b)) / F.size(x)


def sum_abs_error(x: Column, y: Column) -> Column:
    return _pairwise_sum(x, y, lambda a, b: F.abs(a - b))


def sum_abs_error_2d(x: Column, y: Column) -> Column:
    return sum_abs_error(F.flatten(x), F.flatten(y))


def weights_add(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a + b)


def weights_subtract(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a - b)


def weights_zero(x: Column) -> Column:
    return F.transform(x, lambda a: a * 0.0)


def weights_divide(x: Column, divisor: float) -> Column:
    return F.transform(x, lambda a: a / divisor)


# --- scores -----------------------------------------------------------------------------------


def burst_relative(a: Column, s: Column, t: Column) -> Column:
    """Burst score of the plain and relational edge scorers; 0 without history."""
    gap = (a - s / t) * t
    return F.when((s == 0) | (t == 1), 0.0).otherwise(gap * gap / (s * (t - 1)))


def burst_filtered(a: Column, s: Column, t: Column) -> Column:
    """Burst score of the filtering edge scorer; 0 without history."""
    gap = a + s - a * t
    return F.when(s == 0, 0.0).otherwise(gap * gap / (s * (t - 1)))


def expected_path_length(n: Column) -> Column:
    n = n.cast("double")
    return (
        F.when(n > 2, 2 * (F.log(n - 1) + EULER) - 2 * (n - 1) / n).when(n == 2, 1.0).otherwise(0.0)
    )


def isolation_score(mean_path: Column, n: Column) -> Column:
    """2^(-h/c(n)); a sample too small to normalise scores 0.5."""
    norm = expected_path_length(n)
    return F.when(norm > 0, F.pow(F.lit(2.0), -mean_path / norm)).otherwise(0.5)


def above(score: Column, cutoff: float | Column, op: str = ">") -> Column:
    cutoff = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    return {">": score > cutoff, ">=": score >= cutoff, "<": score < cutoff}[op]
