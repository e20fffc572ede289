"""IP address texts as comparable bytes.

``family`` is 4 or 6 and ``packed`` the address bytes; Spark compares binary
values as unsigned bytes. Texts that are no address give null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

IPV4_TEXT = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"


def ipv4_number(text: Column) -> Column:
    """Value of a dotted IPv4 text, null for any other text."""
    octets = F.split(F.when(text.rlike(IPV4_TEXT), text), r"\.")
    numbers = F.transform(octets, lambda octet: octet.cast("bigint"))
    valid = F.forall(numbers, lambda number: number <= 255)
    folded = F.aggregate(
        numbers, F.lit(0).cast("bigint"), lambda acc, number: acc * F.lit(256) + number
    )
    return F.when(valid, folded)


def ipv4_text(number: Column) -> Column:
    octets = [F.shiftright(number, bits).bitwiseAND(F.lit(255)) for bits in (24, 16, 8, 0)]
    return F.concat_ws(".", *[octet.cast("string") for octet in octets])


def number_bytes(number: Column) -> Column:
    return F.unhex(F.lpad(F.hex(number), 8, "0"))


IPV6_TEXT = r"^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(%[^%]+)?$"
IPV4_TAIL = r"^(.*:)((?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3})$"
HEXTET = r"^[0-9A-Fa-f]{1,4}$"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once: a column used twice is otherwise written out twice."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _without_dots(bare: Column) -> Column:
    """An address whose last two groups are dotted, with hexadecimal groups; null if they are no IPv4 address."""

    def joined(parts: Column) -> Column:
        last = F.lpad(F.hex(ipv4_number(parts[1])), 8, "0")
        return _let(last, lambda x: F.concat(parts[0], F.substring(x, 1, 4), F.lit(":"), F.substring(x, 5, 4)))

    head, dotted = F.regexp_extract(bare, IPV4_TAIL, 1), F.regexp_extract(bare, IPV4_TAIL, 2)
    return F.when(bare.contains("."), _let(F.array(head, dotted), joined)).otherwise(bare)


def _hextets(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _whole(halves: Column) -> Column:
    """Thirty-two digits from what stands on both sides of ``::``, or from all groups."""

    def digits(groups: Column) -> Column:
        return F.array_join(F.transform(groups, lambda group: F.lpad(group, 4, "0")), "")

    def checked(sides: Column) -> Column:
        left, right, short = sides["left"], sides["right"], sides["short"]
        written = F.size(left) + F.size(right)
        valid = F.when(short, written <= 7).otherwise(written == 8)
        valid = valid & F.forall(F.concat(left, right), lambda group: group.rlike(HEXTET))
        zeros = F.repeat(F.lit("0"), F.greatest(F.lit(0), (F.lit(8) - written) * 4))
        return F.when(valid, F.upper(F.concat(digits(left), zeros, digits(right))))

    right = _let(F.coalesce(F.get(halves, F.lit(1)), F.lit("")), _hextets)
    sides = F.struct(
        _let(F.get(halves, F.lit(0)), _hextets).alias("left"), right.alias("right"), (F.size(halves) == 2).alias("short")
    )
    return F.when(F.size(halves) <= 2, _let(sides, checked))


def ipv6_bytes(text: Column) -> Column:
    """Packed IPv6 address of a text, null for any other; IPv4-mapped ones become their four bytes.

    Eight groups of up to four hexadecimal digits, of which ``::`` stands for one or more that
    are zero; the last two may be a dotted IPv4 address. A zone after ``%`` is left out.
    """

    def unmapped(whole: Column) -> Column:
        mapped = whole.startswith("0" * 20 + "F" * 4)
        return F.unhex(F.when(mapped, F.substring(whole, 25, 8)).otherwise(whole))

    bare = F.substring_index(F.when(text.rlike(IPV6_TEXT), text), "%", 1)
    halves = F.split(_let(bare, _without_dots), "::")
    return _let(_let(halves, _whole), unmapped)


def packed(text: Column, with_ipv6: bool = True) -> Column:
    """Address bytes, four or sixteen; null for texts that are no address."""
    native = number_bytes(ipv4_number(text))
    return F.coalesce(native, ipv6_bytes(text)) if with_ipv6 else native


def family(packed_bytes: Column) -> Column:
    return F.when(F.octet_length(packed_bytes) == 4, 4).when(
        F.octet_length(packed_bytes) == 16, 6
    )
