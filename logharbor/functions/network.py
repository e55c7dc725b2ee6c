"""IP address checks and canonical forms as column expressions, without Python on executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logharbor.functions.binding import bind

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"
_HEX_GROUP = r"^[0-9a-f]{1,4}\z"
_MAPPED = "0:0:0:0:0:ffff:"


def is_ipv4(text: Column) -> Column:
    return text.rlike(IPV4_PATTERN)


def _hex_group(octets: Column, first: int) -> Column:
    value = octets[first].cast("int") * 256 + octets[first + 1].cast("int")
    return F.lower(F.hex(value))


def _plain_groups(address: Column) -> Column:
    """The address with a dotted-quad ending written as two hexadecimal groups."""

    def replace_quad(tail: Column) -> Column:
        octets = F.split(tail, r"\.")
        quad = F.concat_ws(":", _hex_group(octets, 0), _hex_group(octets, 2))
        head = F.substring(address, F.lit(1), F.length(address) - F.length(tail))
        return F.when(~tail.contains("."), address).when(is_ipv4(tail), F.concat(head, quad))

    return bind(F.substring_index(address, ":", -1), replace_quad)


def _expand(body: Column) -> Column:
    """Eight groups without leading zeros joined by ':', null for a malformed address."""

    def from_halves(halves: Column) -> Column:
        left, right = F.get(halves, F.lit(0)), F.coalesce(F.get(halves, F.lit(1)), F.lit(""))
        pieces = F.struct(
            F.filter(F.split(left, ":"), lambda g: g != "").alias("left"),
            F.filter(F.split(right, ":"), lambda g: g != "").alias("right"),
        )
        stray = (
            left.startswith(":") | left.endswith(":") | right.startswith(":") | right.endswith(":")
        )

        def from_pieces(p: Column) -> Column:
            shown = F.size(p["left"]) + F.size(p["right"])
            zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - shown, F.lit(0)))
            fits = F.when(F.size(halves) == 2, shown <= 7).otherwise(shown == 8)
            whole = bind(
                F.concat(p["left"], zeros, p["right"]),
                lambda groups: F.when(
                    F.forall(groups, lambda g: g.rlike(_HEX_GROUP)),
                    F.array_join(F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":"),
                ),
            )
            return F.when(fits, whole)

        return F.when((F.size(halves) <= 2) & ~stray, bind(pieces, from_pieces))

    return bind(F.split(body, "::"), from_halves)


def _compress(full: Column) -> Column:
    """The first longest run of two or more zero groups as '::'; mapped IPv4 in dotted form."""
    arms = []
    for run in range(8, 1, -1):
        pattern = rf"^(.*?)(?:^|:)0(?::0){{{run - 1}}}(?::|$)(.*)$"
        arms.append(F.when(full.rlike(pattern), F.regexp_replace(full, pattern, "$1::$2")))
    groups = F.split(full, ":")
    high, low = (F.conv(F.get(groups, F.lit(i)), 16, 10).cast("int") for i in (6, 7))
    octets = [F.shiftright(high, 8), high % 256, F.shiftright(low, 8), low % 256]
    dotted = F.concat(F.lit("::ffff:"), F.concat_ws(".", *[o.cast("string") for o in octets]))
    return F.when(full.startswith(_MAPPED), dotted).otherwise(F.coalesce(*arms, full))


def canonical_ipv6(text: Column) -> Column:
    address = F.lower(F.substring_index(text, "%", 1))
    plain = bind(address, lambda a: bind(bind(_plain_groups(a), _expand), _compress))
    scoped = text.contains("%")
    good_scope = text.rlike(r"^[^%]*%[^%]+\z")
    scope = F.when(scoped, F.concat(F.lit("%"), F.substring_index(text, "%", -1))).otherwise("")
    return F.when(~scoped | good_scope, F.concat(plain, scope))


def canonical_ip(text: Column) -> Column:
    """Canonical text of an IPv4 or IPv6 address, null for anything else."""
    return F.when(is_ipv4(text), text).when(text.contains(":"), canonical_ipv6(text))


def ip_version(text: Column) -> Column:
    """4, 6 or null."""
    return F.when(is_ipv4(text), F.lit(4)).when(
        text.contains(":") & canonical_ipv6(text).isNotNull(), F.lit(6)
    )
