"""Address and port predicates built from JVM-side expressions."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})"
_DOTTED = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ipv4_number(address: Column | str) -> Column:
    """Dotted IPv4 text as BIGINT; NULL for anything else (IPv6, names, NULL)."""
    address = _col(address)
    octets = F.split(address, r"\.")
    number = F.lit(0).cast("bigint")
    for position in range(4):
        number = number * 256 + F.get(octets, F.lit(position)).try_cast("bigint")
    return F.when(address.rlike(_DOTTED), number)


def in_cidr(address: Column | str, network: Column | str) -> Column:
    """True/False for IPv4 text, NULL otherwise.

    ``network`` is literal CIDR text, or a column with ``a.b.c.d`` or ``a.b.c.d/len``.
    """
    number = ipv4_number(address)
    if isinstance(network, str):
        net = ipaddress.IPv4Network(network, strict=False)
        mask = F.lit(int(net.netmask)).cast("bigint")
        return number.bitwiseAND(mask) == F.lit(int(net.network_address)).cast("bigint")
    parts = F.split(network, "/")
    length = F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.lit(32))
    host_bits = F.when(length.between(0, 32), F.lit(32) - length)
    shifted = [F.call_function("shiftright", side, host_bits) for side in (number, ipv4_number(F.get(parts, F.lit(0))))]
    return shifted[0] == shifted[1]


def direction(source: Column | str, target: Column | str, home: str = "172.28.0.0/16") -> Column:
    """Traffic direction relative to the home network; NULL when an end is not IPv4."""
    # An index into the four outcomes reads each address once, where a chain of cases would repeat it.
    outcome = in_cidr(source, home).cast("int") * 2 + in_cidr(target, home).cast("int")
    return F.get(F.array(*map(F.lit, ("external", "inbound", "outbound", "internal"))), outcome)


# --- both address families -----------------------------------------------------------------------

_HEX = "[0-9A-Fa-f]{1,4}"
_COLONS = rf"^(?=.*:)(?!.*:::)(?!.*::.*::)(?!:[^:])(?!.*[^:]:$)(?:{_HEX})?(?::(?:{_HEX})?)*$"
_TAIL = rf"^(.*:)({_OCTET}(?:\.{_OCTET}){{3}})$"
_V4_PREFIX = "00" * 10 + "ffff"  # where IPv4 addresses lie among the 128-bit ones
_ALL = (1 << 128) - 1


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body looks at it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hex_of_ipv4(address: Column) -> Column:
    return F.lpad(F.hex(ipv4_number(address)), 8, "0")


def _hex_of_ipv6(address: Column) -> Column:
    """32 hexadecimal digits; NULL for text that is no IPv6 address."""

    def dotted_tail(tail: Column) -> Column:  # stands for the last two groups
        digits = _hex_of_ipv4(F.substring_index(address, ":", -1))
        return F.concat(tail, F.left(digits, F.lit(4)), F.lit(":"), F.right(digits, F.lit(4)))

    def groups(part: Column) -> Column:
        return F.transform(F.filter(F.split(part, ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0"))

    def joined(text: Column, halves: Column) -> Column:
        left, right = halves["left"], halves["right"]
        missing = F.lit(8) - F.size(left) - F.size(right)
        fits = F.when(F.contains(text, F.lit("::")), missing >= 1).otherwise(missing == 0)
        return F.when(fits, F.concat(F.array_join(left, ""), F.repeat(F.lit("0000"), missing), F.array_join(right, "")))

    def read(text: Column) -> Column:
        none = F.array().cast("array<string>")
        right = F.when(F.contains(text, F.lit("::")), groups(F.substring_index(text, "::", -1))).otherwise(none)
        halves = F.struct(groups(F.substring_index(text, "::", 1)).alias("left"), right.alias("right"))
        return F.when(text.rlike(_COLONS), _bound(halves, lambda h: joined(text, h)))

    tail = F.regexp_extract(address, _TAIL, 1)
    return _bound(F.when(F.contains(address, F.lit(".")), dotted_tail(tail)).otherwise(address), read)


def address_bytes(address: Column | str) -> Column:
    """An IPv4 or IPv6 address as 16 bytes, which compare in the order of the addresses; NULL for anything else.

    IPv4 counts as the IPv6 address that embeds it.
    """
    a = _col(address)
    four = F.concat(F.lit(_V4_PREFIX), _hex_of_ipv4(a))
    return F.unhex(F.when(F.contains(a, F.lit(":")), _hex_of_ipv6(a)).otherwise(four))


def _span(network: str) -> tuple[int, int]:
    """First and last 128-bit number of a network."""
    net = ipaddress.ip_network(network, strict=False)
    shift = (0xFFFF << 32) if net.version == 4 else 0
    return int(net.network_address) + shift, int(net.broadcast_address) + shift


def _union(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint spans that are not next to each other."""
    merged: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _outside(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    edges = [-1, *(x for span in spans for x in span), _ALL + 1]
    return [(a + 1, b - 1) for a, b in zip(edges[::2], edges[1::2], strict=True) if a + 1 <= b - 1]


def _items(text: str) -> list[str]:
    """The parts of a list between its outermost commas."""
    items, depth, begun = [], 0, 0
    for at, c in enumerate(text + ","):
        depth += (c == "[") - (c == "]")
        if c == "," and not depth:
            items.append(text[begun:at].strip())
            begun = at + 1
    if depth:
        raise ValueError(f"brackets do not match in {text!r}")
    return items


def address_spans(networks: str) -> list[tuple[int, int]]:
    """The 128-bit addresses of a network list as sorted disjoint spans.

    ``networks`` is an address, a network, ``any``, a list in brackets, or one of these behind ``!`` for all others.
    Of a list, what its negated parts name is taken away from what the rest names (from everything if all are negated).
    """
    text = networks.strip()
    if text.startswith("!"):
        return _outside(address_spans(text[1:]))
    if text == "any":
        return [(0, _ALL)]
    if not text.startswith("["):
        return [_span(text)]
    if not text.endswith("]"):
        raise ValueError(f"brackets do not match in {networks!r}")
    items = [item for item in _items(text[1:-1]) if item]
    wanted = _union([s for item in items if not item.startswith("!") for s in address_spans(item)])
    taken = _union([s for item in items if item.startswith("!") for s in address_spans(item[1:])])
    if items and all(item.startswith("!") for item in items):
        wanted = [(0, _ALL)]
    free = _outside(taken)
    return _union([(max(a, c), min(b, d)) for a, b in wanted for c, d in free if max(a, c) <= min(b, d)])


def in_networks(address: Column | str, networks: str) -> Column:
    """Whether an IPv4 or IPv6 address is in a network list (see ``address_spans``); NULL for anything else.

    The spans are two sorted array literals; a binary search in steps of falling powers of two counts those that begin at
    or before the address, so a long list costs its logarithm for each row.
    """
    spans = address_spans(networks)
    steps = [1 << i for i in reversed(range(len(spans).bit_length()))]
    lows, highs = (F.array(*[F.lit(span[i].to_bytes(16, "big")) for span in spans]) for i in (0, 1))

    def member(a: Column) -> Column:
        if not spans:
            return F.when(a.isNotNull(), F.lit(False))

        def further(count: Column, step: Column) -> Column:
            return F.when((count + step <= len(spans)) & (F.get(lows, count + step - 1) <= a), count + step).otherwise(count)

        count = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)
        return F.when(a.isNotNull(), F.coalesce(a <= F.get(highs, count - 1), F.lit(False)))

    return _bound(address_bytes(address), member)


def direction_by_networks(source: Column | str, target: Column | str, home: str) -> Column:
    """Traffic direction relative to a home network list of either family; NULL when an end is no address."""
    outcome = in_networks(source, home).cast("int") * 2 + in_networks(target, home).cast("int")
    return F.get(F.array(*map(F.lit, ("external", "inbound", "outbound", "internal"))), outcome)


def prefix_key(address: Column, length: Column) -> Column:
    """The leading ``length`` bits of 16 bytes, as text: whole bytes in hex, then what the next byte keeps of its bits."""
    digits, rest = F.hex(address), F.pmod(length, F.lit(8))
    whole = F.floor(length / 8).cast("int")
    byte = F.conv(F.substring(digits, whole * 2 + 1, F.lit(2)), 16, 10).cast("int")
    partial = F.when(rest > 0, F.call_function("shiftright", byte, (F.lit(8) - rest).cast("int"))).otherwise(0)
    return F.concat(F.left(digits, whole * 2), F.lit("."), partial.cast("string"))


def in_port_group(port: Column | str, ports: Sequence[int] = (80, 443)) -> Column:
    return _col(port).isin(*ports)
