"""Networks, catalogues, suppression and batch rate limits."""

import datetime as dt
import ipaddress
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, plan, rows
from flowlantern.functions.net import address_bytes, address_spans, direction, in_cidr, in_networks, in_port_group, ipv4_number
from flowlantern.operators import alerts, catalogues
from flowlantern.plans import queries
from flowlantern.sources import readers

ADDRESSES = ["172.28.0.10", "203.0.113.9", "fe80::1", None, "172.28.255.255", "172.29.0.0", "1.2.3", "1.2.3.256", "1.2.3.4.5", "", "a.b.c.d", "0.0.0.0", "255.255.255.255"]


def test_ipv4_number(spark):
    table = spark.createDataFrame([(a,) for a in ADDRESSES], "a string")

    def wanted(address):
        try:
            return int(ipaddress.IPv4Address(address))
        except (ValueError, TypeError):
            return None

    assert rows(table.select("a", ipv4_number("a"))) == sorted([(a, wanted(a)) for a in ADDRESSES], key=repr)


@pytest.mark.parametrize("network", ["172.28.0.0/16", "0.0.0.0/0", "172.28.0.10/32", "172.28.0.10", "128.0.0.0/1"])
def test_in_cidr_literal_and_column(spark, network):
    table = spark.createDataFrame([(a,) for a in ADDRESSES], "a string").withColumn("net", F.lit(network))
    net = ipaddress.IPv4Network(network)

    def wanted(address):
        try:
            return ipaddress.IPv4Address(address) in net
        except (ValueError, TypeError):
            return None

    expected = sorted([(a, wanted(a)) for a in ADDRESSES], key=repr)
    assert rows(table.select("a", in_cidr("a", network))) == expected
    assert rows(table.select("a", in_cidr("a", F.col("net")))) == expected


def test_direction_and_ports(spark):
    home, out = "172.28.0.1", "8.8.8.8"
    pairs = [(home, home), (home, out), (out, home), (out, out), (home, None), ("fe80::1", out)]
    table = spark.createDataFrame(pairs, "a string, b string")
    found = [row[0] for row in table.select(direction("a", "b")).collect()]
    assert found == ["internal", "outbound", "inbound", "external", None, None]
    ports = spark.createDataFrame([(80,), (443,), (8080,)], "p int")
    assert [row[0] for row in ports.select(in_port_group("p")).collect()] == [True, True, False]


TEXTS = [
    "::", "::1", "1::", "fe80::1", "2001:db8::ff00:42:8329", "2001:0DB8:0:0:0:ff00:0042:8329", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33", "1.2.3.4",
    "0.0.0.0", "255.255.255.255", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "", None, "x", "1:2", "1:::2",
    "::1::2", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "12345::", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "fe80::1%eth0", "::1.2.3.256", "1.2.3", "::g", ":",
]


def test_address_bytes_against_the_library(spark):
    def wanted(text):
        try:
            address = ipaddress.ip_address(text or "")
        except ValueError:
            return None
        if "%" in text:
            return None
        return int(address).to_bytes(16, "big") if address.version == 6 else b"\0" * 10 + b"\xff" * 2 + address.packed

    found = spark.createDataFrame([(t,) for t in TEXTS], "a string").select("a", address_bytes("a").alias("b")).collect()
    assert {r.a: None if r.b is None else bytes(r.b) for r in found} == {t: wanted(t) for t in TEXTS}


def test_random_addresses(spark):
    rng = random.Random(6)
    numbers = [rng.getrandbits(128) & rng.getrandbits(128) & rng.getrandbits(128) & sum(0xFFFF << 16 * i for i in range(8) if rng.random() < 0.6) for _ in range(300)]
    texts = [t for n in numbers for t in (str(ipaddress.IPv6Address(n)), ipaddress.IPv6Address(n).exploded.upper())]
    found = spark.createDataFrame([(t,) for t in texts], "a string").select(address_bytes("a")).collect()
    assert [int.from_bytes(r[0], "big") for r in found] == [n for n in numbers for _ in (0, 1)]


@pytest.mark.parametrize(
    "networks",
    [
        "10.0.0.0/8", "any", "!any", "[]", "!10.0.0.0/8", "[10.0.0.0/8, !10.1.0.0/16]", "[10.0.0.0/8, ![10.1.0.0/16, !10.1.2.0/24]]",
        "[!10.0.0.0/8, !2001:db8::/32]", "[2001:db8::/32, 10.0.0.0/9, 10.128.0.0/9]", "[[10.1.0.0/16, 10.3.0.0/16], ![10.3.3.3], fe80::/10]",
    ],
)
def test_network_lists(spark, networks):
    def named(text, at):
        text = text.strip()
        if text.startswith("!"):
            return not named(text[1:], at)
        if not text.startswith("["):
            net = ipaddress.ip_network("::/0" if text == "any" else text)
            return text == "any" or (at.version == net.version and at in net)
        items = [named_item for named_item in re.findall(r"!?\[(?:[^\[\]]|\[[^\]]*\])*\]|[^,\[\]\s]+", text[1:-1])]
        yes, no = [i for i in items if i[0] != "!"], [i for i in items if i[0] == "!"]
        return bool(items) and (not yes or any(named(i, at) for i in yes)) and all(named(i, at) for i in no)

    texts = [f"10.{a}.{b}.3" for a in (0, 1, 2, 3, 127, 128, 255) for b in (0, 2, 3)] + ["11.0.0.0", "9.255.255.255", "10.0.0.0", "10.255.255.255"]
    texts += ["2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "2001:db9::", "fe80::1", "febf::", "fec0::", "::"]
    found = spark.createDataFrame([(t,) for t in [*texts, "x", None]], "a string").select("a", in_networks("a", networks).alias("b")).collect()
    assert {r.a: r.b for r in found} == {t: named(networks, ipaddress.ip_address(t)) for t in texts} | {"x": None, None: None}


def test_spans_are_disjoint_and_sorted():
    spans = address_spans("[10.0.0.0/8, 10.1.0.0/16, 11.0.0.0/8, !10.2.0.0/16, ::/127]")
    assert len(spans) == 3 and all(a[1] + 1 < b[0] for a, b in zip(spans, spans[1:]))
    for text in ("[10.0.0.0/8", "10.0.0.0/8]", "[[10.0.0.0/8]", "10.0.0.0/40", "home"):
        with pytest.raises(ValueError):
            address_spans(text)


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "line_no long, line string")


def test_classification_lines(spark):
    dim = catalogues.classification_dim(
        lines(
            spark,
            "# config classification: shortname,short description,priority",
            "",
            "config classification: malware-traffic,Traffic of known malware, 1",
            "config classification: port-sweep,Sweep over many ports,3",
            "config classification: odd,One, two, 2",
            "config classification: broken,No priority",
        )
    )
    assert rows(dim, "shortname", "description", "priority") == [
        ("malware-traffic", "Traffic of known malware", 1),
        ("odd", "One, two", 2),
        ("port-sweep", "Sweep over many ports", 3),
    ]


def test_reference_lines_last_one_wins(spark):
    table = lines(
        spark,
        "config reference: secunia   http://first/",
        "#config reference: cve http://off/",
        "config reference: bid\t    http://bid/",
        "config reference: secunia http://last/",
    )
    assert rows(catalogues.reference_dim(table)) == [("bid", "http://bid/"), ("secunia", "http://last/")]
    assert "WindowGroupLimit" in plan(catalogues.reference_dim(table))


def test_threshold_lines(spark):
    dim = catalogues.threshold_dim(
        lines(
            spark,
            "threshold gen_id 1, sig_id 5100, type limit, track by_dst, count 4, seconds 30",
            "suppress gen_id 1, sig_id 5200, track by_src, ip 10.20.0.0/16",
            "suppress gen_id 1, sig_id 7",
            "#threshold gen_id 2, sig_id 8, type both, track by_src, count 6, seconds 90",
            "threshold gen_id x, sig_id 99999999999999999999, type both",
        )
    )
    assert rows(dim.drop("line_no")) == sorted(
        [
            ("threshold", 1, 5100, "limit", "by_dst", 4, 30, None),
            ("suppress", 1, 5200, None, "by_src", None, None, "10.20.0.0/16"),
            ("suppress", 1, 7, None, None, None, None, None),
            ("threshold", None, None, "both", None, None, None, None),
        ],
        key=repr,
    )


def test_catalogues_from_files(spark, tmp_path):
    (tmp_path / "c.config").write_text("# x\nconfig classification: a,b,1\n")
    dim = readers.read_catalogue(spark, str(tmp_path / "c.config"), "classification")
    assert rows(dim, "shortname", "description", "priority") == [("a", "b", 1)]
    (tmp_path / "f.yml").write_text("rule-files:\n  - a.rules\n  - b.rules\n  - a.rules\n")
    listed = readers.read_catalogue(spark, str(tmp_path / "f.yml"), "lines")
    assert rows(catalogues.distinct_rule_files(listed)) == [("a.rules", 2), ("b.rules", 1)]
    events = queries._alerts(spark, SF_DIR)
    assert "BroadcastHashJoin" in plan(alerts.enrich_class(events, dim))


def test_large_catalogue_is_not_broadcast(spark):
    events = queries._alerts(spark, SF_DIR)
    wide = spark.range(5_000_000).select(
        F.col("id").cast("string").alias("description"), F.lit("s").alias("shortname"), F.lit(1).alias("priority")
    )
    assert "SortMergeJoin" in plan(alerts.enrich_class(events, wide))


def test_catalogue_diff_counts_copies(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("c", 2), ("c", 2), (None, 3)], "k string, v int")
    assert rows(catalogues.catalogue_diff(old, new, ["k", "v"])) == [
        ("a", 1, "removed", 1),
        ("b", 2, "removed", 1),
        ("c", 2, "added", 2),
    ]
    assert catalogues.catalogue_diff(old, old, ["k", "v"]).count() == 0


ALERTS = "alert_id string, ts timestamp, sig_id long, src_ip string, dest_ip string"


def alert(ident, second, sig=1, src="a", dst="b"):
    return (str(ident), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second), sig, src, dst)


def test_suppress_keeps_alerts_it_cannot_place(spark):
    table = spark.createDataFrame(
        [alert(1, 0, 5, "10.0.0.1"), alert(2, 0, 5, "10.0.1.1"), alert(3, 0, 5, None), alert(4, 0, 5, "fe80::1"), alert(5, 0, 6, "10.0.0.1"), alert(6, 0, None, "10.0.0.1"), alert(7, 0, 7)],
        ALERTS,
    ).withColumn("gid", F.lit(1).cast("long"))
    rules = catalogues.threshold_dim(lines(spark, "suppress gen_id 1, sig_id 5, track by_src, ip 10.0.0.0/24", "suppress gen_id 1, sig_id 7"))
    assert rows(alerts.suppress(table, rules), "alert_id") == [("2",), ("3",), ("4",), ("5",), ("6",)]


@pytest.mark.parametrize(
    ("line", "left"),
    [
        ("suppress gen_id 3, sig_id 5", [1, 3, 4]),
        ("suppress gen_id 0, sig_id 5", [3, 4]),
        ("suppress gen_id 3, sig_id 0", [1, 3]),
        ("suppress gen_id 0, sig_id 0", []),
        ("suppress gen_id 0, sig_id 0, track by_src, ip [10.0.0.1, 10.0.2.0/24]", [2, 4]),
        ("suppress gen_id 1, sig_id 5, track by_dst, ip 10.0.0.1", [1, 2, 3, 4]),
    ],
)
def test_suppress_by_generator_any_and_lists(spark, line, left):
    table = spark.createDataFrame(
        [("1", 1, 5, "10.0.0.1", "b"), ("2", 3, 5, "10.0.1.1", "b"), ("3", 1, 6, "10.0.2.9", "b"), ("4", 3, 7, None, "b")],
        "alert_id string, gid long, sig_id long, src_ip string, dest_ip string",
    )
    found = alerts.suppress(table, catalogues.threshold_dim(lines(spark, line)))
    assert rows(found, "alert_id") == [(str(i),) for i in left]


def test_suppress_by_networks_of_both_families(spark):
    table = spark.createDataFrame(
        [(str(i), 1, 5, a, "10.0.0.1") for i, a in enumerate(["2001:db8::1", "2001:db8:1::1", "2001:DB8:0:0::9", "10.9.9.9", "::ffff:10.9.9.9", "host", None])],
        "alert_id string, gid long, sig_id long, src_ip string, dest_ip string",
    )

    def left(*texts):
        return {int(r[0]) for r in rows(alerts.suppress(table, catalogues.threshold_dim(lines(spark, *texts))), "alert_id")}

    assert left("suppress gen_id 1, sig_id 5, track by_src, ip 2001:db8::/48") == {1, 3, 4, 5, 6}
    assert left("suppress gen_id 1, sig_id 5, track by_src, ip 2001:db8::/47") == {3, 4, 5, 6}
    assert left("suppress gen_id 1, sig_id 5, track by_src, ip ::/0") == {5, 6}
    assert left("suppress gen_id 1, sig_id 5, track by_src, ip 0.0.0.0/0") == {0, 1, 2, 5, 6}
    assert left("suppress gen_id 0, sig_id 0, track by_src, ip [10.9.9.8/31, 2001:db8:1::1]") == {0, 2, 5, 6}
    assert left("suppress gen_id 1, sig_id 5, track by_src, ip 10.9.9.9/40") == set(range(7))
    assert left("suppress gen_id 1, sig_id 5, track by_dst, ip 10.0.0.0/29") == set()
    assert left("suppress gen_id 1, sig_id 6") == set(range(7)) and left() == set(range(7))


def test_suppress_joins_by_equality_only(spark):
    table = spark.createDataFrame([("1", 1, 5, "10.0.0.1", "b")], "alert_id string, gid long, sig_id long, src_ip string, dest_ip string")
    rules = catalogues.threshold_dim(lines(spark, "suppress gen_id 0, sig_id 0, track by_src, ip [10.0.0.0/24, fe80::/10]", "suppress gen_id 1, sig_id 0"))
    text = plan(alerts.suppress(table, rules))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_doubled_catalogue_keys_do_not_multiply(spark):
    table = spark.createDataFrame([("x", "Text"), ("y", "Other")], "alert_id string, category string")
    dim = catalogues.classification_dim(
        lines(spark, "config classification: a,Text,1", "config classification: b,Text,2", "config classification: b,Text,3")
    )
    assert rows(alerts.enrich_class(table, dim), "alert_id", "shortname", "priority") == [("x", "b", 3), ("y", None, None)]
    systems = catalogues.reference_dim(lines(spark, "config reference: CVE http://one/", "config reference: cve http://two/"))
    cited = spark.createDataFrame([("Cve,7",)], "reference string")
    assert rows(alerts.enrich_reference(cited, systems), "reference_url") == [("http://two/7",)]


def test_limits_of_a_catalogue(spark):
    rules = catalogues.threshold_dim(
        lines(
            spark,
            "threshold gen_id 1, sig_id 5, type limit, track by_src, count 9, seconds 60",
            "threshold gen_id 1, sig_id 5, type limit, track by_src, count 1, seconds 60",
            "event_filter gen_id 3, sig_id 0, type threshold, track by_dst, count 2, seconds 60",
        )
    )
    T = dt.datetime(2024, 1, 1)
    table = [(f"{g}{s}{i}", T + dt.timedelta(seconds=20 * i), g, s, "a", "b") for g, s in ((1, 5), (1, 6), (3, 8)) for i in range(4)]
    frame = spark.createDataFrame(table, "alert_id string, ts timestamp, gid long, sig_id long, src_ip string, dest_ip string")
    left = ["150", "153", "160", "161", "162", "163", "381"]
    found = alerts.apply_limits(frame, rules)
    assert rows(found, "alert_id") == [(i,) for i in left] and found.columns == frame.columns
    rest = catalogues.threshold_dim(lines(spark, "threshold gen_id 0, sig_id 0, type both, track by_src, count 2, seconds 3600"))
    assert rows(alerts.apply_limits(frame, rest), "alert_id") == [("151",), ("161",), ("381",)]


def expected_limit(table, kind, n, seconds, track):
    """Brute force over sorted rows."""
    seen, kept = {}, []
    for row in sorted(table, key=lambda r: (r[1], r[0])):
        tracker = row[3] if track == "by_src" else row[4]
        group = (row[2], tracker, int((row[1] - dt.datetime(1970, 1, 1)).total_seconds() // seconds))
        rank = seen[group] = seen.get(group, 0) + 1
        if {"limit": rank <= n, "both": rank == n, "threshold": rank % n == 0}[kind]:
            kept.append((row[0],))
    return sorted(kept, key=repr)


@pytest.mark.parametrize("kind", ["limit", "both", "threshold"])
@pytest.mark.parametrize("track", ["by_src", "by_dst"])
@pytest.mark.parametrize("seconds", [10, 3600, 7])
def test_rate_limit_against_brute_force(spark, kind, track, seconds):
    rng = random.Random(seconds)
    # A third of the rows belong to one signature and address, many at the same moment.
    table = [alert(i, rng.choice([0, 0, rng.random() * 7200]), 1, "hot", "hot") for i in range(200)]
    table += [alert(i, rng.random() * 7200, rng.choice([1, 2, None]), rng.choice("xyz"), rng.choice(["x", None])) for i in range(200, 600)]
    frame = spark.createDataFrame(table, ALERTS).repartition(3)
    found = alerts.rate_limit(frame, kind, 3, seconds, track)
    assert rows(found, "alert_id") == expected_limit(table, kind, 3, seconds, track)
    assert found.columns == frame.columns


@pytest.mark.parametrize("kind", ["limit", "both"])
def test_large_n(spark, kind):
    rng = random.Random(1)
    table = [alert(i, rng.random() * 100, 1, "hot") for i in range(300)]
    frame = spark.createDataFrame(table, ALERTS)
    for n in (70, 5000):
        found = alerts.rate_limit(frame, kind, n, 50)
        assert rows(found, "alert_id") == expected_limit(table, kind, n, 50, "by_src")


def test_limit_is_monotone_in_n(spark):
    frame = queries._alerts(spark, SF_DIR)
    sizes = [alerts.rate_limit(frame, "limit", n, 86400).count() for n in (1, 2, 5)]
    assert sizes == sorted(sizes)
    with pytest.raises(ValueError):
        alerts.rate_limit(frame, "never")


def test_hot_address_is_cut_down_before_the_shuffle(spark):
    frame = queries._alerts(spark, SF_DIR)
    for kind in ("limit", "both"):
        text = plan(alerts.rate_limit(frame, kind, 3, 60))
        assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")
        assert ", Partial" in text
    # Every n-th needs all ranks: the shuffle of the rows is by time slice as well.
    text = plan(alerts.rate_limit(frame, "threshold", 3, 60))
    assert "hashpartitioning(_group" in text and "_slice" in text[text.index("hashpartitioning(_group") :][:60]
