"""Uploads, objects, locations, names, layouts and messages."""

import base64
import datetime as dt
import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from hydrolens.functions import text
from hydrolens.functions.shapes import SHAPES, as_shape, from_shape
from hydrolens.functions.text import inner_ipv4, ipv6_halves
from hydrolens.operators.lookup import locate_numbers, locate_prefixes, lookup_join, pair_by_name, unpaired
from hydrolens.operators.upsert import latest_per_key, upsert_rows
from hydrolens.plans import uploads as u
from hydrolens.schemas import PREDICTIONS
from hydrolens.sources.messages import kafka_options, normalise_messages, parse_messages, to_messages, write_messages
from hydrolens.sources.mock import mock_predictions
from tests.conftest import plan_text


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_media_types(spark):
    names = ["a.PNG", "b.tar.jpeg", "noext", "x.txt", "y.svg", ".webp", "a.b/c"]
    assert apply(spark, text.media_type, names) == [
        "image/png", "image/jpeg", "image/png", "image/png", "image/svg+xml", "image/webp", "image/png",
    ]


def test_names_in_paths(spark):
    assert apply(spark, text.base_name, ["a/b/c.d.png", "plain", ".hidden", "x/.png"]) == ["c.d", "plain", ".hidden", ".png"]
    keys = ["uploads/17_a_b.png", "uploads/17.png", "other/1_a.png", "uploads/_x", "uploads/a/b_c"]
    assert apply(spark, text.uploaded_name, keys) == ["a_b.png", None, None, "x", "c"]


def test_iso_text(spark):
    stamps = [dt.datetime(2024, 1, 2, 3, 4, 5, 600), dt.datetime(2024, 1, 2, 3, 4, 5)]
    assert apply(spark, text.iso_text, stamps, "timestamp_ntz") == [s.isoformat() for s in stamps]


def test_fixed_places_round_ties_to_even(spark):
    numbers = [56.25, 0.125, 1234567.875, 0.4235]
    assert apply(spark, lambda c: text.fixed(c, 2), numbers, "double") == [f"{n:.2f}" for n in numbers]


def test_size_texts(spark):
    sizes = [0, 10239, 10240, 10240 * 1024 - 513, 10240 * 1024 - 512, 52428800, 1 << 40, 1 << 50]
    assert apply(spark, text.size_text, sizes, "bigint") == [
        "0 bytes", "10239 bytes", "10 kB", "10239 kB", "10 MB", "50 MB", "1024 GB", "1024 TB",
    ]


def test_ipv4(spark):
    ips = ["1.2.3.4", "255.255.255.255", "256.1.1.1", "::1", "1.2.3", "", None, "01.2.3.4x"]
    want = [int(ipaddress.ip_address(x)) for x in ips[:2]] + [None] * 6
    assert apply(spark, text.ipv4_number, ips) == want


def test_id_json(spark):
    df = spark.createDataFrame([(7, 'a"b')], "id bigint, name string")
    row = df.select(text.id_json("id").alias("a"), text.id_json("name").alias("b")).first()
    assert row.a == json.dumps({"id": 7}) and row.b == json.dumps({"id": 'a"b'})


def test_normalised_names(spark):
    df = spark.sql("SELECT 1 AS `A B`, named_struct('C d', array(named_struct('E F', 2))) AS `X`, map('K k', named_struct('V v', 3)) AS `M M`")
    clean = text.normalise_names(df)
    assert clean.schema.simpleString() == "struct<a_b:int,x:struct<c_d:array<struct<e_f:int>>>,m_m:map<string,struct<v_v:int>>>"
    assert clean.first().m_m["K k"].v_v == 3
    with pytest.raises(ValueError):
        text.normalise_names(spark.sql("SELECT 1 AS `a b`, 2 AS a_b"))


def test_upload_limits(spark):
    rows = [("a.png", 52428800), ("b.TIFF", 52428801), ("c.gif", 1), ("d", 1)]
    got = u.validate_uploads(spark.createDataFrame(rows, "filename string, file_size bigint")).collect()
    assert [(r.size_ok, r.type_ok) for r in got] == [(True, True), (False, True), (True, False), (True, False)]


def test_already_uploaded_counts_successes_only(spark):
    log = spark.createDataFrame([("a", True), ("a", True), ("b", False)], "filename string, success boolean")
    new = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "filename string")
    got = {r.filename: r.already_uploaded for r in u.mark_already_uploaded(new, log).collect()}
    assert got == {"a": True, "b": False, "c": False, None: False}


def test_statistics_of_an_empty_log(spark):
    row = u.upload_statistics(spark.createDataFrame([], "success boolean, file_size bigint")).first()
    assert tuple(row) == (0, 0, 0, None, 0.0)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_a_hot_key(spark, how):
    rng = random.Random(3)
    rows = [(i, None if i % 50 == 0 else (7 if i % 3 else rng.randrange(40))) for i in range(3000)]
    left = spark.createDataFrame(rows, "i int, k int")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 40, 2)] + [(7, 70)], "k int, v int")
    want = sorted(map(tuple, left.join(right, "k", how).select("i", "v").collect()))
    hot = lookup_join(left, right, "k", how, hot_rows=100)
    assert sorted(map(tuple, hot.select("i", "v").collect())) == want
    assert "Union" in plan_text(hot) and hot.columns == ["k", "i", "v"]
    assert sorted(map(tuple, lookup_join(left, right, "k", how).select("i", "v").collect())) == want


def test_locations_against_brute_force(spark):
    rng = random.Random(5)
    cuts = sorted(rng.sample(range(1 << 32), 120) + [0, 65535, 65536, (1 << 32) - 1])
    ranges = [(a, b - 1, f"r{i}") for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if i % 3]
    points = [rng.randrange(1 << 32) for _ in range(400)] + [a for a, _, _ in ranges] + [b for _, b, _ in ranges]
    df = spark.createDataFrame([(x,) for x in {*points, None}], "n bigint")
    got = {r.n: (r.name, r.found) for r in locate_numbers(df, spark.createDataFrame(ranges, "ip_from bigint, ip_to bigint, name string"), "n", ["name"]).collect()}
    want = {x: next(((name, True) for a, b, name in ranges if x is not None and a <= x <= b), (None, False)) for x in [*points, None]}
    assert got == want


def test_location_rules(spark):
    rows = [(1, "20.0.0.9, 10.0.0.1", "x"), (2, "", "127.0.0.1"), (3, None, "10.1.1.1"), (4, "172.16.0.5", "x"), (5, "junk", "x"), (6, " 21.0.0.1 ,x", "x")]
    uploads = spark.createDataFrame(rows, "id int, x_forwarded_for string, client_host string")
    low = int(ipaddress.ip_address("20.0.0.0"))
    ranges = spark.createDataFrame(
        [(low, low + 255, "A", "R", None, 1.5, None), (low + (1 << 24), low + (1 << 24) + 5, None, "S", "C", 2.0, 3.0)],
        "ip_from bigint, ip_to bigint, country string, region string, city string, lat double, lon double",
    )
    got = {r.id: (r.ip, r.country, r.region, r.city, r.lat, r.lon) for r in u.enrich_location(uploads, ranges).collect()}
    local = ("Development", "Local", "Localhost", 40.7128, -74.0060)
    lost = ("0.0.0.0", "Unknown", "Unknown", "Unknown", 0.0, 0.0)
    assert got == {
        1: ("20.0.0.9", "A", "R", "Unknown", 1.5, 0.0),
        2: ("127.0.0.1", *local),
        3: ("10.1.1.1", *local),
        4: lost,
        5: lost,
        6: ("21.0.0.1", "Unknown", "S", "C", 2.0, 3.0),
    }


ADDRESSES = [
    "::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "::ffff:1.2.3.4", "1:2:3:4:5:6:77.77.88.88", "fe80::1%eth0", "0:0:0:0:0:0:0:1", "::FFFF:C0A8:1",
    "", "::1::", "1:2:3", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "::ffff:1.2.3", "1.2.3.4", ":::", ":1", "1:", "1::2::3", "1:2:3:4:5:6:7::8:9", "::1.2.3.256", "1:2:3:4:5:6:7:8::",
]


def spelt_ipv6(rng, n):
    address = ipaddress.IPv6Address(n)
    return rng.choice([str(address), address.exploded, str(address).upper()])


def number_of(text):
    try:
        return int(ipaddress.IPv6Address(text.split("%")[0]))
    except ValueError:
        return None


def test_ipv6_spellings(spark):
    rng = random.Random(1)
    numbers = [rng.getrandbits(128) & ~(((1 << (16 * rng.randint(0, 7))) - 1) << (16 * rng.randint(0, 4))) & ((1 << 128) - 1) for _ in range(500)]
    texts = [*ADDRESSES, *(spelt_ipv6(rng, n) for n in numbers)]
    halves = ipv6_halves(F.col("t"))
    high, low = halves["high"], halves["low"]
    rows = spark.createDataFrame([(t,) for t in [*texts, "[::5]", "[::5]:443", None]], "t string").select("t", high.alias("h"), low.alias("l"), inner_ipv4(high, low).alias("v4")).collect()
    mask = (1 << 64) - 1
    got = {r.t: None if r.h is None else (r.h & mask) << 64 | r.l & mask for r in rows}
    assert got == {**{t: number_of(t) for t in texts}, "[::5]": 5, "[::5]:443": 5, None: None}
    assert {r.t: r.v4 for r in rows if r.v4 is not None} == {"::ffff:1.2.3.4": 0x01020304, "::FFFF:C0A8:1": 0xC0A80001}


def test_longest_prefix_against_brute_force(spark):
    rng = random.Random(2)
    nets = {ipaddress.IPv6Network((rng.getrandbits(128), rng.choice([0, 1, 7, 32, 33, 63, 64, 65, 96, 127, 128])), strict=False) for _ in range(60)}
    for net in list(nets):  # nested ones
        nets |= {ipaddress.IPv6Network((int(net.network_address) | rng.getrandbits(128 - net.prefixlen) if net.prefixlen < 128 else int(net.network_address), min(128, net.prefixlen + 9)), strict=False)}
    points = [rng.getrandbits(128) for _ in range(100)] + [int(n.network_address) | (rng.getrandbits(128 - n.prefixlen) if n.prefixlen < 128 else 0) for n in nets for _ in range(3)]
    networks = spark.createDataFrame([(str(n), str(n)) for n in nets] + [("1.2.3.0/24", "v4"), ("::", "no length"), ("::/129", "too long"), (None, "none")], "cidr string, name string")
    for some in (networks, networks.where("cidr NOT LIKE '%/0'")):
        known = [ipaddress.IPv6Network(r.cidr) for r in some.collect() if r.name == r.cidr]
        halves = ipv6_halves(F.col("t"))
        high, low = halves["high"], halves["low"]
        df = spark.createDataFrame([(str(ipaddress.IPv6Address(p)),) for p in set(points)], "t string").select("t", high.alias("high"), low.alias("low"))
        got = {r.t: r.network.name for r in locate_prefixes(df, u.parsed_networks(some), ["name"]).collect()}
        want = {}
        for p in set(points):
            inside = [n for n in known if ipaddress.IPv6Address(p) in n]
            if inside:
                want[str(ipaddress.IPv6Address(p))] = str(max(inside, key=lambda n: n.prefixlen))
        assert got == want
    assert locate_prefixes(df, u.parsed_networks(networks.limit(0)), ["name"]).count() == 0


def test_ipv6_location_rules(spark):
    rows = [(1, "::ffff:20.0.0.9", "x"), (2, "::ffff:10.0.0.1", "x"), (3, "2001:DB8::5, 1.1.1.1", "x"), (4, "2001:db9::5", "x"), (5, None, "::1"), (6, "::ffff:127.0.0.1", "x"), (7, None, None)]
    uploads = spark.createDataFrame(rows, "id int, x_forwarded_for string, client_host string")
    low = int(ipaddress.ip_address("20.0.0.0"))
    shape = "country string, region string, city string, lat double, lon double"
    ranges = spark.createDataFrame([(low, low + 255, "A", "R", "C", 1.5, 2.5)], f"ip_from bigint, ip_to bigint, {shape}")
    networks = spark.createDataFrame([("2001:db8::/32", "B", None, "D", None, 3.5)], f"cidr string, {shape}")
    got = {r.id: (r.ip, r.country, r.region, r.city, r.lat, r.lon) for r in u.enrich_location(uploads, ranges, networks).collect()}
    local, lost = ("Development", "Local", "Localhost", 40.7128, -74.0060), ("0.0.0.0", "Unknown", "Unknown", "Unknown", 0.0, 0.0)
    assert got == {
        1: ("::ffff:20.0.0.9", "A", "R", "C", 1.5, 2.5), 2: ("::ffff:10.0.0.1", *local), 3: ("2001:DB8::5", "B", "Unknown", "D", 0.0, 3.5),
        4: lost, 5: ("::1", *local), 6: ("::ffff:127.0.0.1", *local), 7: lost,
    }


def test_pairs(spark):
    a = spark.createDataFrame([("x",), ("y",)], "name string")
    b = spark.createDataFrame([("x", 1)], "name string, m int")
    with pytest.raises(ValueError, match="y"):
        pair_by_name(a, b, "name")
    assert pair_by_name(a, b, "name", "drop").count() == 1
    assert [r.name for r in unpaired(a, b, "name").collect()] == ["y"]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1)], "k int, v string, seq int")
    assert sorted(map(tuple, upsert_rows(target, updates, ["k"], ["seq"]).collect()), key=str) == [(1, "a"), (2, "d"), (3, None)]
    assert latest_per_key(updates, ["k"], ["seq"]).count() == 2


def test_layouts_round_trip(spark):
    base = spark.createDataFrame([(dt.datetime(2024, 1, 1), 5, "f", "u", "m", "v", 12.5, 0.5, 0.1, 0.2, True, 9, "X")], PREDICTIONS)
    for shape, columns in SHAPES.items():
        out = as_shape(base, shape)
        assert out.columns == list(columns)
        back = from_shape(out, shape).first().asDict()
        for canonical in columns.values():
            assert back[canonical] == base.first()[canonical]
    empty = as_shape(spark.createDataFrame([(None,) * len(PREDICTIONS)], PREDICTIONS), "C").first()
    assert (empty.iou_score, empty.dice_score, empty.overflow_detected, empty.location) == (0.0, 0.0, False, "unknown")


def test_messages(spark):
    good = base64.b64encode(b"\x00\xffbytes").decode()
    lines = [
        json.dumps({"filename": "a", "image": good, "date": "2024-01-01T00:00:00", "message_id": 1, "file_size": 7}),
        json.dumps({"filename": "b", "image_link": "uploads/1_b", "date": "soon", "lat": 1.5, "location": "X"}),
        "{not json",
        json.dumps({"filename": "c", "image": "***"}),
        json.dumps({"filename": "d"}),
        json.dumps({"image": good}),
        json.dumps({"filename": "../x", "image": good}),
        json.dumps({"filename": "x..y", "image_link": "a/../../b"}),
        json.dumps({"filename": "x..y", "image_link": "a..b"}),
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = [r for r in normalise_messages(parse_messages(df.select(F.col("i").cast("string").alias("source_id"), "value"))).orderBy("source_id").collect()]
    assert [r.error for r in got] == [None, None, "not JSON", "bad base64", "no image", None, *["path outside the store"] * 2, None]
    assert bytes(got[0].content) == b"\x00\xffbytes" and got[0].location == "unknown"
    assert (got[1].image_link, got[1].lat, got[1].location, got[1].event_time) == ("uploads/1_b", 1.5, "X", None)


def test_written_messages(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "id int, name string, x double")
    rows = {r.key: json.loads(r.value) for r in to_messages(df, "id").collect()}
    assert rows == {"1": {"name": "a"}, "2": {"name": "b", "x": 2.5}}
    write_messages(df, "id", {"format": "json", "path": str(tmp_path / "out")})
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_kafka_settings():
    assert kafka_options("h:1") == {"kafka.bootstrap.servers": "h:1", "kafka.security.protocol": "PLAINTEXT"}
    sasl = kafka_options("h:1", username="u", password="p")
    assert sasl["kafka.security.protocol"] == "SASL_PLAINTEXT" and 'password="p"' in sasl["kafka.sasl.jaas.config"]


def test_mock_rows(spark):
    df = mock_predictions(spark, 5000, seed=4)
    assert df.columns == list(SHAPES["C"])
    r = df.agg(
        F.min("water_coverage_pct"), F.max("water_coverage_pct"), F.min("avg_confidence"), F.max("dice_score"),
        F.min("processing_time_ms"), F.max("processing_time_ms"), F.count_distinct("location"),
        F.count_if(F.col("overflow_detected") != (F.col("water_coverage_pct") > 60)),
    ).first()
    assert 10 <= r[0] < 10.5 and 89.5 < r[1] <= 90 and r[2] >= 0.5 and r[3] <= 0.9 and r[4] == 50 and r[5] == 500 and r[6] == 3 and r[7] == 0
    assert df.repartition(3).orderBy("timestamp").collect() == mock_predictions(spark, 5000, seed=4).orderBy("timestamp").collect()


def test_addresses_are_parsed_once(spark, monkeypatch):
    """Many rows of few addresses: what reads an address is planned over the staged distinct ones, with equal results."""
    spelt = ["20.0.0.9", "::ffff:20.0.0.9", "2001:db8::5", "fe80::1%eth0", "junk", None]
    uploads = spark.range(600).select("id", F.get(F.array(*map(F.lit, spelt)), (F.col("id") % 6).cast("int")).alias("x_forwarded_for"), F.lit(None).cast("string").alias("client_host"))
    low = int(ipaddress.ip_address("20.0.0.0"))
    shape = "country string, region string, city string, lat double, lon double"
    ranges = spark.createDataFrame([(low, low + 255, "A", "R", "C", 1.5, 2.5)], f"ip_from bigint, ip_to bigint, {shape}")
    networks = spark.createDataFrame([("2001:db8::/32", "B", None, "D", None, 3.5)], f"cidr string, {shape}")
    staged = []

    def stage(df, label):
        staged.append((label, df))
        return u_stage(df, label)

    u_stage = u.stage
    monkeypatch.setattr(u, "stage", stage)
    found = u.enrich_location(uploads, ranges, networks)
    assert [label for label, _ in staged] == ["addresses", "numbered"]
    assert sorted(r._n for r in staged[0][1].collect()) == [100] * 6 and staged[1][1].count() == 6
    assert plan_text(found).count("Range (") == 1  # the uploads are read by the join alone
    want = {"20.0.0.9": "A", "::ffff:20.0.0.9": "A", "2001:db8::5": "B", "fe80::1%eth0": "Unknown", "junk": "Unknown", None: "Unknown"}
    got = found.groupBy("x_forwarded_for", "country").count().collect()
    assert {r.x_forwarded_for: (r.country, r["count"]) for r in got} == {k: (v, 100) for k, v in want.items()}
