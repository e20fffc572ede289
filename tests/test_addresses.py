"""Native address parsing and the range index against Python's ipaddress."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from netrill.functions import addresses
from netrill.operators import ranges

ODD = [
    "", ":", "::", ":::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8",
    "1:2:3:4:5:6:7:8::", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7", "12345::", "g::", "1::2::3", ":1:2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7:8:", "::ffff:1.2.3.4", "::FFFF:255.255.255.255", "::ffff:256.1.1.1", "::1.2.3", "::1.2.3.04",
    "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "fe80::1%eth0", "fe80::1%", "fe80::1%a%b", "::1.2.3.4:5",
    " ::1", "::1\n", "::ffff:0:1.2.3.4", "0:0:0:0:0:ffff:102:304", "1.2.3.4", "::g1.2.3.4", "abcd:EF01:2345:6789:abcd:ef01:2345:6789",
]


def packed(text):
    try:
        address = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    return (address.ipv4_mapped or address).packed


def test_ipv6_texts(spark):
    rng = random.Random(1)
    made = [str(ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128))) for _ in range(50)]
    made += [ipaddress.IPv6Address(rng.getrandbits(rng.choice((20, 60, 100)))).exploded for _ in range(50)]
    made += ["".join(rng.choice("01f:.") for _ in range(rng.randrange(12))) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in [*ODD, *made]], "text string")
    for text, got in rows.select("text", addresses.ipv6_bytes(F.col("text"))).collect():
        assert (got and bytes(got)) == packed(text), text


def test_index_against_every_range(spark):
    rng = random.Random(2)
    texts, known = [], []
    for _ in range(150):
        bits = rng.choice((32, 128))
        kind = ipaddress.IPv4Address if bits == 32 else ipaddress.IPv6Address
        low = rng.getrandbits(bits) if rng.random() < 0.5 else rng.getrandbits(10) + (7 << (bits - 8))
        high = min((1 << bits) - 1, low + rng.choice((0, 5, 300, 1 << 20)))
        texts.append(f"{kind(low)}-{kind(high)}")
        known.append((bits, low, high))
    asked = [(bits, max(0, min((1 << bits) - 1, end + d))) for bits, *ends in known for end in ends for d in (-1, 0, 1)]
    asked = [(str((ipaddress.IPv4Address if b == 32 else ipaddress.IPv6Address)(n)), b, n) for b, n in asked]
    rows = spark.createDataFrame([(t,) for t, _, _ in asked], "host string")
    found = ranges.in_ranges(rows, "host", ranges.configured_ranges(spark, ",".join(texts)))
    wanted = {t for t, b, n in asked if any(b == bits and low <= n <= high for bits, low, high in known)}
    # A text below ::1:0:0:0 may read as IPv4-mapped; none is made here.
    assert {r.host for r in found.collect()} == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "NestedLoop" not in plan


def test_others_pass_and_rows_stay(spark):
    rows = spark.createDataFrame([("10.0.0.1", 1), ("10.0.0.1", 1), (None, 2), ("x", 3), ("10.0.0.9", 4)], "host string, n int")
    wanted = ranges.configured_ranges(spark, "10.0.0.0/29,10.0.0.1")
    got = ranges.in_ranges(rows, "host", wanted, others=F.col("n") == 2)
    assert sorted(map(tuple, got.collect()), key=str) == [("10.0.0.1", 1), ("10.0.0.1", 1), (None, 2)]


@pytest.mark.parametrize("text", ["10.0.0.255-10.0.0.1", "1::2/129", "10.0.0.0/8-10.0.0.1"])
def test_bad_ranges_raise(spark, text):
    with pytest.raises(Exception, match="invalid address range"):
        ranges.configured_ranges(spark, text).collect()
