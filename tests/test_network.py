import ipaddress
import random

from pyspark.sql import functions as F

from logharbor.functions.network import canonical_ip, ip_version

EDGES = [
    "192.168.1.1", "256.256.256.256", "01.2.3.4", "1.2.3", "1.2.3.4.5", "", "::", "::1", "1::",
    "2001:DB8::0001", "2001:db8:0:0:1:0:0:1", "1:0:0:2:0:0:0:3", "0:0:0:0:0:0:0:0", "1:2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "12345::",
    "::ffff:1.2.3.4", "::ffff:256.2.3.4", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.4", "fe80::1%eth0", "fe80::1%",
    "g::1", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8", "1:2:3:4::5:6:7:8", "a b", "::ffff:0:0",
]


def expected(text):
    try:
        ip = ipaddress.ip_address(text)
        return str(ip), ip.version
    except ValueError:
        return None, None


def test_matches_the_standard_library(spark):
    rng = random.Random(7)
    texts = list(EDGES)
    for _ in range(300):
        groups = [rng.choice(["0", "0", "0000", "1", "00ab", "FfFf"]) for _ in range(8)]
        text = ":".join(groups)
        if rng.random() < 0.5:
            cut = sorted(rng.sample(range(9), 2))
            text = ":".join(groups[: cut[0]]) + "::" + ":".join(groups[cut[1] :])
        texts.append(text)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select("text", canonical_ip(F.col("text")).alias("ip"), ip_version(F.col("text")).alias("v")).collect()
    wrong = [(r.text, r.ip, r.v, expected(r.text)) for r in got if (r.ip, r.v) != expected(r.text)]
    assert wrong == []
