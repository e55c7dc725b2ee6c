"""Golden rows of the detections and the ingest of raw lines."""

import datetime

import pytest

from logharbor.functions.tagging import accepted, rejected
from logharbor.operators import detections as det
from logharbor.sources.firewall import parse_firewall_lines

AS_OF = "2025-12-26T12:00:00Z"


def at(hour, minute, second=0):
    return datetime.datetime(2025, 12, 26, hour, minute, second)


FIREWALL = [
    (at(9, 0), "10.7.0.3", "198.18.4.4", "allow", 443, 900, "web-out"),
    (at(9, 2), "10.7.0.9", "198.18.4.5", "allow", 53, 77, "names-out"),
    (at(9, 30), "100.64.1.2", "10.7.0.3", "drop", 23, 0, "telnet-in"),
    (at(9, 31), "100.64.1.2", "10.7.0.4", "deny", 5900, 0, "desktop-in"),
    (at(9, 33), "100.64.1.2", "10.7.0.4", "deny", 23, 0, "telnet-in"),
    (at(9, 34), "100.64.1.2", "10.7.0.5", "drop", 5900, 0, "desktop-in"),
    (at(9, 40), "100.64.7.7", "10.7.0.4", "deny", 23, 0, "telnet-in"),
    (at(11, 5), "10.7.0.8", "198.18.9.9", "allow", 21, 62914560, "copy-out"),
    (at(11, 59), "10.7.0.8", "198.18.9.1", "allow", 22, 47185920, "copy-out"),
]
SCHEMA = (
    "TimeGenerated timestamp, SourceIP string, DestinationIP string, Action string, "
    "DestinationPort int, BytesTransferred long, RuleName string"
)


@pytest.fixture(scope="module")
def fw(spark):
    return spark.createDataFrame(FIREWALL, SCHEMA)


def test_bruteforce(fw):
    (row,) = det.detect_bruteforce(fw, AS_OF).collect()
    assert (row.SourceIP, row.AttemptCount, row.TargetHosts, row.AlertSeverity) == ("100.64.1.2", 4, 3, "Low")
    assert (row.FirstSeen, row.LastSeen) == (at(9, 30), at(9, 34))


def test_exfiltration(fw):
    (row,) = det.detect_exfiltration(fw, AS_OF).collect()
    assert tuple(row) == (at(11, 0), "10.7.0.8", 105.0, 2, ["198.18.9.1", "198.18.9.9"])


def test_block_summary(fw):
    got = [(r.RuleName, r.BlockCount, r.UniqueSourceIPs, r.TopTargetPorts) for r in det.block_summary(fw, AS_OF).collect()]
    assert got == [("telnet-in", 3, 2, [23]), ("desktop-in", 2, 1, [5900])]


def test_rows_before_the_lookback_are_left_out(fw):
    assert det.detect_bruteforce(fw, "2025-12-28T00:00:00Z").count() == 0


def test_largest_byte_counts_do_not_overflow(spark):
    top = 2**63 - 1
    rows = [(at(10, i), "10.0.0.1", "10.0.0.2", "allow", 443, top, "r") for i in range(3)]
    (row,) = det.detect_exfiltration(spark.createDataFrame(rows, SCHEMA), AS_OF).collect()
    assert row.TotalMB == round(3 * top / 1048576.0, 2)


def test_vpn_totals(spark):
    rows = [(1048576, 524288, 3600), (2097152, 1048576, 7200), (5242880, 10485760, 14400)]
    (row,) = det.vpn_totals(spark.createDataFrame(rows, "BytesIn long, BytesOut long, ConnectionDuration int")).collect()
    assert (row.TotalSessions, row.TotalInMB, row.TotalOutMB, row.AvgDurationHours) == (3, 8.0, 11.5, 2.33)


LINES = [
    "2024-02-20T12:00:00Z|192.168.1.1|10.0.0.1|allow|firewall-rule-1|TCP|80|443|1024",
    "2024-01-01T10:00:00.5Z|192.168.1.100|10.0.0.1|ALLOW|rule1|tcp|80|443|1024|extra",
    "Feb 20 2024 12:00:00|::1|2001:DB8::1|Drop",
    "2024/02/20 12:00:00|192.168.1.1|10.0.0.1|reset| padded ||||",
    "2024-2-3 1:02:03| 192.168.1.1 |10.0.0.1|deny",
    "2024-02-20T12:00:00Z|256.256.256.256|10.0.0.1|allow",
    "20.02.2024|192.168.1.1|10.0.0.1|allow",
    "2024-02-20T12:00:00Z|192.168.1.1|10.0.0.1|explode",
    "2024-02-20T12:00:00Z|192.168.1.1||allow",
    "2024-02-20T12:00:00Z|192.168.1.1|10.0.0.1|allow|r|TCP|8x|443|1",
    "",
]


@pytest.fixture(scope="module")
def tagged(spark):
    lines = spark.createDataFrame(list(enumerate(LINES)), "n int, line string")
    return parse_firewall_lines(lines, AS_OF)


def test_good_lines(tagged):
    rows = {r.n: r for r in accepted(tagged).collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4]
    assert rows[0].TimeGenerated == datetime.datetime(2024, 2, 20, 12)
    assert (rows[0].SourcePort, rows[0].DestinationPort, rows[0].BytesTransferred) == (80, 443, 1024)
    assert rows[1].TimeGenerated.microsecond == 500000
    assert (rows[1].FirewallAction, rows[1].Protocol) == ("allow", "TCP")
    assert (rows[2].SourceIP, rows[2].DestinationIP, rows[2].FirewallAction) == ("::1", "2001:db8::1", "drop")
    assert (rows[3].RuleName, rows[3].Protocol, rows[3].SourcePort) == ("padded", None, None)
    assert (rows[4].SourceIP, rows[4].TimeGenerated) == ("192.168.1.1", datetime.datetime(2024, 2, 3, 1, 2, 3))
    assert {r.LogSource for r in rows.values()} == {"Firewall"}


def test_reasons_of_bad_lines(tagged):
    assert {r.n: r.reason for r in rejected(tagged).collect()} == {
        5: "bad_ip:SourceIP",
        6: "bad_timestamp",
        7: "bad_action",
        8: "missing_fields:DestinationIP",
        9: "bad_integer:SourcePort",
        10: "bad_timestamp",
    }
