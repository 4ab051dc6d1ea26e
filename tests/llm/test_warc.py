"""Broken archives: defined records, and never a failure."""

import gzip
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import warc


def record(kind="response", own="<a>", length=None, block=b"HTTP/1.1 200 OK\r\n\r\nbody", **headers):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"WARC-Payload-Digest: sha1:{warc.base32_sha1(block.partition(b'\r\n\r\n')[2])}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    lines += [f"Content-Length: {len(block) if length is None else length}"] if length != "none" else []
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def told(raw):
    return [(r["record_id"], r["sound"], r["block"][-4:]) for r in warc.parse_records(raw)]


GOOD = [("<a>", True, b"body"), ("<b>", True, b"body")]


@pytest.mark.parametrize("length", ["-1", "-99999", "", "x", "none", "1e3", "999999", "5", "9" * 30, "1_0", "٣"])
def test_bad_lengths(length):
    """The record ends where the next one starts, and is not intact."""
    assert told(record() + record(own="<x>", length=length) + record(own="<b>")) == [GOOD[0], ("<x>", False, b"body"), GOOD[1]]
    last = told(record(own="<x>", length=length))
    assert [(own, sound) for own, sound, _ in last] == [("<x>", False)]


def test_payloads_that_look_like_records():
    inner = b"HTTP/1.1 200 OK\r\n\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nbody"
    assert told(record(block=inner) + record(own="<b>")) == GOOD


def test_gaps_and_truncation():
    whole = record() + record(own="<b>")
    assert told(b"junk\r\n\r\n" + whole) == GOOD
    assert told(record() + b"junk\r\n" + record(own="<b>")) == [("<a>", True, b"body"), GOOD[1]]
    assert told(whole[:-4]) == GOOD and told(whole[:-5]) == [GOOD[0], ("<b>", False, b"\nbod")]
    assert told(b"") == told(b"\r\n\r\n") == told(b"no record at all") == []
    header = record().partition(b"\r\n\r\n")[0]
    assert told(header) == [("<a>", False, b"")]
    assert told(header + b"\r\n" + record(own="<b>")) == [("<a>", False, b""), GOOD[1]]


def test_broken_members():
    one, two, three = (gzip.compress(record(own=f"<{c}>")) for c in "abc")
    sound = [(f"<{c}>", True, b"body") for c in "abc"]
    assert told(one + two + three) == told(gzip.compress(b"".join(gzip.decompress(x) for x in (one, two, three)))) == sound
    assert told(one + two[:-8] + bytes(8) + three) == sound  # a checksum is wrong, the record's own tells
    for end in range(12, len(two) - 40, 10):
        first, *cut, last = told(one + two[:end] + three)
        assert (first, last) == (sound[0], sound[2]) and not any(r[1] for r in cut)
        first, *cut = told(one + two[:end])
        assert first == sound[0] and not any(r[1] for r in cut)
    assert told(one + b"\0\0 padding" + three) == [sound[0], sound[2]]
    assert told(one[:20]) == [(None, False, b"")] and told(one[:3]) == []
    big = gzip.compress(record(block=bytes(random.Random(1).randbytes(300_000))))
    assert [(r["sound"], len(r["block"])) for r in warc.parse_records(big + one)] == [(True, 300_000), (True, 23)]


@pytest.mark.parametrize("number", ["x", "", "-2", "0", "9" * 30])
def test_bad_segment_numbers(spark, tmp_path, number):
    block = warc._HTTP + warc.chunked(b"x" * 100)
    payload = warc.base32_sha1(b"x" * 100)

    def part(own, text, n, **more):
        return record("response" if n == 1 else "continuation", own, block=text, WARC_Segment_Number=n, X_Page_ID=own, **more).replace(
            b"WARC-Payload-Digest: sha1:" + warc.base32_sha1(text.partition(b"\r\n\r\n")[2]).encode(), b"WARC-Payload-Digest: sha1:" + payload.encode()
        )

    total = {"WARC_Segment_Total_Length": len(block)}
    whole = part("<o>", block[:150], 1) + part("<o2>", block[150:], 2, WARC_Segment_Origin_ID="<o>", **total)
    broken = part("<p>", block[:150], 1) + part("<p2>", block[150:], number, WARC_Segment_Origin_ID="<p>", **total)
    alone = part("<q>", block, 1).replace(b"Segment-Number: 1", f"Segment-Number: {number}".encode())
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "one.warc").write_bytes(whole + broken + alone)
    found = {r["page_id"]: r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    assert found["<o>"]["intact"] and bytes(found["<o>"]["payload"]) == b"x" * 100
    assert not found["<p>"]["intact"] and not found["<q>"]["intact"]
    assert bytes(found["<q>"]["payload"]) == b"x" * 100


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.binary(max_size=6), st.integers(0, 9)), max_size=4), st.booleans())
def test_any_damage_is_read_to_the_end(damage, packed):
    raw = record() + record(own="<b>", WARC_Segment_Number=1) + record("continuation", "<c>", WARC_Segment_Number=2, WARC_Segment_Origin_ID="<b>")
    raw = gzip.compress(raw) if packed else raw
    for at, bytes_, drop in damage:
        raw = raw[:at] + bytes_ + raw[at + drop :]
    assert len(list(warc.parse_records(raw))) <= len(raw) + 10
