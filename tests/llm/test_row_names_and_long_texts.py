"""Rows without an id are told apart; texts that repeat one disguise are read in one pass."""

from __future__ import annotations

import random
import time
import zlib

import pytest

from signalweave.llm import pii, suffix_dedup


def test_clean_text_keeps_its_bytes_beside_a_text_of_equal_checksum(make):
    draw = random.Random(7)

    def noise(n):
        return "".join(draw.choice("abcdefghij ") for _ in range(n))

    def ends():
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,") for _ in range(12))

    passage, clean, dirty = noise(300), noise(520), noise(100)
    by_sum = {zlib.crc32((good := clean + ends()).encode()): good for _ in range(100_000)}
    bad = next(bad for bad in (passage + dirty + ends() for _ in range(2_000_000)) if zlib.crc32(bad.encode()) in by_sum)
    good = by_sum[zlib.crc32(bad.encode())]
    rows = [(None, good), (None, bad), (3, noise(50) + passage)]
    left = {bytes(r["kept"]) for r in suffix_dedup.without_repeats(make(rows)).collect()}
    assert good.encode() in left and bad[300:].encode() in left


@pytest.mark.parametrize("zeros", [10, 5_000, 20_000])
def test_ip_parts_of_any_number_of_digits(zeros):
    text = "0" * zeros + "1.2.3.255 and " + "9" * zeros + ".1.1.1 or 1.2.3.256 and 1.2.3.0" + "0" * zeros
    ip = [s for s in pii.plain_spans(text) if s[0] == "ip"]
    assert ip == [("ip", 0, zeros + 9), ("ip", text.rindex("1.2.3.0"), len(text))]


@pytest.mark.parametrize(
    "text",
    [
        "a[dot]" * 200_000, "a dot " * 200_000 + "@", "a at " * 200_000 + " dot com", "a@ " * 100_000 + "[dot]",
        " " * 1_000_000 + "[at] x@ y", "bob@example.com " * 50_000 + "е", "one " * 200_000, "[ " * 200_000 + " at", "_" * 300_000 + "[dot]",
    ],
    ids=["dots", "words", "ats", "signs", "blanks", "mails", "digits", "brackets", "lines"],
)
def test_long_repeats_take_seconds(text):
    begin = time.process_time()
    base, every = pii.all_spans(text)
    assert time.process_time() - begin < 15
    assert len(base) == (50_000 if "bob" in text else 0) and every[: len(base)] == base


def test_disguised_spans_lie_in_no_other_span():
    text = "bob [at] example [dot] com, x at y dot b.c dot com, ann@site.org and eve at a.b dot co"
    base, every = pii.all_spans(text)
    spans = [(a, b) for _, a, b in every]
    assert set(base) <= set(every) and len(every) > len(base)
    assert not any(x <= a and b <= y and (x, y) != (a, b) for a, b in spans for x, y in spans if ("email", a, b) not in base)
    assert ("email", text.index("eve"), len(text)) in every
