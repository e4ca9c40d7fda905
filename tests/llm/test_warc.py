"""Archives: round trips against plain Python, reading in byte ranges, payloads that hold gzip members themselves."""

import base64
import gzip
import hashlib
import random
from collections import defaultdict

import pytest

from weftline.llm import warc

SCHEMA = "page_id long, url string, html string, kind int, digest string, sha string, salt int"


def brute(rows, least=0):
    heads = defaultdict(list)
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        if len(raw) >= least and page is not None:
            heads[raw].append(page)
    out = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        head = max(heads[raw]) if len(raw) >= least and heads[raw] else None
        refers = head if head is not None and page != head else None
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def pages():
    rng = random.Random(3)
    texts = ["", "a", "<p>é😀</p>", "x" * 70_000, "\r\n\r\nWARC/1.1\r\n", "\x1f\x8b\x08 not a member"]
    rows = [(i, f"http://h{i % 7}/{i}", rng.choice(texts) if i % 2 else "".join(rng.choices("ab\n é", k=rng.randrange(400))), 1, "d", "s", 0) for i in range(300)]
    rows += [(None, None, None, None, None, None, None), (None, "u", "only without a number", 0, "", "", 0), (5, "again", rows[5][2], 0, "", "", 0), (900, "line\nbreak", "", 0, "", "", 0), (901, "u", "x" * 3_000_000, 0, "", "", 0)]
    return rows


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, least):
    rows = pages()
    assert rows_of(warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(5), least)) == brute(rows, least)


def test_byte_ranges_of_any_size_give_every_record_once(spark, tmp_path):
    rows = pages()
    files = warc.write_pages(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path)).cache()
    want = brute(rows)
    for split in (997, 1 << 16, 1 << 30):
        found = warc.read_archives(spark, str(tmp_path), files, split_bytes=split)
        assert rows_of(found) == want
    texts = {r.page_id: bytes(r.payload).decode() for r in found.where("record_type = 'response' and page_id is not null").collect()}
    assert all(texts[p] == next(h or "" for i, _, h, *_ in rows if i == p) for p in texts)


def test_members_are_owned_once_wherever_ranges_are_cut():
    """Members end to end, one of which is no record."""
    inner = warc.record_bytes("response", 1, "u", b"inner", warc.digest(b"inner"), None)
    outer = warc.record_bytes("response", 2, "u", b"outer", warc.digest(b"outer"), None)
    data = outer + inner + gzip.compress(b"no record") + outer
    read = lambda pos, n: data[pos : pos + n]
    whole = list(warc.members(read, 0, len(data)))
    assert [p for p, _ in whole] == [0, len(outer), len(data) - len(outer)]
    for cut in range(0, len(data), 13):
        assert list(warc.members(read, 0, cut, 64)) + list(warc.members(read, cut, len(data), 64)) == whole


def test_empty_table(spark):
    assert rows_of(warc.round_trip(spark.createDataFrame([], SCHEMA))) == []


def test_broken_payload_raises():
    content = gzip.decompress(warc.record_bytes("response", 1, "u", b"abc", warc.digest(b"abc"), None))
    with pytest.raises(ValueError):
        warc.parse(content[:-1])
