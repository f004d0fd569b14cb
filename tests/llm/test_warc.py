import base64
import hashlib
import io
import random
import struct

import pytest
import zstandard

from georisk.llm import catalog, warc
from georisk.llm.common import read_table


def brute(rows, least=0):
    first = {}
    for i, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, h in rows:
        data = (h or "").encode()
        to = first.get(h or "")
        to = None if to == i else to
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def digest_rows(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("p", [warc.Params(), warc.Params(archive_bytes=3000, dictionary_bytes=1024, min_revisit=5)])
def test_round_trip(spark, p):
    rng = random.Random(9)
    texts = [None, "", "a", "<p>é\r\n\r\nWARC/1.1</p>", "x" * 300_000] + [
        f"<html><p>{' '.join(rng.choices(['word', 'other', 'ü', 'text'], k=80))}</p></html>" for _ in range(40)]
    rows = [(i, rng.choice(texts)) for i in range(150, 0, -1)] + [(None, "a"), (None, "lonely"), (7, texts[20]), (7, texts[20])]
    urls = [None, "", "http://n.net/a b\r\nWARC-Type: x", "http://é.net/"]
    pages = spark.createDataFrame([(i, rng.choice(urls), h, "x") for i, h in rows], "page_id long, url string, html string, first string")
    got = warc.round_trip(spark, pages, p, payloads=True)
    assert digest_rows(got) == brute(rows, p.min_revisit)
    held = {(r["page_id"], r["payload_digest"]): r["payload"] for r in got.collect() if r["record_type"] == "response"}
    for i, h in rows:
        data = (h or "").encode()
        key = (i, base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert key not in held or bytes(held[key]) == data


def test_archive_layout():
    p = warc.Params()
    records = [warc.record(i, f"http://n.net/{i}", b"<p>text %d</p>" % i * 20, "A" * 32, None, False, p.date) for i in range(300)]
    data = warc.write_archive(records, p)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8:12] == b"\x37\xa4\x30\xec"  # a trained dictionary
    assert list(warc.read_archive(io.BytesIO(data), step=100)) == records
    # the second record alone, by its offset
    held = zstandard.ZstdCompressionDict(data[8:8 + size])
    first = zstandard.ZstdCompressor(level=p.level, dict_data=held, write_checksum=True).compress(records[0])
    at = 8 + size + len(first)
    assert zstandard.ZstdDecompressor(dict_data=held).decompressobj().decompress(data[at:]) == records[1]
    fields, block = warc.parse(records[5])
    assert fields["warc-target-uri"] == "http://n.net/5" and block.endswith(b"text 5</p>")


@pytest.mark.parametrize("harm", [lambda d: d[:-3], lambda d: b"\0" * 8 + d[8:]])
def test_damaged_archives_raise(harm):
    data = warc.write_archive([warc.record(1, None, b"abc", "A" * 32, None, False, "d")], warc.Params())
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(io.BytesIO(harm(data))))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(spark, pages).count() == 0


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["page_id"], r["html"]) for r in read_table(spark, sf, "pages").collect()]
    assert digest_rows(catalog.QUERIES["op2_warc_archive"](spark, sf)) == brute(rows)
