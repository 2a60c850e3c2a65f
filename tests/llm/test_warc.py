"""Archives: exact round trip, revisits, dictionary frame, single records, awkward pages."""

import hashlib

import pytest
import zstandard

from ridemart.llm import warc
from ridemart.llm.storage import opened, qualified

COLS = "page_id long, url string, html string, digest string, refers_to string, `a.b` string, file string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "f") for r in rows], COLS)


def brute(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [q for q, _, h in rows if (h or "") == (html or "")]
        known = [q for q in same if q is not None]
        first = min(known) if known else None
        again = len(payload) >= 100 and first is not None and (page_id is None or page_id > first)
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def pages():
    body = "<html>" + "common words of every page " * 20
    rows = [(i, f"http://h/{i}", body + f"page {i % 40} é日" + "x" * (i % 7)) for i in range(300)]
    rows += [(1000, None, None), (1001, "http://h/\r\nWARC-Type: evil é", ""), (None, "u", body), (None, "u", body), (1002, "u", body),
             (1003, "u", "s" * 99), (1004, "u", "s" * 99), (1005, "u", "t" * 100), (1006, "u", "t" * 100), (1006, "u", "t" * 100),
             (1005, "u", "t" * 100), (1007, "u", "é\r\n\r\nWARC/1.1\r\n" * 30_000), (1007, "u", "z" * 3_000_000)]
    return rows


def test_round_trip_matches_brute_force(spark):
    rows = pages()
    index = warc.write_archives(frame(spark, rows).repartition(3), archive_bytes=200_000)
    got = [tuple(r) for r in warc.read_archives(spark, index).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert index.count() == len(rows) and index.select("file").distinct().count() > 3


def test_dictionary_frame_and_single_records(spark):
    rows = [(i, f"http://h/{i}", f"<html><title>{i}</title>" + f"some shared boilerplate {i * 7919 % 1000} " * 30) for i in range(400)]
    index = warc.write_archives(frame(spark, rows).coalesce(1)).collect()
    assert len({r.file for r in index}) == 1 and index[0].dictionary_bytes > 1000
    store, path = opened(index[0].file)
    raw = store.open_input_file(path).read()
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_MAGIC and 0x184D2A50 <= warc.DICTIONARY_MAGIC <= 0x184D2A5F
    size = int.from_bytes(raw[4:8], "little")
    assert size == index[0].dictionary_bytes
    dictionary = zstandard.ZstdCompressionDict(raw[8:8 + size])
    by_id = {i: html for i, _, html in rows}
    for r in index[::37]:
        alone = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(raw[r.offset:r.offset + r.length])
        head, block = warc.read_record(r.file, r.offset, r.length)
        assert alone == warc.record(r.page_id, f"http://h/{r.page_id}", by_id[r.page_id], head["warc-payload-digest"][7:], None)
        assert block.endswith(by_id[r.page_id].encode()) and head["x-page-id"] == str(r.page_id)
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(raw[index[5].offset:index[5].offset + index[5].length])
    # the dictionary pays: records of their own without it take more room
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(warc.record(i, u, h, "0" * 64, None))) for i, u, h in rows)
    assert sum(r.length for r in index) < plain


def test_rerun_task_replaces_its_archive(spark, scratch):
    rows = [(i, "u", "text %d " % i * 20) for i in range(50)]
    folder = scratch("warc")
    store, base = opened(qualified(spark, folder))
    store.create_dir(f"{base}/archives", recursive=True)
    left = f"{base}/archives/pages-000000-0000.warc.zst"
    with store.open_output_stream(left) as f:
        f.write(b"left by a lost attempt")
    index = warc.write_archives(frame(spark, rows).coalesce(1), folder)
    assert sorted(tuple(r) for r in warc.read_archives(spark, index).collect()) == sorted(brute(rows))
    assert warc.read_archives(spark, index).count() == 50


def test_empty_table_and_broken_archives(spark, scratch):
    index = warc.write_archives(frame(spark, [(1, "u", "x")]).limit(0))
    assert index.count() == 0 and warc.read_archives(spark, index).count() == 0
    one = warc.record(1, "u", "payload " * 20, hashlib.sha256(b"payload " * 20).hexdigest(), None)
    assert warc.described(one)[0] == 1
    with pytest.raises(ValueError):
        warc.described(one.replace(b"payload payload", b"payload poyload"))
    with pytest.raises(ValueError):
        warc.described(one[:-5] + b"\r\n\r\n")


def test_addresses():
    assert opened("file:/tmp/x/y")[1] == "/tmp/x/y" and opened("file:///tmp/x/y")[1] == "/tmp/x/y"
    with pytest.raises(ValueError):
        opened("/tmp/x")
