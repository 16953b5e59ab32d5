"""Archives: what is written is read back, and what is broken is found."""

import base64
import hashlib
import struct

import pytest
import zstandard

from tapeworks.llm import warc
from tapeworks.session import workspace

ROWS = [(1, "http://a.example/x y\r\nWARC-Type: evil", "<p>same</p>", "q"), (2, None, "<p>same</p>", "r"), (3, "http://b", None, None),
        (4, "http://b", "", "s"), (None, "http://c", "", "t"), (5, "http://é.example", "é" * 300_000, "u"), (7, "u", "\r\n\r\n", "v"),
        (8, "u", "other\x00", "w"), (9, "u", "other\x00", "w"), (9, "u", "other\x00", "w")]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, digest string")


def read_back(spark, pages, **options):
    folder = workspace(spark, "warc-test")
    warc.write(pages, folder, **options)
    return folder, warc.read(spark, folder).collect()


def test_round_trip(spark, pages):
    _, found = read_back(spark, pages)
    assert len(found) == len(ROWS)
    by = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"]), r["payload_bytes"], r["payload_digest"]) for r in found)
    firsts = {"<p>same</p>": 1, "": 3, "other\x00": 8}
    wanted = []
    for i, _, text, _ in ROWS:
        first = firsts.get(text or "")
        other = first is not None and first != i
        wanted.append((str(i), "revisit" if other else "response", str(first) if other else "None",
                       len((text or "").encode()), digest(text)))
    assert by == sorted(wanted)
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in found if r["record_type"] == "response"} == {
        1: "<p>same</p>", 3: "", 5: "é" * 300_000, 7: "\r\n\r\n", 8: "other\x00"}


def test_small_payloads_are_not_revisited(spark, pages):
    _, found = read_back(spark, pages, min_bytes=7)
    assert sorted(r["page_id"] for r in found if r["record_type"] == "revisit") == [2]


def test_no_pages(spark, pages):
    assert read_back(spark, pages.limit(0))[1] == []


def test_many_archives_with_a_dictionary(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_FRAMES", 16)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    texts = [f"<html><body><p>page {i} of a site, with words {i * 37 % 91} and more words {i * 17 % 89}</p></body></html>" * 6 for i in range(300)]
    pages = spark.createDataFrame([(i, f"http://h/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string").coalesce(2)
    folder, found = read_back(spark, pages)
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in found} == dict(enumerate(texts))
    archives = [bytes(r[0]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content").collect()]
    assert len(archives) > 10
    for archive in archives:
        magic, size = struct.unpack_from("<II", archive)
        assert magic == warc.DICTIONARY_FRAME
        with pytest.raises(zstandard.ZstdError):  # no record can be read without the dictionary
            zstandard.ZstdDecompressor().decompress(archive[8 + size + 8 :])
        assert 1 <= len(list(warc.frames(archive))) < 16


def frame(data):
    return zstandard.ZstdCompressor(write_checksum=True).compress(data)


GOOD = warc.record(1, "http://a", b"hello", None, "2020-01-01T00:00:00Z")


@pytest.mark.parametrize("broken", [
    GOOD.replace(b"Content-Length: 5", b"Content-Length: 4"), GOOD.replace(b"WARC/1.1", b"WURC/1.1"), GOOD[:-1], GOOD + b"x",
    GOOD.replace(b"hello", b"hellO"), GOOD.replace(b"WARC-Date", b"WARC-Type"), GOOD.replace(b"WARC-Record-ID: ", b"X: "),
    GOOD.replace(b"WARC-Type: response", b"WARC-Type: revisit"), b""])
def test_broken_records(broken):
    assert warc.parsed(GOOD).payload == b"hello"
    with pytest.raises(warc.BrokenArchive):
        warc.parsed(broken)


def test_names_in_any_case_and_other_records():
    assert warc.parsed(GOOD.replace(b"WARC-Payload-Digest", b"warc-payload-DIGEST").replace(b"WARC-Type", b"Warc-TYPE")).payload == b"hello"
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    assert warc.parsed(info) is None
    for bad in (info[:-1], info.replace(b"Length: 4", b"Length: abc"), GOOD.replace(b"Content-Length: 5", b"Content-Length: -5"),
                GOOD.replace(b"WARC-Type: response", b"WARC-Type: other"), b"\xff" + GOOD):
        with pytest.raises(warc.BrokenArchive):
            warc.parsed(bad)


def test_a_compressed_dictionary(spark, tmp_path):
    samples = [f"<html><p>page {i} of many, {i * 37 % 91} words</p></html>".encode() * 4 for i in range(200)]
    trained = zstandard.train_dictionary(1 << 12, samples)
    packed = zstandard.ZstdCompressor().compress(trained.as_bytes())
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date: d\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    encoder = zstandard.ZstdCompressor(dict_data=trained)
    archive = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + encoder.compress(info) + encoder.compress(GOOD)
    (tmp_path / "part-0").write_bytes(archive)
    assert [bytes(r.payload) for r in warc.read(spark, str(tmp_path)).collect()] == [b"hello"]
    (tmp_path / "part-1").write_bytes(frame(GOOD.replace(b"Content-Length: 83", b"Content-Length: abc")))
    with pytest.raises(Exception, match="part-1.*Content-Length"):
        warc.read(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("broken", [
    frame(GOOD)[:-3], frame(GOOD) + b"abc", struct.pack("<II", 0x184D2A50, 99) + b"short",
    frame(GOOD) + struct.pack("<II", warc.DICTIONARY_FRAME, 0)])
def test_broken_frames(broken):
    assert list(warc.frames(warc.EMPTY_FRAME + frame(GOOD) + warc.EMPTY_FRAME)) == [GOOD]
    with pytest.raises(warc.BrokenArchive):
        list(warc.frames(broken))


def test_query(spark, sf_dir):
    from tapeworks.llm.queries import llm_queries

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r["page_id"]):
        first.setdefault(r["html"] or "", r["page_id"])
    found = {r["page_id"]: r for r in llm_queries()["op3_warc"](spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for r in pages:
        own, text = found[r["page_id"]], r["html"] or ""
        other = first[text] != r["page_id"]
        assert (own["record_type"], own["refers_to"]) == (("revisit", first[text]) if other else ("response", None))
        assert (own["payload_bytes"], own["payload_digest"]) == (len(text.encode()), digest(text))
