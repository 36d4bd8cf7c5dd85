"""Operator 2: damaged, oddly packed and oddly signed archives, read through Spark."""
import base64
import gzip
import hashlib

import pytest

from nextbuy.llm import warc
from tests.llm.test_llm import Bytes

BIG = "<p>" + "text " * 80


def signed(payload, block_digest=None, payload_digest=None, page=1):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = ["WARC/1.0", "WARC-Type: response", "Content-Type: application/http; msgtype=response", f"X-Page-Id: {page}"]
    head += [f"WARC-Block-Digest: {block_digest(block)}"] if block_digest else []
    head += [f"WARC-Payload-Digest: {payload_digest(payload)}"] if payload_digest else []
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


FORMS = {
    "base32": lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode(),
    "upper hex": lambda b: "SHA-256:" + hashlib.sha256(b).hexdigest().upper(),
    "md5": lambda b: "md5:" + hashlib.md5(b).hexdigest(),
}


@pytest.mark.parametrize("form", sorted(FORMS))
@pytest.mark.parametrize("which", ["block", "payload"])
def test_digests_of_all_forms_are_checked(form, which):
    digest = FORMS[form]
    args = (digest, None) if which == "block" else (None, digest)
    good = signed(b"some payload", *args)
    assert [x.reason for x in warc.salvage(Bytes(good))] == [None]
    wrong = signed(b"some payload", *((lambda b: digest(b + b"x")) if a else None for a in args))
    assert [x.reason for x in warc.salvage(Bytes(wrong))] == [f"{which} digest"]


def test_unknown_digests_are_no_witness():
    for told in ("crc32:12345678", "sha1:short", "nothing"):
        assert [x.reason for x in warc.salvage(Bytes(signed(b"p", lambda b, told=told: told)))] == [None]


def test_file_gzipped_as_a_whole():
    records = [signed(f"payload {k}".encode(), FORMS["base32"], page=k) for k in range(5)]
    plain = b"".join(records)
    found = list(warc.salvage(Bytes(gzip.compress(plain))))
    assert [x.headers["x-page-id"] for x in found] == list("01234") and sum(x.length for x in found) == len(gzip.compress(plain))
    # one record inside damaged: the others come out, its bytes are a gap
    hurt = plain.replace(b"payload 2", b"paXload 2")
    found = list(warc.salvage(Bytes(gzip.compress(hurt) + gzip.compress(records[0]))))
    assert [x.headers["x-page-id"] if x.headers else x.reason for x in found] == ["0", "1", "block digest", "3", "4", "0"]


def test_damaged_archive_through_spark(spark, tmp_path):
    """Two of nine archives' records are hurt: the rest comes back, the gap table names the bytes, revisits resolve."""
    rows = [(k, f"http://h/{k}", BIG if k % 3 == 0 else f"{BIG} {k}") for k in range(1, 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    files = warc.write_archives(pages, str(tmp_path / "archives"))
    names = [r.file for r in files.collect()]
    assert all(n.startswith("file:///") for n in names)
    whole = {r.page_id: r for r in warc.page_digests(warc.read_archives(files)).collect()}
    name = names[0].removeprefix("file://")
    with open(name, "rb") as f:
        data = bytearray(f.read())
    found = [x for x in warc.salvage(Bytes(bytes(data)))]
    hit = [x for x in found if x.headers["warc-type"] == "response"][1:3]
    for x in hit:
        data[x.offset + x.length // 2] ^= 0xFF
    with open(name, "wb") as f:
        f.write(bytes(data))
    records = warc.inspected(warc.read_archives(files))
    logged = warc.log_gaps(records, str(tmp_path / "gaps")).collect()
    assert sum(r.length for r in logged) == sum(x.length for x in hit) and {r.file for r in logged} == {names[0]}
    assert {r.offset for r in logged} <= {x.offset for x in hit} and all(r.reason for r in logged)
    lost = {int(x.headers["x-page-id"]) for x in hit}
    got = {r.page_id: r for r in warc.page_digests(records).collect()}
    assert got == {k: r for k, r in whole.items() if k not in lost}
    # a revisit's length and digest are those of the response that it names
    digest = hashlib.sha256(BIG.encode()).hexdigest()
    assert all(r.payload_digest == digest and r.payload_bytes == len(BIG) for r in got.values() if r.refers_to == 3)
    again = spark.read.parquet(str(tmp_path / "gaps")).collect()
    assert sorted(again) == sorted(logged)


def test_no_gaps_give_an_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    assert warc.log_gaps(warc.inspected(warc.read_archives(warc.write_archives(pages))), str(tmp_path / "none")).collect() == []


def test_archive_folder_is_qualified(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert warc.qualified(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    with pytest.raises(Exception, match="(?i)file ?system|scheme"):
        warc.qualified(spark, "nosuchfs://host/x")
