import hashlib

import pyarrow.fs as pafs
import pytest

from surveyfold.llm import wacz as op

from .helpers import rows


def pages(spark):
    big, other = "<p>" + "é" * 80 + "</p>", "<html>" + "x" * 5000
    data = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, "short"), (4, "http://a/4\r\nX: y", "short"),
            (5, "u", None), (6, "u", ""), (None, "n", big), (None, "n", "<i>" + "z" * 200), (7, "u", other),
            (7, "u", other), (8, "u", other), (9, "u", "\x00 \r\n\r\n WARC/1.1 \r\n" + "q" * 100)]
    return spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'c' as digest", "1 as first_id")


def model(table):
    first = {}
    for r in table:
        body = (r.html or "").encode()
        if len(body) >= 100 and r.page_id is not None:
            first[body] = min(first.get(body, r.page_id), r.page_id)
    out = []
    for r in table:
        body = (r.html or "").encode()
        lead = first.get(body)
        revisit = lead is not None and r.page_id != lead
        out.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", lead if revisit else None))
    return out


@pytest.mark.parametrize("force64", [False, True])
def test_round_trip(spark, force64):
    table = pages(spark)
    got = rows(op.round_trip(table, force64=force64).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    assert sorted(map(repr, got)) == sorted(map(repr, model(table.collect())))


def test_payloads_and_urls_come_back(spark, tmp_path):
    table = pages(spark)
    manifest = op.write_archives(op.classified(table), str(tmp_path), archive_bytes=400).persist()
    assert manifest.count() > 2                       # rolled over
    got = {(r.page_id, bytes(r.payload)) for r in op.read_archives(manifest, str(tmp_path)).collect() if r.record_type == "response"}
    assert (9, "\x00 \r\n\r\n WARC/1.1 \r\n".encode() + b"q" * 100) in got and (5, b"") in got
    urls = {r.url for r in op.read_archives(manifest, str(tmp_path)).collect()}
    assert None in urls and "http://a/4%0D%0AX: y" in urls


def test_archive_is_a_zip_that_other_readers_open(tmp_path):
    import zipfile
    fs, path = pafs.LocalFileSystem(), str(tmp_path / "a.wacz")
    rec = op._gzip_member(op.record_bytes(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), "response", None), 6)
    for wide in (False, True):
        op.write_archive(fs, path, [rec], ['0 {"offset": 0, "length": %d}\n' % len(rec)], wide)
        with zipfile.ZipFile(path) as z:
            assert z.testzip() is None and z.read(op.WARC_MEMBER) == rec
        assert [r.payload for r in op.read_archive(fs, path)] == [b"hello"]


def test_directory_of_another_writer_with_a_comment(tmp_path):
    import zipfile
    path = tmp_path / "b.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("one", b"1" * 10)
        z.writestr("two", b"22")
        z.comment = b"PK a comment"
    with pafs.LocalFileSystem().open_input_file(str(path)) as f:
        members = op.central_directory(f, f.size())
        assert f.read_at(2, op.data_offset(f, members["two"])) == b"22"


def test_damage_is_noticed(tmp_path):
    data = op.record_bytes(1, "u", b"hello", "0" * 64, "response", None)
    with pytest.raises(ValueError):
        op.parse_record(data)
    fs = pafs.LocalFileSystem()
    (tmp_path / "c").write_bytes(b"not a zip")
    with pytest.raises(ValueError), fs.open_input_file(str(tmp_path / "c")) as f:
        op.central_directory(f, f.size())


def test_empty_table(spark):
    assert rows(op.round_trip(pages(spark).limit(0))) == []


def test_ids_of_any_type(spark):
    named = pages(spark).selectExpr("concat('p\\r\\n: %', page_id) AS page_id", "url", "html")
    got = rows(op.round_trip(named).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    assert sorted(map(repr, got)) == sorted(map(repr, model(named.collect())))


@pytest.mark.parametrize("form", ["file:{}", "file://{}", "{}"])
def test_folder_as_uri_or_path(spark, tmp_path, form):
    folder = form.format(tmp_path / "a b")
    manifest = op.write_archives(op.classified(pages(spark)), folder).persist()
    assert manifest.count() > 0 and list((tmp_path / "a b").glob("*.wacz"))
    assert op.read_archives(manifest, folder).count() == pages(spark).count()
    assert op.qualified(spark, folder).startswith("file:/")


def test_bare_paths_are_on_the_default_file_system(spark):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    spark.conf.set("fs.defaultFS", "file:///")
    try:
        assert op.qualified(spark, "/shared/x") == "file:///shared/x" and before is not None
    finally:
        spark.conf.unset("fs.defaultFS")
