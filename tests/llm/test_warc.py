import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.warc import START, VERSION, audit, audit_folders, cut_records, damaged, fixity_report, manifest, read_warc, trees, warc_records, write_warc
from tidemark.session import scratch_path


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://x/{k}", f"<p>{'é' * (k % 7)} page {k}</p>\r\n" * (1 + k % 5)) for k in range(300)]
    rows += [(300, None, None), (None, "http://a\r\nb", ""), (301, "u", "x" * 200_000), (301, "u", "x" * 200_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).cache()


def test_archives_give_the_records_back(spark, pages):
    path = scratch_path(spark, "test-warc")
    records = warc_records(pages)
    write_warc(records, path)
    read = read_warc(spark, path)
    assert read.where("not complete").count() == 0
    assert sorted(map(tuple, read.select("place", "record").collect())) == sorted(map(tuple, records.collect()))
    assert {r.page_id for r in read.collect()} == {*range(302), None}


def test_manifest(pages):
    rows = sorted(manifest(warc_records(pages)).collect())
    said = dict(map(tuple, warc_records(pages).collect()))
    at = {}
    for r in rows:
        assert r.digest == hashlib.sha256(said[r.place].encode()).hexdigest()
        assert r["first"] == at.get(r.archive, 0)
        at[r.archive] = r.end
        assert r.end - r["first"] == len(START) + len(said[r.place].encode()) + 4


def test_audit_finds_what_was_done(pages):
    ours = warc_records(pages).cache()
    places = sorted(r.place for r in ours.collect())
    lost, changed = {places[0], places[170]}, {places[5], places[171], places[-1]}
    theirs = ours.where(~F.col("place").isin(lost)).withColumn("record", F.when(F.col("place").isin(changed), F.concat("record", F.lit("!"))).otherwise(F.col("record")))
    theirs = theirs.unionByName(ours.limit(1).select(F.lit(max(places) + 1).alias("place"), "record"))
    found = {r.place: r.status for r in audit(manifest(ours), manifest(theirs)).collect()}
    assert found == {**dict.fromkeys(lost, "missing"), **dict.fromkeys(changed, "changed"), max(places) + 1: "extra"}


def test_equal_and_empty_replicas(pages):
    ours = manifest(warc_records(pages)).cache()
    assert audit(ours, ours).collect() == []
    assert {r.status for r in audit(ours, ours.limit(0)).collect()} == {"missing"}
    assert audit(ours, ours.limit(0)).count() == ours.count()
    assert audit(ours.limit(0), ours.limit(0)).collect() == []
    top = trees(ours, ours)[-1].collect()
    assert len(top) == 2 and top[0].digest == top[1].digest


def test_report(spark, pages, clashing):
    path = scratch_path(spark, "test-warc")
    rows = fixity_report(clashing(pages), path).collect()
    read = read_warc(spark, path)
    after = {r.place: r.record for r in damaged(read).collect()}
    assert len(rows) == pages.count()
    for r in read.collect():
        expected = "missing" if r.place not in after else "ok" if after[r.place] == r.record else "changed"
        assert next(x.status for x in rows if x.place == r.place) == expected
    assert fixity_report(pages.limit(0), scratch_path(spark, "test-warc")).collect() == []


def member(version, fields, body, length=None, tail=b"\r\n\r\n"):
    lines = [f"WARC/{version}", *fields, f"Content-Length: {len(body) if length is None else length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + tail


INNER = member("1.0", ["WARC-Type: response", "WARC-Record-ID: <urn:x:inner>"], b"inner")
STANDARD = [
    member("1.0", ["WARC-Type: warcinfo", "WARC-Record-ID: <urn:x:0>"], b"software: test\r\n"),
    member("1.1", ["WARC-Record-ID: <urn:x:1>", "WARC-Date: 2024-01-01T00:00:00Z", "WARC-Target-URI: http://x/WARC/1.0"], b"a WARC/1.0\r\nb"),
    member("1.0", ["WARC-Type: resource", "WARC-Record-ID: <urn:x:2>"], INNER + INNER),
    member("1.0", ["WARC-Record-ID: <urn:x:3>"], b"short", length=9),
    member("1.0", ["WARC-Record-ID: <urn:x:4>"], b"long", length=10 ** 7),
    member("1.0", ["warc-record-id: <urn:x:5>"], b"\xff\xfe no text"),
    member("1.0", ["WARC-Record-ID: <urn:x:6>"], b"", tail=b""),
]


def test_records_are_cut_by_their_length():
    whole = b"".join(STANDARD)
    cut = list(cut_records(iter(whole.split(VERSION))))
    assert [whole[first:end] for first, end, _, _ in cut] == STANDARD
    assert [complete for *_, complete in cut] == [True, True, True, False, False, True, True]
    assert [r for _, _, r, c in cut if c][2].endswith(INNER + INNER)
    assert list(cut_records(iter([]))) == list(cut_records(iter([b"no archive"]))) == []


def test_standard_archives_in_two_folders(spark, tmp_path):
    folders = [tmp_path / "a", tmp_path / "b"]
    for folder in folders:
        folder.mkdir()
    (folders[0] / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, STANDARD)))        # a member for each record
    (folders[0] / "two.warc.gz").write_bytes(gzip.compress(b"".join(member("1.0", [f"WARC-Record-ID: <urn:y:{k}>"], b"y" * k) for k in range(500))))
    (folders[0] / "notes.txt").write_text("no archive")
    rows = read_warc(spark, str(folders[0])).collect()
    assert len(rows) == 507 and len({r.place for r in rows}) == 507 and {r.page_id for r in rows} == {None}
    assert {r.record_id for r in rows if not r.complete} == {"<urn:x:3>", "<urn:x:4>"}
    whole = b"".join(STANDARD)
    assert sorted(whole[r["first"]:r.end] for r in rows if r.file == "one.warc.gz") == sorted(STANDARD)
    assert next(r.url for r in rows if r.record_id == "<urn:x:1>") == "http://x/WARC/1.0"

    other = [member("1.0", [f"WARC-Record-ID: <urn:y:{k}>"], b"y" * k + b"!" * (k == 7)) for k in range(501) if k != 300]
    (folders[1] / "all.warc.gz").write_bytes(b"".join(map(gzip.compress, STANDARD[:-1])) + gzip.compress(b"".join([*other[::-1], STANDARD[-1]])))
    at = {r.place: r.record_id for folder in folders for r in read_warc(spark, str(folder)).collect()}
    found = {at[r.place]: r.status for r in audit_folders(spark, *map(str, folders)).collect()}
    assert found == {"<urn:y:7>": "changed", "<urn:y:300>": "missing", "<urn:y:500>": "extra"}


def test_offsets_of_the_report(spark, pages):
    path = scratch_path(spark, "test-warc")
    files = {r.path.rsplit("/", 1)[1]: gzip.decompress(bytes(r.content))
             for r in (fixity_report(pages, path), spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path))[1].collect()}
    said = {r.place: r.record for r in read_warc(spark, path).collect()}
    rows = read_warc(spark, path).collect()
    assert len(rows) == pages.count()
    for r in rows:
        assert files[r.file][r["first"]:r.end] == (START + said[r.place] + "\r\n\r\n").encode()


def test_repeated_places_are_compared_together(spark):
    def kept(*rows):
        return manifest(spark.createDataFrame(rows, "place long, record string"))

    left = kept((1, "a"), (1, "b"), (1, "b"), (2, "c"), (3, "d"), (3, "d"))
    assert audit(left, kept((1, "b"), (2, "c"), (1, "a"), (3, "d"), (1, "b"), (3, "d"))).collect() == []
    found = {r.place: r.status for r in audit(left, kept((1, "a!"), (1, "b"), (1, "b"), (2, "c"), (3, "d"))).collect()}
    assert found == {1: "changed", 3: "changed"}
