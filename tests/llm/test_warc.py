"""Archives round trip, revisit roles against a plain loop, the merge against sorted()."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import common, warc
from keelson.llm.common import filesystem, make_folder, new_folder, shared_folder, stored
from keelson.llm.warc import NO_ID, PAGES, LoserTree, captures, merge_pass, merge_runs, op1_warc, read_archives, uri, write_archives
from tests.conftest import TESTDATA


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)).map(sorted), max_size=12))
def test_loser_tree_merges(runs):
    got = list(LoserTree([iter([(x, i) for x in r]) for i, r in enumerate(runs)], lambda x: x[0]))
    assert got == sorted((x, i) for i, r in enumerate(runs) for x in r)


def expected(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(first.get(body, page), page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = body in first and (page is None or page > first[body])
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first[body] if revisit else None))
    return sorted(out, key=str)


def result(df):
    rows = sorted(df.collect(), key=lambda r: (r.part, r.seq))
    keys = [(r.url_key, r.captured, NO_ID if r.page_id is None else r.page_id) for r in rows]
    assert keys == sorted(keys)  # one global order
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


AWKWARD = [
    (1, "http://a.b/c d", "x" * 100), (2, None, "x" * 100), (3, "http://[bad", "x" * 99), (4, "u\n\tv", "x" * 99), (5, "é😀", None), (6, "", ""),
    (None, "http://a/", "x" * 100), (7, "http://www.A.com/X?y=1", "é" * 50), (8, "q", "é" * 50), (8, "q", "é" * 50), (7, "q", "é" * 50),
    (9, "z", "a\r\n\r\nb" * 30), (9, "z", "other"), (10, "http://long/", "y" * 3_000_000),
]


def test_awkward_pages(spark):
    df = spark.createDataFrame([(*r, 0, 1) for r in AWKWARD], PAGES + ", first int, digest int")
    assert result(captures(df)) == expected(AWKWARD)
    assert captures(df.limit(0)).count() == 0


def test_passes_are_balanced(spark, monkeypatch):
    """Three passes over 27 runs: every pass has a task for each group and range, and no range has over twice the mean."""
    monkeypatch.setattr(warc, "SPARSE", 16)
    urls = [f"http://h{i % 3}/{'hot' if i % 3 else i}" for i in range(3000)]
    df = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], PAGES).repartition(27)
    folder = new_folder(spark, "warc-test")
    make_folder(folder)
    lines = sorted((warc.url_key(u), warc.timestamp(i), i) for i, u in enumerate(urls))
    runs = []
    for k in range(27):
        n, keys = warc.write_run(f"{folder}/run-{k}.cdx", [f"{a} {b} {c} []" for a, b, c in lines[k::27]])
        runs.append((f"{folder}/run-{k}.cdx", n, keys))
    runs = spark.createDataFrame(runs, warc.RUNS)
    bounds = warc.key_ranges(runs, 4)
    assert len(bounds) == 5 and bounds[1:-1] == sorted(bounds[1:-1])
    pieces, n = runs.selectExpr("explode(sequence(0, 3)) as part", "path"), runs.count()
    assert n == 27
    for groups in (9, 3):
        longer = merge_pass(pieces.selectExpr("part", "path", f"pmod(xxhash64(path), {groups}) as group"), bounds, folder)
        per_range = [r.n for r in longer.groupBy("part").agg({"records": "sum"}).toDF("part", "n").collect()]
        assert sum(per_range) == 3000 and len(per_range) == 4 and max(per_range) <= 2 * 3000 / 4
        assert longer.count() > 4 * groups // 2
        pieces = longer.select("part", "path")
    runs = read_archives(write_archives(df, folder), folder)
    assert result(merge_runs(runs, folder, fan_in=3, parts=4)) == expected([(i, u, f"page {i}") for i, u in enumerate(urls)])


def test_target_uri():
    assert uri("http://a.b/c d?x=%20é#f") == "http://a.b/c%20d?x=%20%C3%A9#f" and uri(None) == "" and uri(" u\n\tv") == "u%0A%09v"
    record = warc.record_bytes(1, "http://a.b/c d", b"x", None)
    assert b"\r\nWARC-Target-URI: http://a.b/c%20d\r\n" in record and warc.parse(record)["url"] == "http://a.b/c%20d"


def test_shared_folder_without_a_scheme(spark, tmp_path, monkeypatch):
    """Spark and the file writers mean the same place, the one of Hadoop's default file system."""
    monkeypatch.setattr(common, "CHECKPOINT_KEY", "keelson.test.folder")
    hadoop = spark._jsc.hadoopConfiguration()
    spark.conf.set("keelson.test.folder", str(tmp_path))
    table = stored(spark.range(5), "place")
    fs, path = filesystem(table._keelson_path)
    assert path.startswith(str(tmp_path)) and fs.get_file_info(path + "/_SUCCESS").is_file
    try:
        hadoop.set("fs.defaultFS", "hdfs://127.0.0.1:9")
        assert shared_folder(spark) == f"hdfs://127.0.0.1:9{tmp_path}"
    finally:
        hadoop.unset("fs.defaultFS")
        spark.conf.unset("keelson.test.folder")


def test_whole_table_and_passes(spark):
    """A fan-in of 2 over many runs needs several passes and gives the same order."""
    sf = f"{TESTDATA}/sf0.001"
    want = expected([tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()])
    assert result(op1_warc(spark, sf)) == want
    folder = new_folder(spark, "warc-test")
    runs = read_archives(write_archives(spark.read.parquet(f"{sf}/pages.parquet").repartition(7), folder), folder)
    assert result(merge_runs(runs, folder, fan_in=2, parts=3)) == want
