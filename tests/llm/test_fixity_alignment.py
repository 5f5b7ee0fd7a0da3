"""Audits of replicas that have lost, gained and changed records, against a plain comparison by record."""

import gzip

from pyspark.sql import functions as F

from aerolith.llm import fixity

CONFIG = fixity.FixityConfig(archive_records=40, fan_out=3)


def pages(spark, ids):
    return spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>") for i in ids], "page_id long, url string, html string")


def trees(spark, one, two, archives, rot=None):
    laid = [fixity.lay_out(pages(spark, x), CONFIG, archives, r).cache() for x, r in ((one, None), (two, rot))]
    return laid, [fixity.build_tree(x, CONFIG) for x in laid]


def test_lost_gained_and_changed_records_are_located(spark):
    ids = list(range(400))
    replica = [i for i in ids if i not in (17, 18, 200)] + [1000, 1001]
    (a, b), (one, two) = trees(spark, ids, replica, 10, F.col("page_id") == 300)
    got = {(r.archive, r.place, r.status) for r in fixity.audit(one, two, CONFIG).collect()}
    at = lambda laid, wanted: {(r.archive, r.place) for r in laid.filter(F.col("page_id").isin(*wanted)).collect()}
    want = {(*x, "missing") for x in at(a, [17, 18, 200])} | {(*x, "extra") for x in at(b, [1000, 1001])} | {(*x, "differs") for x in at(a, [300])}
    assert got == want


def test_unlike_heights_and_empty_replicas(spark):
    ids = list(range(60))
    _, (one, two) = trees(spark, ids, [*ids, *range(1000, 4000)], 100)
    assert fixity.audit(one, two, CONFIG).groupBy("status").count().collect()[0] == ("extra", 3000)
    _, (one, none) = trees(spark, ids, [], 3)
    assert {r.status for r in fixity.audit(one, none, CONFIG).collect()} == {"missing"} and fixity.audit(one, none, CONFIG).count() == 60
    assert fixity.audit(none, none, CONFIG).count() == 0


def test_only_branches_that_differ_are_compared(spark):
    ids = list(range(2000))
    _, (one, two) = trees(spark, ids, ids, 50, F.col("page_id") == 123)
    seen = {}
    assert fixity.audit(one, two, CONFIG, seen).count() == 1
    assert seen[0] <= 40 and sum(seen.values()) <= 120


def test_malformed_and_gzipped_archives(spark, tmp_path):
    record = fixity.record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = [r.r.encode() for r in pages(spark, range(5)).select(record.alias("r")).collect()]
    data = rows[0] + b"junk\r\n\r\n" + rows[1] + rows[2].replace(b"Content-Length: ", b"Content-Length: x") + rows[3] + rows[4][:-6]
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(rows)))
    got = fixity.read_warc(spark, f"file://{tmp_path}").collect()
    plain = [r for r in got if r.archive.endswith("a.warc")]
    assert [r.record_id for r in plain if r.error is None] == [f"<urn:page:{i}>" for i in (0, 1, 3)] and sum(r.length for r in plain) == len(data)
    assert len([r for r in got if r.archive.endswith(".gz") and r.error is None]) == 5
