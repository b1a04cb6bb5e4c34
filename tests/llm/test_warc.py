import pytest
from pyspark.sql import functions as F

from shelfrank.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, copy string, segment int, place string, hash string"


def pages(spark, n=300):
    rows = [(i, f"http://h{i % 7}/{i}", f"<p>{'x' * (i * 37 % 900)}{i}</p>") for i in range(n)]
    rows += [(None, None, None), (5, None, ""), (6, "u", None), (6, "u", None), (7, "http://h0/7", "é" * 70_000)]
    return spark.createDataFrame([(*r, "a", "b", 1, "c", "d") for r in rows], SCHEMA), len(rows)


@pytest.mark.parametrize("segment_bytes", [8 << 20, 20_000])
def test_records_stand_one_behind_the_other(spark, segment_bytes):
    table, n = pages(spark)
    rows = warc.manifest(table, segment_bytes=segment_bytes).collect()
    assert len(rows) == n
    by = {}
    for r in rows:
        assert (r.copy_length, r.copy_sha256) == (r.length, r.sha256)
        by.setdefault(r.segment, []).append((r.offset, r.length))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length


@pytest.mark.parametrize("children", [8, 2])
def test_audit_finds_each_damage_and_nothing_else(spark, children, monkeypatch):
    monkeypatch.setattr(warc, "CHILDREN", children)
    monkeypatch.setattr(warc, "RANGE_BYTES", 2048)
    table, n = pages(spark)
    payload = F.col("payload")
    copy = (
        F.when(F.col("page_id") == 3, F.concat(payload, F.encode(F.lit("!"), "UTF-8")))
        .when(F.col("page_id") == 90, F.expr("substring(payload, 1, 40)"))
        .when(F.col("page_id") == 200, F.lit(None))
        .otherwise(payload)
    )
    got = warc.fixity(table, copy).collect()
    assert len(got) == n
    assert {r.page_id: r.status for r in got if r.status != "ok"} == {3: "altered", 90: "altered", 200: "missing"}


def test_only_mismatching_branches_are_descended(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 1024)
    rows = [(0, i * 1000, 1000, f"sha{i}") for i in range(400)]
    schema = "segment long, offset long, length long, sha256 string"
    ours = spark.createDataFrame(rows, schema)
    other = [r for r in rows if r[1] != 77_000] + [(1, 0, 5, "new")]
    theirs = spark.createDataFrame([(*r[:3], "bad") if r[1] == 5000 else r for r in other], schema)
    trees = [warc.tree(t, 6, n) for t, n in ((ours, "a"), (theirs, "b"))]
    assert [level.count() for level in trees[0]][0] > 8 * [level.count() for level in trees[0]][1] - 8
    bad = {r.place for r in warc.mismatches(*trees).collect()}
    assert bad == {5000 // 1024, 77_000 // 1024, warc.PLACES}
    status = {(r.segment, r.offset): r.status for r in warc.audit(ours, theirs).collect()}
    assert len(status) == 401
    assert {k: v for k, v in status.items() if v != "ok"} == {(0, 5000): "altered", (0, 77_000): "missing", (1, 0): "added"}
    assert {r.status for r in warc.audit(ours, ours).collect()} == {"ok"}


def test_empty_tables(spark):
    table, _ = pages(spark)
    none = table.limit(0)
    assert warc.fixity(none).count() == 0
    records = spark.createDataFrame([(0, 0, 5, "a")], "segment long, offset long, length long, sha256 string")
    assert [r.status for r in warc.audit(records, records.limit(0)).collect()] == ["missing"]
