"""Quarantine of bad rows and the streaming store: counts, reasons, replays after a kill at every point."""

import pytest
from pyspark.sql import functions as F

from collide import fixtures as FX
from collide import schema as S
from collide.session import fresh_dir
from collide.sources import commits as C
from collide.sources import io as IO
from collide.sources import quarantine as Q
from collide.streaming import store as ST
from tests.conftest import SF_SMALL


def _lines(spark, texts):
    path = fresh_dir(spark, "lines")
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_rows_keep_their_text(spark):
    ok = ["0.5"] * len(S.FEATURES)
    rows = [["1", "1", *ok], ["2", "0.5", *ok], ["3", "x", *ok], ["4", "0"], ["5", "1", *ok, "9"], ["6", "", *ok],
            ["1", "1", *ok], ["8", "7.0", *ok]]
    texts = [",".join(r) for r in rows]
    base = fresh_dir(spark, "q")
    Q.write_judged(spark, Q.scan_permissive(spark, _lines(spark, texts), header=False), base)
    good, bad = Q.good_rows(spark, base), Q.bad_rows(spark, base)
    why = {r["event_id"]: r for r in bad.collect()}
    assert good.count() + bad.count() == len(rows)
    assert dict(good.dtypes)[S.LABEL] == "int" and not {Q.BAD, Q.REASONS, Q.RECORD} & set(good.columns)
    assert [r["event_id"] for r in good.collect()] == [1, 1]  # the repeated row is kept twice
    for i in (3, 4, 5):
        assert why[i][Q.REASONS] == ["malformed"] and why[i][Q.RECORD] == texts[i - 1]
    assert "label:fractional" in why[2][Q.REASONS] and why[2][Q.RECORD] is None
    assert why[6][Q.REASONS] == ["label:not_nullable"] and why[8][Q.REASONS] == ["label:isin_0_1"]
    assert dict(Q.reason_counts(bad).collect())["malformed"] == 3


def test_counts_add_up_and_good_rows_pass(spark):
    dirty = FX.view(spark, SF_SMALL, "dirty")
    base = fresh_dir(spark, "q")
    Q.write_judged(spark, dirty, base)
    good, bad = Q.good_rows(spark, base), Q.bad_rows(spark, base)
    assert good.count() and bad.count() and good.count() + bad.count() == dirty.count()
    assert Q.judged(good).where(Q.BAD).count() == 0 and bad.where(F.size(Q.REASONS) == 0).count() == 0
    assert Q.judged(dirty.limit(0)).count() == 0
    with pytest.raises(ValueError):
        Q.judged(dirty.withColumn(Q.BAD, F.lit(1)))
    empty = fresh_dir(spark, "q")
    Q.write_judged(spark, dirty.limit(0), empty)
    with pytest.raises(FileNotFoundError):
        Q.good_rows(spark, empty)


class _Killed(Exception):
    pass


@pytest.mark.parametrize("where", ["before", "inside", "after"])
def test_killed_stream_leaves_one_run(spark, monkeypatch, where):
    src, root, ckpt = (fresh_dir(spark, n) for n in ("src", "store", "ckpt"))
    dirty = FX.view(spark, SF_SMALL, "dirty")
    dirty.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(dirty.schema).option("maxFilesPerTrigger", 1).parquet(src)
    real = C.commit_as

    def dies(session, log, n, record):
        if n == 1:
            if where == "after":
                real(session, log, n, record)
            elif where == "inside":
                fs, p = C.fs_of(session, f"{log}/{n:020d}.json")
                out = fs.create(p, False)
                out.write(bytearray(b'{"batch": 1, "da'))
                out.close()
            raise _Killed
        return real(session, log, n, record)
    monkeypatch.setattr(C, "commit_as", dies)
    with pytest.raises(Exception, match="_Killed"):
        ST.start(stream, root, ckpt).awaitTermination()
    assert len(ST.batches(spark, root)) == (2 if where == "after" else 1)
    monkeypatch.setattr(C, "commit_as", real)
    ST.start(stream, root, ckpt).awaitTermination()
    want = Q.judged(dirty)
    got = ST.good(spark, root).select("event_id").union(ST.bad(spark, root).select("event_id"))
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in dirty.select("event_id").collect())
    assert ST.bad(spark, root).count() == want.where(Q.BAD).count()
    assert [r["batch"] for r in ST.batches(spark, root)] == [0, 1, 2]
    orphans = C.collect_orphans(spark, root, [f"{root}/_commits"], -60.0)
    assert len(orphans) == (0 if where == "after" else 1)
    assert got.count() == dirty.count()


def test_refused_and_empty_batches(spark):
    root = fresh_dir(spark, "store")
    dirty = FX.view(spark, SF_SMALL, "dirty")
    clean = FX.collisions(spark, SF_SMALL).select(dirty.columns)
    assert ST.store_batch(clean, 0, root, max_bad_share=0.01)
    assert ST.store_batch(dirty, 1, root, max_bad_share=0.01)
    assert ST.store_batch(dirty.limit(0), 2, root, max_bad_share=0.01)
    assert not ST.store_batch(clean, 0, root)  # given again: nothing changes
    assert [r["refused"] for r in ST.batches(spark, root)] == [False, True, False]
    assert ST.good(spark, root).count() == clean.count() and ST.bad(spark, root).count() == 0
    assert ST.refused(spark, root).count() == dirty.count()
    with pytest.raises(FileNotFoundError):
        ST.good(spark, fresh_dir(spark, "none"))
