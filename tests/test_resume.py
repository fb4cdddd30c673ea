"""An embedding pass that is killed, restarted and sent the same plan again takes each crop once."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from talkmill.streaming import resume

PLAN = "episode string, cluster string, draw int, length_s double, crop_start_s double, attempt int"
LOG = f"{PLAN}, vector array<double>, error string, error_kind string"


def plan(spark, episodes):
    return spark.createDataFrame([(e, c, d, 10.0, float(d)) for e in episodes for c in ("SPEAKER_00", "SPEAKER_01") for d in range(3)], "episode string, cluster string, draw int, length_s double, crop_start_s double")


def embedded(batch, failing=()):
    bad = F.col("episode").isin(list(failing)) & (F.col("attempt") == 0)
    vector = F.when(~bad, F.array(F.col("crop_start_s"), F.lit(1.0)))
    return batch.withColumns({"vector": vector, "error": F.when(bad, "no route"), "error_kind": F.when(bad, "download")})


def crops(df):
    return Counter((r["episode"], r["cluster"], r["draw"]) for r in df.collect())


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / x) for x in ("plans", "log", "held")]


def test_each_crop_once(spark, places):
    plans, log, held = places
    run = lambda embed=embedded: resume.embed_stream(spark, plans, log, held, PLAN, embed)
    first, more = plan(spark, ["a", "b"]), plan(spark, ["b", "c"])
    resume.send_plan(first, plans)
    resume.send_plan(first, plans)
    assert run() >= 1 and crops(resume.read_log(spark, log, LOG)) == crops(first)
    run()
    assert crops(resume.read_log(spark, log, LOG)) == crops(first)
    resume.send_plan(more, plans)

    def breaks(batch):
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        run(breaks)
    resume.send_plan(first.union(more), plans)  # sent again while it was down
    run()
    assert crops(resume.read_log(spark, log, LOG)) == crops(first.union(more).distinct())
    assert resume.unfinished(resume.read_log(spark, log, LOG), first).isEmpty()


def test_a_batch_that_broke_off_after_its_part_is_written_over(spark, places):
    plans, log, held = places
    resume.send_plan(plan(spark, ["a"]), plans)

    class Late(RuntimeError):
        pass

    def half(batch):
        embedded(batch).limit(2).withColumn("seq", F.lit(0)).write.mode("overwrite").json(f"{log}/batch={0:09d}")
        raise Late("after the part")

    with pytest.raises(Exception, match="after the part"):
        resume.embed_stream(spark, plans, log, held, PLAN, half)
    assert sum(crops(resume.read_log(spark, log, LOG)).values()) == 2
    resume.embed_stream(spark, plans, log, held, PLAN, embedded)
    assert crops(resume.read_log(spark, log, LOG)) == crops(plan(spark, ["a"]))


def test_failed_downloads_are_tried_again(spark, places):
    plans, log, held = places
    whole = plan(spark, ["a", "b"])
    resume.send_plan(whole, plans)
    resume.embed_stream(spark, plans, log, held, PLAN, lambda b: embedded(b, ["b"]))
    left = resume.unfinished(resume.latest(resume.read_log(spark, log, LOG)), whole)
    assert {r["episode"] for r in left.collect()} == {"b"}
    resume.send_plan(left, plans, attempt=1)
    resume.embed_stream(spark, plans, log, held, PLAN, lambda b: embedded(b, ["b"]))
    records = resume.latest(resume.read_log(spark, log, LOG))
    assert crops(records) == crops(whole) and records.where("vector is null").isEmpty() and resume.unfinished(records, whole).isEmpty()
