"""The library's queries run on the smallest tables, give rows, and have columns of their own names; negative controls find nothing."""

import os

import pytest

from talkmill import queries, queries_io  # noqa: F401  registers its queries too

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", ["s8_h1_h3_search", "a1_turn_merge", "a19_concentration", "w4_assign", "j7_reconcile", "p1_p2_j6_plan", "c2_w3_build_chunks", "h9_clip_plan", "a32_offset_scan", "h8_substitutes"])
def test_queries_give_rows(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns) and df.limit(1).count() == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_all_actions_occur_and_controls_find_nothing(spark):
    actions = {r["action"] for r in queries.planned(spark, SF).select("action").distinct().collect()}
    assert actions == {"EXCLUDE", "TRANSCRIBE", "UNPARSEABLE", "EMBED_ONLY", "IDENTIFY_ONLY", "SKIP"}
    assert queries.QUERIES["w4_assign_control"](spark, SF).first()["named"] == 0
    assert queries.QUERIES["j14_similar_pairs_control"](spark, SF).first()["pairs"] == 0


def plain(rows):
    return sorted(repr([float(x) if type(x).__name__ == "Decimal" else x for x in r]) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", ["s1_k4_written_transcripts", "s3_feed", "s10_k13_appended_log", "s13_audio_rates", "s15_embedded_crops", "p9_identified", "k18_p8_bulk_embed", "k1_replaced_episodes", "s11_k5_k6_export", "k8_backups", "k16_uploaded_book", "p3_nightly", "j21_w9_nearest_clusters", "h8_substitutes", "a32_offset_scan", "w4_assign", "j15_w7_speaker_at", "s8_nearest_many", "s3_feeds_stream", "s15_cut_crops", "p7_k13_resumed_stream", "j16_k9_mended_copy", "c2_chunks_folded"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    with duckdb.connect() as c:
        for table in os.listdir(SF):
            c.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{table}')")
        found = c.execute(queries.SQL[name])
        columns = [x[0] for x in found.description]
        want = plain(found.fetchall())
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns) and plain(map(tuple, got.select(columns).collect())) == want and want


def test_every_sql_has_its_query():
    assert not set(queries.SQL) - set(queries.QUERIES)
