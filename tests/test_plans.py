"""The physical plans keep the properties the scale design relies on."""

import re

from __spark_entry__ import queries


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_used_columns(spark, sf_small):
    p = plan(queries()["item_table"](spark, sf_small))
    read = re.findall(r"ReadSchema: (struct<[^>]*>)", p) or re.findall(r"ReadSchema: struct<([^>]*)>", p)
    text = " ".join(read) if read else p
    assert "l_extendedprice" not in text and "l_comment" not in text
    assert "o_totalprice" not in p and "p_retailprice" not in p


def test_dedup_is_partially_aggregated_before_the_shuffle(spark, sf_small):
    p = plan(queries()["clean_ratings"](spark, sf_small))
    assert "partial_max" in p
    # the partial aggregate sits below the exchange on (userId, movieId)
    assert p.index("hashpartitioning(userId") < p.rindex("partial_max")


def test_ranking_does_not_shuffle_the_product(spark, sf_small):
    p = plan(queries()["recommend_known"](spark, sf_small))
    lines = p.splitlines()
    nlj = next(i for i, l in enumerate(lines) if "BroadcastNestedLoopJoin" in l)
    # nothing between the top of the plan and the product is an exchange on the
    # product's side: the windows reuse the range partitioning by user
    above = lines[:nlj]
    assert not any("Exchange" in l and "BroadcastExchange" not in l and "userId" in l for l in above)
    assert any("rangepartitioning(userId" in l for l in lines[nlj:nlj + 3])
    assert "WindowGroupLimit" in p and "Partial" in p


def test_leave_n_out_limits_each_user_map_side(spark, sf_small):
    from reelrank.operators import splits
    from reelrank.plans.catalog import Catalog

    p = plan(splits.leave_n_out(Catalog(spark, sf_small).ratings, 1, 10))
    assert re.search(r"WindowGroupLimit \[userId.*Partial", p)


def test_bucketed_ratings_need_no_shuffle_per_user(spark, sf_small):
    from pyspark.sql import functions as F

    from reelrank.plans.catalog import Catalog
    from reelrank.session import scratch_path
    from reelrank.sinks import tables

    c = Catalog(spark, sf_small)
    tables.publish_bucketed(c.ratings, "ratings_bucketed_test", scratch_path(spark, "rb"), "userId", 4,
                            sort_within=["userId", "movieId"])
    agg = spark.table("ratings_bucketed_test").groupBy("userId").agg(F.avg("rating"))
    p = plan(agg)
    assert "Exchange" not in p
    assert agg.count() == c.ratings.select("userId").distinct().count()


def test_hot_groups_are_limited_map_side(spark, sf_small):
    def partial_for(p: str, key: str) -> bool:
        return any(f"WindowGroupLimit [{key}" in l and l.rstrip().endswith("Partial") for l in p.splitlines())

    search_plan = plan(queries()["title_search"](spark, sf_small))
    assert partial_for(search_plan, "token")  # class heads per (token, tf, dl)
    assert partial_for(search_plan, "shape")  # k smallest ids per title shape
    ranking_plan = plan(queries()["recommend_known"](spark, sf_small))
    assert partial_for(ranking_plan, "mask")  # k smallest ids per genre mask


def scans(p: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", p))


def test_profiles_read_the_fact_table_once(spark, sf_small):
    for name in ("user_genre_profile", "rating_facts", "recommend_known"):
        assert scans(plan(queries()[name](spark, sf_small)), "lineitem") == 1


def test_ranking_never_shuffles_by_mask(spark, sf_small):
    p = plan(queries()["recommend_known"](spark, sf_small))
    product = p[:p.index("BroadcastNestedLoopJoin")]
    assert "hashpartitioning(mask" not in product  # only the mask table itself is grouped by mask, below


def test_title_search_reads_the_index_once(spark, sf_small):
    # the written index replaces the table in every branch but the final titles
    assert scans(plan(queries()["title_search"](spark, sf_small)), "part") <= 2
