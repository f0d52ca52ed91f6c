"""Hand-made frames for the cases the given tables do not hold."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import rows_of

from basketry.config import CandidateConfig
from basketry.operators import candidates as C
from basketry.operators import cleaning as I
from basketry.operators import evaluation as M
from basketry.operators import generators as R
from basketry.operators import quality as Q
from basketry.operators import ranker as K
from basketry.operators import reports as E
from basketry.operators import serving as V
from basketry.operators import splits as S
from basketry.operators import weights as W

EVENTS = "timestamp timestamp_ntz, user_id int, event string, item_id int"
PAIRS = "user_id int, item_id int"
RECS = "user_id int, item_id int, rank int"
END = dt.datetime(2024, 3, 1)
MS = dt.timedelta(milliseconds=1)


@pytest.fixture
def bounds(frame):
    events = frame([(END - MS, 1, "view", 1)], EVENTS)
    return S.time_boundaries(events)


def test_windows_are_half_open(frame, bounds):
    edges = bounds.first()
    assert edges["data_end"] == END
    assert edges["evaluation_start"] == END - dt.timedelta(days=7)
    times = [
        edges["ranker_start"] - MS,
        edges["ranker_start"],
        edges["evaluation_start"] - MS,
        edges["evaluation_start"],
        END - MS,
    ]
    events = frame([(t, i, "view", i) for i, t in enumerate(times)], EVENTS)
    splits = S.temporal_split(events, bounds)
    assert rows_of(splits.history, "user_id") == [(0,)]
    assert rows_of(splits.ranker, "user_id") == [(1,), (2,)]
    assert rows_of(splits.evaluation, "user_id") == [(3,), (4,)]


def test_boundaries_keep_microseconds(frame):
    late = dt.datetime(2024, 1, 31, 12, 0, 0, 123456)
    row = S.time_boundaries(frame([(late, 1, "view", 1)], EVENTS)).first()
    assert row["data_end"] == late + MS


def test_epoch_and_times_normalise_alike(frame):
    raw = frame([(1_700_000_000_123, 5, "view", 7, None)],
                "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid bigint")
    row = I.normalize_interactions(raw).first()
    assert row["timestamp"] == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert (row["user_id"], row["item_id"]) == (5, 7)
    again = I.normalize_interactions(I.normalize_interactions(raw))
    assert again.first() == row


def test_clean_events_drops_only_full_duplicates(frame):
    schema = "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid bigint"
    raw = frame([(1, 1, "view", 1, None), (1, 1, "view", 1, None), (1, 1, "view", 1, 9)], schema)
    assert I.clean_events(raw).count() == 2
    assert dict(I.clean_events(raw).dtypes)["visitorid"] == "int"


def test_popular_counts_users_and_breaks_ties_by_item(frame):
    t = dt.datetime(2024, 1, 1)
    events = frame(
        [(t, 1, "addtocart", i) for i in (3, 2, 1)]
        + [(t, 1, "transaction", 4)] * 5
        + [(t, 2, "addtocart", 4), (t, 3, "view", 9)],
        EVENTS,
    )
    assert rows_of(R.top_popular(events, 3)) == [(1, 1, 2), (2, 1, 3), (4, 2, 1)]


def test_weights_without_views_use_the_floor(frame):
    probability = W.conversion_probability(frame([], EVENTS))
    assert probability.first()["probability"] == pytest.approx(1e-3)
    weights = dict(W.event_weights(probability).collect())
    assert weights["addtocart"] == pytest.approx(math.sqrt(1000))
    assert weights["transaction"] == pytest.approx(1.3 * math.sqrt(1000))
    assert weights["view"] == 1.0


def test_weights_add_up_per_pair_and_skip_unknown_events(frame):
    t = dt.datetime(2024, 1, 1)
    events = frame(
        [(t, 1, "view", 1), (t, 1, "view", 1), (t, 1, "addtocart", 1), (t, 1, "signup", 2)], EVENTS
    )
    weights = W.event_weights(W.conversion_probability(events))
    assert rows_of(W.weighted_interactions(events, weights)) == [(1, 1, 3.0)]


def test_blank_means_white_space_only(frame):
    props = frame(
        [(1, "a", ""), (1, "a", " "), (2, "a", "\t"), (3, "a", None), (4, "a", "x"), (4, " ", "0.0")],
        "itemid int, property string, value string",
    )
    summary = Q.quality_summary({"p": props}).first()
    assert (summary["rows"], summary["null_values"], summary["empty_strings"]) == (6, 1, 4)
    share = {r["property"]: r for r in Q.property_missing_share(props).collect()}
    assert share["a"]["missing_values"] == 4 and share["a"]["missing_percent"] == 80.0
    blank = Q.items_with_blank_fields(props).first()
    assert tuple(blank) == (1, 3)
    assert rows_of(Q.property_zero_values(props)) == [(" ", 1, 1)]


def test_duplicates_count_all_but_the_first(frame):
    df = frame([(1, None)] * 3 + [(2, "x")], "a int, b string")
    row = Q.quality_summary({"t": df}).first()
    assert (row["rows"], row["duplicates"], row["null_values"]) == (4, 2, 3)


def test_quality_of_an_empty_table(frame):
    row = Q.quality_summary({"t": frame([], "a int, b string")}).first()
    assert tuple(row) == ("t", 0, 0, 0, 0)


def test_compare_datasets_is_a_multiset_comparison(frame):
    a = frame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    b = frame([(2, None), (1, "x"), (1, "x")], "a int, b string")
    c = frame([(2, None), (2, None), (1, "x")], "a int, b string")
    assert Q.compare_datasets(a, b).first()["same_data"]
    different = Q.compare_datasets(a, c).first()
    assert different["same_shape"] and not different["same_data"]
    other = Q.compare_datasets(a, a.select("a")).first()
    assert not other["same_shape"] and not other["same_data"]


def test_numeric_profile_finds_the_narrowest_type(frame):
    df = frame([(1, 200, 40_000, 3_000_000_000, 0.5), (-128, 0, 0, 0, 1.5)],
               "a bigint, b bigint, c bigint, d bigint, e double")
    found = {r["column"]: r["narrowest"] for r in Q.numeric_profile(df).collect()}
    assert found == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "double"}


def test_describe_matches_known_values(frame):
    props = frame(
        [(i, "p", str(v)) for i in range(1, 5) for v in range(i)] + [(9, "q", "z")],
        "itemid int, property string, value string",
    )
    row = Q.values_per_item(props, "p").first()
    assert (row["count"], row["mean"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]) == (
        4, 2.5, 1, 1.75, 2.5, 3.25, 4,
    )
    assert row["std"] == pytest.approx(math.sqrt(5 / 3))


def test_categories_without_views_or_carts(frame):
    t = dt.datetime(2024, 1, 1)
    events = frame(
        [(t, 1, "transaction", 1), (t, 1, "view", 2), (t, 1, "addtocart", 2), (t, 1, "view", 3)],
        "timestamp timestamp_ntz, visitorid int, event string, itemid int",
    )
    latest = frame([(1, 10), (2, 20), (3, None)], "itemid int, categoryid smallint")
    matrix = E.category_event_matrix(events, latest)
    assert rows_of(matrix) == [(10, 0, 0, 1, 1), (20, 1, 1, 0, 2)]
    conversion = {r["categoryid"]: r["percent"] for r in E.category_conversion(matrix, 0).collect()}
    assert conversion == {10: None, 20: 100.0}
    assert rows_of(E.cart_from_view(matrix, 0), "categoryid") == [(20,)]
    assert E.purchase_from_cart(matrix, 0).first()["percent"] is None


def test_latest_category_prefers_the_larger_id_on_a_tie(frame):
    t = dt.datetime(2024, 1, 1)
    changes = frame([(t, 1, 5), (t, 1, 7), (t - MS, 1, 9), (t + MS, 2, 1), (t, 2, 8)],
                    "timestamp timestamp_ntz, itemid int, categoryid smallint")
    assert rows_of(E.latest_category(changes)) == [(1, 7), (2, 1)]


def test_history_keeps_the_last_touch_and_n_items(frame, bounds):
    start = bounds.first()["ranker_start"]
    events = frame(
        [(start - k * MS, 1, "view", k) for k in range(1, 5)]
        + [(start - 9 * MS, 1, "addtocart", 1), (start, 1, "view", 99), (start - MS, 1, "other", 50)],
        EVENTS,
    )
    assert rows_of(C.user_history(events, bounds, 2)) == [(1, 1), (1, 2)]


def test_one_plan_equals_step_by_step(frame, bounds):
    start = bounds.first()["ranker_start"]
    events = frame(
        [(start - u * k * MS, u, "view", k) for u in (1, 2, 3) for k in range(1, 5)], EVENTS
    )
    popular = frame([(1, 9, 1), (2, 8, 2), (77, 7, 3)], "itemid int, score bigint, rank int")
    als = frame([(1, 1, 0.5, 1), (1, 77, 0.4, 2), (9, 3, 0.1, 1)],
                "visitorid int, itemid int, score float, rank smallint")
    similar = frame([(1, 2, 0.9, 1), (1, 77, 0.8, 2), (2, 77, 0.7, 1), (3, 5, 0.3, 1)],
                    "itemid int, similar_itemid int, score float, rank smallint")
    config = CandidateConfig(history_items=3, similar_top_n=2, popular_top_n=2)
    history = C.user_history(events, bounds, 3)
    sims = C.similar_features(history, similar, 2)
    pairs = C.union_candidates(
        C.als_candidates(als), sims, C.popular_candidates(history, popular, 2)
    )
    steps = C.add_popular_features(pairs, popular)
    steps = C.add_als_features(C.add_similar_features(steps, sims), als)
    steps = C.finalize_candidates(steps)
    fused = C.build_candidates(events, bounds, popular, als, similar, config)
    assert rows_of(fused) == rows_of(steps)
    row = fused.where("user_id = 1 AND item_id = 77").first()
    # 77 is popular but not proposed from there: the flag still says so.
    assert (row["from_als"], row["from_popular"], row["from_similar"]) == (1, 1, 1)
    assert row["similarity_sources"] == 2 and row["similarity_rank"] == 1
    assert row["popular_score_log"] == pytest.approx(math.log(8))


def test_ranks_break_ties_by_item(frame):
    scored = frame([(1, i, 0.5) for i in (3, 1, 2)] + [(2, 8, None), (2, 9, 0.1)],
                   "user_id int, item_id int, score double")
    expected = [(1, 1, 0.5, 1), (1, 2, 0.5, 2), (1, 3, 0.5, 3), (2, 8, None, 2), (2, 9, 0.1, 1)]
    assert rows_of(K.rank_recommendations(scored)) == expected
    assert rows_of(K.rank_recommendations(scored, large_users=True)) == expected


def test_groups_need_both_labels(frame):
    train = frame([(1, 1, 1), (1, 2, 0), (2, 1, 1), (3, 1, 0)], "user_id int, item_id int, target tinyint")
    assert rows_of(K.valid_groups(train), "user_id", "item_id") == [(1, 1), (1, 2)]


def test_labels_keep_users_with_a_positive_anywhere(frame):
    candidates = frame([(1, 1), (1, 2), (2, 1), (3, 1)], PAIRS)
    positives = frame([(1, 2), (1, 2), (2, 9)], PAIRS)
    assert rows_of(K.label_candidates(candidates, positives)) == [(1, 1, 0), (1, 2, 1), (2, 1, 0)]


def test_order_puts_missing_ranks_last(frame):
    train = frame([(1, 1, None), (1, 2, 2), (1, 3, 1), (0, 9, None)],
                  "user_id int, item_id int, als_rank smallint")
    assert [r["item_id"] for r in K.order_groups(train).collect()] == [9, 3, 2, 1]


def test_coverage_of_no_positives_is_zero(frame):
    row = K.candidate_coverage(frame([], PAIRS), frame([(1, 1)], PAIRS)).first()
    assert tuple(row) == (0, 0, 0.0)


def test_missing_feature_fails(frame):
    with pytest.raises(ValueError, match="als_rank"):
        K.require_features(frame([(1.0,)], "als_score float"), ["als_score", "als_rank"])


def test_serving_removes_bought_items_at_any_time(frame):
    t = dt.datetime(2024, 1, 1)
    scored = frame([(1, i, float(i)) for i in range(5)] + [(2, 1, 0.5), (3, 7, 0.5)],
                   "user_id int, item_id int, score double")
    events = frame([(t, 1, "transaction", 4), (t, 1, "addtocart", 3), (t, 2, "transaction", 1)], EVENTS)
    assert rows_of(V.serve_batch(scored, events, top_k=2)) == [
        (1, 2, 2.0, 2), (1, 3, 3.0, 1), (3, 7, 0.5, 1),
    ]
    assert rows_of(V.serve_batch(scored, events, users=[3]), "user_id") == [(3,)]
    assert V.serve_batch(scored, events, users=[2, 99]).count() == 0


def test_histogram_is_cumulative(frame):
    recs = frame([(s,) for s in (-3.0, -2.0, 0.25, 5.0)], "score double")
    counts = dict(V.score_histogram(recs).collect())
    assert counts["-2.0"] == 2 and counts["0.0"] == 2 and counts["0.5"] == 3 and counts["+Inf"] == 4


def test_metrics_by_hand(frame):
    recs = frame([(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 1), (9, 5, 1), (1, 8, 11)], RECS)
    truth = frame([(1, 1), (1, 7), (2, 4), (3, 1)], PAIRS)
    catalog = frame([(2,)], "catalog_size bigint")
    novelty = frame([(1, 1.0), (2, 2.0), (5, 6.0)], "item_id int, novelty double")
    row = M.evaluate_recommendations(recs, truth, catalog, novelty, 10).first()
    assert row["precision"] == pytest.approx((1 / 10 + 0 + 0) / 3)
    assert row["recall"] == pytest.approx((1 / 2 + 0 + 0) / 3)
    assert row["coverage"] == pytest.approx(4 / 2)
    assert row["novelty"] == pytest.approx((1 + 2 + 1 + 6) / 4)
    both = M.compare_models({"a": recs, "b": recs.where("user_id = 9")}, truth, catalog, novelty)
    rows = {r["model"]: r for r in both.collect()}
    assert rows["a"]["recall"] == row["recall"] and rows["b"]["precision"] == 0.0
    only = M.compare_models({"a": recs}, truth, catalog, novelty).first()
    assert only["model"] == "a" and only["novelty"] == row["novelty"]


def test_metrics_of_an_empty_truth(frame):
    recs = frame([(1, 1, 1)], RECS)
    catalog = frame([(1,)], "catalog_size bigint")
    novelty = frame([], "item_id int, novelty double")
    row = M.evaluate_recommendations(recs, frame([], PAIRS), catalog, novelty).first()
    assert row["precision"] is None and row["coverage"] == 1.0 and row["novelty"] is None


def test_novelty_of_items(frame, bounds):
    start = bounds.first()["evaluation_start"]
    events = frame([(start - MS, 1, "view", 1)] * 3 + [(start - MS, 1, "x", 2), (start, 1, "view", 3)], EVENTS)
    assert rows_of(M.novelty_map(events, bounds)) == [
        (1, pytest.approx(-math.log2(0.75))), (2, pytest.approx(2.0)),
    ]


def test_ids_are_encoded_in_order_without_gaps(frame):
    df = frame([(k * 7 % 101,) for k in range(500)] + [(None,)], "visitorid int")
    encoding = S.encode_ids(df, "visitorid")
    assert rows_of(encoding) == sorted(((i, i) for i in range(101)), key=repr)
    back = S.decode_ids(S.apply_encoding(df, encoding, "visitorid"), encoding, "visitorid")
    assert rows_of(back) == rows_of(df.where("visitorid IS NOT NULL"))


def test_categories_out_of_range_are_dropped(frame):
    values = ["70000", "-40000", "Infinity", "-Infinity", "NaN", "x", None, " 12 ", "32767"]
    rows = [(None, k, "categoryid", v) for k, v in enumerate(values)]
    props = frame(rows, "timestamp timestamp_ntz, itemid int, property string, value string")
    got = {r["itemid"]: r["categoryid"] for r in E.item_categories(props).collect()}
    assert got == {7: 12, 8: 32767}


def test_served_lists_have_bounds(frame):
    empty = frame([], "user_id int, item_id int, score float")
    events = frame([], "timestamp timestamp_ntz, visitorid int, event string, itemid int")
    for k in (0, 101):
        with pytest.raises(ValueError, match="between 1 and 100"):
            V.serve_batch(empty, events, top_k=k)


def test_comparison_moves_digests_and_not_rows(spark, frame):
    rows = [(1, None, "a"), (None, 1, "a"), (2, 2, None), (2, 2, None), (3, 0, "")]
    schema = "x int, y int, z string"
    left = frame(rows, schema)

    def compared(other):
        return tuple(Q.compare_datasets(left, frame(other, schema)).first())[2:]

    assert compared(rows[::-1]) == (5, 3, True, True)
    assert compared([(None, 1, "a"), (None, 1, "a"), *rows[2:]]) == (5, 3, True, False)
    assert compared(rows[:-1]) == (4, 3, False, False)
    assert compared([*rows[:3], rows[4], rows[4]]) == (5, 3, True, False)
    assert compared([*rows[:4], (3, 0, None)]) == (5, 3, True, False)
    nothing = frame([], schema)
    assert tuple(Q.compare_datasets(nothing, nothing).first()) == (0, 3, 0, 3, True, True)
    other = frame([*rows[:3], (3, 0, ""), (3, 0, ""), (9, 9, "n")], schema)
    got = rows_of(Q.differing_rows(left, other))
    assert got == sorted([(2, 2, None, 2, 1), (3, 0, "", 1, 2), (9, 9, "n", 0, 1)], key=repr)
    assert Q.differing_rows(left, left).isEmpty()
    plan = Q.compare_datasets(left, left)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any(f"{c}#" in line for line in moved for c in "xyz")
