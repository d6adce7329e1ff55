"""Q1/Q2 hand-made cases (FIXTURES.md §3)."""

from clickflow.operators import category as C

from .helpers import action, actions_df


def _events(spark, rows):
    return sorted((r.event_id, r.category_id, r.metric)
                  for r in C.category_action_events(actions_df(spark, rows)).collect())


def test_first_match_classification(spark):
    rows = [
        action(1, click=3, orders="4,5"),          # click and order -> click only
        action(2, orders="4", pays="5"),           # order and pay -> order only
        action(3, orders="  ", pays="5"),          # blank order list -> pay
        action(4, orders="1,,2,"),                 # ragged list -> 1 and 2
        action(5, click=-2),                       # negative id is a real click
        action(6, click=None, orders="4"),         # null click id = no click
        action(7),                                 # nothing
    ]
    assert _events(spark, rows) == [
        (1, "3", "click"), (2, "4", "order"), (3, "5", "pay"), (4, "1", "order"), (4, "2", "order"),
        (5, "-2", "click"), (6, "4", "order"),
    ]


def test_repeated_id_counts_twice(spark):
    f = C.category_funnel_counts(actions_df(spark, [action(1, orders="7,7")])).collect()
    assert [(r.category_id, r.click_count, r.order_count, r.pay_count) for r in f] == [("7", 0, 2, 0)]


def test_top10_ties_broken_by_id_text(spark):
    # 11 categories with one click each: text order keeps "1", "10", "11", "2", ...
    rows = [action(i, click=i) for i in range(1, 12)]
    top = C.category_top10(actions_df(spark, rows)).orderBy("rank").collect()
    assert [r.category_id for r in top] == ["1", "10", "11", "2", "3", "4", "5", "6", "7", "8"]
    assert [r.rank for r in top] == list(range(1, 11))


def test_ranking_keys_in_order(spark):
    rows = [action(1, click=1), action(2, click=2), action(3, click=2),
            action(4, orders="1"), action(5, orders="1"), action(6, pays="3"), action(7, click=3)]
    top = C.category_top10(actions_df(spark, rows)).orderBy("rank").collect()
    assert [(r.category_id, r.click_count, r.order_count, r.pay_count) for r in top] == [
        ("2", 2, 0, 0), ("1", 1, 2, 0), ("3", 1, 0, 1)]


def test_session_top_k_per_category(spark):
    rows = []
    eid = 0
    for s, n in [("a", 3), ("b", 1), ("c", 2)]:
        for _ in range(n):
            eid += 1
            rows.append(action(eid, session=s, click=9))
    out = C.category_session_top10(actions_df(spark, rows), k=2).orderBy("rank").collect()
    assert [(r.category_id, r.rank, r.session_id, r.click_count) for r in out] == [
        ("9", 1, "a", 3), ("9", 2, "c", 2)]
