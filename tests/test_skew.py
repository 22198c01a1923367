"""Hot users, hot items, hot words and copies: same results as plain Python."""

import random

import pytest

from tagmatch import Scale, recommend
from tagmatch.operators.catalog import item_catalog
from tagmatch.operators.interactions import positive_interactions
from tagmatch.operators.profiles import (
    Profiles,
    user_count,
    user_item_details,
    user_tag_profile,
    user_term_totals,
)
from tagmatch.operators.similarity import cosine_similarity
from tagmatch.operators.weights import term_frequency
from tests import brute_force

TARGET = 7
WAYS = {
    "hot users": Scale(hot_rows=300, salts=4),
    "large catalog": Scale(broadcast_bytes=4000),
    "large catalog, hot keys": Scale(broadcast_bytes=4000, hot_rows=300, salts=4),
    "many words, hot keys": Scale(broadcast_bytes=0, hot_rows=35, salts=4),
}
# Whether the catalog is broadcast, words are numbered, and there are hot users.
TAKEN = {
    "hot users": (True, False, True),
    "large catalog": (False, True, False),
    "large catalog, hot keys": (False, True, True),
    "many words, hot keys": (False, False, True),
}


@pytest.fixture(scope="module")
def rows():
    """A third of all rows of one user, a third of one item, a third copies of one row."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    tags = {
        item: ["Common", *draw.sample(words, 3), draw.choice([" A\tb ", "x, y", None])]
        for item in range(60)
    }
    tags[60], tags[61] = [], None
    titles = {item: f"t{item}" for item in range(0, 62) if item % 10}
    liked = [(draw.randrange(40), draw.randrange(62)) for _ in range(600)]
    liked += [(3, draw.randrange(62)) for _ in range(700)]
    liked += [(draw.randrange(40), 11) for _ in range(700)]
    liked += [(9, 23)] * 700
    draw.shuffle(liked)
    return liked, tags, titles


@pytest.fixture(scope="module")
def tables(spark, rows):
    liked, tags, titles = rows
    return (
        spark.createDataFrame(
            [(u, i, True) for u, i in liked], "user_id int, app_id int, is_recommended boolean"
        ).repartition(5),
        spark.createDataFrame(list(titles.items()), "app_id int, title string"),
        spark.createDataFrame(list(tags.items()), "app_id int, tags array<string>"),
    )


@pytest.fixture(scope="module", params=WAYS)
def way(request):
    return request.param


@pytest.fixture(scope="module")
def scale(way):
    return WAYS[way]


def item_words(rows, scope):
    _, tags, titles = rows
    return {
        item: brute_force.words_of(t)
        for item, t in tags.items()
        if t and (scope == "tagged" or item in titles)
    }


@pytest.fixture(scope="module")
def profiles(tables, scale):
    interactions, items, item_tags = tables
    return Profiles(
        positive_interactions(interactions), item_catalog(items, item_tags, "tagged"), scale
    )


def test_the_way_is_taken(profiles, way):
    taken = (profiles.small, profiles.word_numbers is not None, profiles.hot_users is not None)
    assert taken == TAKEN[way]
    assert (profiles.hot_words is not None) == (way == "many words, hot keys")


def test_totals_and_counts(profiles, rows):
    words = item_words(rows, "tagged")
    totals = {}
    held = 0
    for user, item in rows[0]:
        if item in words:
            held += 1
            totals[user] = totals.get(user, 0) + len(words[item])
    found = {r.user_id: r.total_word_count for r in user_term_totals(profiles).collect()}
    assert found == totals
    assert user_count(profiles).collect()[0].user_count == len(totals)
    assert user_item_details(profiles).count() == held
    shares = {}
    for r in term_frequency(profiles).collect():
        shares[r.user_id] = shares.get(r.user_id, 0.0) + r.tf
    assert shares == {user: pytest.approx(1.0) for user in totals}
    listed = {}
    for r in user_tag_profile(profiles).collect():
        listed[r.user_id] = listed.get(r.user_id, 0) + sum(r.word_counts)
    assert listed == totals


@pytest.mark.parametrize("idf", ["plain", "smoothed"])
def test_similarity(profiles, rows, idf):
    expected = brute_force.similarities(rows[0], item_words(rows, "tagged"), TARGET, idf)
    found = {
        r.user_id: r.cosine_similarity for r in cosine_similarity(profiles, TARGET, idf).collect()
    }
    assert found == {user: pytest.approx(s, abs=1e-12) for user, s in expected.items()}


@pytest.mark.parametrize(("scope", "target"), [("titled", TARGET), ("tagged", 3)])
def test_recommendation(tables, rows, scale, scope, target):
    words = item_words(rows, scope)
    near = brute_force.nearest(brute_force.similarities(rows[0], words, target), 5)
    expected = brute_force.recommended(rows[0], words, rows[2], near, target)
    found = recommend(*tables, target, k=5, scope=scope, scale=scale).collect()
    assert {(r.app_id, r.title): r.similar_user_ids for r in found} == expected
