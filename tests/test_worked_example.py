"""The worked example, on each of the ways the engine can take."""

import functools

import pytest

from tagmatch import Scale, recommend, recommend_hashed, recommend_tagged, recommend_titled
from tagmatch.operators.catalog import hash_catalog, item_catalog
from tagmatch.operators.interactions import positive_interactions
from tagmatch.operators.profiles import (
    Profiles,
    user_count,
    user_item_details,
    user_tag_profile,
    user_term_totals,
    user_terms,
)
from tagmatch.operators.recommend import recommendation_lines, unseen_items
from tagmatch.operators.similarity import cosine_similarity, most_similar
from tagmatch.operators.weights import inverse_document_frequency, target_profile, tfidf
from tagmatch.sources.schemas import Columns
from tests import worked

# How keys and tables are treated; the results have to be the same.
WAYS = {
    "default": Scale(),
    "all hot": Scale(hot_rows=0, hot_share=1e-9, salts=3),
    "no broadcast, some hot": Scale(broadcast_bytes=0, hot_rows=2, hot_share=0.0, salts=2),
}


@pytest.fixture(params=WAYS, scope="module")
def scale(request):
    return WAYS[request.param]


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@functools.cache
def profiles(spark, scale, scope="titled", hashed=False):
    interactions, items, item_tags = worked.tables(spark)
    catalog = item_catalog(items, item_tags, scope)
    catalog = hash_catalog(catalog) if hashed else catalog
    return Profiles(positive_interactions(interactions), catalog, scale)


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def close(values):
    return {key: pytest.approx(value, abs=1e-9) for key, value in values.items()}


def test_details_and_terms(spark, scale):
    p = profiles(spark, scale)
    details = sorted((r.user_id, r.app_id, r.title) for r in user_item_details(p).collect())
    assert details == [
        (1, 10, "Alpha"), (2, 10, "Alpha"), (2, 11, "Beta"), (2, 11, "Beta"), (3, 12, "Gamma"),
        (4, 11, "Beta"), (4, 15, "Eps"), (5, 11, "Beta"), (5, 15, "Eps"),
    ]
    terms = sorted((r.user_id, r.word) for r in user_terms(p).collect() if r.user_id < 4)
    assert terms == [
        (1, "action"), (1, "free to play"),
        (2, "action"), (2, "action"), (2, "action"), (2, "free to play"), (2, "rpg"), (2, "rpg"),
        (3, " logic"), (3, "puzzle"),
    ]
    assert as_dict(user_term_totals(p)) == {1: 2, 2: 6, 3: 2, 4: 4, 5: 4}
    assert user_count(p).collect()[0].user_count == 5


def test_tag_profile_holds_every_word(spark, scale):
    words = {}
    for row in user_tag_profile(profiles(spark, scale)).collect():
        words.setdefault(row.user_id, {}).update(zip(row.tag_words, row.word_counts))
    assert words[2] == {"action": 3, "free to play": 1, "rpg": 2}
    assert words[3] == {"puzzle": 1, " logic": 1}


def test_idf(spark, scale):
    p = profiles(spark, scale)
    plain = {r.word: (r.user_count, r.idf) for r in inverse_document_frequency(p).collect()}
    assert {w: n for w, (n, _) in plain.items()} == {
        "action": 4, "free to play": 2, "rpg": 3, "puzzle": 1, " logic": 1,
    }
    assert plain["action"][1] == pytest.approx(0.223144, abs=1e-6)
    smoothed = {r.word: r.idf for r in inverse_document_frequency(p, "smoothed").collect()}
    assert smoothed["rpg"] == pytest.approx(0.405465, abs=1e-6)


def test_tfidf(spark, scale):
    weights = {(r.user_id, r.word): r.tfidf for r in tfidf(profiles(spark, scale)).collect()}
    assert len(weights) == 11
    assert weights[2, "rpg"] == pytest.approx(0.170275, abs=1e-6)
    assert weights[3, " logic"] == pytest.approx(0.804719, abs=1e-6)
    target = as_dict(target_profile(profiles(spark, scale), worked.TARGET))
    assert target == {
        "action": pytest.approx(0.111572, abs=1e-6),
        "free to play": pytest.approx(0.458145, abs=1e-6),
    }


@pytest.mark.parametrize(
    ("scope", "hashed", "kind", "expected"),
    [
        ("titled", False, "plain", {2: 0.686784676, 3: 0.0, 4: 0.094717207, 5: 0.094717207}),
        ("titled", False, "smoothed", {2: 0.675218722, 3: 0.0, 4: 0.104323679, 5: 0.104323679}),
        ("titled", True, "smoothed", {2: 0.675218722, 3: 0.0, 4: 0.104323679, 5: 0.104323679}),
        ("tagged", False, "plain", {2: 0.859997981, 3: 0.0, 4: 0.167311285, 5: 0.167311285}),
    ],
)
def test_similarity(spark, scale, scope, hashed, kind, expected):
    p = profiles(spark, scale, scope, hashed)
    kept = cosine_similarity(p, worked.TARGET, kind)
    assert as_dict(kept) == close(expected)
    dropped = as_dict(cosine_similarity(p, worked.TARGET, kind, zero="drop"))
    assert dropped == close({u: s for u, s in expected.items() if s > 0})


def test_ties_and_zeros_among_the_nearest(spark, scale):
    p = profiles(spark, scale)
    similarities = cosine_similarity(p, worked.TARGET)
    assert [r.user_id for r in most_similar(similarities, 2).collect()] == [2, 4]
    assert [r.user_id for r in most_similar(similarities, 4).collect()] == [2, 4, 5, 3]


def test_unseen_items(spark, scale):
    p = profiles(spark, scale)
    nearest = most_similar(cosine_similarity(p, worked.TARGET))
    rows = sorted(tuple(r) for r in unseen_items(p, nearest, worked.TARGET).collect())
    assert rows == [(11, 2, 2), (11, 4, 1), (11, 5, 1), (15, 4, 1), (15, 5, 1)]


def test_recommendations(spark, scale):
    tables = worked.tables(spark, "int" if scale == Scale() else "bigint")
    lists = sorted(tuple(r) for r in recommend_titled(*tables, 1, scale=scale).collect())
    assert lists == [(11, "Beta", [2, 2, 4, 5]), (15, "Eps", [4, 5])]
    hashed = sorted(tuple(r) for r in recommend_hashed(*tables, 1, scale=scale).collect())
    assert hashed == lists
    sets = sorted(tuple(r) for r in recommend_tagged(*tables, 1, scale=scale).collect())
    assert sets == [(11, "Beta", [2, 4, 5]), (15, "Eps", [4, 5])]
    counts = recommend(*tables, 1, users="counts", scale=scale).collect()
    assert {r.app_id: [tuple(u) for u in r.similar_user_ids] for r in counts} == {
        11: [(2, 2), (4, 1), (5, 1)],
        15: [(4, 1), (5, 1)],
    }


def test_untitled_item_counts_but_is_not_recommended(spark, scale):
    tables = worked.tables(spark)
    rows = recommend(*tables, 1, k=4, scope="tagged", zero="keep", users="set", scale=scale)
    assert sorted(r.app_id for r in rows.collect()) == [11, 12, 15]


def test_unknown_target_gives_nothing(spark, scale):
    tables = worked.tables(spark)
    assert recommend_titled(*tables, 99, scale=scale).count() == 0
    assert recommend_titled(*tables, 7, scale=scale).count() == 0


def test_lines(spark):
    tables = worked.tables(spark)
    sets = recommendation_lines(recommend_tagged(*tables, 1), "set")
    assert sorted(r.line for r in sets.collect()) == [
        "Game ID: 11, userId: 2,4,5, title: Beta",
        "Game ID: 15, userId: 4,5, title: Eps",
    ]
    lists = recommendation_lines(recommend_titled(*tables, 1), "list")
    assert sorted(r.line for r in lists.collect()) == [
        "Game ID: 11, Title: Beta, Users: 2, 2, 4, 5",
        "Game ID: 15, Title: Eps, Users: 4, 5",
    ]


def test_target_of_common_words_only(spark):
    interactions = spark.createDataFrame(
        [(1, 1, True), (2, 1, True), (2, 2, True)], "user_id int, app_id int, is_recommended boolean"
    )
    items = spark.createDataFrame([(1, "A"), (2, "B")], "app_id int, title string")
    tags = spark.createDataFrame([(1, ["x"]), (2, ["y"])], "app_id int, tags array<string>")
    p = Profiles(positive_interactions(interactions), item_catalog(items, tags))
    assert as_dict(cosine_similarity(p, 1)) == {2: 0.0}
    assert as_dict(cosine_similarity(p, 1, zero="drop")) == {}


@pytest.mark.parametrize(
    "option", [{"scope": "x"}, {"terms": "x"}, {"idf": "x"}, {"zero": "x"}, {"users": "x"}]
)
def test_unknown_options_are_refused(spark, option):
    with pytest.raises(ValueError):
        recommend(*worked.tables(spark), 1, **option)


def test_tables_with_other_column_names(spark):
    interactions, items, item_tags = worked.tables(spark)
    columns = Columns(user="player", item="game", liked="thumbs_up", title="name", tags="labels")
    renamed = {"user_id": "player", "app_id": "game", "is_recommended": "thumbs_up", "title": "name", "tags": "labels"}
    # Columns of the standard names that mean something else are not read.
    others = [t.withColumnsRenamed(renamed).selectExpr("*", "1 AS app_id", "'x' AS title") for t in (interactions, items, item_tags)]
    found = recommend_titled(*others, worked.TARGET, columns=columns)
    assert found.columns == ["game", "name", "similar_user_ids"]
    plain = recommend_titled(interactions, items, item_tags, worked.TARGET)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
