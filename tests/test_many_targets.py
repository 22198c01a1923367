"""Stored profiles and the neighbours of many targets, against single runs and plain Python."""

import random
import time
from pathlib import Path

import pytest

from tagmatch import Scale
from tagmatch.operators import recommend
from tagmatch.operators.catalog import item_catalog
from tagmatch.operators.interactions import positive_interactions
from tagmatch.operators.neighbours import nearest_users
from tagmatch.operators.profiles import Profiles
from tagmatch.operators.similarity import cosine_similarity, most_similar
from tagmatch.operators.recommend import recommend_many
from tagmatch.operators.store import open_profiles, store_profiles, stored_similarity
from tagmatch.sources import testdata
from tagmatch.sources.shared import shared_folder, stored
from tests import brute_force
from tests.conftest import TESTDATA


def profiles_of(spark, liked, tags, scale=Scale()):
    interactions = spark.createDataFrame([(u, i, True) for u, i in liked], "user_id long, app_id long, is_recommended boolean")
    items = spark.createDataFrame([(i, f"t{i}") for i in tags], "app_id long, title string")
    item_tags = spark.createDataFrame(list(tags.items()), "app_id long, tags array<string>")
    return Profiles(positive_interactions(interactions), item_catalog(items, item_tags), scale)


@pytest.fixture(scope="module")
def sparse():
    """Users of many small groups with few words in common, one word that all have, two
    equal users, users without a common word and one with nothing but the common word."""
    draw = random.Random(11)
    tags = {item: ["Common", f"g{item % 25}", f"w{draw.randrange(200)}"] for item in range(300)}
    tags[900], tags[901], tags[902] = ["Common"], ["alone"], ["apart", "alone"]
    liked = [(u, draw.randrange(12) * 25 + u % 25) for u in range(100, 400) for _ in range(draw.randrange(1, 6))]
    liked += [(500, 7), (501, 7), (500, 32), (501, 32), (600, 900), (3, 901), (4, 902), (5, 902), (5, 902)]
    return liked, tags


def by_brute_force(liked, tags, targets, k, kind, zero):
    words = {item: brute_force.words_of(t) for item, t in tags.items()}
    found = []
    for target in targets:
        sims = brute_force.similarities(liked, words, target, kind, zero)
        found += [(target, n, u, round(sims[u], 9)) for n, u in enumerate(brute_force.nearest(sims, k), 1)]
    return sorted(found)


def rows_of(found):
    return sorted((r.target_user, r["rank"], r.user_id, round(r.cosine_similarity, 9)) for r in found.collect())


@pytest.mark.parametrize(("k", "kind", "zero"), [(3, "smoothed", "drop"), (12, "plain", "keep")])
def test_neighbours_of_every_user(spark, sparse, k, kind, zero):
    liked, tags = sparse
    store = store_profiles(profiles_of(spark, liked, tags))
    users = sorted({u for u, _ in liked})
    targets = spark.createDataFrame([(u,) for u in [*users, users[0], None, 9999]], "user_id long")
    assert rows_of(nearest_users(store, targets, k, kind, zero)) == by_brute_force(liked, tags, users, k, kind, zero)


def test_targets_are_taken_in_blocks_that_fit(spark, sparse):
    liked, tags = sparse
    store = store_profiles(profiles_of(spark, liked, tags, Scale(broadcast_bytes=30_000)))
    users = sorted({u for u, _ in liked})
    targets = spark.createDataFrame([(u,) for u in users], "user_id long")
    assert rows_of(nearest_users(store, targets)) == by_brute_force(liked, tags, users, 3, "plain", "keep")


def test_no_targets_give_no_rows(spark, sparse):
    store = store_profiles(profiles_of(spark, *sparse))
    none = spark.createDataFrame([], "user_id long")
    assert nearest_users(store, none).collect() == []
    with pytest.raises(ValueError):
        nearest_users(store, none, k=0)


@pytest.fixture(scope="module")
def small_table(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    catalog = item_catalog(testdata.items(spark, sf_dir), testdata.item_tags(spark, sf_dir))
    return Profiles(positive_interactions(testdata.interactions(spark, sf_dir)), catalog)


def test_many_targets_equal_single_runs(spark, small_table):
    """A thousand targets in one go; some of them alone."""
    store = store_profiles(small_table)
    targets = store.by_user.select("user_id").distinct().orderBy("user_id").limit(1000)
    found = nearest_users(store, targets)
    got = {}
    for row in found.collect():
        got.setdefault(row.target_user, []).append((row.user_id, round(row.cosine_similarity, 10)))
    assert len(got) == 1000 and all(len(rows) == 3 for rows in got.values())
    for target in sorted(got)[::125]:
        alone = most_similar(cosine_similarity(small_table, target)).collect()
        assert [(r.user_id, round(r.cosine_similarity, 10)) for r in alone] == sorted(
            got[target], key=lambda r: (-r[1], r[0])
        )


@pytest.mark.parametrize("scale", [Scale(), Scale(broadcast_bytes=0, hot_rows=5, salts=3)])
@pytest.mark.parametrize("users", ["counts", "set", "list"])
def test_recommendations_of_many_targets(spark, sparse, scale, users):
    liked, tags = sparse
    profiles = profiles_of(spark, liked, tags, scale)
    words = {item: brute_force.words_of(t) for item, t in tags.items()}
    titles = {item: f"t{item}" for item in tags}
    targets, pairs, want = (101, 115, 500, 5), [], {}
    for target in targets:
        chosen = brute_force.nearest(brute_force.similarities(liked, words, target))
        pairs += [(target, user) for user in chosen]
        for (item, title), names in brute_force.recommended(liked, words, titles, chosen, target).items():
            want[target, item, title] = names
    neighbours = spark.createDataFrame(pairs, "target_user long, user_id long")
    got = {
        (r.target_user, r.app_id, r.title): list(r.similar_user_ids)
        for r in recommend_many(profiles, neighbours, users).collect()
    }
    assert got.keys() == want.keys() and got
    for key, names in want.items():
        if users == "list":
            assert got[key] == names
        elif users == "set":
            assert got[key] == sorted(set(names))
        else:
            assert [tuple(h) for h in got[key]] == sorted((u, names.count(u)) for u in set(names))


def test_pairs_are_dropped_before_they_are_exchanged(spark, small_table):
    """Far fewer rows than pairs of targets and users reach the ranking."""
    store = store_profiles(small_table)
    targets = store.by_user.select("user_id").distinct()
    found = nearest_users(store, targets, zero="drop")
    made = exchanges(found)
    assert all("hashpartitioning(target_user" in dealt for dealt, _ in made)
    assert 0 < sum(rows for _, rows in made) < store.users * store.users / 10
    names = {node.nodeName() for node in final_nodes(found)}
    assert not names & {"BroadcastNestedLoopJoin", "CartesianProduct"}


def final_nodes(df):
    """Nodes of the plan as it ran, without subqueries."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            found.append(node)
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found


def exchanges(df):
    """What each shuffle of the plan is dealt by, and how many rows it wrote."""
    return [
        (node.simpleString(100), node.metrics().apply("shuffleRecordsWritten").value())
        for node in final_nodes(df)
        if node.nodeName() == "Exchange"
    ]


@pytest.mark.parametrize("zero", ["keep", "drop"])
def test_stored_profiles_give_the_same_similarities(spark, small_table, zero):
    store = store_profiles(small_table)
    want = {r.user_id: round(r.cosine_similarity, 10) for r in cosine_similarity(small_table, 7, zero=zero).collect()}
    got = stored_similarity(store, 7, zero=zero).collect()
    assert {r.user_id: round(r.cosine_similarity, 10) for r in got} == want
    assert stored_similarity(store, -1, zero=zero).collect() == []


def test_later_targets_exchange_no_counts(spark, small_table):
    folder = shared_folder(spark, "profiles")
    store_profiles(small_table, folder)
    store = open_profiles(spark, folder)
    for target in (7, 42):
        found = stored_similarity(store, target)
        assert exchanges(found) == []
        scans = [n.simpleString(100) for n in final_nodes(found) if n.nodeName().startswith("Scan")]
        assert any("Bucketed: true" in scan for scan in scans)
    # Rows of a target's words only, and of them sums per user and task.
    found = stored_similarity(store, 42, zero="drop")
    ((dealt, rows),) = exchanges(found)
    scans = [n for n in final_nodes(found) if n.nodeName().startswith("Scan") and "In(word" in n.simpleString(1000)]
    assert "hashpartitioning(user_id" in dealt
    assert scans and rows < store.by_user.count() / 2


def test_no_row_per_pair_is_made_where_all_share_words(spark):
    """Every user has a word of every target; of their pairs, no node makes rows."""
    draw = random.Random(3)
    tags = {item: [f"w{w}" for w in draw.sample(range(12), 4)] for item in range(40)}
    liked = [(u, item) for u in range(300) for item in draw.sample(range(40), 6)]
    store = store_profiles(profiles_of(spark, liked, tags))
    users = list(range(300))
    targets = spark.createDataFrame([(u,) for u in users], "user_id long")
    found = nearest_users(store, targets, zero="drop")
    nodes = final_nodes(found)
    made = [n.metrics().apply("numOutputRows").value() for n in nodes if n.metrics().contains("numOutputRows")]
    assert 0 < max(made) < len(users) * len(users) / 8
    assert rows_of(found) == by_brute_force(liked, tags, users, 3, "plain", "drop")


def test_recommendations_meet_no_row_per_pair_where_all_share_words(spark, monkeypatch):
    """From the users' words to the items: what is read of the neighbours, and what of them."""
    draw = random.Random(8)
    tags = {item: [f"w{w}" for w in draw.sample(range(12), 4)] for item in range(40)}
    liked = [(u, item) for u in range(300) for item in draw.sample(range(40), 6)]
    words, titles = {i: brute_force.words_of(t) for i, t in tags.items()}, {i: f"t{i}" for i in tags}
    profiles = profiles_of(spark, liked, tags)
    people = []

    def seen(df, name):
        people.append(df)
        return stored(df, name)

    monkeypatch.setattr(recommend, "stored", seen)
    wanted = spark.createDataFrame([(u,) for u in range(300)], "user_id long")
    neighbours = nearest_users(store_profiles(profiles), wanted, zero="drop")
    got = {}
    for r in recommend_many(profiles, neighbours, "set").collect():
        got.setdefault(r.target_user, {})[r.app_id, r.title] = list(r.similar_user_ids)
    nodes = final_nodes(people[0])
    made = [n.metrics().apply("numOutputRows").value() for n in nodes if n.metrics().contains("numOutputRows")]
    assert 0 < max(made) < 300 * 300 / 8
    for target in range(0, 300, 20):
        near = brute_force.nearest(brute_force.similarities(liked, words, target))
        names = brute_force.recommended(liked, words, titles, near, target)
        assert got[target] == {key: sorted(set(of)) for key, of in names.items()}


def with_large_catalog(spark, sparse, seen=None):
    """Profiles of a catalog that is not broadcast, though its words are."""
    profiles = profiles_of(spark, *sparse, Scale(broadcast_bytes=18_000))
    assert not profiles.small and profiles.words_fit
    if seen is None:
        return profiles

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    liked = spark.createDataFrame(sparse[0], "user_id long, app_id long").mapInArrow(counted, "user_id long, app_id long")
    return Profiles(liked, profiles.catalog, profiles.scale)


def test_liked_rows_are_read_once_with_a_large_catalog(spark, sparse):
    """The rows come from a join in practice, which every reading shuffles again."""
    liked, tags = sparse
    read = spark.sparkContext.accumulator(0)
    profiles = with_large_catalog(spark, sparse, read)
    targets = (101, 115, 500, 5)
    wanted = spark.createDataFrame([(t,) for t in targets], "user_id long")
    got = {}
    for r in recommend_many(profiles, nearest_users(store_profiles(profiles), wanted), "set").collect():
        got.setdefault(r.target_user, {})[r.app_id, r.title] = list(r.similar_user_ids)
    assert read.value == len(liked)
    words, titles = {i: brute_force.words_of(t) for i, t in tags.items()}, {i: f"t{i}" for i in tags}
    for target in targets:
        near = brute_force.nearest(brute_force.similarities(liked, words, target))
        names = brute_force.recommended(liked, words, titles, near, target)
        assert got.get(target, {}) == {key: sorted(set(of)) for key, of in names.items()}


def test_storing_leaves_no_shuffled_rows_and_no_counts(spark, sparse):
    profiles = with_large_catalog(spark, sparse)
    profiles.counts  # what it stores is not asked for here
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    base = Path(spark.conf.get("spark.checkpoint.dir"))

    def shuffled():
        return {file for folder in folders for file in Path(folder).rglob("shuffle_*")}

    shuffles, tables, names = shuffled(), set(base.iterdir()), {t.name for t in spark.catalog.listTables()}
    store_profiles(profiles)
    until = time.time() + 10
    while shuffled() - shuffles and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - shuffles
    assert [folder.name.split("-")[0] for folder in set(base.iterdir()) - tables] == ["profiles"]
    assert len({t.name for t in spark.catalog.listTables()} - names) == 1
