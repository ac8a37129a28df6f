"""Similar listings and their clusters against plain Python."""

import math
import random

import pytest

from vitrine.operators import similarity


def plain_links(sets, least):
    n = {}
    for terms in sets.values():
        for t in terms:
            n[t] = n.get(t, 0) + 1
    vectors = {}
    for node, terms in sets.items():
        w = {t: math.log1p(len(sets) / n[t]) for t in terms}
        length = math.sqrt(sum(x * x for x in w.values()))
        vectors[node] = {t: x / length for t, x in w.items()}
    out = {}
    for a in vectors:
        for b in vectors:
            if a < b:
                s = round(sum(x * vectors[b].get(t, 0) for t, x in vectors[a].items()) * similarity.UNIT)
                if s >= round(least * similarity.UNIT):
                    out[a, b] = s
    return out


def plain_labels(nodes, links, rounds=20):
    edges = {x: [(x, similarity.UNIT)] for x in nodes}
    for (a, b), s in links.items():
        edges[a].append((b, s))
        edges[b].append((a, s))
    label = {x: x for x in nodes}
    for _ in range(rounds):
        new = {}
        for x in nodes:
            votes = {}
            for y, s in edges[x]:
                votes[label[y]] = votes.get(label[y], 0) + s
            new[x] = min(votes, key=lambda k: (-votes[k], k))
        if new == label:
            break
        label = new
    return label


def listings(seed, n=150):
    r = random.Random(seed)
    themes = [[f"{t}{i}" for i in range(6)] for t in "abcde"]
    rows = []
    for i in range(n):
        theme = r.choice(themes)
        rows.append((f"u{i:03}", ["home", *r.sample(theme, r.randint(2, 5)), *r.sample([f"x{k}" for k in range(40)], r.randint(0, 2))]))
    return rows + [("v1", ["home"]), ("v2", None), ("v3", []), ("v4", ["home", "home", None]), ("v5", rows[0][1] * 2)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("least", [0.5, 0.8])
def test_links_and_clusters(spark, seed, least):
    rows = listings(seed)
    sets = {}
    for url, terms in sorted(rows):
        key = frozenset(t for t in terms or [] if t)
        if key:
            sets.setdefault(key, url)
    nodes = {url: set(key) for key, url in sets.items()}
    links = plain_links(nodes, least)
    df = spark.createDataFrame(rows, "url string, terms array<string>")
    found = similarity.nodes(df, "url", "terms")
    got = similarity.links(similarity.weighted(found), least)
    assert {(r["a"], r["b"]): r["similarity"] for r in got.collect()} == links and len(links) > 10
    label = plain_labels(nodes, links)
    want = {url: label[sets[frozenset(t for t in terms or [] if t)]] if any(terms or []) else url for url, terms in rows}
    for parts in (1, 7):
        assert {r["url"]: r["cluster"] for r in similarity.clusters(df.repartition(parts), "url", "terms", least).collect()} == want
    assert 1 < len(set(want.values())) < len(rows)


def test_a_prefix_leaves_out_frequent_terms(spark):
    rows = [(f"u{i}", ["all", f"t{i % 5}"]) for i in range(50)]
    vectors = similarity.weighted(similarity.nodes(spark.createDataFrame(rows, "url string, terms array<string>"), "url", "terms"))
    firsts = vectors.select(similarity.prefix(vectors["vector"], 0.9).alias("p")).collect()
    assert all("all" not in r["p"] for r in firsts) and all(r["p"] for r in firsts)


def test_no_rows(spark):
    df = spark.createDataFrame([], "url string, terms array<string>")
    assert similarity.clusters(df, "url", "terms").count() == 0


def test_candidates_are_not_shuffled(spark, monkeypatch):
    """A pair is weighed where its entries meet: the written links stand on one join by term, without a distinct or a join by node above it."""
    import plans

    vectors = similarity.weighted(similarity.nodes(spark.createDataFrame(listings(3), "url string, terms array<string>"), "url", "terms"))
    written = plans.record_writes(monkeypatch)
    monkeypatch.setattr(similarity, "GROUP", 5)
    got = {(r["a"], r["b"]) for r in similarity.links(vectors, 0.5).collect()}
    sets = {}
    for url, terms in sorted(listings(3)):
        if any(terms or []):
            sets.setdefault(frozenset(t for t in terms if t), url)
    assert got == set(plain_links({url: set(key) for key, url in sets.items()}, 0.5))
    assert "hashpartitioning(a#" not in written[-1] and "hashpartitioning(b#" not in written[-1]


def test_no_task_holds_more_than_two_blocks_of_a_term(spark, monkeypatch):
    """A term that all listings have is met block by block; pairs within and between blocks are found, by products of matrices or one by one."""
    rows = [(f"w{i:03}", ["all", f"y{i % 3}", f"y{i % 4}"]) for i in range(12)] + listings(4)
    df = spark.createDataFrame(rows, "url string, terms array<string>")
    sets = {}
    for url, terms in sorted(rows):
        if any(terms or []):
            sets.setdefault(frozenset(t for t in terms if t), url)
    want = plain_links({url: set(key) for key, url in sets.items()}, 0.4)
    vectors = similarity.weighted(similarity.nodes(df, "url", "terms"))
    monkeypatch.setattr(similarity, "GROUP", 4)
    met = similarity._met(vectors, 0.4).toArrow()
    groups = met.group_by(["term", "i", "j"]).aggregate([("at", "count")])
    of_term = met.select(["term", "node"]).group_by(["term", "node"]).aggregate([]).group_by("term").aggregate([("node", "count")])
    assert max(groups["at_count"].to_pylist()) < max(of_term["node_count"].to_pylist()) and max(groups["j"].to_pylist()) > 3
    for several, columns, together in ((2, 1000, 8192), (2, 3, 1), (1000, 3, 40)):
        monkeypatch.setattr(similarity, "SEVERAL", several)
        monkeypatch.setattr(similarity, "COLUMNS", columns)
        monkeypatch.setattr(similarity, "ROWS", together)
        got = [(r["a"], r["b"], r["similarity"]) for batch in similarity._weighed(iter(met.to_batches(max_chunksize=7)), 0.4) for r in batch.to_pylist()]
        assert {(a, b): s for a, b, s in got} == want and len(got) == len(want) > 100


def test_labels_move_over_numbers_in_the_order_of_the_keys(spark, monkeypatch):
    """Rounds shuffle whole numbers, a node's votes stand side by side, and the smallest key still names a cluster."""
    rows = [(f"https://{'z' if i % 2 else 'é'}/{i}", terms) for i, (_, terms) in enumerate(listings(6, 40))]
    seen, moved = [], similarity.labels
    monkeypatch.setattr(similarity, "labels", lambda n, l, rounds: seen.append((dict(n.dtypes)["node"], dict(l.dtypes)["a"])) or moved(n, l, rounds))
    df = spark.createDataFrame(rows + [(None, ["only", "here"])], "url string, terms array<string>")
    got = {r["url"]: r["cluster"] for r in similarity.clusters(df, "url", "terms", 0.5).collect()}
    assert seen == [("bigint", "bigint")] and got.pop(None) is None
    sets = {}
    for url, terms in sorted(rows):
        if any(terms or []):
            sets.setdefault(frozenset(t for t in terms if t), url)
    nodes = {url: set(key) for key, url in sets.items()}
    # the row without a key counts as a set of terms in no figure
    label = plain_labels(nodes, plain_links(nodes, 0.5))
    assert got == {url: label[sets[frozenset(t for t in terms if t)]] if any(terms or []) else url for url, terms in rows}
