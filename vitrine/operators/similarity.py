"""Listings that use like words: a graph of TF-IDF similarity, and clusters by label propagation on it.

Listings with the same terms are one node. Two nodes are linked when the cosine of their weighted terms reaches a least value. Links come from an inverted index
with a prefix filter: terms are ordered from rare to frequent, a node is entered under its first terms only, up to where
the rest of its vector is too short to reach that value with any other, and two nodes that reach it share such a term. Frequent terms, whose lists
would be long, stand last and are hardly ever entered.

A term's entries are dealt into blocks, and each pair of blocks meets in one task, so that no task holds more than two blocks of any term. There the pairs are weighed
as products of matrices, and what reaches the least value is weighed again term by term, in one order.

Labels move in rounds over all nodes at once: a node takes the label that most of its weight is linked to (itself with weight one), of equal ones the smallest.
Weights are whole numbers, so no sum depends on the order of rows, and the clusters are the same for any partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.ordering import with_position
from vitrine.workspace import partitions_for, ship, stage

#: Whole units of similarity in one.
UNIT = 1_000_000
#: Entries of a term in one block; pairs for each task that weighs them.
GROUP, PAIRS = 2048, 1 << 22
#: Rows that are weighed together, rows of a group from which on a product of matrices rules out pairs, and its columns at a time.
ROWS, SEVERAL, COLUMNS = 8192, 32, 1024


def sets(df: DataFrame, key: str, terms: str) -> DataFrame:
    """A written table (key, terms) of every row: its distinct terms in order, computed once."""
    return stage(df.select(F.col(key).alias("key"), F.array_sort(F.array_distinct(F.array_compact(F.col(terms)))).alias("terms")), "sets")


def nodes(df: DataFrame, key: str, terms: str) -> DataFrame:
    """A written table (node, terms, members): distinct sets of terms, each named by its smallest key. Rows without terms are no nodes."""
    return _nodes(sets(df, key, terms))


def _nodes(rows: DataFrame) -> DataFrame:
    return stage(rows.where(F.size("terms") > 0).groupBy("terms").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("members")), "nodes")


def weighted(graph_nodes: DataFrame) -> DataFrame:
    """(node, vector): terms from rare to frequent with weights ln(1 + N / n) scaled to length one; N and n count nodes.

    Lengths are summed from rare to frequent, so they are the same on every run.
    """
    total = graph_nodes.agg(F.count(F.lit(1))).scalar()
    counts = graph_nodes.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rows = graph_nodes.select("node", F.explode("terms").alias("term")).join(counts, "term").withColumn("w", F.log1p(total / F.col("n")))
    vectors = rows.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "term", "w"))).alias("v"))  # the terms of one node
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, t: a + t["w"] * t["w"]))
    vectors = vectors.withColumn("length", length)
    return vectors.select("node", F.transform("v", lambda t: F.struct(t["term"].alias("term"), (t["w"] / F.col("length")).alias("w"))).alias("vector"))


def prefix(vector: Column, least: float) -> Column:
    """The first terms of a vector, up to where the length of the rest falls below `least`."""
    def rest(i: Column) -> Column:
        return F.aggregate(F.slice(vector, i + 1, F.size(vector)), F.lit(0.0), lambda a, t: a + t["w"] * t["w"])

    return F.transform(F.filter(vector, lambda t, i: rest(i) >= least * least - 1e-9), lambda t: t["term"])


def links(vectors: DataFrame, least: float) -> DataFrame:
    """A written table (a, b, similarity) of the node pairs, a < b, whose cosine is at least `least`; similarity in units of 1 / `UNIT`, rounded.

    The index holds the vectors, so a pair is weighed where its two entries meet, and kept at the first term that both are entered under alone:
    candidates are neither written nor shuffled, what is moved grows with the entries and with the blocks of their term.
    """
    ship(vectors.sparkSession)
    kind = dict(vectors.dtypes)["node"]
    return stage(_met(vectors, least).mapInArrow(lambda batches: _weighed(batches, least), f"a {kind}, b {kind}, similarity long"), "links")


def _met(vectors: DataFrame, least: float) -> DataFrame:
    """The index, dealt: (term, i, j, block, node, at, vector), for each pair i <= j of a term's blocks the entries of both, side by side."""
    entries = stage(vectors.where("node IS NOT NULL").select("node", "vector", F.size(prefix(F.col("vector"), least)).alias("n")), "entries")
    index = entries.select("node", "vector", F.posexplode(F.slice("vector", F.lit(1), F.col("n"))).alias("at", "entered"))
    index = index.select("node", "vector", "at", F.col("entered")["term"].alias("term"))
    counts = entries.select(F.explode(F.slice("vector", F.lit(1), F.col("n"))["term"]).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("entries"))
    dealt = stage(counts.where("entries > 1").select("term", "entries", F.ceil(F.col("entries") / GROUP).cast("int").alias("blocks")), "dealt")
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    index = index.join(dealt, "term").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = index.select("term", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "at", "vector")
    pairs = dealt.agg(F.sum(F.col("entries") * F.col("entries") / 2)).first()[0] or 0
    tasks = max(partitions_for(entries), int(pairs) // PAIRS + 1)
    # terms have one order in all vectors, so the first common one is the same seen from either side
    return met.repartition(tasks, "term", "i", "j").sortWithinPartitions("term", "i", "j")


def _weighed(batches, least: float):
    """Links of rows (term, i, j, block, node, at, vector), whole groups of (term, i, j) at a time."""
    held: list[pa.RecordBatch] = []
    n, last = 0, None
    for batch in batches:
        while batch.num_rows:
            keys = [batch.column(c) for c in ("term", "i", "j")]
            new = np.concatenate([[last is not None and tuple(k[0].as_py() for k in keys) != last], _changes(keys)])
            full = np.flatnonzero(new & (n + np.arange(batch.num_rows) >= ROWS))
            cut = int(full[0]) if len(full) else batch.num_rows
            if cut:
                held.append(batch.slice(0, cut))
                n, last = n + cut, tuple(k[cut - 1].as_py() for k in keys)
            if len(full):
                yield from _links_of(pa.Table.from_batches(held), least)
                held, n, last = [], 0, None
            batch = batch.slice(cut)
    if held:
        yield from _links_of(pa.Table.from_batches(held), least)


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """Whether a row differs from the one before it, from the second row on."""
    codes = [c.dictionary_encode().indices.to_numpy() for c in columns]
    return np.any([c[1:] != c[:-1] for c in codes], axis=0)


def _links_of(rows: pa.Table, least: float):
    rows = rows.combine_chunks()
    columns = {c: rows[c].combine_chunks() for c in rows.column_names}
    first = np.flatnonzero(np.concatenate([[True], _changes([columns[c] for c in ("term", "i", "j")])]))
    rank = pa.compute.rank(columns["node"], tiebreaker="dense").to_numpy().astype(np.int64)
    within = columns["i"].to_numpy() == columns["j"].to_numpy()
    right = (columns["block"].to_numpy() == columns["j"].to_numpy()) & ~within
    at, vector = columns["at"].to_numpy(), columns["vector"]
    size = pa.compute.list_value_length(vector).to_numpy().astype(np.int64)
    start = np.cumsum(size) - size
    flat = vector.flatten()
    coded = flat.field("term").dictionary_encode()
    term, w, width = coded.indices.to_numpy().astype(np.int64), flat.field("w").to_numpy(), len(coded.dictionary)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.argsort(owner * width + term, kind="stable")
    ordered = (owner * width + term)[order]

    def found(row: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Where a term stands among all terms of all rows, -1 if its row lacks it."""
        key = row * width + wanted
        place = np.minimum(np.searchsorted(ordered, key), len(ordered) - 1)
        return np.where(ordered[place] == key, order[place], -1)

    def verified(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        """Of candidate pairs those that are links, and meet for the first time."""
        x, y = np.where(rank[x] < rank[y], x, y), np.where(rank[x] < rank[y], y, x)
        go = rank[x] < rank[y]
        for k in range(int(at[x].max(initial=0))):
            some = np.flatnonzero(go & (at[x] > k))
            place = found(y[some], term[start[x[some]] + k])
            go[some] = (place < 0) | (place - start[y[some]] >= at[y[some]])
        x, y = x[go], y[go]
        cosine = np.zeros(len(x))
        for k in range(int(size[y].max(initial=0))):
            some = np.flatnonzero(size[y] > k)
            mine = start[y[some]] + k
            place = found(x[some], term[mine])
            cosine[some] += np.where(place >= 0, w[place] * w[mine], 0.0)
        units = cosine * UNIT
        units = (np.floor(units) + (units - np.floor(units) >= 0.5)).astype(np.int64)  # halves go up, as SQL rounds them
        go = units >= round(least * UNIT)
        a, b = (columns["node"].take(pa.array(k[go])) for k in (x, y))
        return pa.RecordBatch.from_arrays([a, b, pa.array(units[go])], ["a", "b", "similarity"])

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the rows x and y come near the least value, for all pairs of them."""
        inside, has = [], []
        for k in (x, y):
            chosen, seen = np.zeros(len(size), bool), np.zeros(width, bool)
            chosen[k] = True
            inside.append(np.flatnonzero(chosen[owner]))
            seen[term[inside[-1]]] = True
            has.append(seen)
        common = np.flatnonzero(has[0] & has[1])
        number = np.full(width, -1)
        number[common] = np.arange(len(common))
        row = np.empty(len(size), np.int64)
        total = np.zeros((len(x), len(y)))
        for c in range(0, len(common), COLUMNS):
            sides = []
            for k, of in zip((x, y), inside):
                of = of[(number[term[of]] >= c) & (number[term[of]] < c + COLUMNS)]
                row[k] = np.arange(len(k))
                side = np.zeros((len(k), min(COLUMNS, len(common) - c)))
                side[row[owner[of]], number[term[of]] - c] = w[of]
                sides.append(side)
            total += sides[0] @ sides[1].T
        return total >= least - 1e-6

    small: list[tuple[np.ndarray, np.ndarray]] = []
    pairs = 0
    for begin, end in zip(first, np.append(first[1:], len(size))):
        one = np.arange(begin, end)
        x, y = (one, one) if within[begin] else (one[~right[begin:end]], one[right[begin:end]])
        for k in range(0, len(x), GROUP):
            part = x[k : k + GROUP]
            if len(one) < SEVERAL:
                i, j = np.repeat(np.arange(len(part)), len(y)), np.tile(np.arange(len(y)), len(part))
            else:
                i, j = np.nonzero(near(part, y))
            if x is y:
                i, j = i[(i + k) < j], j[(i + k) < j]
            small.append((part[i], y[j]))
            pairs += len(i)
            if pairs >= ROWS * SEVERAL:
                yield verified(*(np.concatenate([p[m] for p in small]) for m in (0, 1)))
                small, pairs = [], 0
    if pairs:
        yield verified(*(np.concatenate([p[m] for p in small]) for m in (0, 1)))


def labels(graph_nodes: DataFrame, graph_links: DataFrame, rounds: int = 20) -> DataFrame:
    """(node, label) after label propagation, until no label moves or for `rounds` rounds at most."""
    both = (
        graph_links.select("a", "b", "similarity").unionByName(graph_links.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
        .unionByName(graph_nodes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(UNIT).cast("long").alias("similarity"))))
    # a node's links side by side: its votes are added up where they are read, and few are shuffled
    both = stage(both.repartition(partitions_for(graph_links, 32 << 20), "a"), "edges")
    now = graph_nodes.select("node", F.col("node").alias("label"))
    for _ in range(rounds):
        votes = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"), "label").agg(F.sum("similarity").alias("votes"))
        # the most votes, and of labels with as many the smallest
        then = stage(votes.groupBy("node").agg(F.min_by("label", F.struct(-F.col("votes"), F.col("label"))).alias("label")), "labels")
        moved = then.join(now.withColumnRenamed("label", "before"), "node").where("label <> before").limit(1).count()
        now = then
        if not moved:
            break
    return now


def clusters(df: DataFrame, key: str, terms: str, least: float = 0.6, rounds: int = 20) -> DataFrame:
    """(key, cluster) of every row with terms: the smallest key of the label its terms ended with. Rows without terms are clusters of their own."""
    rows = sets(df, key, terms)
    found = _nodes(rows).where("node IS NOT NULL")
    # numbers in the order of the keys stand for them while links are found and labels move
    found = stage(with_position(found, ["node", "terms"], name="number").select(F.col("number").alias("node"), "terms", F.col("node").alias("key")), "numbered")
    ends = labels(found, links(weighted(found), least), rounds)
    keys = found.select(F.col("node").alias("label"), F.col("key").alias("cluster"))
    named = found.select("node", "terms").join(ends, "node").join(keys, "label").select("terms", "cluster")
    return rows.join(named, "terms", "left").select(F.col("key").alias(key), F.coalesce("cluster", "key").alias("cluster"))
