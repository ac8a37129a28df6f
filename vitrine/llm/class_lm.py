"""Language-model scoring with word classes (Brown class n-grams).

**Packing.** Documents are dealt into groups of a bounded size, each group's words are numbered, and a group becomes one row of numbers.
Words travel between groups and shards as hashes of 64 bits, in packed arrays: a group has each of its words once.

**Counts and classes.** Shards of the vocabulary add up the words' counts and, for each word, how often which class stands before and after
it. At first the most frequent words are classes of their own and all others one class. In each sweep all words are exchanged: a word
goes to the class in which its neighbours' classes are most likely, the mutual information of neighbouring classes being the measure and
the other words' classes fixed. The second sweep counts neighbours by the classes of the first, so its counts give the
transitions from the classes of the first sweep to those of the second.

**Score.** P(word | previous) = L * P(class of word | class of previous) * P(word | class) + (1 - L) * P(word), where P(word) is the
add-half estimate and a word that was never seen has this part only. 1 - L is the share of training tokens that
occur once there, which is how often a new text has words that were never seen (Good and Turing).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import rows
from vitrine.workspace import partitions_for, stage

FOLD = (5, 1)
CLASSES = 64
#: Bounds of 1 - L.
LEAST_UNSEEN, MOST_UNSEEN = 0.05, 0.9
SWEEPS = 2
GROUP_BYTES = 8 << 20
#: Transitions by the classes' own shares that are added to those counted after each class.
PRIOR = 5.0
END = 0  # the hash that stands for the end of a text


def hashes(text: str | None) -> np.ndarray:
    """A text's words, lower-cased (A-Z only), and the end."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.maximum(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), 1)
    out[-1] = END
    return out


def _press(*arrays: np.ndarray) -> bytes:
    import zstandard

    sizes = np.array([len(a) for a in arrays], "<i8").tobytes()
    return zstandard.compress(sizes + b"".join(a.tobytes() for a in arrays), 1)


def _open(data: bytes, *kinds: str) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.decompress(data)
    sizes, at, out = np.frombuffer(raw, "<i8", len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _pack(documents: DataFrame, fold: tuple[int, int], groups: int) -> DataFrame:
    """One row for each group: ids, lengths, whether they train, the words' numbers; the words' hashes and training counts."""
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id")
        train = np.array([rows.crc_of_id(i) % fold[0] != fold[1] for i in ids.to_pylist()])
        docs = [hashes(t) for c in table.column("text").iterchunks() for t in c.to_pylist()]
        lengths = np.array([len(d) for d in docs], "<i8")
        words, codes = np.unique(np.concatenate(docs), return_inverse=True)
        counts = np.bincount(codes[np.repeat(train, lengths)], minlength=len(words))
        body = _press(codes.astype("<u4"), lengths, train.astype("u1"))
        return pa.table({
            "g": table.column("g")[:1], "ids": pa.array([ids.to_pylist()], pa.list_(ids.type)), "body": [body],
            "words": [_press(words, counts.astype("<i8"))],
        })

    kind = documents.schema["doc_id"].dataType.simpleString()
    dealt = documents.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
    return dealt.groupBy("g").applyInArrow(run, f"g long, ids array<{kind}>, body binary, words binary")


def _split(shards: int, h: np.ndarray) -> list[tuple[int, np.ndarray]]:
    shard = (h % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    return [(s, order[cuts[s] : cuts[s + 1]]) for s in range(shards) if cuts[s] < cuts[s + 1]]


def _counts(packed: DataFrame, shards: int) -> DataFrame:
    """(shard, g, asked): the words of a group and their training counts, by shard."""
    def run(batches):
        for batch in batches:
            for g, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h, n = _open(words, "<u8", "<i8")
                parts = [(s, g, _press(h[at], n[at])) for s, at in _split(shards, h)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts), (pa.int32(), pa.int64(), pa.binary()))], ["shard", "g", "asked"])

    return packed.select("g", "words").mapInArrow(run, "shard int, g long, asked binary")


def _frequent(asked: DataFrame, most: int) -> tuple[dict[int, int], int, int, int]:
    """The most frequent words with their class, the number of training tokens, of different ones, and of those that occur once."""
    def run(table: pa.Table) -> pa.Table:
        h, n = (np.concatenate(x) for x in zip(*(_open(a, "<u8", "<i8") for a in table.column("asked").to_pylist())))
        words, at = np.unique(h, return_inverse=True)
        total = np.bincount(at, n, len(words)).astype(np.int64)
        seen = words != END
        top = np.lexsort((words[seen], -total[seen]))[:most]
        word, n = [None, *words[seen][top].view(np.int64).tolist()], [0, *total[seen][top].tolist()]
        rest = [0] * len(top)
        return pa.table({
            "word": pa.array(word, pa.int64()), "n": pa.array(n, pa.int64()), "tokens": [int(total.sum()), *rest],
            "kinds": [int((total > 0).sum()), *rest], "once": [int((total == 1).sum()), *rest],
        })

    found = stage(asked.groupBy("shard").applyInArrow(run, "word long, n long, tokens long, kinds long, once long"), "frequent")
    sums = found.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds"), F.sum("once").alias("once")).first()
    top = found.where("word is not null and n > 0").orderBy(F.desc("n"), "word").limit(most).collect()  # `most` rows
    return {r["word"]: i for i, r in enumerate(top)}, sums["tokens"] or 0, sums["kinds"] or 0, sums["once"] or 0


def _neighbours(body: bytes, h: np.ndarray, classes: np.ndarray, count: int, shards: int) -> list[tuple[int, bytes]]:
    """For the words of a group, by shard: class, and how often which class stands before and after them in training texts."""
    codes, lengths, train = _open(body, "<u4", "<i8", "u1")
    codes = codes[np.repeat(train.astype(bool), lengths)].astype(np.int64)
    if not len(codes):
        return []
    ends = h[codes] == END
    own = np.where(ends, count, classes[codes]).astype(np.int64)
    before = np.concatenate([[count], own[:-1]])  # the end of a text stands before the beginning of the next
    wide = 2 * (count + 1)
    keys = np.concatenate([codes * wide + before, (codes * wide + count + 1)[~ends] + np.concatenate([own[1:], [count]])[~ends]])
    keys, n = np.unique(keys, return_counts=True)
    word, context = keys // wide, (keys % wide).astype("u1")
    there, starts = np.unique(word, return_index=True)
    sizes = np.diff(np.append(starts, len(word)))
    out = []
    for s, at in _split(shards, h[there]):
        at = np.sort(at)
        rows_ = np.repeat(starts[at], sizes[at]) + np.arange(sizes[at].sum()) - np.repeat(np.cumsum(sizes[at]) - sizes[at], sizes[at])
        mine = there[at]
        out.append((s, _press(h[mine], np.where(h[mine] == END, count, classes[mine]).astype("u1"), sizes[at].astype("<u4"), context[rows_], n[rows_].astype("<u4"))))
    return out


def _summed(sent: DataFrame, count: int) -> DataFrame:
    """(shard, vectors): the same, added up over all groups."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_open(x, "<u8", "u1", "<u4", "u1", "<u4") for x in table.column("vectors").to_pylist()]
        h, classes, sizes, context, n = (np.concatenate(x) for x in zip(*parts))
        words, first, at = np.unique(h, return_index=True, return_inverse=True)
        wide = 2 * (count + 1)
        keys, place = np.unique(np.repeat(at, sizes) * wide + context, return_inverse=True)
        total = np.bincount(place, n, len(keys)).astype("<i8")
        sizes = np.bincount(keys // wide, minlength=len(words)).astype("<u4")
        return pa.table({"shard": table.column("shard")[:1], "vectors": [_press(words, classes[first], sizes, (keys % wide).astype("u1"), total)]})

    return sent.groupBy("shard").applyInArrow(run, "shard int, vectors binary")


_VECTORS = ("<u8", "u1", "<u4", "u1", "<i8")


def _matrix(cells: DataFrame, count: int) -> np.ndarray:
    out = np.zeros((count + 1, count + 1))
    for r in cells.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():  # a cell for each two classes
        out[r["a"], r["b"]] = r["n"]
    return out


def _transitions(vectors: DataFrame, count: int, column: str = "vectors") -> np.ndarray:
    """How often which class is followed by which, by the classes that the vectors hold."""
    def run(batches):
        out = np.zeros((count + 1, count + 1))
        for batch in batches:
            for data in batch.column(0).to_pylist():
                _, classes, sizes, context, n = _open(data, *_VECTORS)
                left = context <= count
                np.add.at(out, (context[left], np.repeat(classes, sizes)[left]), n[left])
        a, b = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(out[a, b].astype(np.int64))], ["a", "b", "n"])

    return _matrix(vectors.select(column).mapInArrow(run, "a int, b int, n long"), count)


def _exchanged(vectors: DataFrame, matrix: np.ndarray, count: int) -> DataFrame:
    """(shard, model): words, counts, classes before and after the sweep; `vectors` again with the new classes."""
    def run(batches):
        total = matrix.sum() + 1e-9
        gain = np.log((matrix + 0.1) * total / np.outer(matrix.sum(1) + 0.1 * (count + 1), matrix.sum(0) + 0.1 * (count + 1)))
        gain = np.concatenate([gain, gain.T])[:, :count]  # contexts before, contexts after
        for batch in batches:
            shards, models, again = batch.column(0), [], []
            for data in batch.column(1).to_pylist():
                words, classes, sizes, context, n = _open(data, *_VECTORS)
                starts = np.cumsum(sizes.astype(np.int64)) - sizes
                new = np.zeros(len(words), "u1")
                for i in range(0, len(words), 20_000):
                    a, b = starts[i], starts[i + 20_000] if i + 20_000 < len(words) else len(context)
                    score = np.add.reduceat(gain[context[a:b]] * n[a:b, None], starts[i : i + 20_000] - a)
                    new[i : i + 20_000] = score.argmax(1)
                new[words == END] = count
                counts = np.add.reduceat(np.where(context <= count, n, 0), starts).astype("<i8")
                models.append(_press(words, counts, classes, new))
                again.append(_press(words, new, sizes, context, n))
            yield pa.RecordBatch.from_arrays([shards, pa.array(models, pa.binary()), pa.array(again, pa.binary())], ["shard", "model", "moved"])

    return vectors.mapInArrow(run, "shard int, model binary, moved binary")


_MODEL = ("<u8", "<i8", "u1", "u1")


def _answers(asked: DataFrame, model: DataFrame) -> DataFrame:
    """(g, told): for each group what the shard's model knows of its words; a word that is not there has the count 0."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = []
        if right.num_rows:
            words, counts, old, new = _open(right.column("model")[0].as_py(), *_MODEL)
        for data in left.column("asked").to_pylist():
            h, _ = _open(data, "<u8", "<i8")
            c, x, y = np.zeros(len(h), "<i8"), np.zeros(len(h), "u1"), np.zeros(len(h), "u1")
            if right.num_rows:
                at = np.minimum(np.searchsorted(words, h), len(words) - 1)
                there = words[at] == h
                c[there], x[there], y[there] = counts[at[there]], old[at[there]], new[at[there]]
            told.append(_press(h, c, x, y))
        return pa.table({"g": left.column("g"), "told": pa.array(told, pa.binary())})

    return asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(run, "g long, told binary")


def _told(table: pa.Table) -> list[np.ndarray]:
    """What all shards know of a group's words, in the order of the words."""
    parts = [_open(x, *_MODEL) for x in table.column("told").to_pylist()]
    h, c, x, y = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(h, kind="stable")
    return [h[order], c[order], x[order], y[order]]


def score(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", fold: tuple[int, int] = FOLD, classes: int = CLASSES,
          weight: float | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): one row for each input row, repeated rows included.

    Words are runs without white space, A-Z lower-cased; each text ends in one more token. Null counts as the empty text, which has
    that token only. Documents whose crc32(id as text) mod fold[0] is fold[1] are scored, but not learnt from; a null id counts as the empty
    text. `weight` sets L. Without training documents nothing is known and all tokens are equally unlikely. An empty table gives an
    empty one; other columns are not read.
    """
    spark = documents.sparkSession
    rows.importable(spark)
    source = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    groups, shards = (partitions_for(documents, b) for b in (GROUP_BYTES, 4 * GROUP_BYTES))
    packed = stage(_pack(source, fold, groups), "packed")
    asked = stage(_counts(packed, shards), "asked")
    first, tokens, kinds, once = _frequent(asked, classes - 1)
    if weight is None:
        weight = 1 - min(MOST_UNSEEN, max(LEAST_UNSEEN, once / max(1, tokens)))
    shared = spark.sparkContext.broadcast(first)  # classes - 1 words

    def start(batches):
        for batch in batches:
            for body, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = _open(words, "<u8", "<i8")[0]
                own = np.array([shared.value.get(x, classes - 1) for x in h.view(np.int64).tolist()])
                parts = _neighbours(body, h, own, classes, shards)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in parts], t) for i, t in ((0, pa.int32()), (1, pa.binary()))], ["shard", "vectors"])

    def again(left: pa.Table, right: pa.Table) -> pa.Table:
        h, _, _, own = _told(right)
        parts = [p for body in left.column("body").to_pylist() for p in _neighbours(body, h, own, classes, shards)]
        return pa.table({"shard": pa.array([p[0] for p in parts], pa.int32()), "vectors": pa.array([p[1] for p in parts], pa.binary())})

    model = None
    for sweep in range(SWEEPS):
        if sweep == 0:
            sent = packed.select("body", "words").mapInArrow(start, "shard int, vectors binary")
        else:
            told = _answers(asked, model)
            sent = packed.select("g", "body").groupBy("g").cogroup(told.groupBy("g")).applyInArrow(again, "shard int, vectors binary")
        vectors = stage(_summed(sent, classes), "vectors")
        moved = stage(_exchanged(vectors, _transitions(vectors, classes), classes), "moved")
        model = moved.select("shard", "model")
    follow = _transitions(moved, classes, "moved")
    size = follow.sum(0)
    uni = size / max(1.0, size.sum())
    after = (follow + PRIOR * uni) / (follow.sum(1, keepdims=True) + PRIOR) if size.sum() else follow

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        h, c, old, new = _told(right)
        out: list[list] = [[] for _ in range(5)]
        with np.errstate(divide="ignore", invalid="ignore"):
            base = (c + 0.5) / (tokens + 0.5 * (kinds + 1))
            emit = np.where(c > 0, c / np.maximum(1.0, size[new]), 0.0)
        old = np.where(c > 0, old, classes + 1)
        chances = np.vstack([after, uni])
        for ids, body in zip(left.column("ids").to_pylist(), left.column("body").to_pylist()):
            codes, lengths, _ = _open(body, "<u4", "<i8", "u1")
            begin = np.cumsum(lengths) - lengths
            before = np.concatenate([[classes], old[codes[:-1]]]).astype(np.int64)
            before[begin] = classes
            p = weight * chances[before, new[codes]] * emit[codes] + (1 - weight) * base[codes]
            sums = [lengths, np.add.reduceat((c[codes] > 0).astype(np.int64), begin), np.add.reduceat(np.log10(base[codes]), begin), np.add.reduceat(np.log10(p), begin)]
            for column, values in zip(out, [ids, *(x.tolist() for x in sums)]):
                column += values
        kinds_ = (left.schema.field("ids").type.value_type, pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({k: pa.array(v, t) for k, v, t in zip(("doc_id", "n_tokens", "n_known", "base_score", "score"), out, kinds_)})

    kind = source.schema["doc_id"].dataType.simpleString()
    told = _answers(asked, model)
    rated = packed.select("g", "ids", "body").groupBy("g").cogroup(told.groupBy("g")).applyInArrow(rate, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return rated.withColumn("train_tokens", F.lit(tokens).cast("long"))
