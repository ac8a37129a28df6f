"""Removal of passages that repeat across documents: exact strings of a fixed number of bytes, found with suffix arrays.

A byte goes if a string of `LENGTH` bytes that covers it also starts in a document with a smaller id.

**Anchors.** Of the `GRAM`-byte grams of a string of `LENGTH` bytes, those with the smallest hash are its anchors. They depend on the
string alone, so all occurrences of a string have the same anchors in the same places, and what shares no anchor with
another document shares no string.

**Shards.** Hashes of anchors go to shards in packed arrays, one of each task for each hash, and the shards answer which
of them other documents have. Only around these a document's text is cut out (as far as a string with that anchor can reach) and sent
to the shard of the anchor; of equal pieces from the documents of a task only that of the smallest id is sent, the others are
covered by it. So a passage that very many documents share comes to a shard once for each task.

**Hot anchors.** Very many documents may share an anchor and differ around it. Their pieces would be one group, however large. Around such
an anchor every string of `LENGTH` bytes is sent as a piece of its own, to the shard of the string, again once for each task.

**Suffix arrays.** Equal pieces in a shard are one. Where pieces with one anchor differ, the shard's pieces are put into one text, whose
suffix array is built by induced sorting; permuted common prefixes of `LENGTH` bytes join the suffixes that begin with the
same string, and the smallest id among them tells from which documents the string goes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import rows
from vitrine.llm.jaccard import mix
from vitrine.llm.suffixes import common_prefixes, suffix_array
from vitrine.workspace import _input_bytes as input_bytes
from vitrine.workspace import stage

LENGTH = 50
GRAM = 24  # a multiple of eight; shorter ones are cheaper to look for, but meet by chance more often
#: What a task gathers before it sends (anchors; bytes of pieces), and the bytes of pieces in one suffix array.
ANCHORS, PIECES, SHARD_BYTES = 2_000_000, 32 << 20, 2 << 20
#: Bytes of input files for each shard of hashes, and the smallest number of shards.
SHARD_INPUT, SHARDS = 16 << 20, 32
LAST = (1 << 63) - 1
#: Bytes of short texts whose anchors are found at a time.
BLOCK = 64 << 10
#: An anchor that more documents have is hot: their pieces might be more than one suffix array holds.
HOT = SHARD_BYTES // (2 * LENGTH - GRAM)
#: In place of an anchor's place in its piece: the piece is one string.
ALONE = -1


def anchors(texts: list[bytes], length: int = LENGTH):
    """Yields (numbers of the texts, positions, hashes) of the grams that are smallest in some string of `length` bytes of a text; equally small
    ones all count. Texts are taken together up to `BLOCK` bytes; a string doesn't reach from one into the next."""
    i = 0
    while i < len(texts):
        first, size = i, 0
        while i < len(texts) and (i == first or size + len(texts[i]) <= BLOCK):
            size += len(texts[i])
            i += 1
        sizes = np.array([len(t) for t in texts[first:i]], np.int64)
        ends = np.cumsum(sizes)
        at, h = _anchors(b"".join(texts[first:i]), ends[:-1], length)
        number = np.searchsorted(ends, at, side="right")
        yield number + first, at - (ends - sizes)[number], h


def _anchors(data: bytes, borders: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of `data`; no string reaches over a border."""
    n = len(data)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    words = np.ndarray((n - 7,), "<u8", np.frombuffer(data, np.uint8), 0, (1,))
    grams = n - GRAM + 1
    h = np.zeros(grams, np.uint64)
    for k in range(0, GRAM, 8):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + grams])
    np.maximum(h, np.uint64(1), out=h)  # nothing stands for strings that are none
    width = length - GRAM + 1

    def sliding(x: np.ndarray, best) -> np.ndarray:
        """The best of every `width` neighbours."""
        step, out = 1, x
        while 2 * step <= width:
            out = best(out[:-step], out[step:])
            step *= 2
        rest = width - step
        return best(out[: len(out) - rest], out[rest:]) if rest else out

    least = sliding(h, np.minimum)
    over = (borders[:, None] - np.arange(1, length)).ravel()
    least[over[(over >= 0) & (over < len(least))]] = 0
    wide = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(sliding(wide, np.maximum) == h)
    return at, h[at]


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans joined."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]


def _utf8(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _lists(lengths: np.ndarray, values: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """Lists of whole numbers from their lengths and all of their values; those marked `null` are null."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    mask = None if null is None else pa.array(null)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()), mask=mask)


def _asked(texts: DataFrame, shards: int, length: int) -> DataFrame:
    """Of texts without copies under another u, (shard, hashes, owners, direct): packed 5-byte hashes in runs for each document; `direct`: those that documents of one task share."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[bytes] = set()
        count = 0

        def flush():
            owner, h = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            order = np.argsort(h, kind="stable")
            h, owner = h[order], owner[order]
            first = np.concatenate([[True], h[1:] != h[:-1]])
            shared = ~first
            shared[:-1] |= shared[1:]
            keep = first | shared
            h, owner, first, shared = h[keep], owner[keep], first[keep], shared[keep]
            shard = ((h >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)  # equal packed hashes meet in one shard
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            out: dict[str, list] = {"shard": [], "hashes": [], "owners": [], "direct": [], "direct_owners": []}
            for s in range(shards):
                at = order[cuts[s] : cuts[s + 1]]
                if len(at):
                    one, both = at[first[at]], at[shared[at]]
                    out["shard"].append(s)
                    for name, where in (("hashes", one), ("direct", both)):
                        by = where[np.argsort(owner[where], kind="stable")]
                        out[name].append((h[by] >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
                        users, lengths = np.unique(owner[by], return_counts=True)
                        out["owners" if name == "hashes" else "direct_owners"].append(users.tobytes() + lengths.astype("<i4").tobytes())
            return pa.RecordBatch.from_arrays([pa.array(out["shard"], pa.int32()), *(pa.array(out[k], pa.binary()) for k in ("hashes", "owners", "direct", "direct_owners"))], ["shard", "hashes", "owners", "direct", "direct_owners"])

        for batch in batches:
            users, some = [], []
            for u, data in zip(batch.column(0).to_pylist(), _utf8(batch.column(1))):
                if (k := hashlib.md5(data).digest()) not in seen:  # else a repeated row: same text, same u
                    seen.add(k)
                    users.append(u)
                    some.append(data)
            users = np.array(users, np.int64)
            for number, _, h in anchors(some, length):
                order = np.lexsort((h, number))
                number, h = number[order], h[order]
                new = np.concatenate([[True], (number[1:] != number[:-1]) | (h[1:] != h[:-1])])[: len(h)]
                held.append((users[number[new]], h[new]))
                count += len(held[-1][1])
            if count >= ANCHORS:
                yield flush()
                held, count = [], 0
        if count:
            yield flush()

    return texts.select("u", "text").mapInArrow(run, "shard int, hashes binary, owners binary, direct binary, direct_owners binary")


def _unpacked(packed: bytes, owners: bytes) -> tuple[np.ndarray, np.ndarray]:
    five = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    wide = np.zeros((len(five), 8), np.uint8)
    wide[:, :5] = five
    n = len(owners) // 12
    return wide.view("<u8")[:, 0], np.repeat(np.frombuffer(owners, np.int64, n), np.frombuffer(owners, "<i4", n, 8 * n))


def _answered(asked: DataFrame, hot: int) -> DataFrame:
    """(u, hashes, hot): the hashes of a document that other documents have, too; `hot`: those of them that more than `hot` documents have."""
    def run(table: pa.Table) -> pa.Table:
        own = [_unpacked(h, o) for h, o in zip(table.column("hashes").to_pylist(), table.column("owners").to_pylist())]
        task = np.concatenate([np.full(len(h), i) for i, (h, _) in enumerate(own)])
        h, u = (np.concatenate([x[i] for x in own]) for i in (0, 1))
        order = np.argsort(h, kind="stable")
        h, u, task = h[order], u[order], task[order]
        again = h[1:] == h[:-1]
        shared = np.zeros(len(h), bool)
        shared[1:] |= again
        shared[:-1] |= again
        known = [_unpacked(d, o) for d, o in zip(table.column("direct").to_pylist(), table.column("direct_owners").to_pylist())]
        # what a task's documents share among themselves, and of each task the one that asked for all of them
        asked_h, asked_task = h[shared], task[shared]
        h, u = (np.concatenate([x[shared], *(k[i] for k in known)]) for i, x in ((0, h), (1, u)))
        order = np.argsort(h, kind="stable")
        h, u = h[order], u[order]
        _, several = np.unique(h, return_inverse=True)
        many = (np.bincount(several) > hot)[several]
        order = np.argsort(u, kind="stable")
        h, u, many = h[order], u[order], many[order]
        users, first = np.unique(u, return_index=True)
        cut = lambda x: np.split(x, first[1:]) if len(users) else []
        packed = [(x.astype("<u8").tobytes(), x[m].astype("<u8").tobytes()) for x, m in zip(cut(h), cut(many))]
        return pa.table({"u": users, "hashes": pa.array([x for x, _ in packed], pa.binary()), "hot": pa.array([x for _, x in packed], pa.binary())})

    return asked.groupBy("shard").applyInArrow(run, "u long, hashes binary, hot binary")


def _pieces(texts: DataFrame, length: int) -> DataFrame:
    """Pieces of text around the anchors that other documents have: (at, piece, id, u, place, more places), and (u, spans) of documents
    whose piece another document of the task with a smaller id has. Around a hot anchor, each string of `length` bytes is a piece of
    its own, with `at` = `ALONE`."""
    lead = length - GRAM
    names, numbers = ["at", "piece", "id", "u", "place", "more", "spans"], ("at", "id", "u", "place")

    def cut(batch):
        """Tables (piece, at, id, u, place) of all pieces of a batch."""
        u, id_ = (batch.column(c).to_numpy() for c in ("u", "id"))
        texts = _utf8(batch.column("text"))

        def keys(lists) -> np.ndarray:
            """The packed hashes of each text, together with its number."""
            packed = lists.flatten()
            of = np.repeat(pa.compute.list_parent_indices(lists).to_numpy(), pa.compute.binary_length(packed).to_numpy() // 8)
            return (of.astype(np.uint64) << np.uint64(40)) | np.frombuffer(b"".join(packed.to_pylist()), "<u8")

        def among(key: np.ndarray, ordered: np.ndarray) -> np.ndarray:
            return ordered[np.minimum(np.searchsorted(ordered, key), len(ordered) - 1)] == key if len(ordered) else np.zeros(len(key), bool)

        wanted, many = np.sort(keys(batch.column("answers"))), np.sort(keys(batch.column("hot")))
        sizes = np.array([len(t) for t in texts], np.int64)
        for number, place, h in anchors(texts, length):
            out = []
            key = (number.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
            alone = among(key, many)
            found = among(key, wanted) & ~alone
            of, place_ = number[found], place[found]
            begin = np.maximum(0, place_ - lead)
            out.append((of, begin, np.minimum(place_ + length, sizes[of]), place_ - begin))
            if alone.any():  # a string may hold several anchors: it is sent once
                of, place_ = number[alone], place[alone]
                begin = np.maximum(0, place_ - lead)
                n = np.minimum(place_, sizes[of] - length) + 1 - begin
                of, begin = np.repeat(of, n), np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
                of, begin = np.unique(np.stack([of, begin]), axis=1)
                out.append((of, begin, begin + length, np.full(len(of), ALONE)))
            for of, begin, end, at in out:
                for i in range(0, len(of), 100_000):
                    part = slice(i, i + 100_000)
                    piece = pa.array([texts[k][b:e] for k, b, e in zip(*(x[part].tolist() for x in (of, begin, end)))], pa.binary())
                    yield pa.table({"piece": piece, "at": at[part], "id": id_[of[part]], "u": u[of[part]], "place": begin[part]})

    def sifted(held: list[pa.Table]):
        """What has the smallest id of its piece, equal pieces side by side, and (id, u, begin, end) of the rest."""
        rows_ = pa.concat_tables(held).combine_chunks()
        same = rows_["piece"].combine_chunks().dictionary_encode().indices.to_numpy()
        at, id_, u, place = (rows_[c].to_numpy() for c in numbers)
        same = same.astype(np.int64) * (length + 2) + at + 1
        order = np.lexsort((place, u, id_, same))
        new = np.concatenate([[True], same[order][1:] != same[order][:-1]])
        least = id_[order][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        stays = np.empty(len(new), bool)
        stays[order] = id_[order] == least
        size = pa.compute.binary_length(rows_["piece"]).to_numpy()
        return rows_.take(order[stays[order]]), np.stack([x[~stays] for x in (id_, u, place, place + size)])

    def sent(rows_: pa.Table, spans: np.ndarray):
        """Rows of sifted pieces, one for each document, and one of each document with spans."""
        at, id_, u, place = (rows_[c].to_numpy() for c in numbers)
        same = rows_["piece"].combine_chunks().dictionary_encode().indices.to_numpy()
        head = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in (same, at, id_, u)], axis=0)]))
        lengths = np.diff(np.append(head, len(place))) - 1
        other = np.ones(len(place), bool)
        other[head] = False
        more = _lists(lengths, place[other], lengths == 0)
        first = rows_.take(head)
        columns = [first["at"], first["piece"], first["id"], first["u"], first["place"], more, pa.nulls(len(head), kinds[-1])]
        table = pa.table([c.cast(k) for c, k in zip(columns, kinds)], names)
        yield from table.combine_chunks().to_batches(20_000)
        id_, u, begin, end = spans[:, np.lexsort((spans[2], spans[1], spans[0]))]
        if len(u):
            document = np.concatenate([[0], np.cumsum((id_[1:] != id_[:-1]) | (u[1:] != u[:-1]))])
            apart = document * (2 << 31)  # spans of different documents never touch
            begin_, end_ = merged(begin + apart, end + apart)
            document_ = begin_ // (2 << 31)
            head = np.unique(document, return_index=True)[1]
            flat = np.stack([begin_, end_], 1).ravel() - np.repeat(document_, 2) * (2 << 31)
            none = [pa.nulls(len(head), k) for k in kinds]
            columns = [none[0], none[1], pa.array(id_[head]), pa.array(u[head]), none[4], none[5], _lists(2 * np.bincount(document_), flat)]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))

    def run(batches):
        held: list[pa.Table] = []
        spans, size, kept = [np.empty((4, 0), np.int64)], 0, 0
        for batch in batches:
            for found in cut(batch):
                held.append(found)
                size += found.nbytes
                if size - kept >= PIECES:  # copies go first, and if little is left without them, it stays
                    rows_, more = sifted(held)
                    spans.append(more)
                    held, size = [rows_], rows_.nbytes
                    kept = size
                    if 2 * size >= PIECES or sum(x.nbytes for x in spans) >= PIECES:
                        yield from sent(rows_, np.concatenate(spans, 1))
                        held, spans, size, kept = [], [np.empty((4, 0), np.int64)], 0, 0
        if held:
            rows_, more = sifted(held)
            yield from sent(rows_, np.concatenate([*spans, more], 1))

    return texts.select("u", "id", "text", "answers", "hot").mapInArrow(run, "at int, piece binary, id long, u long, place int, more array<int>, spans array<int>")


def meeting(pieces: pa.BinaryArray, anchor: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether a piece may share a string of `length` bytes that covers the anchor with another piece of that anchor: a rolling
    hash of these strings, each at its distance from the anchor, rules out most that share little more than the anchor."""
    n, width = len(pieces), 2 * length - GRAM
    if not n:
        return np.zeros(0, bool)
    lead = length - GRAM  # what a full piece has before its anchor
    begin, size = lead - at, pa.compute.binary_length(pieces).to_numpy().astype(np.int64)
    table = np.zeros((n, width), np.uint64)
    flat = np.frombuffer(b"".join(pieces.to_pylist()), np.uint8)
    rows_ = np.repeat(np.arange(n), size)
    table[rows_, begin[rows_] + np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat + np.uint64(1)
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.uint64(pow(int(base), length, 1 << 64))
    sums = np.zeros((width + 1, n), np.uint64)
    for k in range(width):
        sums[k + 1] = sums[k] * base + table[:, k]
    out = np.zeros(n, bool)
    for k in range(width - length + 1):
        whole = np.flatnonzero((begin <= k) & (begin + size >= k + length))
        h = mix(sums[k + length, whole] - sums[k, whole] * power) ^ anchor[whole].view(np.uint64)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        out[whole[order[1:][same]]] = True
        out[whole[order[:-1][same]]] = True
    return out


def removable(pieces: list[bytes], least_id: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the pieces, each with one byte behind it, the smallest id of a piece that has the string of `length` bytes from there, too,
    `LAST` where none begins; and where the pieces start."""
    data = b"\x00".join(pieces) + b"\x00"
    sizes = np.array([len(p) + 1 for p in pieces])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(pieces)), sizes)
    sa = suffix_array(np.frombuffer(data, np.uint8).astype(np.int64))
    joined = common_prefixes(data, sa, length)[sa]
    # a string must not reach over the end of its piece; such suffixes belong to no group
    inside = (np.arange(len(data)) - starts[owner] + length <= sizes[owner] - 1)[sa]
    groups = np.flatnonzero(~joined)
    ids = np.where(inside, least_id[owner[sa]], LAST)
    least = np.zeros(len(data), np.int64)
    least[sa] = np.repeat(np.minimum.reduceat(ids, groups), np.diff(np.append(groups, len(sa))))
    return least, starts


def _found(pieces: DataFrame, length: int) -> DataFrame:
    """(u, id, spans): flat begin and end of the bytes that go."""
    def solve(sent: pa.Table) -> pa.RecordBatch:
        """Whole groups of pieces, in the order of their anchors."""
        h, at, id_, u, place = (sent[c].to_numpy() for c in ("h", "at", "id", "u", "place"))
        at = np.maximum(at, 0)
        coded = sent["piece"].combine_chunks().dictionary_encode()
        texts, number = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        least = np.full(len(texts), LAST, np.int64)
        np.minimum.at(least, number, id_)
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        kinds = np.unique((group * len(texts) + number) * (2 * length) + at, return_index=True)[1]
        several = kinds[(np.bincount(group[kinds]) > 1)[group[kinds]]]
        alike = meeting(texts.take(pa.array(number[several])), h[several], at[several], length)
        mixed = np.unique(number[several[alike]])
        # where pieces are all that they share, the whole piece goes; else from the first string that goes to the end of the last, as they overlap
        sizes = pa.compute.binary_length(texts).to_numpy().astype(np.int64)[number]
        begin, end = np.zeros(len(number), np.int64), np.where((least[number] < id_) & (sizes >= length), sizes, 0)
        if len(mixed):
            smallest, starts = removable(texts.take(pa.array(mixed)).to_pylist(), least[mixed], length)
            where = np.full(len(texts), -1)
            where[mixed] = starts
            of = np.flatnonzero((where[number] >= 0) & (sizes >= length))
            end[where[number] >= 0] = 0
            n = sizes[of] - length + 1
            row, k = np.repeat(of, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            goes = smallest[where[number[row]] + k] < id_[row]
            row, k = row[goes], k[goes]
            if len(row):
                head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                begin[row[head]] = k[head]
                end[row[head]] = k[np.append(head[1:], len(row)) - 1] + length
        go = np.flatnonzero(end)
        more = sent["more"].combine_chunks().take(pa.array(go))
        n = pa.compute.fill_null(pa.compute.list_value_length(more), 0).to_numpy() + 1
        places = np.empty(n.sum(), np.int64)
        first = np.zeros(len(places), bool)
        first[np.cumsum(n) - n] = True
        places[first], places[~first] = place[go], more.flatten().to_numpy()
        flat = np.stack([places + np.repeat(begin[go], n), places + np.repeat(end[go], n)], 1).ravel()
        return pa.RecordBatch.from_arrays([pa.array(u[go]), pa.array(id_[go]), _lists(2 * n, flat)], ["u", "id", "spans"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            direct = batch.filter(pa.compute.is_valid(batch.column("spans")))
            yield direct.select(["u", "id", "spans"])
            sent = batch.filter(pa.compute.is_valid(batch.column("piece")))
            while sent.num_rows:
                h = sent.column("h").to_numpy()
                upto = np.cumsum(pa.compute.binary_length(sent.column("piece")).to_numpy().astype(np.int64))
                new = np.concatenate([[last is not None and h[0] != last], h[1:] != h[:-1]])
                full = np.flatnonzero(new & (size + np.concatenate([[0], upto[:-1]]) >= SHARD_BYTES))
                cut = int(full[0]) if len(full) else sent.num_rows
                if cut:
                    held.append(sent.slice(0, cut))
                    size, last = size + int(upto[cut - 1]), h[cut - 1]
                if len(full):
                    yield solve(pa.Table.from_batches(held))
                    held, size, last = [], 0, None
                sent = sent.slice(cut)
        if held:
            yield solve(pa.Table.from_batches(held))

    # what has one anchor goes to one partition, side by side, and around hot anchors what is one string; spans anywhere
    shared = F.when(F.col("at") == ALONE, F.col("piece")).otherwise(F.substring("piece", F.col("at") + 1, F.lit(GRAM)))
    anchor = F.xxhash64(F.coalesce(shared, F.col("u").cast("string").cast("binary")))
    dealt = pieces.repartition(anchor).withColumn("h", anchor).sortWithinPartitions("h")
    return dealt.mapInArrow(run, "u long, id long, spans array<int>")


def remove_repeats(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): one row for each input row; `kept` are the remaining bytes, left out on demand.

    Texts are UTF-8 bytes; null counts as the empty text; shorter texts than `length` stay whole. Matches never cross documents and are
    judged on the input. A null id counts as larger than all others; rows with one id are none of them smaller than the other,
    so repeated rows get the same result. Of exact copies the one with the smallest id is worked on, and all of the others go. An
    empty table gives an empty one; other columns are not read. Ids are whole numbers.
    """
    rows.importable(documents.sparkSession)
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = source.withColumns({
        "id": F.coalesce("doc_id", F.lit(LAST)), "k": F.unhex(F.md5(F.col("text").cast("binary"))), "n": F.octet_length("text").cast("long"),
    }).withColumn("u", F.xxhash64("k", "id"))
    short, long = keyed.where(F.col("n") < length), keyed.where(F.col("n") >= length)
    firsts = stage(long.groupBy("k").agg(F.min("id").alias("id")), "firsts")
    # all joins of texts go by u alone, so that one shuffle of the texts serves them all; the ids are compared besides
    same = lambda a, b: a.bitwiseXOR(b) == 0
    chosen = firsts.select(F.xxhash64("k", "id").alias("u"), F.col("id").alias("first_id"))
    texts = long.select("u", "id", "text").join(chosen.hint("shuffle_hash"), "u").where(same(F.col("id"), F.col("first_id"))).drop("first_id")
    # asked for the chosen copies alone: answers must come under the u that is worked on
    answers = _answered(_asked(texts, max(SHARDS, input_bytes(documents) // SHARD_INPUT + 1), length), HOT)
    answers = answers.groupBy("u").agg(F.collect_list("hashes").alias("answers"), F.collect_list("hot").alias("hot"))  # of one document
    pieces = _pieces(texts.join(answers.hint("shuffle_hash"), "u"), length)
    spans = _found(pieces, length).groupBy("u", "id").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # of one document
    spans = spans.select(F.col("u").alias("span_u"), F.col("id").alias("span_id"), "spans").hint("shuffle_hash")
    worked = texts.join(spans, (F.col("u") == F.col("span_u")) & same(F.col("id"), F.col("span_id")), "left").select(F.nullif("id", F.lit(LAST)).alias("doc_id"), "text", "spans")

    def cut(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for data, flat in zip(_utf8(batch.column("text")), batch.column("spans").to_pylist()):
                begin, end = merged(*np.array(flat, np.int64).reshape(-1, 2).T) if flat else ((), ())
                edges = [0, *(int(x) for pair in zip(begin, end) for x in pair), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if flat else data
                values = (len(data), len(data) - len(rest), len(begin), hashlib.sha256(rest).hexdigest(), rest if kept else None)
                for column, x in zip(out, values):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out, kinds)], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    done = worked.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    none, nothing = F.lit(0).cast("long"), F.lit("").cast("binary")
    copies = long.select("doc_id", "id", "k", "n").join(firsts.withColumnRenamed("id", "least"), "k").where("id > least")
    copies = copies.select("doc_id", F.col("n"), F.col("n"), F.lit(1).cast("long"), F.sha2(nothing, 256), nothing)
    whole = F.col("text").cast("binary")
    short = short.select("doc_id", "n", none, none, F.sha2(whole, 256), whole)
    result = done.unionByName(copies.toDF(*names)).unionByName(short.toDF(*names))
    return result if kept else result.drop("kept")
