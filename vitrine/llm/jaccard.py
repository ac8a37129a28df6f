"""Similarity join of shingle sets by Jaccard similarity, with signatures that partition the domain (PartEnum).

**Bands.** Sizes are cut into bands so that sets with a similarity of at least g lie in one band or in neighbouring ones. Each
set takes part in two instances, that of its band and that of the next. In an instance whose largest size is r, similar sets
differ in at most k = 2 (1 - g) / (1 + g) r shingles.

**Signatures.** The domain of shingles is hashed into k + 1 partitions. At most k of them can hold a difference, so similar sets
agree in one partition at least: the subsets to enumerate are the single partitions, and a signature is the hash of what a set
has in one of them. Sets that are equal are one class from the start. Empty partitions would make one signature of very many sets. With
k + 1 + m partitions similar sets agree in m + 1 at least, so a set that has m empty ones at most needs no signatures of these: if two
sets agreed in empty ones only, both would have m + 1 of them.

**Candidates.** Of the classes with one signature, all are compared with one of them (first within a task, then over
all tasks, so that a signature shared by very many is never gathered). Classes with a common signature that are still
unconnected after that are compared with one another, in blocks: first by parity sketches (a bit for each place of
a hash: whether the number of shingles there is odd), whose distance never exceeds the true difference, then by their sets. Of those that
sketches leave, each class takes the nearest one of another component, and so on in rounds, until none is left.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import rows
from vitrine.llm.graph import components
from vitrine.workspace import _input_bytes as input_bytes
from vitrine.workspace import stage

WORDS = 4
PERCENT = 85
#: Signatures that a task sorts at a time, and members of a signature that one task compares with as many others.
SORTED = 1_000_000
#: Bytes of a signature that are kept, bytes of input files for each shard of signatures, and the smallest number of shards.
KEPT, SHARD_INPUT, SHARDS = 5, 64 << 20, 32
#: Places of the bitmap that tells which texts may be wanted.
PLACES = 1 << 23
BLOCK = 2048
ORDERS = 8
#: Rounds in which unconnected classes are compared with their nearest one only; after them with all that are near.
ROUNDS = 3

_P = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A hash of 64 bits that looks random in all of them."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a text with fewer words is one shingle, one without words none."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    take = min(words, n)
    out = np.full(n - take + 1, take, np.uint64)
    for i in range(take):
        out *= _P
        out += h[i : n - take + 1 + i]
    out = mix(out)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def key_of(s: np.ndarray) -> bytes:
    """128 bits that stand for a set; the first 64 are its id among the candidates."""
    n = np.uint64(len(s))
    sums = [np.add.reduce(mix(s ^ np.uint64(salt)), dtype=np.uint64) + n for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return mix(np.array(sums)).tobytes()


@lru_cache(maxsize=16)
def bands(percent: int, up_to: int) -> list[tuple[int, int]]:
    """(smallest, largest size) of each band."""
    out, low = [], 1
    while low <= up_to:
        high = low * 100 // percent
        out.append((low, high))
        low = high + 1
    return out


def band_of(n: int, percent: int) -> int:
    limit = 1 << max(10, n.bit_length() + 1)
    found = bands(percent, limit)
    return int(np.searchsorted([low for low, _ in found], n, side="right")) - 1


def largest_difference(size: int, percent: int) -> int:
    """Of two sets of `size` at most that are similar enough: k as above, in whole numbers."""
    return 2 * (100 - percent) * size // (100 + percent)


def spare_partitions(k: int) -> int:
    """m as above: few sets have more empty partitions, and few partitions are added."""
    return 0 if k < 8 else 1 if k < 32 else 2


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    if not len(s):
        return np.empty(0, np.int64)
    band = band_of(len(s), percent)
    limits = bands(percent, 1 << max(10, len(s).bit_length() + 1))
    out, values = [], mix(s + _P)
    for instance in (band, band + 1):
        k = largest_difference(limits[instance][1], percent)
        spare = spare_partitions(k)
        parts = k + 1 + spare
        place = (mix(s ^ np.uint64(instance)) % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, place, values)
        found = mix(sums ^ mix(np.arange(parts, dtype=np.uint64) + np.uint64(instance << 32)))
        filled = np.bincount(place, minlength=parts) > 0
        out.append(found[filled] if parts - filled.sum() <= spare else found)
    return np.concatenate(out).view(np.int64)


def packed(sigs: np.ndarray) -> bytes:
    """The lowest bytes of each signature; sets that meet by these alone are ruled out like all others."""
    return sigs.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()


def unpacked(sigs: bytes | list[int]) -> np.ndarray:
    """Of packed signatures, or of a list of them."""
    if not isinstance(sigs, bytes):
        return np.array(sigs, np.int64)
    wide = np.zeros((len(sigs) // KEPT, 8), np.uint8)
    wide[:, :KEPT] = np.frombuffer(sigs, np.uint8).reshape(-1, KEPT)
    return wide.view("<i8")[:, 0]


def sketch(s: np.ndarray) -> bytes:
    """Parities of the numbers of shingles that hash into each of more places than there are shingles; a power of two, 64 at least."""
    bits = max(64, 1 << len(s).bit_length())
    odd = np.bincount((mix(s + np.uint64(77)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def distances(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Lower bounds of the number of shingles in which the sets behind the sketches differ, every one with every one."""
    size = min(map(len, [*a, *b]))

    def folded(x: list[bytes]) -> np.ndarray:
        out = np.zeros((len(x), size), np.uint8)
        for i, one in enumerate(x):
            out[i] = np.bitwise_xor.reduce(np.frombuffer(one, np.uint8).reshape(-1, size), axis=0)
        return out.view(np.uint64)

    left, right = folded(a), folded(b)
    out = np.zeros((len(a), len(b)), np.int32)
    for i in range(left.shape[1]):
        out += np.bitwise_count(left[:, i, None] ^ right[None, :, i])
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


# ---- tables ----


def _prepared(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """For every row its class; signatures and sketch once for each class in a task."""
    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keys, ids, sizes, sigs, sketches = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, words)
                key = key_of(s)
                new = len(s) > 0 and key not in seen
                if new:
                    seen.add(key)
                keys.append(key)
                ids.append(int.from_bytes(key[:8], "little", signed=True))
                sizes.append(len(s))
                sigs.append(packed(signatures(s, percent)) if new else None)
                sketches.append(sketch(s) if new else None)
            columns = [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "key", "id", "n", "sigs", "sketch"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"doc_id {kind}, text_hash long, key binary, id long, n long, sigs binary, sketch binary")


def centers(sig: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(firsts, sig, center, id): places where a signature's first class stands, and the others, each with the first. Which is first
    goes by one of `ORDERS` orders, chosen by the signature: a class that is linked with few of its group is then not the center everywhere."""
    order = np.argsort(sig, kind="stable")
    again = sig[order[1:]] == sig[order[:-1]]
    shared = np.zeros(len(sig), bool)
    shared[order[1:][again]] = True
    shared[order[:-1][again]] = True
    at = np.flatnonzero(shared)
    turn = mix(own[at].view(np.uint64) ^ mix(sig[at].view(np.uint64) % np.uint64(ORDERS)))
    at = at[np.lexsort((turn, sig[at]))]
    first = np.ones(len(at), bool)
    first[1:] = sig[at[1:]] != sig[at[:-1]]
    center = own[at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]]
    other = own[at] != center
    return np.concatenate([np.flatnonzero(~shared), at[first]]), sig[at[other]], center[other], own[at[other]]


def _stars(prepared: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(sig, center, id): the classes that share a signature with another one, each with the first of its task, these with
    the first of all. Signatures go to shards in packed arrays, one of each task for each class, and a task's own stars to any shard."""
    def combined(batches):
        sig_parts, id_parts, held = [], [], 0

        def flush():
            sig, own = np.concatenate(sig_parts), np.concatenate(id_parts)
            at, *star = centers(sig, own)
            at.sort()  # signatures of one class are neighbours again
            sig, own = sig[at], own[at]
            shard = (sig % shards).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            sig, own, cuts = sig[order], own[order], np.searchsorted(shard[order], np.arange(shards + 1))
            dealt = (mix(star[2].view(np.uint64)) % np.uint64(shards)).astype(np.int32)  # a signature's star may be large: by its members
            order = np.argsort(dealt, kind="stable")
            triples, star_cuts = np.stack([x[order] for x in star], 1), np.searchsorted(dealt[order], np.arange(shards + 1))
            out: list[list] = [[], [], [], []]
            for s in range(shards):
                i = slice(cuts[s], cuts[s + 1])
                new = np.flatnonzero(np.concatenate([[True], own[i][1:] != own[i][:-1]])) if cuts[s] < cuts[s + 1] else np.empty(0, np.int64)
                lengths = np.diff(np.append(new, cuts[s + 1] - cuts[s])).astype("<i4")
                values = (s, packed(sig[i]), own[i][new].tobytes() + lengths.tobytes(), triples[star_cuts[s] : star_cuts[s + 1]].tobytes())
                for column, value in zip(out, values):
                    column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int32(), *[pa.binary()] * 3))], ["shard", "sigs", "owners", "stars"])

        for batch in batches:
            for own, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sig_parts.append(unpacked(raw))
                id_parts.append(np.full(len(sig_parts[-1]), own, np.int64))
                held += len(sig_parts[-1])
                if held >= SORTED:
                    yield flush()
                    sig_parts, id_parts, held = [], [], 0
        if held:
            yield flush()

    def across(batches):
        def solve(sigs, owners, stars):
            own = [np.repeat(np.frombuffer(o, np.int64, len(o) // 12), np.frombuffer(o, "<i4", len(o) // 12, len(o) // 12 * 8)) for o in owners]
            _, *star = centers(np.concatenate([unpacked(x) for x in sigs]), np.concatenate(own))
            local = np.frombuffer(b"".join(stars), np.int64).reshape(-1, 3).T
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x, y])) for x, y in zip(star, local)], ["sig", "center", "id"])

        shard, held = None, []
        for batch in batches:
            for s, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if s != shard and held:
                    yield solve(*zip(*held))
                    held = []
                shard = s
                held.append(rest)
        if held:
            yield solve(*zip(*held))

    found = prepared.where("sigs is not null").select("id", "sigs")
    found = found.mapInArrow(combined, "shard int, sigs binary, owners binary, stars binary")
    return found.repartition("shard").sortWithinPartitions("shard").mapInArrow(across, "sig long, center long, id long")


def _kept_by_sketch(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ids that the sketches do not rule out."""
    def run(batches):
        for batch in batches:
            a, b, na, nb, sa, sb = (c.to_pylist() for c in batch.columns)
            keep = []
            for x, y, p, q in zip(sa, sb, na, nb):
                if 100 * min(p, q) < percent * max(p, q):
                    keep.append(False)
                    continue
                if len(x) == len(y):
                    far = (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()
                else:
                    far = int(distances([x], [y])[0, 0])
                keep.append((100 + percent) * far <= (100 - percent) * (p + q))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def _perhaps(source: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of `source` whose `key` may be among those of `wanted`, without a shuffle: by a bitmap of a fixed size over hashes."""
    place = F.pmod(F.xxhash64(key), F.lit(PLACES)) + 1
    bits = wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    at = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    placed = source.withColumn("place", place).withColumn("bucket", F.bitmap_bucket_number("place"))
    return placed.join(F.broadcast(bits), "bucket").where(F.getbit(byte, F.pmod(at, F.lit(8))) == 1).select(*source.columns)


def _links(pairs: DataFrame, classes: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) keys of the classes that are similar, by their sets."""
    pairs = stage(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stage(wanted.join(classes, "id").select("id", "key", "doc_id"), "wanted")

    def own(batches):
        for batch in batches:
            keep = [key_of(shingles(t, words)) == k for k, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    # a repeated doc_id may bring other texts along; the key tells them apart
    source = _perhaps(documents.select("doc_id", "text"), wanted, "doc_id").select(F.col("doc_id").alias("own_id"), "text")
    texts = wanted.hint("shuffle_hash").join(source, wanted.doc_id.eqNullSafe(source.own_id)).select("id", "key", "text")
    texts = stage(texts.mapInArrow(own, "id long, key binary, text string").dropDuplicates(["key"]), "texts")

    def run(batches):
        known: dict[bytes, np.ndarray] = {}

        def of(key, text):
            if key not in known:
                if len(known) > 500:
                    known.clear()
                known[key] = shingles(text, words)
            return known[key]

        for batch in batches:
            ka, kb, ta, tb = (c.to_pylist() for c in batch.columns)
            keep = [similar(of(k, t), of(m, u), percent) for k, m, t, u in zip(ka, kb, ta, tb)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("id").alias("a"), F.col("key").alias("ka"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("key").alias("kb"), F.col("text").alias("tb"))
    compared = pairs.join(right, "b").join(left, "a").select("ka", "kb", "ta", "tb")
    return stage(compared.mapInArrow(run, "ka binary, kb binary").select(F.col("ka").alias("a"), F.col("kb").alias("b")), "links")


def near_pairs(ids, component, n, sketches: list[int], bits: list[int], failed: list, left, right, percent: int, every: bool):
    """(a, b) of members of two blocks (positions `left` and `right`) in different components that the sketches do not rule out: of each
    member outside the largest component the nearest one, or all; and the members that have such pairs, but are in none of these."""
    sizes: dict = {}
    for c in component:
        sizes[c] = sizes.get(c, 0) + 1
    largest = max(sizes, key=lambda c: (sizes[c], c))
    both = left + right if left is not right else left
    if len(both) <= 24:
        def far(x, y):
            if bits[x] == bits[y]:
                return (sketches[x] ^ sketches[y]).bit_count()
            size = min(len(raw) for raw in (_raw(sketches[x], bits[x]), _raw(sketches[y], bits[y])))
            return int(distances([_raw(sketches[x], bits[x])], [_raw(sketches[y], bits[y])])[0, 0]) if size else 0

        found: dict = {}
        for x in left:
            for y in right:
                if component[x] == component[y] or (left is right and y <= x):
                    continue
                p, q = n[x], n[y]
                if 100 * min(p, q) < percent * max(p, q) or ids[y] in (failed[x] or ()):
                    continue
                d = far(x, y)
                if (100 + percent) * d <= (100 - percent) * (p + q):
                    found.setdefault(x, []).append((d, ids[y], y))
                    found.setdefault(y, []).append((d, ids[x], x))
        out = set()
        for x, options in found.items():
            if every:
                out.update((min(ids[x], i), max(ids[x], i)) for _, i, _ in options)
            elif component[x] != largest:
                i = min(options)[1]
                out.add((min(ids[x], i), max(ids[x], i)))
        return sorted(out), sorted({ids[x] for x in found} - {i for pair in out for i in pair})
    raw = [_raw(sketches[x], bits[x]) for x in range(len(ids))]
    far = distances([raw[x] for x in left], [raw[x] for x in right])
    names = {c: k for k, c in enumerate(sizes)}
    kind, size, own = np.array([names[c] for c in component]), np.array(n), np.array(ids, np.int64)
    p, q = size[left][:, None], size[right][None, :]
    near = ((100 + percent) * far <= (100 - percent) * (p + q)) & (100 * np.minimum(p, q) >= percent * np.maximum(p, q))
    near &= kind[left][:, None] != kind[right][None, :]
    at = {i: k for k, i in enumerate(own[right].tolist())}
    back = {i: k for k, i in enumerate(own[left].tolist())}
    for row, x in enumerate(left):
        for i in failed[x] or ():
            if i in at:
                near[row, at[i]] = False
    for column, y in enumerate(right):
        for i in failed[y] or ():
            if i in back:
                near[back[i], column] = False
    if every:
        a, b = np.nonzero(near)
    else:
        cost = np.where(near, far, np.iinfo(np.int32).max)
        rows_ = np.flatnonzero(near.any(1) & (kind[left] != names[largest]))
        columns = np.flatnonzero(near.any(0) & (kind[right] != names[largest]))
        a = np.concatenate([rows_, cost[:, columns].argmin(0)]) if len(columns) else rows_
        b = np.concatenate([cost[rows_].argmin(1), columns]) if len(rows_) else columns
    open_ = np.union1d(own[left][near.any(1)], own[right][near.any(0)])
    a, b = own[left][a], own[right][b]
    return sorted(set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist()))), np.setdiff1d(open_, np.concatenate([a, b])).tolist()


def _raw(sketch_: int, bits: int) -> bytes:
    return sketch_.to_bytes(bits // 8, "little")


def _members(stars: DataFrame) -> DataFrame:
    """(sig, id): the classes that must be compared with others of their signature. A pair of a center and a class of its star is decided
    already, so stars of one class are left out, and so is a center that all others of the signature were compared with."""
    kinds = stars.groupBy("sig").agg(F.min("center").alias("x"), F.max("center").alias("y"), F.count("*").alias("size"))
    kinds = kinds.where("size > 1").select("sig", F.expr("x = y").alias("single"))
    of = F.when(F.col("single"), F.array("id")).otherwise(F.array("center", "id"))
    return stars.join(kinds, "sig").select("sig", F.explode(of).alias("id")).distinct()


def _left_over(members: DataFrame, together: DataFrame, sketches: DataFrame, failed: DataFrame | None, every: bool, percent: int) -> DataFrame:
    """(sig, a, b): pairs with a common signature that are not connected yet, not refuted, and not ruled out by their sketches; of each
    class the nearest, or all. A class that has such pairs, but is in none of those chosen, comes with a null b."""
    members = members.join(together, "id", "left").withColumn("component", F.coalesce("component", F.col("id").cast("string")))
    members = stage(members, "members")
    split = members.groupBy("sig").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"),
        *[F.bit_xor(F.xxhash64(F.lit(salt), "id")).alias(f"same_{salt}") for salt in (1, 2)],
    ).where("x < y").dropDuplicates(["size", "same_1", "same_2"])  # signatures of the same classes ask for the same
    split = stage(split.select("sig", F.expr("cast(ceil(size / %d) as long)" % BLOCK).alias("blocks")), "split")
    parts = members.join(split, "sig").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    # every block meets every block of its signature, itself included, in one task for each two of them
    cells = parts.select("sig", "id", "component", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("sig", "id", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")
    cells = cells.join(_perhaps(sketches, members, "id"), "id")  # after the first round few are left
    if failed is None:
        cells = cells.withColumn("failed", F.lit(None).cast("array<long>"))
    else:
        twice = failed.select("a", "b").unionByName(failed.select(F.col("b").alias("a"), F.col("a").alias("b")))
        cells = cells.join(twice.groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("failed")), "id", "left")

    def solve(cell, members_):
        ids, component, block, n, sketches_, refuted = (list(x) for x in zip(*members_))
        bits = [8 * len(x) for x in sketches_]
        whole = [int.from_bytes(x, "little") for x in sketches_]
        left = [k for k, b in enumerate(block) if b == cell[1]]
        right = left if cell[1] == cell[2] else [k for k, b in enumerate(block) if b == cell[2]]
        if left and right:
            pairs, open_ = near_pairs(ids, component, n, whole, bits, refuted, left, right, percent, every)
            for a, b in pairs:
                yield cell[0], a, b
            for a in open_:
                yield cell[0], a, None

    def run(batches):
        cell, held = None, []
        for batch in batches:
            out = []
            for sig, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if (sig, i, j) != cell:
                    if len(held) > 1:
                        out += solve(cell, held)
                    cell, held = (sig, i, j), []
                held.append(rest)
            yield table_of(out)
        if len(held) > 1:
            yield table_of([*solve(cell, held)])

    def table_of(found):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(3)], ["sig", "a", "b"])

    ordered = cells.select("sig", "i", "j", "id", "component", "block", "n", "sketch", "failed").repartition("sig", "i", "j")
    return ordered.sortWithinPartitions("sig", "i", "j").mapInArrow(run, "sig long, a long, b long")


def join(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, key, text_hash): one row for each input row.

    Two documents are linked when 100 * shingles in common >= percent * shingles in either. `component_id` is the smallest id of
    the documents that can be reached over links, itself included; null ids count as larger than all others. `key` is the same
    for all documents of a component; documents without words have no shingles, are linked with nothing and have their own id
    and a null key. Rows with one id and different texts are documents of their own; repeated rows are copies.
    Null and empty texts have no words. An empty table gives an empty one; other columns are not read.
    """
    rows.importable(documents.sparkSession)
    source = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prepared = stage(_prepared(source.withColumn("text_hash", F.xxhash64("text")), words, percent), "shingled")
    classes = prepared.where("n > 0").groupBy("key").agg(
        F.min("id").alias("id"), F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
    )
    classes = stage(classes, "classes")
    sketches = classes.select("id", "n", "sketch")
    stars = stage(_stars(prepared, max(SHARDS, input_bytes(documents) // SHARD_INPUT + 1)), "stars")
    pairs = stars.select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    links = _links(_kept_by_sketch(pairs, sketches, percent), classes, source, words, percent)
    failed, members = None, _members(stars)
    for turn in range(ROUNDS + 1):
        together = components(links).join(classes, F.col("node") == F.col("key")).select("id", F.hex("component").alias("component"))
        found = stage(_left_over(members, together, sketches, failed, turn == ROUNDS, percent), "near")
        if found.isEmpty():
            break
        near = found.where("b is not null").select("a", "b").distinct()
        more = _links(near, classes, source, words, percent)
        named = more.join(classes.select(F.col("key").alias("a"), F.col("id").alias("x")), "a").join(classes.select(F.col("key").alias("b"), F.col("id").alias("y")), "b")
        refuted = near.join(named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), ["a", "b"], "left_anti")
        failed = stage(refuted if failed is None else refuted.unionByName(failed), "failed")
        # what had no near one outside its component will have none: components only grow
        members = found.select("sig", F.explode(F.array("a", "b")).alias("id")).where("id is not null").distinct()
        links = stage(links.unionByName(more), "links")
    joined = components(links)
    whole = classes.join(joined, classes.key == joined.node, "left").select("key", F.coalesce("component", "key").alias("group"), "doc_id")
    least = stage(whole.groupBy("group").agg(F.min("doc_id").alias("component_id")), "least")
    named = whole.join(least, "group").select("key", "group", "component_id")
    placed = prepared.select("doc_id", "text_hash", "key", "n").join(named, "key", "left")
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("group")).alias("key"), "text_hash",
    )



def first_of_each(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of `documents`, all columns as they are, without all but one of each component: the one with the smallest id (of equal ids
    that with the smallest hash of its text, and one of repeated rows). Rows without words all stay."""
    found = join(documents, text, doc_id, words, percent)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = found.where("key is not null").groupBy("key").agg(F.min(order).alias("first"))
    first = stage(first.select(F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash")), "first")
    row = documents.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("own_id"), F.xxhash64(F.col(text)).alias("own_hash"),
        F.coalesce(F.col(text), F.lit("")).rlike("[^\\x20\\x09-\\x0D]").alias("worded"),
    )
    same = (row.own_id.eqNullSafe(first.first_id)) & (row.own_hash == first.first_hash)
    kept = row.where("worded").join(first, same, "left_semi").dropDuplicates(["own_id", "own_hash"])
    return kept.unionByName(row.where("not worded")).select("row.*")
