"""Exact Jaccard self-join of word shingles by universe partition and pigeonhole.

Sets of similar size meet in a size band. The band cuts the universe of hashed shingles into
segments and gives each of them one or two credits, at least one credit more than two linked sets
can differ in shingles. So linked sets agree in a segment, or in one with two credits they agree
but for one shingle. A set is indexed by a hash of what it has in each segment (its subset) and,
where a segment has two credits, by the subset without each one of its shingles.

Empty subsets cost most, as unrelated sets share them. They are left out as long as the credits
they hold are no more than the band has to spare; a set with more of them indexes them too, which
keeps the join exact. Credits and segments are chosen per band by expected cost.

Links are wanted as classes. First each set is compared with the one that is nearest to all in the
largest of its buckets, then of the classes in a bucket only the nearest sets are compared, last all
that are still in different classes. What is compared are bitmaps with the parity
of the shingles that fall on each bit; sets differ in as many shingles at least as their bitmaps
do in bits. Pairs that can be links by their bitmaps are verified on the words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerhub.llm.common import (
    numbers, planes, shard_of, slices, tokenized, word_hashes, written_once,
)
from ledgerhub.llm.components import components
from ledgerhub.sizing import broadcast_within

WORDS = 5
#: Sets link from 4/5 on: 100 * intersection >= 80 * union.
LEAST, OF = 80, 100
SLICE_CHARS = 500_000
FLUSH = 400_000
SHARD_SHINGLES = 800_000
#: Cost model of a band: sets in it, share of pairs of sets that have a passage in common,
#: shingles of such a passage, and what a candidate pair costs in index rows.
BAND_SETS, SHARED_PAIRS, PASSAGE, PAIR_COST = 4000, 0.005, 50, 100
#: Sets of a bucket that are compared in one task; larger buckets are compared part by part.
PART_SETS = 500
#: Sets by which a large bucket's middle one is chosen; buckets up to SMALL are compared as a whole.
JUDGES = 32
SMALL = 64
CHUNK_ROWS = 5000

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(32)
#: Odd numbers that tell the places of a shingle's words apart.
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64) | 1) for k in range(1, WORDS + 1)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits; one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Band:
    """Sets of ``low`` to ``high`` shingles, of which linked pairs have their smaller one below ``top``."""

    low: int
    top: int
    high: int
    credits: int  # of each segment: 1 or 2
    segments: int
    spare: int


def largest_partner(size: int) -> int:
    return size * OF // LEAST


def most_differing(small: int, large: int) -> int:
    """Shingles in which two linked sets of these sizes can differ, at most."""
    return (small + large) * (OF - LEAST) // (OF + LEAST)


def tail(mean: float, k: int) -> float:
    """Chance that a Poisson number of this mean is above ``k``."""
    term = below = math.exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        below += term
    return max(0.0, 1 - below)


def expected_cost(size: int, segments: int, credits: int, spare: int) -> float:
    """Index rows of a set of this size, and what candidates that don't link are expected to cost.

    Such candidates come from small subsets of sets that hold more of them than can be spared, and
    from segments that hold nothing but shingles of a passage both sets have.
    """
    mean = size / segments
    small = segments * math.exp(-mean) * (1 if credits == 1 else 1 + mean)
    over = tail(small, spare // credits)
    passage = min(PASSAGE, size / 2)
    of_it, others = passage / segments, (size - passage) / segments
    if credits == 1:
        rows, same = segments, math.exp(-2 * others)
    else:
        rows, same = segments + size, math.exp(-2 * others) * (1 + 2 * others)
    places = segments * (1 - math.exp(-of_it))
    return rows + BAND_SETS * PAIR_COST * (over * over * min(1.0, small) + SHARED_PAIRS * places * same)


def made_band(low: int, top: int) -> Band:
    """The band with the least expected cost over both numbers of credits and all numbers of segments."""
    small, large = top - 1, largest_partner(top - 1)
    need = most_differing(small, large) + 1
    found = []
    for credits in (1, 2):
        least = -(-need // credits)
        for segments in range(least, 2 * least + 8, 1 + least // 50):
            spare = segments * credits - need
            found.append((expected_cost(low, segments, credits, spare), Band(low, top, large, credits, segments, spare)))
    return min(found, key=lambda x: x[0])[1]


def bands(largest: int) -> list[Band]:
    """Bands for sets of up to ``largest`` shingles. Sets that can only link with equal ones have none."""
    out, low = [], 1
    while low <= largest:
        top = max(low + 1, largest_partner(low))
        if most_differing(top - 1, largest_partner(top - 1)):
            out.append(made_band(low, top))
        low = top
    return out


def ascending(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by owner, then value."""
    order = np.argsort(value)
    small = owner.astype(np.uint16) if len(owner) and owner[-1] < 1 << 16 else owner
    return order[np.argsort(small[order], kind="stable")]


def shingled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, one text after the other, and the text's number.

    A text of fewer than five words is one shingle; one without words has none.
    """
    words, sizes = tokenized(pa.array(texts, pa.large_string()))
    hashes = word_hashes(words)
    begin = np.cumsum(sizes) - sizes
    count = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(sizes)), count)
    place = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
    length = np.minimum(sizes, WORDS)[owner]
    all_long = bool((length == WORDS).all())
    padded = np.append(hashes, np.zeros(WORDS, np.uint64))
    value = length.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            word = padded[place + k] * FACTORS[k]
            value = value + (word if all_long else np.where(k < length, word, np.uint64(0)))
    value = mix(value)
    order = ascending(owner, value)
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]


def bit_count(size: int) -> int:
    """Bits of the bitmap of a set: a power of two, 64 at least."""
    return 1 << max(6, (int(size) - 1).bit_length())


def bitmaps(value: np.ndarray, size: np.ndarray) -> list[bytes]:
    """For each text the parity of its shingles by their lowest bits."""
    out, at = [], 0
    for n in size.tolist():
        bits = bit_count(n)
        own = np.bincount((value[at:at + n] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(own.astype(np.uint8)).tobytes())
        at += n
    return out


def set_rows(ids: pa.Array, texts: list[str]) -> dict[str, pa.Array]:
    """Size, two order-free digests and the bitmap of each text's set."""
    value, owner = shingled(texts)
    n = len(texts)
    size = np.bincount(owner, minlength=n)
    begins = np.flatnonzero(size)
    starts = (np.cumsum(size) - size)[begins]
    digests = []
    for salt in (_A, _B):
        total = np.zeros(n, np.uint64)
        if len(starts):
            with np.errstate(over="ignore"):
                total[begins] = np.add.reduceat(mix(value ^ salt), starts)
        digests.append(pa.array(total.view(np.int64)))
    return {"doc_id": ids, "n_shingles": pa.array(size, pa.int64()), "d1": digests[0], "d2": digests[1],
            "bits": pa.array(bitmaps(value, size), pa.binary())}


def signatures(value: np.ndarray, owner: np.ndarray, n: int, all_bands: list[Band]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(signature, number of the text) of all subsets that are indexed, band by band."""
    size = np.bincount(owner, minlength=n)
    token = mix(value ^ _B)
    for number, band in enumerate(all_bands):
        inside = (size >= band.low) & (size <= band.high)
        if not inside.any():
            continue
        chosen = np.flatnonzero(inside)
        mine = inside[owner]
        m = band.segments
        rank = np.zeros(n, np.int64)
        rank[chosen] = np.arange(len(chosen))
        with np.errstate(over="ignore"):
            segment = (((value[mine] >> _SHIFT) * np.uint64(m)) >> _SHIFT).astype(np.int64)
            cell = rank[owner[mine]] * m + segment  # ascending, as hashes ascend within a text
            held = np.bincount(cell, minlength=len(chosen) * m)
            content = np.zeros(len(held), np.uint64)
            filled = np.flatnonzero(held)
            content[filled] = np.add.reduceat(token[mine], (np.cumsum(held) - held)[filled])
            salt = np.tile(mix((np.arange(m).astype(np.uint64) << np.uint64(12)) + np.uint64(number)), len(chosen))
            by_text = held.reshape(len(chosen), m)
            if band.credits == 1:
                lost = (by_text == 0).sum(1)
            else:
                lost = 2 * (by_text == 0).sum(1) + (by_text == 1).sum(1)
            poor = np.repeat(lost > band.spare, m)
            whole = np.flatnonzero((held >= 1) | poor)
            yield mix(content[whole] + salt[whole]), chosen[whole // m]
            if band.credits == 2:
                less = np.flatnonzero((held[cell] >= 2) | poor[cell])
                yield mix(content[cell[less]] - token[mine][less] + salt[cell[less]]), chosen[cell[less] // m]


INDEXED = "shard int, n int, sigs binary, ids binary"
BUCKETS = "bucket long, doc_id long"


def packed_rows(sigs: list[np.ndarray], ids: list[np.ndarray], shards: int, bits: int) -> Iterator[dict]:
    """Signatures, cut to ``bits`` and sorted, with their documents: a row per shard."""
    sig, doc = np.concatenate(sigs), np.concatenate(ids)
    sig = sig >> np.uint64(64 - bits) << np.uint64(64 - bits)
    order = np.argsort(sig, kind="stable")
    sig, doc = sig[order], doc[order]
    bounds = np.searchsorted(shard_of(sig, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(bounds)):
        own = slice(bounds[shard], bounds[shard + 1])
        yield {"shard": int(shard), "n": int(bounds[shard + 1] - bounds[shard]),
               "sigs": planes(np.diff(sig[own], prepend=np.uint64(0))), "ids": planes(doc[own])}


def buckets(rows: list[dict]) -> dict[str, np.ndarray]:
    """Documents that share a signature, once for each set of documents that share one.

    ``bucket`` is a hash of that set, so buckets of the same documents fall together.
    """
    sig = np.concatenate([np.cumsum(numbers(r["sigs"], np.uint64, r["n"]), dtype=np.uint64) for r in rows])
    doc = np.concatenate([numbers(r["ids"], np.int64, r["n"]) for r in rows])
    order = np.argsort(sig)
    sig, doc = sig[order], doc[order]
    several = np.zeros(len(sig), bool)
    several[1:] = sig[1:] == sig[:-1]
    several[:-1] |= several[1:]
    sig, doc = sig[several], doc[several]
    order = np.lexsort((doc, sig))
    sig, doc = sig[order], doc[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])
    sig, doc = sig[new], doc[new]
    if not len(sig):
        return {"bucket": np.empty(0, np.int64), "doc_id": np.empty(0, np.int64)}
    begins = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    sizes = np.diff(np.append(begins, len(sig)))
    with np.errstate(over="ignore"):
        same = np.add.reduceat(mix(doc.view(np.uint64) + _A), begins) + sizes.astype(np.uint64)
    shared = np.flatnonzero(sizes > 1)
    _, first = np.unique(same[shared], return_index=True)
    kept = shared[first]
    at = np.repeat(begins[kept] - (np.cumsum(sizes[kept]) - sizes[kept]), sizes[kept]) + np.arange(sizes[kept].sum())
    return {"bucket": np.repeat(same[kept].view(np.int64), sizes[kept]), "doc_id": doc[at]}


@dataclass
class Sets:
    """Sets with sizes and bitmaps."""

    size: np.ndarray
    bits: list[bytes]

    def __post_init__(self):
        self.folded: dict[int, np.ndarray] = {}
        self.width = np.array([len(b) for b in self.bits], np.int64)

    def at(self, width: int) -> np.ndarray:
        """Bitmaps folded to ``width`` bytes, as rows of 64-bit words; those that are shorter are zero."""
        if width not in self.folded:
            out = np.zeros((len(self.bits), width), np.uint8)
            for wide in np.unique(self.width[self.width >= width]):
                rows = np.flatnonzero(self.width == wide)
                own = np.frombuffer(b"".join(self.bits[i] for i in rows), np.uint8)
                out[rows] = np.bitwise_xor.reduce(own.reshape(len(rows), -1, width), axis=1)
            self.folded[width] = out.view(np.uint64)
        return self.folded[width]

    def slack(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of sets, by how many bits they are nearer than the limit for a link; below 0 they can't be linked."""
        small, large = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        out = np.where(OF * small >= LEAST * large, (small + large) * (OF - LEAST) // (OF + LEAST), -1)
        widths = np.minimum(self.width[a], self.width[b])
        for width in np.unique(widths[out >= 0]):
            rows = self.at(int(width))
            for these in np.array_split(np.flatnonzero((widths == width) & (out >= 0)), 1 + len(a) * int(width) // (1 << 23)):
                differ = np.bitwise_count(rows[a[these]] ^ rows[b[these]]).sum(1, dtype=np.int64)
                out[these] -= differ
        return out


def middle(sets: Sets, among: np.ndarray) -> int:
    """The set nearest to a few judges, which are spread over the sets: most links go through it."""
    judges = among[np.unique(np.linspace(0, len(among) - 1, JUDGES).astype(int))]
    near = sets.slack(np.repeat(judges, len(among)), np.tile(among, len(judges)))
    return int(among[near.reshape(len(judges), -1).sum(0).argmax()])


Pairs = tuple[np.ndarray, np.ndarray]
NO_PAIRS: Pairs = (np.empty(0, np.int64), np.empty(0, np.int64))


def star(sets: Sets, group: np.ndarray, hub: int, among: np.ndarray) -> Pairs:
    others = among[group[among] != group[hub]]
    hubs = np.full(len(others), hub)
    near = sets.slack(hubs, others) >= 0
    return hubs[near], others[near]


def of_large(sets: Sets, group: np.ndarray, members: np.ndarray, phase: int) -> Pairs:
    """Pairs of one large bucket. Phase 0: a star around its middle; 1: for each set out of its largest
    class the nearest one in it, and a star of the rest; 2: all in different classes that can be links."""
    if phase == 0:
        return star(sets, group, middle(sets, members), members)
    own = group[members]
    found = []
    if phase == 1:
        names, counts = np.unique(own, return_counts=True)
        main, rest = members[own == names[counts.argmax()]], members[own != names[counts.argmax()]]
        for i in rest:
            near = sets.slack(np.full(len(main), i), main)
            if near.max() >= 0:
                found.append((main[near.argmax()][None], i[None]))
        found.append(star(sets, group, middle(sets, rest), rest))
    else:
        found = [star(sets, group, i, members[k + 1:]) for k, i in enumerate(members[:-1])]
    return tuple(np.concatenate([f[k] for f in found]) for k in (0, 1))


def of_small(sets: Sets, group: np.ndarray, members: np.ndarray, begins: np.ndarray, sizes: np.ndarray, phase: int) -> Pairs:
    """Pairs of many small buckets at once. Phase 0: a star around each one's middle; 1: for two classes
    in a bucket their nearest sets; 2: all in different classes that can be links."""
    first, second, bucket = [], [], []
    for n in np.unique(sizes):
        these = np.flatnonzero(sizes == n)
        i, j = np.triu_indices(n, 1)
        first.append((begins[these][:, None] + i).ravel())
        second.append((begins[these][:, None] + j).ravel())
        bucket.append(np.repeat(these, len(i)))
    i, j, bucket = np.concatenate(first), np.concatenate(second), np.concatenate(bucket)
    a, b = members[i], members[j]
    if phase:
        apart = group[a] != group[b]
        a, b, bucket = a[apart], b[apart], bucket[apart]
    count = len(sets.size)
    code, place = np.unique(np.minimum(a, b) * count + np.maximum(a, b), return_inverse=True)
    near = sets.slack(code // count, code % count)
    if phase == 1:
        good = np.flatnonzero(near[place] >= 0)
        ga, gb = group[a[good]], group[b[good]]
        low, high = np.minimum(ga, gb), np.maximum(ga, gb)
        order = np.lexsort((place[good], -near[place[good]], high, low, bucket[good]))
        new = np.ones(len(order), bool)
        for key in (bucket[good], low, high):
            new[1:] &= key[order][1:] == key[order][:-1]
        new[1:] = ~new[1:]
        code = np.unique(code[place[good][order[new]]])
        return code // count, code % count
    if phase == 2:
        code = code[near >= 0]
        return code // count, code % count
    total = np.bincount(i, near[place], len(members)) + np.bincount(j, near[place], len(members))
    # of each bucket the place with the largest total, the first of equal ones
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((np.arange(len(owner)), -total[np.repeat(begins, sizes) + _within(sizes)], owner))
    hub = (np.repeat(begins, sizes) + _within(sizes))[order][np.cumsum(sizes) - sizes]
    chosen = ((i == hub[bucket]) | (j == hub[bucket])) & (near[place] >= 0)
    code = np.unique(code[place[chosen]])
    return code // count, code % count


def _within(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def pairs_of(doc: np.ndarray, size: np.ndarray, bits: list[bytes], group: np.ndarray, bucket: np.ndarray, phase: int) -> Pairs:
    """Pairs of documents to verify, from rows of whole buckets that lie together."""
    begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.append(begins, len(bucket)))
    # a set is its document and bitmap: rows of one document can have several texts
    names: dict[tuple, int] = {}
    member = np.array([names.setdefault(x, len(names)) for x in zip(doc.tolist(), bits)], np.int64)
    _, first = np.unique(member, return_index=True)
    sets, own = Sets(size[first], [bits[i] for i in first]), group[first]
    found = [NO_PAIRS]
    small = (sizes <= SMALL) & (sizes > 1)
    if small.any():
        found.append(of_small(sets, own, member, begins[small], sizes[small], phase))
    for k in np.flatnonzero(sizes > SMALL):
        members = member[begins[k]:begins[k] + sizes[k]]
        if len(np.unique(own[members])) > 1:
            found.append(of_large(sets, own, members, phase))
    a, b = (doc[first][np.concatenate([f[k] for f in found])] for k in (0, 1))
    return np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]


def words_of(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    if len(words) < WORDS:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[k:] for k in range(WORDS))))


def linked(a: frozenset, b: frozenset) -> bool:
    if not a or not b or OF * min(len(a), len(b)) < LEAST * max(len(a), len(b)):
        return False
    both = len(a & b)
    return OF * both >= LEAST * (len(a) + len(b) - both)


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts link. Only texts of the documents named are moved."""
    named = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = written_once(docs.join(broadcast_within(named), "doc_id", "left_semi"), "jaccard-texts")
    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, frozenset()
        for batch in batches:
            good = []
            for a, ta, tb in zip(batch["a"], batch["ta"], batch["tb"], strict=True):
                if (a, ta) != last:
                    last, own = (a, ta), words_of(ta.as_py())
                good.append(linked(own, words_of(tb.as_py())))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long").distinct()


def class_sets(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, n_shingles, d1, d2, bits) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch["text"], SLICE_CHARS):
                ids = batch["doc_id"].slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_pydict(set_rows(ids, texts))

    return written_once(
        docs.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bits binary"), "jaccard-sets")


def indexed(docs: DataFrame, largest: int, shingles: int) -> DataFrame:
    """Stored buckets (bucket, doc_id) of the documents' index, of two documents and more."""
    all_bands = bands(largest)
    shards = -(-shingles // SHARD_SHINGLES) or 1
    bits = min(64, max(shingles, 1).bit_length() + 22)  # few enough chance matches; all are verified

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("sigs", pa.binary()), ("ids", pa.binary())])
        sigs: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        for batch in batches:
            at = 0
            for texts in slices(batch["text"], SLICE_CHARS):
                own = batch["doc_id"].slice(at, len(texts)).to_numpy(zero_copy_only=False)
                at += len(texts)
                value, owner = shingled(texts)
                for sig, text in signatures(value, owner, len(texts), all_bands):
                    sigs.append(sig)
                    ids.append(own[text])
                if sum(map(len, sigs)) >= FLUSH:
                    yield pa.RecordBatch.from_pylist(list(packed_rows(sigs, ids, shards, bits)), schema)
                    sigs, ids = [], []
        if sum(map(len, sigs)):
            yield pa.RecordBatch.from_pylist(list(packed_rows(sigs, ids, shards, bits)), schema)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table({k: pa.array(v, pa.int64()) for k, v in buckets(table.to_pylist()).items()})

    rows = docs.mapInArrow(run, INDEXED).groupBy("shard").applyInArrow(gather, BUCKETS)
    return written_once(rows.distinct(), "jaccard-buckets")


def stars(large: DataFrame) -> DataFrame:
    """Pairs (a, b) of a hub and the sets of its bucket that can link with it: at most one for each stored row.

    The hub is the judge nearest to all judges, which are the JUDGES sets with the smallest hash.
    """
    lowest = W.partitionBy("bucket").orderBy(F.xxhash64("doc_id", "bits"), "doc_id")
    judges = large.withColumn("judge", F.row_number().over(lowest)).where(F.col("judge") <= JUDGES)

    def chosen(key: tuple, table: pa.Table) -> pa.Table:
        sets = Sets(table["n_shingles"].to_numpy(), table["bits"].to_pylist())
        return table.select(["bucket", "hub", "hub_shingles", "hub_bits"]).slice(middle(sets, np.arange(len(sets.size))), 1)

    hubs = judges.select(
        "bucket", "n_shingles", "bits", F.col("doc_id").alias("hub"), F.col("n_shingles").alias("hub_shingles"),
        F.col("bits").alias("hub_bits"),
    ).groupBy("bucket").applyInArrow(chosen, "bucket long, hub long, hub_shingles long, hub_bits binary")
    hubs = written_once(hubs, "jaccard-hubs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sets = Sets(np.concatenate([batch["n_shingles"].to_numpy(), batch["hub_shingles"].to_numpy()]),
                        batch["bits"].to_pylist() + batch["hub_bits"].to_pylist())
            a, b = batch["doc_id"].to_numpy(), batch["hub"].to_numpy()
            good = (sets.slack(np.arange(n), n + np.arange(n)) >= 0) & (a != b)
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(np.minimum(a, b)[good], pa.int64()), "b": pa.array(np.maximum(a, b)[good], pa.int64())})

    return large.select("bucket", "doc_id", "n_shingles", "bits").join(
        broadcast_within(hubs), "bucket").mapInArrow(run, "a long, b long")


def candidates(rows: DataFrame, phase: int) -> DataFrame:
    """Pairs (a, b) to verify, from stored rows (bucket, doc_id, n_shingles, bits, class, sets) of open buckets.

    In phase 0 a bucket of more than PART_SETS sets is one star. Later, when only buckets with
    several classes are left, it is compared part by part: each pair of its parts is a bucket of
    its own here, so none is larger than two parts.
    """
    if phase == 0:
        large = written_once(rows.where(F.col("sets") > PART_SETS), "jaccard-large")
        return compared(rows.where(F.col("sets") <= PART_SETS), phase).union(stars(large)).distinct()
    return compared(rows, phase)


def compared(rows: DataFrame, phase: int) -> DataFrame:
    """Pairs (a, b) to verify, of sets that meet in a bucket or in two parts of a large one."""
    parts = F.ceil(F.col("sets") / PART_SETS).cast("long")
    cut = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("doc_id"), "parts"))
    # part p is in the groups (p, q) and (q, p) of all q; a bucket of one part is the group (0, 0)
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1).cast("array<long>")))
    cut = cut.withColumn("cell", F.when(F.col("parts") == 1, F.col("bucket")).otherwise(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            a, b = pairs_of(table["doc_id"].to_numpy(), table["n_shingles"].to_numpy(), table["bits"].to_pylist(),
                            table["class"].to_numpy(), table["cell"].to_numpy(), phase)
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                held.append(batch.slice(at, CHUNK_ROWS))
                table = pa.Table.from_batches(held)
                cell = table["cell"].to_numpy()
                whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0  # the last bucket may go on
                if whole:
                    yield found(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held:
            yield found(pa.Table.from_batches(held))

    dealt = cut.select("cell", "doc_id", "n_shingles", "bits", "class").repartition("cell")
    return dealt.sortWithinPartitions("cell", "doc_id").mapInArrow(run, "a long, b long").distinct()


def first_buckets(named: DataFrame) -> DataFrame:
    """Each document of (bucket, doc_id, class) once, in its bucket of most documents; with ``sets``."""
    size = written_once(named.groupBy("bucket").agg(F.count(F.lit(1)).alias("sets")), "jaccard-sizes")
    rows = written_once(named.join(size, "bucket"), "jaccard-rows")
    largest = rows.groupBy("doc_id").agg(F.max(F.struct("sets", "bucket")).alias("x"))
    chosen = written_once(largest.select("doc_id", "x.bucket"), "jaccard-largest")
    return rows.join(chosen, ["doc_id", "bucket"])


def open_buckets(named: DataFrame) -> DataFrame:
    """Documents of buckets with several classes, buckets with one main class put together.

    The buckets of near copies are many samples of one group of documents; together they are that
    group, and its documents are compared once. Nothing is lost: what shared a bucket still does.
    """
    counted = named.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    several = counted.groupBy("bucket").agg(
        F.min("class").alias("x"), F.max("class").alias("y"),
        F.max(F.struct("n", (-F.col("class")).alias("c"))).alias("top")).where("x <> y")
    main = written_once(several.select("bucket", (-F.col("top.c")).alias("main")), "jaccard-open")
    rows = written_once(named.join(main, "bucket").select(
        F.col("main").alias("bucket"), "doc_id", "class").distinct(), "jaccard-rows")
    size = written_once(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("sets")), "jaccard-sizes")
    return rows.join(size, "bucket")


def joined_classes(docs: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links (a, b) that hold every class together; ``found`` are the buckets, ``sets`` has the bitmaps."""
    links = checked = None
    for phase in (0, 1, 2):
        if phase:
            known = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
            known = written_once(known, "jaccard-classes")
            named = found.join(known, found["doc_id"] == known["node"], "left").select(
                "bucket", "doc_id", F.coalesce("component", "doc_id").alias("class"))
        else:
            named = found.select("bucket", "doc_id", F.col("doc_id").alias("class"))
        rows = first_buckets(written_once(named, "jaccard-named")) if not phase else open_buckets(
            written_once(named, "jaccard-named"))
        rows = rows.join(sets, "doc_id")
        pairs = candidates(rows, phase)
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = written_once(pairs, "jaccard-pairs")
        checked = pairs if checked is None else checked.union(pairs)
        new = written_once(verified(pairs, docs), "jaccard-links")
        links = new if links is None else links.union(new)
    return links


def classes(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row (doc_id, n_shingles, component_id) for each row of ``df``.

    Sets are the distinct five-word shingles of the whole text, A-Z in lower case; a shorter text
    is one shingle. ``component_id`` is the least key reachable by links, the row's own included.
    Null, empty and wordless texts have an empty set and link with nothing. Rows with one key are
    one document that links wherever one of its texts does. A row without key links with nothing
    and has a null component. Other columns of ``df`` are not looked at. Equal sets are indexed
    once, however many there are.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = rows.where("doc_id is not null")
    sets = class_sets(rows)
    digest = ["n_shingles", "d1", "d2"]
    same = written_once(sets.where("n_shingles > 0 and doc_id is not null").groupBy(*digest).agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "jaccard-same")
    members = written_once(sets.drop("bits").join(same, digest, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("least"),
    ), "jaccard-members")
    # per document with words: whether one of its sets is indexed under its own key, and its sets' keys
    keys = written_once(members.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("least") == F.col("doc_id")).alias("own"), F.min("least").alias("x"), F.max("least").alias("y"),
    ).where("not own or x <> y"), "jaccard-keys")
    size = members.agg(F.max("n_shingles").alias("most"), F.sum("n_shingles").alias("all")).first()
    single = docs.join(broadcast_within(keys.where("not own").select("doc_id")), "doc_id", "left_anti")
    links = joined_classes(
        docs, indexed(single, size["most"] or 0, size["all"] or 0), sets.where("n_shingles > 0").select("doc_id", "n_shingles", "bits"))
    several = members.where("n_shingles > 0").join(keys.where("x <> y").select("doc_id", "x"), "doc_id")
    links = links.union(several.where("least <> x").select(F.col("least").alias("a"), F.col("x").alias("b")))
    found = written_once(
        components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "jaccard-classes")
    return members.join(found, members["least"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "least").alias("component_id"))
