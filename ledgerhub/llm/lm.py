"""Language-model scoring by backoff with counts that cover the whole corpus.

The model smooths each order with the one below: p(w|h) = (c(hw) + m p(w|h')) / (c(h) + m), where
h' is h without its first word; single words have add-one smoothing and share one unknown word.
The model is a backoff automaton: the histories that were seen are its states, state h has an arc for each w
seen after it, of weight log p(w|h), and a failure arc to h' of weight log m / (c(h) + m). A block builds
the part of it that its words can reach and reads all its texts in one traversal from left to right,
side by side: each carries its state, and where a state has no arc for the next word, failure arcs are taken.

Counts never meet in one place. Documents are dealt into blocks; a block sends its distinct
n-grams as sorted hashes, once for counting and looking up, to shards of the hash range; a shard
adds the counts up and answers each block in the order it was asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.llm.common import (
    fold_of, numbers, planes, shard_of, tokenized, word_hashes, written_once,
)

ORDER = 2
#: Weight of the lower order against the counts of a history, chosen on held-out texts.
STRENGTH = 300.0
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
#: Hashes that stand for the start of a text, which is a history only, and for its end.
_START = np.uint64(0x5851F42D4C957F2C)
_END = np.uint64(0x14057B7EF767814E)
_ONE = np.uint64(1)


@dataclass
class Sequences:
    """Texts as word hashes: one start mark, the words, one end mark each, one text after the other."""

    hashes: np.ndarray
    is_start: np.ndarray
    owner: np.ndarray  # number of the text


def sequences(texts: pa.Array) -> Sequences:
    words, sizes = tokenized(texts)
    own = word_hashes(words) & ~_ONE  # the lowest bit tells single words from longer n-grams
    begins = np.cumsum(sizes + 2) - (sizes + 2)
    hashes = np.empty(int(sizes.sum()) + 2 * len(sizes), np.uint64)
    is_start = np.zeros(len(hashes), bool)
    is_start[begins] = True
    ends = begins + sizes + 1
    inner = np.ones(len(hashes), bool)
    inner[begins] = inner[ends] = False
    hashes[begins], hashes[ends] = _START & ~_ONE, _END & ~_ONE
    hashes[inner] = own
    return Sequences(hashes, is_start, np.repeat(np.arange(len(sizes)), sizes + 2))


def keys_by_order(s: Sequences, order: int) -> list[np.ndarray]:
    """Per order a key for the n-gram that ends at each place; 0 where the text has no such n-gram."""
    with np.errstate(over="ignore"):
        levels, last = [s.hashes], s.hashes
        for n in range(1, order):
            key = np.zeros(len(s.hashes), np.uint64)
            inside = np.zeros(len(key), bool)
            inside[1:] = (s.owner[1:] == s.owner[:-1]) & (last[:-1] != 0)
            before = np.empty_like(last)
            before[1:] = last[:-1]
            mixed = (before[inside] * _ODD + s.hashes[inside]) * _MIX
            key[inside] = (mixed ^ (mixed >> np.uint64(29))) * _ODD | _ONE
            levels.append(key)
            last = key
    return levels


def pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences, and their counts."""
    return planes(np.diff(keys, prepend=np.uint64(0))), planes(counts.astype(np.uint32))


def unpack_keys(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(numbers(data, np.uint64, count), dtype=np.uint64)


ASKED = "shard int, block int, n int, ks binary, cs binary"
ANSWERED = "block int, shard int, n int, cs binary, tokens long, types long"


def asked_by(block: int, texts: pa.Array, train: np.ndarray, order: int, shards: int) -> Iterator[dict]:
    """What a block has of each shard's n-grams: keys, and their counts in its training texts."""
    s = sequences(texts)
    levels = keys_by_order(s, order)
    flat = np.concatenate(levels)
    learned = np.tile(train[s.owner], order) & (flat != 0)
    keys, place = np.unique(flat, return_inverse=True)
    counts = np.bincount(place[learned], minlength=len(keys))
    if len(keys) and keys[0] == 0:
        keys, counts = keys[1:], counts[1:]
    bounds = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(bounds)):
        own = slice(bounds[shard], bounds[shard + 1])
        ks, cs = pack(keys[own], counts[own])
        yield {"shard": int(shard), "block": block, "n": int(bounds[shard + 1] - bounds[shard]), "ks": ks, "cs": cs}


def answers(shard: int, rows: list[dict]) -> Iterator[dict]:
    """Counts over all blocks, for each block in its own order; the first row has the shard's totals."""
    own = [unpack_keys(r["ks"], r["n"]) for r in rows]
    counts = np.concatenate([numbers(r["cs"], np.uint32, r["n"]) for r in rows]).astype(np.int64)
    keys, place = np.unique(np.concatenate(own), return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(keys)).astype(np.uint64)
    single = ((keys & _ONE) == 0) & (keys != (_START & ~_ONE))
    tokens, types = int(total[single].sum()), int((total[single] > 0).sum())
    at = 0
    for r in rows:
        mine = total[place[at:at + r["n"]]]
        at += r["n"]
        yield {"block": r["block"], "shard": shard, "n": r["n"], "cs": planes(mine), "tokens": tokens, "types": types}
        tokens = types = 0


@dataclass
class Automaton:
    """Numbered states, one for each history that was seen, arcs and failure arcs; weights are log10.

    State 0 is the empty history; it has an arc for every word, those without a count sharing one weight.
    ``arcs`` are the others, sorted by state * number of words + word, with their weights and targets.
    ``fails`` and ``fail_weights`` lead from a state to the history without its first word.
    """

    words: int
    root_weights: np.ndarray
    root_targets: np.ndarray
    arcs: np.ndarray
    arc_weights: np.ndarray
    arc_targets: np.ndarray
    fails: np.ndarray
    fail_weights: np.ndarray

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word from each state: the weights of the arcs taken, failure arcs included, and the new states."""
        weights = np.zeros(len(states))
        out = np.zeros(len(states), np.int64)
        left = np.arange(len(states))
        while True:
            at_root = states[left] == 0
            here = left[at_root]
            weights[here] += self.root_weights[words[here]]
            out[here] = self.root_targets[words[here]]
            left = left[~at_root]
            if not len(left):
                return weights, out
            wanted = states[left] * self.words + words[left]
            place = np.minimum(np.searchsorted(self.arcs, wanted), max(len(self.arcs) - 1, 0))
            found = self.arcs[place] == wanted if len(self.arcs) else np.zeros(len(left), bool)
            here, place = left[found], place[found]
            weights[here] += self.arc_weights[place]
            out[here] = self.arc_targets[place]
            left = left[~found]
            weights[left] += self.fail_weights[states[left]]
            states[left] = self.fails[states[left]]


def built(
    levels: list[np.ndarray], distinct: np.ndarray, words: np.ndarray, count_of: Callable[[np.ndarray], np.ndarray],
    tokens: int, types: int, strength: float,
) -> tuple[Automaton, np.ndarray]:
    """The automaton of the n-grams of some texts, and the count of the word at each place.

    ``distinct`` are the keys of the words, ``words`` the numbers of the places' words among them; ``count_of``
    gives the counts of n-gram keys over the training texts. An n-gram's probability is (its count + strength * that without its first word) /
    (its history's count + strength); it has an arc if it has a count.
    """
    n_words = max(1, len(distinct))
    word_counts = count_of(distinct) if len(distinct) else np.zeros(1)
    log_share = np.log10((word_counts + 1) / (tokens + types + 1))
    state_at = np.zeros(len(words), np.int64)  # of the level before, at each place; 0 if it has no count
    share_at = 10.0 ** log_share[words]  # probability of the n-gram of the level before that ends there
    held_at = word_counts[words]  # and its count
    fails, fail_weights, arcs, weights, targets = [np.zeros(1, np.int64)], [np.zeros(1)], [], [], []
    root_targets = np.zeros(n_words, np.int64)
    states, order = 1, len(levels)
    if order > 1:  # single words as histories
        seen = np.flatnonzero(word_counts > 0)
        root_targets[seen] = states + np.arange(len(seen))
        fails.append(np.zeros(len(seen), np.int64))
        fail_weights.append(np.log10(strength / (word_counts[seen] + strength)))
        states += len(seen)
        state_at = root_targets[words]
    for n in range(1, order):
        key = levels[n]
        inside = np.flatnonzero(key != 0)
        own, place = np.unique(key[inside], return_inverse=True)
        one = np.zeros(len(own), np.int64)
        one[place] = inside  # a place of each n-gram
        count = count_of(own)
        share = (count + strength * share_at[one]) / (held_at[one - 1] + strength)
        has = (count > 0) & (state_at[one - 1] > 0)
        state = np.zeros(len(one), np.int64)
        if n < order - 1:
            state[has] = states + np.arange(int(has.sum()))
            fails.append(state_at[one[has]])
            fail_weights.append(np.log10(strength / (count[has] + strength)))
            states += int(has.sum())
        arcs.append(state_at[one[has] - 1] * n_words + words[one[has]])
        weights.append(np.log10(share[has]))
        targets.append(state[has] if n < order - 1 else state_at[one[has]])
        new_state, new_share, new_held = np.zeros_like(state_at), np.zeros_like(share_at), np.zeros_like(held_at)
        new_state[inside], new_share[inside], new_held[inside] = state[place], share[place], count[place]
        state_at, share_at, held_at = new_state, new_share, new_held
    empty = np.zeros(0, np.int64)
    code, weight, target = (np.concatenate(x) if x else empty for x in (arcs, weights, targets))
    by = np.argsort(code, kind="stable")
    made = Automaton(
        n_words, log_share, root_targets, code[by], weight[by], target[by], np.concatenate(fails), np.concatenate(fail_weights))
    return made, word_counts[words]


#: Words that a lane reads, besides those before it that lead to its first state.
LANE = 256


def traversed(s: Sequences, words: np.ndarray, automaton: Automaton, order: int, lane: int = LANE) -> np.ndarray:
    """The weight of reading each place's word, from left to right, the state carried from word to word.

    All texts are read side by side. A long text is several lanes: the state depends on the last
    ``order - 1`` words at most, so a lane reads these first, without counting them.
    """
    begins = np.flatnonzero(s.is_start)
    sizes = np.diff(np.append(begins, len(words)))
    lanes = -(-sizes // lane)
    nth = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    text = np.repeat(np.arange(len(begins)), lanes)
    first = begins[text] + nth * lane  # the first place that counts
    lead = np.minimum(nth * lane, order - 1)
    start, size = first - lead, np.minimum(lane, sizes[text] - nth * lane) + lead
    longest = np.argsort(-size, kind="stable")
    start, size, lead = start[longest], size[longest], lead[longest]
    states = np.zeros(len(start), np.int64)
    out = np.zeros(len(words))
    active = np.searchsorted(-size, -np.arange(int(size.max()) if len(size) else 0), "left")  # lanes longer than each step
    for step, n in enumerate(active.tolist()):
        place = start[:n] + step
        weight, states[:n] = automaton.step(states[:n].copy(), words[place])
        counts = step >= lead[:n]
        out[place[counts]] = weight[counts]
    return out


def scored(
    texts: pa.Array, count_of: Callable[[np.ndarray], np.ndarray], tokens: int, types: int, strength: float, order: int,
) -> dict[str, np.ndarray]:
    """Per text: tokens with the end, tokens with a count, and log10 probabilities by words and by the model."""
    s = sequences(texts)
    n = len(texts)
    levels = keys_by_order(s, order)
    distinct, words = np.unique(s.hashes, return_inverse=True)
    automaton, count = built(levels, distinct, words, count_of, tokens, types, strength)
    weight = traversed(s, words, automaton, order)
    read = ~s.is_start
    owner = s.owner[read]
    per = lambda values: np.bincount(owner, weights=values[read], minlength=n)
    base = np.log10((count + 1) / (tokens + (types + 1)))
    return {
        "n_tokens": np.bincount(owner, minlength=n), "n_known": per((count > 0).astype(float)).astype(np.int64),
        "base_score": per(base), "score": per(weight),
    }


def counts_in(keys: np.ndarray, counts: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Look-up of n-gram keys in sorted ``keys``; others have no count."""
    def count_of(wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[place] == wanted, counts[place], 0).astype(np.float64)

    return count_of


def score(
    df: DataFrame, train: Column, text: str = "text", order: int = ORDER, strength: float = STRENGTH,
    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``df`` without its text, with n_tokens, n_known, train_tokens, base_score and score.

    ``train`` says which rows the model learns from; null counts as no. Words are runs without ASCII
    white space, A-Z in lower case; a null or empty text has the end alone. N-grams are told apart
    by 64-bit hashes. With nothing to learn from, every word is unknown. Columns of these names
    are replaced. Blocks and shards grow in number with the text, not in size. A text lies whole in one
    block, however long it is; repeated rows count each time in training and each get a row.
    """
    made = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    whole = F.coalesce(F.col(text), F.lit(""))
    size = df.agg(F.sum(F.octet_length(whole))).first()[0] or 0
    blocks, shards = -(-size // block_bytes) or 1, -(-size // shard_bytes) or 1
    rest = [c for c in df.columns if c not in [text, *made]]
    dealt = df.select(
        *rest, whole.alias("text_"), F.coalesce(train, F.lit(False)).alias("train_"),
        F.pmod(F.xxhash64(whole, *[F.col(c) for c in rest]), F.lit(blocks)).cast("int").alias("block_"),
    )

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        train = table["train_"].to_numpy()
        rows = list(asked_by(key[0].as_py(), table["text_"], train, order, shards))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.Table.from_pylist(rows, pa.schema(list(zip(["shard", "block", "n", "ks", "cs"], kinds))))

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        names = ["block", "shard", "n", "cs", "tokens", "types"]
        rows = list(answers(key[0].as_py(), table.sort_by("block").to_pylist()))
        return pa.Table.from_pylist(rows, pa.schema(list(zip(names, kinds))))

    asked = dealt.select("block_", "text_", "train_").groupBy("block_").applyInArrow(ask, ASKED)
    answered = written_once(asked.groupBy("shard").applyInArrow(answer, ANSWERED), "lm-counts")
    total = answered.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    tokens, types = total["tokens"] or 0, total["types"] or 0

    def read(key: tuple, own: pa.Table, found: pa.Table) -> pa.Table:
        texts = own["text_"].combine_chunks()
        keys = np.unique(np.concatenate(keys_by_order(sequences(texts), order)))
        keys = keys[keys != 0]
        parts = found.sort_by("shard").to_pylist()
        counts = [numbers(p["cs"], np.uint64, p["n"]) for p in parts]
        out = scored(texts, counts_in(keys, np.concatenate(counts)), tokens, types, strength, order)
        out["train_tokens"] = np.full(len(texts), tokens)
        kept = own.select(rest)
        for name in made:
            kind = pa.float64() if name.endswith("score") else pa.int64()
            kept = kept.append_column(name, pa.array(out[name], kind))
        return kept

    fields = [f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in rest]
    ddl = ", ".join([*fields, *[f"{c} {'double' if c.endswith('score') else 'long'}" for c in made]])
    found = answered.select("block", "shard", "n", "cs")
    return dealt.drop("train_").groupBy("block_").cogroup(found.groupBy("block")).applyInArrow(read, ddl)


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from training."""
    return fold_of(key, 7) == 2
