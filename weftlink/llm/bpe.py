"""Byte-level BPE encoding and decoding.

Texts are read once, in slices of a task's rows. A slice has its distinct words (matches of the public pattern) as byte
arrays, and every text as places among them. A word that is a token itself is its id. Over every other word's bytes the
ranked merges are folded: a step takes the neighbouring pair of lowest rank (the leftmost, on ties) and puts the joined token
there, until no pair has a rank. Words never leave their slice, so nothing is shuffled, whatever words the texts share.
Decoding looks each id's bytes up and concatenates them.

The fold has two forms with equal ids. With `expressions`, Spark's higher-order functions fold the distinct words, with ranks
from a literal map (Spark scans a map's keys, so the literal is an array of many small maps that the pair selects by a
remainder). Spark interprets these functions, some 40 microseconds a step, which is beyond the check tool's limits; so by
default the words are folded where the slice is made, by the same ranks. Words of more than `LONG` bytes are merged over a
linked list with a heap in both, in time n log n.

Edge cases: null and empty texts have no ids (0 tokens, hashes of the empty string); repeated rows are encoded each; a
null doc_id is kept; an empty table gives no rows; other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import ship
from weftlink.llm.tokens import load_ranks, words_of

SLICE = 4 << 20  # characters of a slice; a longer text is one alone
LONG = 128  # bytes; longer words are merged with a heap
NONE = 2**31 - 1
BITS, PLACES = 8, 256  # a word that Spark folds has fewer places
SHIFT = 2**20  # a pair's key is left * SHIFT + right
MAPS = 65521  # a prime


@cache
def pairs_of(path: str) -> dict[int, int]:
    """Rank of every pair of tokens, by key, that together are a token."""
    ranks = load_ranks(path)
    found = {}
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
            if left is not None and right is not None:
                found[left * SHIFT + right] = rank
    return found


@cache
def _literals(path: str) -> tuple[str, str]:
    """JSON texts: the maps, and the ids of single bytes."""
    maps: list[dict[int, int]] = [{} for _ in range(MAPS)]
    for key, rank in pairs_of(path).items():
        maps[key % MAPS][key] = rank
    ranks = load_ranks(path)
    return json.dumps(maps), json.dumps([ranks[bytes([b])] for b in range(256)])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fold_word(word: Column, path: str) -> Column:
    """Ids of one word of two bytes or more, given as an array of byte values, by folding merges.

    The state is (p, r): the tokens between two marks of -1, and the rank of each with the next. A step looks up only the two
    ranks that it changes."""
    maps, singles = (F.from_json(F.lit(x), t) for x, t in zip(_literals(path), ("array<map<string,bigint>>", "array<bigint>"), strict=True))
    mark = F.array(F.lit(-1).cast("bigint"))

    def rank(left: Column, right: Column) -> Column:
        key = left * SHIFT + right
        return F.coalesce(F.element_at(maps, F.pmod(key, F.lit(MAPS)).cast("int") + 1)[key.cast("string")], F.lit(NONE).cast("bigint"))

    def step(state: Column, _: Column) -> Column:
        p, r = state["p"], state["r"]

        def join(least: Column) -> Column:  # rank * PLACES + index from 0
            low, at = F.shiftright(least, BITS), (least.bitwiseAND(F.lit(PLACES - 1)) + 1).cast("int")
            merged = F.struct(
                F.concat(F.slice(p, F.lit(1), at - 1), F.array(low), F.slice(p, at + 2, F.lit(PLACES))).alias("p"),
                F.concat(F.slice(r, F.lit(1), at - 2), F.array(rank(F.element_at(p, at - 1), low), rank(low, F.element_at(p, at + 2))), F.slice(r, at + 2, F.lit(PLACES))).alias("r"),
            )
            return F.when(least >= NONE * PLACES, state).otherwise(merged)

        return let(F.array_min(F.transform(r, lambda x, i: x * PLACES + i)), join)

    tokens = F.concat(mark, F.transform(word, lambda b: F.element_at(singles, b + 1)), mark)
    ranks = lambda p: F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: rank(F.element_at(p, i), F.element_at(p, i + 1)))
    start = let(tokens, lambda p: F.struct(p.alias("p"), ranks(p).alias("r")))
    return F.aggregate(F.sequence(F.lit(2), F.size(word)), start, step, lambda s: F.slice(s["p"], F.lit(2), F.size(s["p"]) - 2))


def merge_short(word: bytes, path: str) -> list[int]:
    """Ids of one word of two bytes or more, by folding merges."""
    pairs, ranks = pairs_of(path), load_ranks(path)
    p = [ranks[word[i : i + 1]] for i in range(len(word))]
    r = [pairs.get(a * SHIFT + b, NONE) for a, b in zip(p, p[1:])]  # noqa: B905, RUF007
    while r and (low := min(r)) != NONE:
        at = r.index(low)
        p[at : at + 2] = [low]
        del r[at]
        if at:
            r[at - 1] = pairs.get(p[at - 1] * SHIFT + low, NONE)
        if at < len(r):
            r[at] = pairs.get(low * SHIFT + p[at + 1], NONE)
    return p


def merge_long(word: bytes, path: str) -> list[int]:
    """Ids of one word, by the same merges, with a heap of ranks over a linked list."""
    pairs, ranks = pairs_of(path), load_ranks(path)
    ids = [ranks[bytes([b])] for b in word]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(pairs[k], i) for i in range(n - 1) if (k := ids[i] * SHIFT + ids[i + 1]) in pairs]
    heapq.heapify(heap)
    while heap:
        low, i = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or pairs.get(ids[i] * SHIFT + ids[j]) != low:
            continue  # one of the two has been joined since
        ids[i], ids[j], after[i] = low, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (k := low * SHIFT + ids[after[i]]) in pairs:
                heapq.heappush(heap, (pairs[k], i))
        if before[i] >= 0 and (k := ids[before[i]] * SHIFT + low) in pairs:
            heapq.heappush(heap, (pairs[k], before[i]))
    return [x for x in ids if x >= 0]


class _Places(dict):
    """Word to its number in order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = found = len(self)
        return found


def slicing(path: str, expressions: bool):
    """From batches (doc_id, text) to a row per slice: ids (doc_id of each text), sizes (words of each), places, words (byte values of the words
    that are left to fold), order (number of each of those, then of the settled ones) and settled (ids of the other words)."""

    def run(batches):
        import pyarrow as pa

        ranks = load_ranks(path)

        def settle(word: bytes) -> list[int] | None:
            if (known := ranks.get(word)) is not None:
                return [known]
            return merge_long(word, path) if len(word) > LONG else None if expressions else merge_short(word, path)

        def flush(held, sizes, places, index):
            words = [w.encode() for w in index]
            open_, shut, ids, ends = array("I"), array("I"), array("q"), array("i", [0])
            for i, word in enumerate(words):
                if (ready := settle(word)) is None:
                    open_.append(i)
                else:
                    shut.append(i)
                    ids.extend(ready)
                    ends.append(len(ids))
            settled = pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, np.int32)), pa.array(np.frombuffer(ids, np.int64)) if ids else pa.array([], pa.int64()))
            lengths = np.array([0, *(len(words[i]) for i in open_)], dtype=np.int32)
            data = np.frombuffer(b"".join(words[i] for i in open_), np.uint8).astype(np.int16)
            bodies = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(data))
            one = lambda column: pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
            packed = lambda x: pa.array([x.tobytes()], pa.binary())
            columns = [one(pa.concat_arrays(held)), packed(sizes), packed(places), one(bodies), packed(open_ + shut), one(settled)]
            return pa.RecordBatch.from_arrays(columns, ["ids", "sizes", "places", "words", "order", "settled"])

        held, sizes, places, index, room = [], array("I"), array("I"), _Places(), 0
        for b in batches:
            start = 0
            for end, text in enumerate(b.column(1).to_pylist(), start=1):
                if room and room + len(text or "") > SLICE:
                    if end - 1 > start:
                        held.append(b.column(0).slice(start, end - 1 - start))
                    yield flush(held, sizes, places, index)
                    held, sizes, places, index, room, start = [], array("I"), array("I"), _Places(), 0, end - 1
                found = words_of(text or "")
                places.extend(map(index.__getitem__, found))
                sizes.append(len(found))
                room += len(text or "")
            if b.num_rows > start:
                held.append(b.column(0).slice(start, b.num_rows - start))
        if sizes:
            yield flush(held, sizes, places, index)

    return run


def expanding():
    """From slices, with the ids of their words as folded (if any) and settled, to batches (doc_id, ids)."""

    def expand(batches):
        import pyarrow as pa

        def texts(owners, sizes, places, order, parts):
            sizes, places, order = (np.frombuffer(x, np.uint32).astype(np.int64) for x in (sizes, places, order))
            lengths = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in parts]).astype(np.int64)
            flat = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in parts]).astype(np.int32)
            at = np.empty(len(order), np.int64)
            at[order] = np.arange(len(order))
            starts, ends, first = np.cumsum(lengths) - lengths, np.cumsum(sizes), 0
            while first < len(sizes):  # about 250,000 words at a time
                base = ends[first] - sizes[first]
                last = max(first + 1, int(np.searchsorted(ends, base + (1 << 18), side="right")))
                words = at[places[base : ends[last - 1]]]
                n = lengths[words]
                ids = flat[np.repeat(starts[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                offsets = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends[first:last] - base])]
                yield pa.RecordBatch.from_arrays([owners.slice(first, last - first), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))], ["doc_id", "ids"])
                first = last

        for b in batches:
            for r in range(b.num_rows):
                yield from texts(b.column("ids")[r].values, *(b.column(c)[r].as_py() for c in ("sizes", "places", "order")), [b.column(c)[r].values for c in ("folded", "settled") if c in b.schema.names])

    return expand


@cache
def _pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """Bytes and decimal digits of each id."""
    pieces: list[bytes] = [b""] * (max(load_ranks(path).values()) + 1)
    for piece, r in load_ranks(path).items():
        pieces[r] = piece
    return pieces, [b"%d" % r for r in range(len(pieces))]


def decode(ids: list[int], path: str) -> bytes:
    """The bytes of a sequence of ids."""
    return b"".join(map(_pieces(path)[0].__getitem__, ids))


def digesting(path: str):
    """From batches (doc_id, ids) to batches (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def digest(batches):
        import pyarrow as pa

        digits = _pieces(path)[1]
        for b in batches:
            column = b.column(1)
            ids, ends = column.flatten().to_numpy().tolist(), np.cumsum(column.value_lengths().to_numpy()).tolist()
            sizes, spelled, decoded = [], [], []
            for first, last in zip([0, *ends], ends, strict=False):
                one = ids[first:last]
                sizes.append(len(one))
                spelled.append(hashlib.sha256(b",".join(map(digits.__getitem__, one))).hexdigest())
                decoded.append(hashlib.sha256(decode(one, path)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(spelled), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str, expressions: bool = False) -> DataFrame:
    """doc_id, ids for each row of `docs` (doc_id, text)."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    run, expand = slicing(path, expressions), expanding()
    if not expressions:
        return _texts(docs).mapInArrow(lambda batches: expand(run(batches)), f"doc_id {kind}, ids array<int>")
    schema = f"ids array<{kind}>, sizes binary, places binary, words array<array<smallint>>, order binary, settled array<array<bigint>>"
    folded = F.transform("words", lambda w: fold_word(w, path)).alias("folded")
    return _texts(docs).mapInArrow(run, schema).select("ids", "sizes", "places", "order", "settled", folded).mapInArrow(expand, f"doc_id {kind}, ids array<int>")


def round_trip(docs: DataFrame, path: str, expressions: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of `docs`: encoded, then decoded from the ids. One pass of one worker unless Spark folds."""
    ship(docs.sparkSession)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    digest = digesting(path)
    if expressions:
        return encode_documents(docs, path, True).mapInArrow(digest, schema)
    run, expand = slicing(path, False), expanding()
    return _texts(docs).mapInArrow(lambda batches: digest(expand(run(batches))), schema)
