"""Counting the keys that entities of source 1 share with candidates, without shuffling the pairs.

Each entity's distinct keys (64-bit hashes) go once to key buckets, packed per Arrow batch. A bucket counts the keys' postings,
drops the hot ones and those without a partner, and sends what is left to slots: a slot is a block of source-1 entities and a
block of candidates of one country, so that all keys of a pair meet in one slot. A slot counts its pairs, some source-1
entities at a time, and they leave as result rows: no pair is shuffled. What is sent grows with the keys and the number of
blocks of the other side, not with the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.session import ship

U64 = np.uint64
ASK_BYTES, GIVE_BYTES, BUCKET_BYTES = 32 << 20, 64 << 20, 4 << 20  # text of a slot's two blocks, and of a bucket
STEP = 1 << 21  # pairs by key that a slot expands at once
ANY = "\x00any"  # the group of source-1 entities whose country no candidate has; they meet all candidates
SCHEMA = "to int, src int, country string, ids binary, sizes binary, keys binary, counts binary, names array<string>"
FIELDS = [field.split()[0] for field in SCHEMA.split(", ")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(29))


def _small(x: np.ndarray) -> bytes:
    """Numbers in one, two or four bytes each, that width first."""
    top = int(x.max(initial=0))
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.uint32}[raw[0]], offset=1).astype(np.int64)


def _packed(to: int, src: int, country: str, owner: np.ndarray, ids: np.ndarray, keys: bytes, counts: np.ndarray) -> tuple:
    """A row of entries, which lie in the order of their owners (places in `ids`)."""
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return to, src, country, ids[owner[first]].tobytes(), _small(np.diff(np.append(first, len(owner)))), keys, _small(counts), None


def _batch(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.int32(), pa.int32(), pa.string(), *(pa.binary(),) * 4, pa.list_(pa.string()))
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], FIELDS


class Slots:
    """Which slots the blocks of a country's entities go to. Made of its (source-1, candidate) bytes."""

    def __init__(self, asks: dict[str, int], gives: dict[str, int]):
        self.asks, self.gives, self.first, n = {}, {}, {}, 0
        for g, size in asks.items():
            self.asks[g] = max(1, math.ceil(size / ASK_BYTES))
            self.gives[g] = max(1, math.ceil((sum(gives.values()) if g == ANY else gives.get(g, 0)) / GIVE_BYTES))
            self.first[g] = n
            n += self.asks[g] * self.gives[g]
        self.known = {c for c in gives if c}

    def group(self, country: str | None) -> str:
        return country if country in self.known else ANY

    def groups(self, country: str | None) -> list[str]:
        """The groups that a candidate of `country` serves."""
        return [g for g in ((country, ANY) if country else (ANY,)) if g in self.asks]

    def ask_block(self, g: str, ids: np.ndarray) -> np.ndarray:
        return (_mix(ids.view(np.uint64) ^ U64(0x51ED)) % U64(self.asks[g])).astype(np.int64)

    def give_block(self, g: str, ids: np.ndarray) -> np.ndarray:
        return (_mix(ids.view(np.uint64) ^ U64(0xA0B1)) % U64(self.gives[g])).astype(np.int64)

    def at(self, g: str, ask: int, give: int) -> int:
        return self.first[g] + ask * self.gives[g] + give


def _emitted(batches, slots: Slots, buckets: int):
    """Rows of each batch's entries to the buckets, and of its names to the slots (as -1 - slot)."""
    import pyarrow as pa

    for b in batches:
        if not b.num_rows:
            continue
        ids, src = b.column("id").to_numpy(), b.column("src").to_numpy()
        names, countries = b.column("entity_id"), np.array(b.column("country").to_pylist(), dtype=object)
        sets = [(s, c, np.flatnonzero((src == s) & (countries == c))) for s in np.unique(src) for c in dict.fromkeys(countries[src == s])]
        out = []
        for s, c, rows in sets:
            for g in [slots.group(c)] if s == 1 else slots.groups(c):
                block = (slots.ask_block if s == 1 else slots.give_block)(g, ids[rows])
                for k in np.unique(block):
                    mine = rows[block == k]
                    told = names.take(pa.array(mine)).to_pylist()
                    others = range(slots.gives[g] if s == 1 else slots.asks[g])
                    out += [(-1 - (slots.at(g, int(k), o) if s == 1 else slots.at(g, o, int(k))), int(s), c, ids[mine].tobytes(), None, None, None, told) for o in others]
        lists = b.column("keys")
        lengths = np.diff(lists.offsets.to_numpy())
        owner, keys = np.repeat(np.arange(len(ids)), lengths), lists.flatten().to_numpy().view(np.uint64)
        order = np.lexsort((keys, owner))
        owner, keys = owner[order], keys[order]
        first = np.flatnonzero(np.concatenate([[len(keys) > 0], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])[: len(keys)])
        owner, keys, counts = owner[first], keys[first], np.diff(np.append(first, len(keys)))
        which = np.zeros(len(ids), np.int64)
        for n, (_, _, rows) in enumerate(sets):
            which[rows] = n
        to = ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64) * len(sets) + which[owner]
        order = np.argsort(to, kind="stable")
        heads, at = np.unique(to[order], return_index=True)
        for head, part in zip(heads, np.split(order, at[1:]) if len(heads) else [], strict=True):
            s, c, _ = sets[head % len(sets)]
            out.append(_packed(int(head // len(sets)), int(s), c, owner[part], ids, keys[part].tobytes(), counts[part]))
        for i in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays(*_batch(out[i : i + 256]))


def _sent(batches, slots: Slots, rows_of: dict[int, int], cap):
    """One bucket: hot keys and keys without a partner go, the rest is sent to the slots."""
    import pyarrow as pa

    parts = []
    for b in batches:
        if b.num_rows and b.column("to")[0].as_py() < 0:
            yield b.set_column(0, "to", pa.array(-1 - b.column("to").to_numpy(), pa.int32()))
        else:
            parts += b.to_pylist()
    if not parts:
        return
    bucket = parts[0]["to"]
    names, back = np.unique(np.concatenate([np.frombuffer(p["keys"], np.uint64) for p in parts]), return_inverse=True)
    codes = np.split(back.ravel(), np.cumsum([len(p["keys"]) // 8 for p in parts])[:-1])
    kept: dict[int, np.ndarray] = {}
    for p, code in zip(parts, codes, strict=True):
        if p["src"] != 1:
            kept.setdefault(p["src"], np.zeros(len(names), np.int64))
            kept[p["src"]] += np.bincount(code, weights=_wide(p["counts"]), minlength=len(names)).astype(np.int64)
    kept = {s: (n > 0) & (n <= cap(rows_of[s])) for s, n in kept.items()}
    offered: dict[str, np.ndarray] = {}  # by group: which keys a candidate offers
    for p, code in zip(parts, codes, strict=True):
        if p["src"] != 1:
            for g in slots.groups(p["country"]):
                offered.setdefault(g, np.zeros(len(names), bool))[code[kept[p["src"]][code]]] = True
    asked: dict[str, np.ndarray] = {g: np.zeros((slots.asks[g], len(names)), bool) for g in offered}
    for turn in (1, 2):  # source 1 first: candidates are sent only where their keys are asked for
        for p, code in zip(parts, codes, strict=True):
            if (p["src"] == 1) != (turn == 1):
                continue
            ids, counts = np.frombuffer(p["ids"], np.int64), _wide(p["counts"])
            owner = np.repeat(np.arange(len(ids)), _wide(p["sizes"]))
            out = []
            for g in [slots.group(p["country"])] if turn == 1 else slots.groups(p["country"]):
                if g not in offered:
                    continue
                block = (slots.ask_block if turn == 1 else slots.give_block)(g, ids)[owner]
                fits = offered[g][code] if turn == 1 else kept[p["src"]][code]
                for k in np.unique(block[fits]):
                    mine = np.flatnonzero(fits & (block == k))
                    if turn == 1:
                        asked[g][k, code[mine]] = True
                        row = _packed(0, 1, p["country"], owner[mine], ids, bucket.to_bytes(4, "little") + _small(code[mine]), counts[mine])
                        out += [(slots.at(g, int(k), o), *row[1:]) for o in range(slots.gives[g])]
                        continue
                    for o in range(slots.asks[g]):
                        some = mine[asked[g][o, code[mine]]]
                        if len(some):
                            out.append(_packed(slots.at(g, o, int(k)), p["src"], p["country"], owner[some], ids, bucket.to_bytes(4, "little") + _small(code[some]), counts[some]))
            if out:
                yield pa.RecordBatch.from_arrays(*_batch(out))


def _met(batches):
    """One slot: s1_id, cand_id, score of its pairs, some source-1 entities at a time."""
    import pyarrow as pa

    ids, told, parts = ([], []), ([], []), ([], [])
    for b in batches:
        for p in b.to_pylist():
            side = int(p["src"] != 1)
            if p["names"] is not None:
                ids[side].append(np.frombuffer(p["ids"], np.int64))
                told[side].append(pa.array(p["names"], pa.string()))
                continue
            code = _wide(p["keys"][4:]) + (int.from_bytes(p["keys"][:4], "little") << 32)
            parts[side].append((np.repeat(np.frombuffer(p["ids"], np.int64), _wide(p["sizes"])), code, _wide(p["counts"]).astype(np.uint32)))
    if not parts[0] or not parts[1]:
        return
    known, names = [], []
    for side in (0, 1):
        x, first = np.unique(np.concatenate(ids[side]), return_index=True)
        known.append(x)
        names.append(pa.concat_arrays(told[side]).take(pa.array(first)))
    (a, ka, na), (b, kb, nb) = ([np.concatenate(c) for c in zip(*parts[side], strict=True)] for side in (0, 1))
    a, b = np.searchsorted(known[0], a).astype(np.int32), np.searchsorted(known[1], b).astype(np.int32)
    order = np.argsort(kb, kind="stable")
    b, kb, nb = b[order], kb[order], nb[order]
    order = np.argsort(a, kind="stable")
    a, ka, na = a[order], ka[order], na[order]
    low = np.searchsorted(kb, ka)
    many = np.searchsorted(kb, ka, side="right") - low
    upto = np.concatenate([[0], np.cumsum(many)])
    edges = np.append(np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])), len(a))  # where each entity's entries begin
    width, e = len(known[1]), 0
    while e < len(edges) - 1:
        f = max(e + 1, int(np.searchsorted(upto[edges], upto[edges[e]] + STEP, side="right")) - 1)
        i, j = edges[e], edges[f]
        base, e = a[i], f
        score = None
        while i < j:  # an entity alone may have more than a step
            k = min(j, max(i + 1, int(np.searchsorted(upto, upto[i] + STEP, side="right")) - 1))
            n = many[i:k]
            at = np.arange(upto[k] - upto[i]) + np.repeat(low[i:k] - (upto[i:k] - upto[i]), n)
            pair = np.repeat((a[i:k] - base).astype(np.int64) * width, n) + b[at]
            weight = np.repeat(na[i:k], n).astype(np.float64) * nb[at]
            if score is None and k == j and (int(a[j - 1]) - int(base) + 1) * width > 8 * len(pair):
                pair, back = np.unique(pair, return_inverse=True)
                score = np.bincount(back.ravel(), weights=weight)
            else:
                dense = np.bincount(pair, weights=weight, minlength=(int(a[j - 1]) - int(base) + 1) * width)
                score = dense if score is None else score + dense
                pair = None
            i = k
        if pair is None:
            pair = np.flatnonzero(score)
            score = score[pair]
        for x in range(0, len(pair), 1 << 17):
            p = pair[x : x + (1 << 17)]
            yield pa.RecordBatch.from_arrays([names[0].take(pa.array(p // width + base)), names[1].take(pa.array(p % width)), pa.array(score[x : x + (1 << 17)].astype(np.int64))], ["s1_id", "cand_id", "score"])


def shared_keys(entities: DataFrame, keys: Column, cap) -> DataFrame:
    """s1_id, cand_id, score of `entities` (entity_id, src, country): for each key in the array `keys` the product of its numbers, summed.

    A key with more than `cap(rows of the source)` postings in a candidate source is none there. An entity of source 1 whose
    country occurs among the candidates meets only candidates of that country."""
    import pyarrow as pa

    ship(entities.sparkSession)
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (("business_name", "business_address") if "business_name" in entities.columns else ("name_norm", "addr_norm"))]
    rows = entities.where("src IS NOT NULL").groupBy("src", "country").agg(F.count("*").alias("n"), F.sum((text[0] + text[1]).cast("long")).alias("size")).collect()
    gives: dict[str, int] = {}
    asks: dict[str, int] = {}
    rows_of: dict[int, int] = {}
    for r in rows:
        if r["src"] != 1:
            rows_of[r["src"]] = rows_of.get(r["src"], 0) + r["n"]
            gives[r["country"]] = gives.get(r["country"], 0) + r["size"]
    for r in rows:
        if r["src"] == 1:
            g = r["country"] if r["country"] and r["country"] in gives else ANY
            asks[g] = asks.get(g, 0) + r["size"]
    slots = Slots(asks, gives)
    buckets = max(24, math.ceil(sum(r["size"] for r in rows) / BUCKET_BYTES))
    given = entities.where("src IS NOT NULL").select("entity_id", F.xxhash64("entity_id").alias("id"), F.col("src").cast("int").alias("src"), "country", F.transform(keys, lambda k: F.xxhash64(k)).alias("keys"))

    def emit(batches):
        return _emitted(batches, slots, buckets)

    def send(batches):
        return _sent(batches, slots, rows_of, cap)

    def meet(batches):
        return _met(batches)

    for f in (send, meet):
        f.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    sent = given.mapInArrow(emit, SCHEMA).groupBy("to").applyInArrow(send, SCHEMA)
    met = sent.groupBy("to").applyInArrow(meet, "s1_id string, cand_id string, score long")
    twice = entities.groupBy("entity_id").agg(F.count_distinct(F.coalesce("country", F.lit(""))).alias("n")).where("n > 1")
    # An id with rows of several countries is in several slots.
    return met if twice.isEmpty() else met.groupBy("s1_id", "cand_id").agg(F.sum("score").alias("score"))
