"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

Words are runs of non-space characters of the lower-cased text; a shingle is five words in a row (a shorter document is one
shingle). A shingle weighs (1 + ln tf) * (1 + damping * ln((1+N)/(1+df)) / ln(1+N)), N documents and df counted over the
whole corpus. The damping keeps a rare shingle from outweighing many that a large group of copies has made common, so that
near copies stay near however large their group is.

1. Every document's shingle hashes go to hash buckets, packed per Arrow batch (a row per batch and bucket, not per shingle).
   A bucket counts df and sends on only the shingles that more than one document has.
2. A document's similarity to any other is at most its shared weight over its whole weight; below the threshold it can
   have no partner and is done, without loss. The others get weighted samples and band keys, and equal shingle
   multisets are folded into one representative.
3. Each document is verified with the leader it meets in most band buckets (a bucket is led by its member that meets most
   others in all bands). In buckets that still hold different classes, every member is verified with the leader L and leaves
   what of it L lacks, its residue. Two members x, y share at most min(w(x in L), w(y in L)) and what their residues share, so
   a pair of similarity t either lies in L by t of both weights, or shares a shingle of a prefix of both residues, rarest
   first. Members meet again by those keys only; small groups there are verified pair by pair, large ones are led anew, until
   no group holds two classes. This keeps every link of the band buckets and takes rows in proportion to the members.
   Classes are connected components.

Rows are known by a 64-bit hash of (doc_id, text); rows that are equal in both are one document before anything is counted.

Edge cases: null and blank texts have no words and are classes of their own; rows without a doc_id are compared like all
others, and a class has no class_id only if none of its rows has a doc_id; repeated rows are one document, reported on each
row; different texts under one doc_id are different documents; an empty table gives no rows; other columns of the input are
left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import batches_for, connected_components, cut, release, runs_of, ship
from weftlink.session import arrow_rows, cut_by, discard

U64 = np.uint64
LOW = U64(2**48 - 1)
_RANDOM = np.random.default_rng(77)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(31))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(29))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every shingle of the concatenated UTF-8 texts in `data`, documents in order."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    at_doc = offsets[(offsets < n)]
    begins[at_doc] = solid[at_doc]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    ends[last] = solid[last]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    p = np.full(n, U64(_BASE), dtype=np.uint64)
    p[0] = 1
    p = np.multiply.accumulate(p)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * p, dtype=np.uint64)])
    q = np.full(n, U64(pow(_BASE, -1, 2**64)), dtype=np.uint64)
    q[0] = 1
    word = mix((sums[b] - sums[a]) * np.multiply.accumulate(q)[a] + (b - a).astype(np.uint64))
    doc = np.searchsorted(offsets, a, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(offsets) - 1))
    count = np.searchsorted(doc, np.arange(len(offsets) - 1), side="right") - first
    short = np.flatnonzero((count > 0) & (count < width))
    m = max(0, len(word) - width + 1)
    whole = doc[:m] == doc[width - 1 :] if m else np.zeros(0, bool)
    h = np.zeros(m, np.uint64)
    for j in range(width):
        h += word[j : j + m] * _PLACE[j]
    few = [mix(np.array([sum(int(word[first[d] + j]) * int(_PLACE[j]) for j in range(count[d])) % 2**64], dtype=np.uint64) + U64(count[d]))[0] for d in short]
    docs = np.concatenate([doc[:m][whole], short])
    hashes = np.concatenate([mix(h[whole]), np.array(few, dtype=np.uint64)])
    if len(short):
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
    return docs, hashes


def counted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, hash) with their counts, by doc then hash."""
    if not len(doc):
        return doc, h, np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]))
    return doc[new], h[new], np.diff(np.append(new, len(doc)))


def six(h: np.ndarray) -> bytes:
    """The low 48 bits of each hash."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


class Sampler:
    """Improved consistent weighted sampling: gamma and uniform variates are drawn from tables by the bits of a hash of (shingle, k)."""

    def __init__(self, bands: int, rows: int, seed: int = 123):
        r = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.seeds = r.integers(1, 2**63, bands * rows, dtype=np.uint64)
        self.gamma = r.gamma(2.0, 1.0, 1 << 16)
        self.log_gamma = np.log(r.gamma(2.0, 1.0, 1 << 16))

    def bands_of(self, h: np.ndarray, w: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Band keys (documents x bands) of documents whose shingles begin at `starts`."""
        logw = np.log(w)
        sizes = np.diff(np.append(starts, len(h)))
        keys = np.zeros((len(starts), self.bands), np.uint64)
        for k, seed in enumerate(self.seeds):
            u = mix(h ^ seed)
            r = self.gamma[(u & U64(0xFFFF)).astype(np.int64)]
            beta = ((u >> U64(16)) & U64(0xFFFFFFFF)).astype(np.float64) / 2**32
            t = np.floor(logw / r + beta)
            value = self.log_gamma[(u >> U64(48)).astype(np.int64)] - r * (t - beta + 1)
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == np.repeat(least, sizes))
            owner = np.searchsorted(starts, hit, side="right") - 1
            sample = mix(h[hit] + t[hit].astype(np.int64).astype(np.uint64) * U64(0x9E3779B97F4A7C15))
            one = np.full(len(starts), U64(2**64 - 1), dtype=np.uint64)
            np.minimum.at(one, owner, sample)
            band = k // self.rows
            keys[:, band] = mix(keys[:, band] * U64(31) + one + U64(k))
        return keys


def tallies(n: np.ndarray) -> bytes:
    """Counts as bytes if they fit, else as 32-bit numbers; `from_tallies` tells by the length."""
    return n.astype(np.uint8 if not len(n) or n.max() < 256 else np.uint32).tobytes()


def from_tallies(raws: list[bytes], sizes: list[int]) -> np.ndarray:
    parts = [np.frombuffer(raw, np.uint8 if len(raw) == size else np.uint32).astype(np.uint32) for raw, size in zip(raws, sizes, strict=True)]
    return np.concatenate([np.zeros(0, np.uint32), *parts])


WORK = "to int, ids binary, counts binary, hashes binary, df binary, tf binary, whole binary"


def _work(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.int32(), *(pa.binary(),) * 6)
    cols = list(zip(*rows, strict=True)) if rows else [()] * 7
    return [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["to", "ids", "counts", "hashes", "df", "tf", "whole"]


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    ids, at = np.unique(bucket[order], return_index=True)
    for b, rows in zip(ids, np.split(order, at[1:]), strict=True):
        yield int(b), rows


def sketches(docs: DataFrame, width: int, threshold: float, bands: int, rows: int, damping: float, batch_bytes: int) -> DataFrame:
    """doc_id, content, whole, hashes, weights, bands of the documents that may have a near duplicate."""
    buckets = batches_for(docs, F.octet_length("text"), batch_bytes)
    total = docs.select("doc_id").distinct().count()
    groups = buckets
    norm = damping / math.log(1 + total) if total else 0.0
    idf = lambda df: 1 + norm * np.log((1 + total) / (1 + df))
    group_of = lambda ids: (mix(ids.astype(np.uint64)) % U64(groups)).astype(np.int64)
    sampler = Sampler(bands, rows)

    def emit(batches):
        import pyarrow as pa

        from weftlink.llm.suffix_dedup import bytes_of

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            data, offsets = bytes_of(batch.column(1))
            parts = []
            for i, j in runs_of(offsets):
                d, x, n = counted(*shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width))
                parts.append(((d + i).astype(np.int32), x, n.astype(np.uint32)))
            doc, h, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
            del parts
            bucket = (h >> U64(32)) * U64(buckets) >> U64(32)
            out = []
            for to, rows in _split(bucket):  # within a bucket rows stay in document order
                d = doc[rows]
                first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                out.append((to, ids[d[first]].tobytes(), np.diff(np.append(first, len(d))).astype(np.uint32).tobytes(), six(h[rows]), b"", tallies(tf[rows]), b""))
            whole = np.bincount(doc, weights=1 + np.log(tf), minlength=len(ids))
            some = np.flatnonzero(whole > 0)
            for to, rows in _split(group_of(ids[some])):
                out.append((-1 - to, ids[some[rows]].tobytes(), b"", b"", b"", b"", whole[some[rows]].tobytes()))
            yield pa.RecordBatch.from_arrays(*_work(out))

    def join(table, name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)

    def count(table):
        import pyarrow as pa

        release()
        to = table.column("to")[0].as_py()
        if to < 0:
            return table.set_column(0, "to", pa.array(np.full(table.num_rows, -1 - to, np.int32)))
        ids, counts = join(table, "ids", np.int64), join(table, "counts", np.uint32)
        raw = table.column("hashes").to_pylist()
        h = from_six(b"".join(raw))
        tf = from_tallies(table.column("tf").to_pylist(), [len(x) // 6 for x in raw])
        owner = np.repeat(np.arange(len(ids)), counts)
        _, one = np.unique(ids, return_inverse=True)
        if len(ids) > (one.max() + 1 if len(ids) else 0):  # repeated rows: one of each (document, shingle) stays
            owner = one[owner]
            order = np.lexsort((h, owner))
            first = order[np.concatenate([[True], (np.diff(owner[order]) != 0) | (np.diff(h[order]) != 0)])]
            ids, owner, h, tf = np.unique(ids), owner[first], h[first], tf[first]
        order = np.argsort(h)
        sorted_h = h[order]
        new = np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]])
        run = np.cumsum(new) - 1
        df = np.empty(len(h), np.uint32)
        df[order] = np.bincount(run)[run]
        shared = np.flatnonzero(df > 1)
        owner, h, df, tf = owner[shared], h[shared] ^ mix(np.array([to], np.uint64) * U64(_BASE)), df[shared], tf[shared]
        out = []
        for group, rows in _split(group_of(ids[owner])):
            d = owner[rows]
            first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            out.append((group, ids[d[first]].tobytes(), np.diff(np.append(first, len(d))).astype(np.uint32).tobytes(), h[rows].tobytes(), df[rows].tobytes(), tallies(tf[rows]), b""))
        return pa.table(*_work(out))

    def sample(table):
        import pyarrow as pa

        release()
        is_whole = np.array([len(x) > 0 for x in table.column("whole").to_pylist()], bool)
        at_whole, at_shared = table.filter(pa.array(is_whole)), table.filter(pa.array(~is_whole))
        ids, first_row = np.unique(join(at_whole, "ids", np.int64), return_index=True)
        whole_tf = join(at_whole, "whole", np.float64)[first_row]
        owner = np.searchsorted(ids, np.repeat(join(at_shared, "ids", np.int64), join(at_shared, "counts", np.uint32)))
        h, df = join(at_shared, "hashes", np.uint64), join(at_shared, "df", np.uint32)
        tf = from_tallies(at_shared.column("tf").to_pylist(), [len(x) // 8 for x in at_shared.column("hashes").to_pylist()])
        logtf = 1 + np.log(tf)
        w = (logtf * idf(df)).astype(np.float32).astype(np.float64)
        shared = np.bincount(owner, weights=w, minlength=len(ids))
        whole = shared + np.maximum(whole_tf - np.bincount(owner, weights=logtf, minlength=len(ids)), 0) * idf(1)
        fit = shared >= (threshold - 1e-6) * whole
        fit &= shared > 0
        keep = np.flatnonzero(fit[owner])
        keep = keep[np.lexsort((h[keep], owner[keep]))]
        owner, h, w, rarity = owner[keep], h[keep], w[keep], np.minimum(np.log2(df[keep]) * 6, 255).astype(np.uint8)
        who, starts = np.unique(owner, return_index=True)
        ends = np.append(starts[1:], len(owner))[: len(starts)]
        keys = sampler.bands_of(h, w, starts).view(np.int64) if len(who) else np.zeros((0, bands), np.int64)
        digest = np.zeros(len(who), np.uint64)
        if len(who):
            digest = np.add.reduceat(mix(h + np.round(w * 4096).astype(np.uint64) * U64(0x9E37)), starts) + np.round(whole[who] * 1024).astype(np.uint64) * U64(0x85EBCA6B)
            alone = whole[who] - shared[who] > 1e-6 * whole[who]  # has shingles of its own, so it equals no other
            digest[alone] = mix(ids[who][alone].astype(np.uint64) + U64(_BASE))
        return pa.table(
            {
                "doc_id": pa.array(ids[who], pa.int64()),
                "content": pa.array(digest.view(np.int64), pa.int64()),
                "size": pa.array(ends - starts, pa.int64()),
                "whole": pa.array(whole[who], pa.float64()),
                "hashes": pa.array([h[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()),
                "weights": pa.array([w[i:j].astype(np.float32).tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()),
                "rarity": pa.array([rarity[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()),
                "bands": pa.array(keys.tolist(), pa.list_(pa.int64())),
            }
        )

    source = docs.select("doc_id", F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary").alias("data"))
    schema = "doc_id long, content long, size long, whole double, hashes binary, weights binary, rarity binary, bands array<long>"
    shared = source.mapInArrow(emit, WORK).groupBy("to").applyInArrow(count, WORK)
    return shared.groupBy("to").applyInArrow(sample, schema)


def probe(pairs: DataFrame, body: DataFrame, threshold: float) -> DataFrame:
    """a, b, near (weighted Jaccard reaches the threshold), held, rest and meets for the rows (a, b) of `pairs`.

    `held` is the weight of b in a, `rest` that of its residue. `meets` are keys of b under the leader a: windows of its weight
    if a holds `threshold` of it (odd), and the shingles of the prefix of its residue (even). Two members that are similar share one of them."""
    of = lambda x: body.select(F.col("doc_id").alias(x), F.struct("whole", "hashes", "weights", "rarity").alias(f"of_{x}"))

    def read(s):
        return np.frombuffer(s["hashes"], np.uint64), np.frombuffer(s["weights"], np.float32).astype(float), np.frombuffer(s["rarity"], np.uint8), s["whole"]

    def check(batches):
        import pyarrow as pa

        for batch in batches:
            near, weights, rests, meets = [], [], [], []
            for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
                (ha, wa, _, all_a), (hb, wb, rare, all_b) = read(x.as_py()), read(y.as_py())
                at = np.minimum(np.searchsorted(ha, hb), len(ha) - 1)
                held = np.where(ha[at] == hb, np.minimum(wa[at], wb), 0.0)
                both, slack = float(held.sum()), 1e-5 * all_b
                near.append(both >= threshold * (all_a + all_b - both))
                weights.append(both)
                rest = wb - held
                rests.append(float(rest.sum()))
                left = np.flatnonzero(rest > 1e-6)
                left = left[np.lexsort((hb[left], rare[left]))]
                after = np.cumsum(rest[left][::-1])[::-1]  # the weight from this shingle on
                keys = mix(hb[left[after >= threshold * all_b - both - slack]]) & ~U64(1)
                if both >= threshold * all_b - slack:
                    window = int(np.floor(np.log(all_b) / -np.log(threshold)))
                    keys = np.append(keys, mix(np.array([window % 2**32, (window + 1) % 2**32], np.uint64)) | U64(1))
                meets.append(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_()), pa.array(weights), pa.array(rests), pa.array(meets, pa.list_(pa.int64()))], ["a", "b", "near", "held", "rest", "meets"])

    # `body` lies by doc_id, so the members are joined where they lie. The leaders asked for are taken out of it first: a leader of
    # a large family is a hot key, and only a join that deals both of its sides anew is split there.
    leaders = cut(of("a").join(pairs.select("a").distinct(), "a", "left_semi"))
    members = pairs.select("a", "b").join(of("b"), "b")
    with arrow_rows(body.sparkSession, 256):
        told = cut(members.join(leaders, "a").select("a", "b", "of_a", "of_b").mapInArrow(check, "a long, b long, near boolean, held double, rest double, meets array<long>"))
    discard(leaders)
    return told


def classes(sketch: DataFrame, threshold: float, few: int = 16) -> DataFrame:
    """node, component over the representatives of equal contents, for those that have a partner.

    `few` members or fewer of a group are compared pair by pair; more of them by a leader and the keys that `probe` gives.
    It doubles from round to round, so that rounds are few also where a leader parts a group from little."""
    reps = sketch.groupBy("content", "size").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    body = cut_by(sketch.join(reps, "doc_id", "left_semi"), "doc_id")  # every probe joins it twice, and does not move it
    seats = body.select(F.posexplode("bands").alias("band", "key"), "doc_id", "whole").select(F.xxhash64("band", "key").alias("bucket"), "doc_id", "whole", F.col("whole").alias("held"), F.lit(0.0).alias("rest"))
    sizes = cut(seats.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    seats = cut(seats.join(sizes, "bucket"))
    degree = cut(seats.groupBy("doc_id").agg(F.sum("n").alias("degree")))
    seats = seats.drop("n")
    home = cut(_homes(seats, degree))
    first = home.select(F.col("home").alias("a"), F.col("doc_id").alias("b"))
    edges = cut(probe(first, body, threshold).where("near").select("a", "b"))
    label = cut(connected_components(edges))
    while True:
        split = None if seats.isEmpty() else cut(_mixed(seats, label))
        if split is None or split.isEmpty():
            discard(body)
            return label
        sizes = cut(split.groupBy("bucket").agg(F.count("*").alias("n")))
        sized = cut(split.join(sizes, "bucket"))
        small, large = sized.where(F.col("n") <= few), sized.where(F.col("n") > few)
        x, y = (small.select("bucket", *(F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "label", "whole", "held", "rest"))) for side in "xy")
        room = F.least("held_x", "held_y") + F.least("rest_x", "rest_y") >= (threshold / (1 + threshold) - 1e-5) * (F.col("whole_x") + F.col("whole_y"))
        pairs = x.join(y, "bucket").where("doc_id_x < doc_id_y AND label_x <> label_y").where(room).select(F.col("doc_id_x").alias("a"), F.col("doc_id_y").alias("b"), F.lit(False).alias("star"))
        led = cut(_led(large, home if home is not None else _homes(large, degree)))
        asked = cut(pairs.union(led.select("a", "b", F.lit(True))).groupBy("a", "b").agg(F.max("star").alias("star")))
        told = probe(asked, body, threshold)
        named = lambda x: label.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))  # noqa: B023, E731
        fresh = told.where("near").select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left")
        links = fresh.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).where("a <> b").distinct()
        links = cut(links)
        if not links.isEmpty():
            merged = cut(connected_components(links))
            known = label.union(merged.select("node", F.col("node").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
            label = cut(known.join(merged.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select("node", F.coalesce("root", "component").alias("component")))
        keys = told.join(led, ["a", "b"]).select("a", F.explode("meets").alias("key"), F.col("b").alias("doc_id"), "whole", "held", "rest")
        keys = keys.select(F.xxhash64("a", "key").alias("bucket"), "doc_id", "whole", "held", F.when(F.col("key") % 2 == 0, F.col("rest")).otherwise(0.0).alias("rest"))
        discard(seats)
        seats = cut(_roomy(cut(keys), threshold))
        discard(split, sizes, sized, led, asked, told)
        home, few = None, 2 * few


def _roomy(seats: DataFrame, threshold: float) -> DataFrame:
    """The seats that leave room for a similar member: even the lightest other one must not be too heavy for what both can share."""
    least = cut(seats.groupBy("bucket").agg(F.min("whole").alias("least"), F.count("*").alias("n")).where("n > 1"))
    room = (F.col("held") + F.col("rest")) * ((1 + threshold) / threshold) - F.col("whole") >= F.col("least") * (1 - 1e-4)
    return seats.join(least, "bucket").where(room).drop("least", "n")


def _homes(seats: DataFrame, degree: DataFrame) -> DataFrame:
    """doc_id, home: of the other members that lead the document's buckets, the one it meets most. A bucket is led by its member of the highest degree."""
    ranked = seats.select("bucket", "doc_id").join(degree, "doc_id")
    leaders = cut(ranked.groupBy("bucket").agg(F.max_by("doc_id", F.struct("degree", -F.col("doc_id"))).alias("a")))
    met = seats.join(leaders, "bucket").where("doc_id <> a").groupBy("doc_id", "a").agg(F.count("*").alias("n"))
    return met.groupBy("doc_id").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("home"))


def _led(seats: DataFrame, home: DataFrame) -> DataFrame:
    """a, b, whole: the members b of buckets under the leader a, the commonest home in a bucket, so that one leader serves the many buckets of a family."""
    housed = seats.select("bucket", "doc_id").join(home, "doc_id")
    votes = housed.groupBy("bucket", "home").agg(F.count("*").alias("n"))
    leaders = cut(votes.groupBy("bucket").agg(F.max_by("home", F.struct("n", -F.col("home"))).alias("a")))
    members = seats.select("bucket", F.col("doc_id").alias("b"), "whole")
    return members.join(leaders, "bucket").where("a <> b").select("a", "b", "whole").distinct()


def _mixed(seats: DataFrame, label: DataFrame) -> DataFrame:
    """The seats, with their documents' labels, in buckets that hold more than one class."""
    held = cut(seats.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component"))
    mixed = cut(held.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("bucket"))
    return held.join(mixed, "bucket")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5, bands: int = 20, rows: int = 4, damping: float = 0.5, batch_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, class_id (the class's smallest doc_id), class_size (its distinct documents) and kept (doc_id = class_id) for each row of `docs` (doc_id, text)."""
    ship(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    sketch = cut(sketches(keyed.select(F.col("key").alias("doc_id"), "text"), width, threshold, bands, rows, damping, batch_bytes))
    found = classes(sketch, threshold)
    rep = cut(sketch.groupBy("content", "size").agg(F.min("doc_id").alias("rep")))
    rep = cut(rep.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("content", "size", F.coalesce("component", "rep").alias("class")))
    member = cut(sketch.select("doc_id", "content", "size").join(rep, ["content", "size"]).select(F.col("doc_id").alias("key"), "class"))
    discard(sketch)
    marked = cut(keyed.select("doc_id", "key").join(member, "key", "left").select("doc_id", "key", F.coalesce("class", "key").alias("class")))
    sizes = cut(marked.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count_distinct("key").alias("class_size")))
    return marked.join(sizes, "class").select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
