"""Removal of repeated passages by sorting suffixes, over all documents.

A byte goes if it is covered by a string of `window` bytes that starts anywhere else as well. Sorting every suffix of the
corpus would move it many times over, so the suffixes to sort are found first, without loss: among the `gram`-byte strings
in a window the one of least hash is its anchor. Two equal windows have equal anchors at equal offsets, so
only windows around anchors that occur twice can repeat.

1. Anchored suffixes (8 leading bytes, hash of the gram, hash of all bytes that any window of this anchor can touch) are
   range-partitioned by their leading bytes at sampled splitters. Each bucket sorts by multikey quicksort: by the first
   key, then only the runs of ties by the next. Equal neighbours share the gram; if their surroundings are equal too, all
   windows of the anchor repeat and nothing else need be asked.
2. Where a gram has different surroundings, its windows are sorted in the same way (8 leading bytes, then a hash of the
   window), and neighbours that are equal repeat. Splitters cut between keys, so equal suffixes never straddle a boundary.

Documents are dealt by hash into batches of bounded size. A batch sends each distinct key once, however many copies it
has, and gets one answer for it: a passage in a third of all documents is a few rows per batch for any bucket.
Hashes are 64 bits beside the 8 leading bytes. Long texts go through in overlapping slices of fixed length.

Edge cases: a null text is empty; an empty or short text (under `window` bytes) loses nothing; a null doc_id is kept as
such; repeated rows are each other's repeats; an empty table gives no rows; only the columns named in `keep` are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import batches_for, release, ship

U64 = np.uint64
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
SLICE = 1 << 16


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(31))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(29))


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of x[i : i + width], by doubling; the result is `width - 1` shorter."""
    op, span = (np.minimum if least else np.maximum), 1
    out = x
    while 2 * span <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return op(out[: len(out) - rest], out[rest:]) if rest else out


class Slice:
    """Anchors of one slice of a batch's concatenated bytes; positions are those of the batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, at: int, window: int, gram: int):
        reach = window - gram  # how far a window starts before its anchor
        lo, hi = max(0, at - 2 * window), min(len(data), at + SLICE + 2 * window)
        b = data[lo:hi]
        n = len(b)
        first = np.searchsorted(offsets, lo, side="right") - 1
        last = np.searchsorted(offsets, hi, side="left")
        lengths = np.diff(np.clip(offsets[first : last + 1], lo, hi))
        self.end = np.repeat(np.clip(offsets[first + 1 : last + 1], None, len(data)), lengths)
        self.start = np.repeat(offsets[first:last], lengths)
        self.lo, self.b, self.window = lo, b, window
        power, self.inverse = _table(n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * power[:n], dtype=np.uint64)])
        index = np.arange(lo, hi)
        h = np.full(n + reach, U64(2**64 - 1), dtype=np.uint64)
        if n >= gram:
            h[: n - gram + 1] = np.where(index[: n - gram + 1] + gram <= self.end[: n - gram + 1], mix(self._hash(slice(0, n - gram + 1), gram)) >> U64(1), U64(2**64 - 1))
        least = sliding(h, reach + 1, True)
        least[index + window > self.end] = 0  # no window starts here
        self.least = least
        most = sliding(np.concatenate([np.zeros(reach, np.uint64), least]), reach + 1, False)
        chosen = np.flatnonzero((most == h[:n]) & (most > 0))
        gram_hash = h[chosen]
        # the next anchor of the same gram takes the windows that hold both
        order = np.lexsort((chosen, gram_hash))
        after = np.full(len(chosen), n + window)
        same = gram_hash[order[:-1]] == gram_hash[order[1:]]
        after[order[:-1][same]] = chosen[order[1:][same]]
        core = (chosen + lo >= at) & (chosen + lo < at + SLICE)
        self.p, self.h, self.after = chosen[core], gram_hash[core], after[core]
        left = np.maximum(self.p + lo - reach, self.start[self.p]) - lo
        right = np.minimum(self.p + lo + window, self.end[self.p]) - lo
        around = (self.sums[right] - self.sums[left]) * self.inverse[left]
        self.around = mix(around + U64(0x51ED270B) * (self.p - left).astype(np.uint64) + U64(0x2545F491) * (right - self.p).astype(np.uint64))
        self.key = mix(self.h * U64(3) + self.around)
        self.reach = reach

    def _hash(self, at, length: int) -> np.ndarray:
        if isinstance(at, slice):
            return (self.sums[at.start + length : at.stop + length] - self.sums[at]) * self.inverse[at]
        return (self.sums[at + length] - self.sums[at]) * self.inverse[at]

    def lead(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.uint64)
        for j in range(8):
            out = (out << U64(8)) | self.b[at + j].astype(np.uint64)
        return out

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into `which`, start in the slice) of every window whose anchor is one of the anchors `which`."""
        p = self.p[which]
        starts = p[:, None] - np.arange(self.reach + 1)[None]
        mine = (starts >= 0) & (starts + self.reach < self.after[which][:, None])
        mine &= self.least[np.maximum(starts, 0)] == self.h[which][:, None]
        owner, back = np.nonzero(mine)
        return owner, p[owner] - back

    def window_keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leading bytes, hash of lead and window)."""
        lead = self.lead(starts)
        return lead, mix(mix(self._hash(starts, self.window)) + lead * U64(5))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS[size] = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _POWERS[size]


def slices(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Iterator[Slice]:
    for at in range(0, len(data), SLICE):
        yield Slice(data, offsets, at, window, gram)


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow binary column as its concatenated bytes and their offsets."""
    import pyarrow as pa

    column = column.cast(pa.large_binary()).combine_chunks() if not isinstance(column, pa.Array) else column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order by the first key, then ties by the second and so on: quicksort of all rows by one key, then only of the runs that are still equal."""
    order = np.argsort(keys[0])
    run = np.cumsum(np.concatenate([[False], keys[0][order][1:] != keys[0][order][:-1]])) if len(order) else np.zeros(0, np.int64)
    for key in keys[1:]:
        open_ = np.zeros(len(order), bool)
        open_[1:] |= run[1:] == run[:-1]
        open_[:-1] |= run[1:] == run[:-1]
        at = np.flatnonzero(open_)
        order[at] = order[at][np.lexsort((key[order[at]], run[at]))]
        sorted_key = key[order]
        run = np.cumsum(np.concatenate([[False], (run[1:] != run[:-1]) | (sorted_key[1:] != sorted_key[:-1])])) if len(order) else run
    return order


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Of sorted rows: index of each row's group."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _send(bucket: np.ndarray, columns: Sequence[np.ndarray | None], batch: int, names: Sequence[str]):
    """One row per bucket that has rows: (bucket, batch, and each column as bytes)."""
    import pyarrow as pa

    order = np.argsort(bucket, kind="stable")
    ids, at = np.unique(bucket[order], return_index=True)
    cuts = [*at.tolist(), len(order)]
    out = {"to": pa.array(ids.astype(np.int32)), "back": pa.array(np.full(len(ids), batch, np.int32))}
    for name, c in zip(names, columns, strict=True):
        c = c[order] if c is not None else np.zeros(0, np.uint8)
        out[name] = pa.array([c[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
    return pa.table(out)


def _gather(table, names: Sequence[tuple[str, type]]) -> tuple[np.ndarray, ...]:
    """The rows of `_send` again, with each row's sender."""
    columns = [np.frombuffer(b"".join(table.column(n).to_pylist()), dtype=t) for n, t in names]
    sizes = [len(x) // np.dtype(names[0][1]).itemsize for x in table.column(names[0][0]).to_pylist()]
    return np.repeat(table.column("back").to_numpy(), sizes), *columns


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one row per distinct key, and whether there were more."""
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return first, count > 1


ASK = "to int, back int, lead binary, gram binary, around binary, more binary"
TELL = "batch int, kind int, bucket int, keys binary, codes binary"
ALL, SOME = 1, 2  # all windows of this anchor repeat; some may


def remove_repeats(docs: DataFrame, window: int = 200, gram: int = 64, keep: Sequence[str] = (), with_text: bool = False, batch_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of `docs` (doc_id, text), with the columns `keep`; `with_text` adds `kept`, the bytes left as text (cut characters are left out)."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    n = batches_for(docs, F.octet_length("text"), batch_bytes)
    splitters = sample_splitters(docs, n)
    base = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("batch"), "doc_id", text.alias("data"), *keep)
    bucket_of = lambda lead: np.searchsorted(splitters, lead, side="right")

    def ask(table):
        release()
        data, offsets = bytes_of(table.column("data"))
        lead, h, around, key = [], [], [], []
        for s in slices(data, offsets, window, gram):
            lead.append(s.lead(s.p)), h.append(s.h), around.append(s.around), key.append(s.key)
        if not key:
            key, lead, h, around = ([np.zeros(0, np.uint64)] for _ in range(4))
        first, more = _distinct(np.concatenate(key))
        lead, h, around = (np.concatenate(x)[first] for x in (lead, h, around))
        return _send(bucket_of(lead), (lead, h, around, more), table.column("batch")[0].as_py(), ("lead", "gram", "around", "more"))

    def answer(table):
        release()
        back, lead, h, around, more = _gather(table, (("lead", np.uint64), ("gram", np.uint64), ("around", np.uint64), ("more", np.bool_)))
        order = multikey_order(lead, h, around)
        back, lead, h, around, more = (x[order] for x in (back, lead, h, around, more))
        group, kind = _firsts(lead, h), _firsts(lead, h, around)
        total = np.bincount(kind, weights=1 + more, minlength=1)[kind] > 1
        kinds = np.bincount(group, weights=np.concatenate([[1], np.diff(kind)]) if len(kind) else None, minlength=1)[group]
        code = np.where(total, ALL, 0) + np.where(kinds > 1, SOME, 0)
        code[(kinds == 1) & ~total] = 0
        return _tell(back, mix(h * U64(3) + around), code.astype(np.uint8))

    def ask_windows(docs_table, told):
        release()
        data, offsets = bytes_of(docs_table.column("data"))
        _, _, settled, lead, key = windows_of(data, offsets, _codes(told), window, gram)
        (lead, key, count), inverse = _runs(lead, key)
        more = (count > 1) | (np.bincount(inverse, weights=settled, minlength=len(key)) > 0)
        batch = docs_table.column("batch")[0].as_py() if docs_table.num_rows else 0
        return _send(bucket_of(lead), (_differences(lead, bucket_of(lead)), key, None, more), batch, ("lead", "gram", "around", "more"))

    def answer_windows(table):
        import pyarrow as pa

        release()
        _, key, more = _gather(table, (("gram", np.uint64), ("more", np.bool_)))
        lead = np.concatenate([np.cumsum(np.frombuffer(x, np.uint64), dtype=np.uint64) for x in table.column("lead").to_pylist()])
        order = multikey_order(lead, key)
        run = _firsts(lead[order], key[order])
        again = np.empty(len(key), bool)
        again[order] = np.bincount(run, weights=1 + more[order], minlength=1)[run] > 1
        ends = np.cumsum([len(x) for x in table.column("more").to_pylist()])
        bits = [np.packbits(part).tobytes() for part in np.split(again, ends[:-1])]
        n = table.num_rows
        return pa.table(
            {"batch": table.column("back"), "kind": pa.array([2] * n, pa.int32()), "bucket": table.column("to"), "keys": pa.array([b""] * n, pa.binary()), "codes": pa.array(bits, pa.binary())}
        )

    def finish(docs_table, told):
        import pyarrow as pa

        release()
        data, offsets = bytes_of(docs_table.column("data"))
        sure, starts, settled, lead, key = windows_of(data, offsets, _codes(told), window, gram)
        (lead, key, _), inverse = _runs(lead, key)
        repeats = _bits(told, bucket_of(lead))
        covered = np.zeros(len(data) + 1, np.int32)
        for at in (sure, starts[settled | repeats[inverse]]):
            np.add.at(covered, at, 1)
            np.add.at(covered, at + window, -1)
        del sure, starts, settled, lead, key, inverse, repeats, at
        lost = np.cumsum(covered[:-1], dtype=np.int32) > 0
        del covered
        rows = docs_table.num_rows
        removed, spans, sha, texts = np.zeros(rows, np.int64), np.zeros(rows, np.int64), [], []
        for r in range(rows):
            a, b = offsets[r], offsets[r + 1]
            gone = lost[a:b]
            removed[r] = gone.sum()
            spans[r] = np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0])
            left = data[a:b].tobytes() if not removed[r] else data[a:b][~gone].tobytes()
            sha.append(hashlib.sha256(left).hexdigest())
            if with_text:
                texts.append(left.decode("utf-8", "ignore"))
        out = {"doc_id": docs_table.column("doc_id"), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed), "n_spans": pa.array(spans), "kept_sha256": pa.array(sha, pa.string())}
        out |= {c: docs_table.column(c) for c in keep} | ({"kept": pa.array(texts, pa.string())} if with_text else {})
        return pa.table(out)

    by = lambda df, key="batch": df.groupBy(key)
    told = by(by(base).applyInArrow(ask, ASK), "to").applyInArrow(answer, TELL)
    asked = by(base).cogroup(by(told)).applyInArrow(ask_windows, ASK)
    again = by(asked, "to").applyInArrow(answer_windows, TELL)
    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + "".join(f", `{c}` {kinds[c]}" for c in keep) + (", kept string" if with_text else "")
    return by(base).cogroup(by(told.union(again))).applyInArrow(finish, schema)


def windows_of(data: np.ndarray, offsets: np.ndarray, code_of, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(starts of windows that repeat for sure and need not be asked; and of those to ask: starts, whether they repeat for sure, leading bytes, hashes)."""
    sure, starts, settled, lead, key = [], [], [], [], []
    for s in slices(data, offsets, window, gram):
        code = code_of(s.key)
        hit = np.flatnonzero(code)
        owner, at = s.windows(hit)
        some = code[hit][owner] & SOME > 0
        sure.append(at[~some] + s.lo)
        a, b = s.window_keys(at[some])
        starts.append(at[some] + s.lo), settled.append(code[hit][owner[some]] & ALL > 0), lead.append(a), key.append(b)
    if not sure:
        return (*(np.zeros(0, np.int64),) * 2, np.zeros(0, bool), *(np.zeros(0, np.uint64),) * 2)
    return tuple(np.concatenate(x) for x in (sure, starts, settled, lead, key))


def _runs(lead: np.ndarray, key: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Distinct (lead, key) in order with their counts, and of each row the index there."""
    order = multikey_order(lead, key)
    run = _firsts(lead[order], key[order])
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
    inverse = np.empty(len(run), np.int64)
    inverse[order] = run
    return (lead[order][first], key[order][first], np.diff(np.append(first, len(run)))), inverse


def _differences(lead: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Sorted leading bytes as steps within each bucket, which compress well."""
    steps = lead.copy()
    steps[1:] -= lead[:-1]
    new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(lead) else np.zeros(0, np.int64)
    steps[new] = lead[new]
    return steps


def _bits(told, bucket: np.ndarray) -> np.ndarray:
    """The answers about windows, in the order in which they were asked: by bucket, then as sent."""
    kinds, buckets, codes = (told.column(c).to_pylist() for c in ("kind", "bucket", "codes"))
    by = {b: c for k, b, c in zip(kinds, buckets, codes, strict=True) if k == 2}
    ids, counts = np.unique(bucket, return_counts=True)
    parts = [np.unpackbits(np.frombuffer(by[int(b)], np.uint8), count=int(n)).astype(bool) for b, n in zip(ids, counts, strict=True)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _tell(back: np.ndarray, key: np.ndarray, code: np.ndarray):
    """Answers that say something, one row per asking batch."""
    import pyarrow as pa

    some = np.flatnonzero(code)
    some = some[np.argsort(back[some], kind="stable")]
    ids, at = np.unique(back[some], return_index=True)
    cuts = [*at.tolist(), len(some)]
    pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.table(
        {
            "batch": pa.array(ids.astype(np.int32), pa.int32()),
            "kind": pa.array(np.full(len(ids), 1, np.int32)),
            "bucket": pa.array(np.zeros(len(ids), np.int32)),
            "keys": pa.array([key[some[i:j]].tobytes() for i, j in pieces], pa.binary()),
            "codes": pa.array([code[some[i:j]].tobytes() for i, j in pieces], pa.binary()),
        }
    )


def _codes(told):
    """The answers about anchors as a function from keys to codes (0: no answer)."""
    rows = [r for r, k in enumerate(told.column("kind").to_pylist()) if k == 1]
    keys, codes = told.column("keys"), told.column("codes")
    key = np.frombuffer(b"".join(keys[r].as_py() for r in rows), dtype=np.uint64)
    code = np.frombuffer(b"".join(codes[r].as_py() for r in rows), dtype=np.uint8)
    order = np.argsort(key, kind="stable")
    key, code = key[order], code[order]

    def of(asked: np.ndarray) -> np.ndarray:
        if not len(key):
            return np.zeros(len(asked), np.uint8)
        at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
        return np.where(key[at] == asked, code[at], 0).astype(np.uint8)

    return of


def sample_splitters(docs: DataFrame, buckets: int, rows: int = 256, each: int = 64) -> np.ndarray:
    """Leading 8 bytes that cut suffixes into about equal parts, from `each` positions of at most `rows` documents. They only balance the buckets."""
    pick = F.transform(
        F.sequence(F.lit(0), F.lit(each - 1)), lambda i: F.substring(F.col("data"), (F.octet_length("data") * i / each).cast("int") + 1, F.lit(8))
    )
    data = docs.where("length(text) >= 64").select(F.col("text").cast("binary").alias("data")).where(F.rand(3) < 0.05)
    some = data.select(pick.alias("leads")).limit(rows).collect()
    leads = np.array(sorted(int.from_bytes(bytes(x)[:8].ljust(8, b"\0"), "big") for r in some for x in r["leads"]), dtype=np.uint64)
    if not len(leads):
        return leads
    return np.unique(leads[np.linspace(0, len(leads) - 1, buckets + 1).astype(int)[1:-1]])
