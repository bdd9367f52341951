"""Embedding near-duplicates with an inverted multi-index.

Equal vectors of a label are first one point with a count. Codebooks for the two vector halves are trained on a bounded
sample; every point of the table gets a cell of their product grid. A point visits cells in the order of a lower bound on
its distance to anything in the cell (per half, the distance to the hyperplane between the cell's and the point's own
codeword; halves add up in squares) and stops where the bound passes the distance that the cosine threshold allows: there
the recall is one. Neighbouring cells make a region, and a point is sent once to each region that has a cell it visits. The
pairs met are verified in double precision. Regions and visitors are cut into blocks by hash, so a hot region is shared
between tasks, and a block reports per point its number of links and its smallest linked point within
the block's own components, never pairs.

Edge cases: vectors that are null, empty, zero, not of the table's commonest length, or hold null or non-finite
components, and vectors without a label, link with nothing (0 links, their own component, kept). Repeated rows are
vectors each and link with one another. A null vec_id links with nothing. An empty table gives no rows; other columns of the input are left out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import connected_components, cut, matrix, ship, usable, usual_length


def train_codebook(points: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """k-means centres (fewer if there are fewer distinct points)."""
    points = np.unique(points, axis=0)
    centres = points[np.random.default_rng(seed).choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = points[near == c].mean(0)
    return centres


def bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's codeword, and its distance to each codeword's region at least (0 for its own)."""
    d2 = (points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T
    own = d2.argmin(1)
    apart = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(2), 0))
    gap = d2 - d2[np.arange(len(points)), own][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        low = np.where(apart[own] > 0, gap / (2 * apart[own]), 0.0)
    return own, np.maximum(low - 1e-9, 0)


def traversal(low1: np.ndarray, low2: np.ndarray, reach2: float) -> list[np.ndarray]:
    """Per point the cells (i * k2 + j), by growing bound, until the bound passes `reach2`."""
    both = (low1[:, :, None] ** 2 + low2[:, None, :] ** 2).reshape(len(low1), -1)
    order = np.argsort(both, axis=1, kind="stable")
    counts = (both <= reach2).sum(1)
    return [o[:n] for o, n in zip(order, counts, strict=True)]


def block_links(home: np.ndarray, home_ids: np.ndarray, home_n: np.ndarray, guests: np.ndarray, guest_ids: np.ndarray, threshold: float, step: int = 256):
    """(id, links, smallest id in the block's component) of the guests, and of the home points with links 0. Guests are compared `step` at a time."""
    linked = np.zeros((len(guests), len(home)), bool)
    steps = [slice(i, i + step) for i in range(0, len(guests), step)]
    links = np.zeros(len(guests), np.int64)
    for s in steps:
        linked[s] = (guests[s] @ home.T) >= threshold
        linked[s] &= guest_ids[s, None] != home_ids[None]
        links[s] = linked[s] @ home_n
    some = links > 0
    mine, theirs = guest_ids.copy(), home_ids.copy()
    top = np.iinfo(np.int64).max
    near = linked[some]
    while len(near):
        before = mine, theirs
        least, theirs = mine[some], theirs.copy()
        for i in range(0, len(near), step):
            theirs = np.minimum(theirs, np.where(near[i : i + step], least[i : i + step, None], top).min(0, initial=top))
        mine = mine.copy()
        mine[some] = np.minimum(least, np.concatenate([np.where(near[i : i + step], theirs[None], top).min(1, initial=top) for i in range(0, len(near), step)]))
        if (before[0] == mine).all() and (before[1] == theirs).all():
            break
    told = theirs != home_ids
    return np.concatenate([guest_ids[some], home_ids[told]]), np.concatenate([links[some], np.zeros(told.sum(), np.int64)]), np.concatenate([mine[some], theirs[told]])


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, sample_rows: int = 20_000, cell_rows: int = 128, block_rows: int = 8192, guest_rows: int = 8192) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of `vectors` (vec_id, embedding, label); `sample_rows` bounds the codebooks' training sample."""
    ship(vectors.sparkSession)
    dim = usual_length(vectors)
    made = dict(vectors.dtypes)["embedding"]
    made = made if made in ("array<float>", "array<double>") else "array<double>"  # floats stay floats until they are compared
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(made), "label")
    fine = usable() & (F.size("embedding") == dim) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumns({"point": F.when(fine, F.xxhash64("embedding")), "twin": F.when(fine, F.xxhash64("embedding", F.lit(1)))})
    points = cut(rows.where("point IS NOT NULL").groupBy("label", "point", "twin", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    size = points.agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")).first()
    sample = points.select("embedding").where(F.rand(5) < min(1.0, 1.5 * sample_rows / max(1, size["n"]))).limit(sample_rows)
    sample = np.array([r[0] for r in sample.collect()], dtype=float).reshape(-1, max(dim, 1))
    if not len(sample):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    words = min(32, max(2, round(math.sqrt(size["n"] / max(1, size["labels"]) / cell_rows))))
    half = max(1, dim // 2)
    book1, book2 = train_codebook(sample[:, :half], words), train_codebook(sample[:, half:], words) if dim > half else np.zeros((1, 0))
    reach2 = 2 - 2 * threshold + 1e-9
    # Neighbouring cells make a region of about `block_rows` points; a point is sent once to a region in which it visits any cell.
    regions = max(1, math.ceil(size["n"] / max(1, size["labels"]) / block_rows))
    wide = math.ceil(len(book1) * len(book2) / regions)

    def visit(batches):
        import pyarrow as pa

        for b in batches:
            x = matrix(b.column(1))
            if not len(x):
                continue
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            own1, low1 = bounds(x[:, :half], book1)
            own2, low2 = bounds(x[:, half:], book2)
            cells = traversal(low1, low2, reach2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), b.column(1), pa.array((own1 * len(book2) + own2) // wide, pa.int64()), pa.array([np.unique(c // wide).tolist() for c in cells], pa.list_(pa.int64()))],
                ["rep", "n", "label", "embedding", "region", "visits"],
            )

    kind = dict(points.dtypes)["label"]
    indexed = cut(points.select("rep", "embedding", "n", "label").mapInArrow(visit, f"rep long, n long, label {kind}, embedding {made}, region long, visits array<long>"))
    homes = indexed.groupBy("label", "region").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    going = indexed.select("label", "rep", F.explode("visits").alias("region"))
    guests = going.groupBy("label", "region").agg(F.ceil(F.count("*") / guest_rows).cast("int").alias("groups"))
    cells = cut(homes.join(guests, ["label", "region"]))
    spot = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    home = indexed.join(cells, ["label", "region"]).select("label", "region", spot("blocks", 1).alias("block"), every("groups").alias("group"), F.lit(True).alias("home"), "rep", "n", "embedding")
    guest = (
        indexed.select("label", "rep", "n", "embedding", F.explode("visits").alias("region"))
        .join(cells, ["label", "region"])
        .select("label", "region", every("blocks").alias("block"), spot("groups", 2).alias("group"), F.lit(False).alias("home"), "rep", "n", "embedding")
    )

    def verify(table):
        import pyarrow as pa

        at_home = table.column("home").to_numpy(zero_copy_only=False)
        ids, n, x = table.column("rep").to_numpy(), table.column("n").to_numpy(), matrix(table.column("embedding"))
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        found = block_links(x[at_home], ids[at_home], n[at_home], x[~at_home], ids[~at_home], threshold)
        return pa.table({"rep": pa.array(found[0], pa.int64()), "links": pa.array(found[1], pa.int64()), "least": pa.array(found[2], pa.int64())})

    found = cut(home.union(guest).groupBy("label", "region", "block", "group").applyInArrow(verify, "rep long, links long, least long"))
    components = connected_components(found.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    about = cut(
        points.select("label", "point", "twin", "rep", "n")
        .join(links, "rep", "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "point", "twin", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    # Rows find their points by two hashes of the vector: 128 bits are moved, not the vectors.
    return rows.select("vec_id", "label", "point", "twin").join(about, ["label", "point", "twin"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
