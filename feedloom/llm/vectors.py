"""Embedding near-duplicates by sorted projection passes.

In each pass the signs of random projections are concatenated to a code, the
vectors are put in order of their codes by a range partitioned sort, and each is
compared with a bounded window of vectors after it, by cosine in double precision.
Pairs at or above the threshold are united across passes to components.

Vectors are centred before they are projected, as a direction that all share tells
nothing apart; cosines are those of the vectors as they are. Width of the window and
number of passes are measured, not assumed: for a bounded sample of vectors, neighbours
at the threshold are made up from the spread of the vectors around them, all vectors
are counted that stand between the two in some trial passes, and window and passes are
chosen such that a pair that no other link of its vectors holds together meets with
chance ``1 - MISS``. Dense or lopsided data therefore take wider windows and more passes.

All links of a vector lie in its component, and are counted there exactly. By
the triangle inequality two vectors within half the threshold angle of the
component's centre are linked, so such a core needs no comparison; the others are
compared with their whole component, in blocks. A component that a hot vector or
thousands of near copies make is spread over as many tasks as it has blocks.

Vectors that are null, zero or empty, or hold null or non-finite components, link
with nothing, neither do vectors of different lengths. Null ids link with nothing
either. Equal vectors are linked. A repeated id is taken once, with the least of
its vectors. Ties in a code go by id. An empty table gives an empty result; only
the id and vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.components import Forest, components
from feedloom.staging import stage

THRESHOLD = 0.9
#: Widths a window may have.
WINDOWS = (128, 512, 2048, 8192)
#: Chance that a pair exactly at the threshold meets in no pass.
MISS = 1e-3
#: Vectors whose surroundings are measured, trial passes, and links that make a vector safe.
SAMPLE, TRIALS, SAFE_LINKS = 512, 24, 4
#: Sampled vectors of similar density that are judged together.
_GROUP = 64
#: Lengths of vectors, the most common ones, that are centred and measured.
_DIMS = 16
#: Most passes whose codes are shuffled at once.
PASS_GROUP = 8
CODE_BITS = 60
SEED = 20240131
MEMBER_BLOCK, OUTER_BLOCK = 4096, 512
_ROWS = 256
#: Angles nearer than this to a bound are compared, not concluded.
_SLACK = 1e-6
#: Microseconds a vector takes in a pass, and for each place of the window.
_PASS_COST, _PLACE_COST = 20.0, 0.013
#: Share of a pass that borders of range partitions may take away.
_BORDERS = 1 / 8


def passes_for(between: np.ndarray, miss: float = MISS) -> tuple[int, int]:
    """Window and passes in which sampled pairs meet but for a share of ``miss``, at the least cost.

    ``between`` has a row for every pair and a column for every trial pass: how many
    vectors stand between the two. Pairs of similar density are judged together.
    """
    if not len(between):
        return WINDOWS[0], 1
    order = np.argsort(np.log1p(between).mean(axis=1))
    groups = np.array_split(between[order], max(len(between) // _GROUP, 1))
    found = []
    for window in WINDOWS:
        # A group that never met in the trials counts as if it had half a time.
        meets = np.array([max((g < window).sum(), 0.5) / g.size for g in groups]) * (1 - _BORDERS)
        passes = 1
        while ((1 - meets) ** passes).mean() > miss:
            passes = max(passes + 1, int(passes * 1.05))
        found.append((passes * (_PASS_COST + _PLACE_COST * (window + _ROWS)), window, passes))
    return min(found)[1:]


def _planes(number: int, dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, number, dim]).standard_normal((dim, CODE_BITS))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one batch, of equal length, as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``dim`` and ``vec`` of the vectors that can be linked; floats stay floats."""
    vec = F.col("vec")
    kind = table.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vec"))
        .where(F.col("id").isNotNull() & ok & F.exists(vec, lambda x: x != 0))
        .groupBy("id")
        .agg(F.min("vec").alias("vec"))
        .select("id", F.size("vec").alias("dim"), "vec")
    )


def _means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Means of the unit vectors of the most common lengths."""
    common = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(_DIMS).collect()
    counts = {r["dim"]: r["count"] for r in common}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                units = _units(_matrix(batch.filter(pa.array(dims == dim)).column("vec")))
                totals[dim] = totals.get(dim, 0) + units.sum(axis=0)
        rows = [(dim, place, x) for dim, total in totals.items() for place, x in enumerate(total.tolist())]
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        kinds = (pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["dim", "place", "x"])

    sums = vectors.where(F.col("dim").isin(list(counts))).mapInArrow(run, "dim int, place int, x double")
    out = {dim: np.zeros(dim) for dim in counts}
    for r in sums.groupBy("dim", "place").agg(F.sum("x").alias("x")).collect():
        out[r["dim"]][r["place"]] = r["x"] / counts[r["dim"]]
    return out


def _codes(units: np.ndarray, mean: np.ndarray | None, planes: np.ndarray) -> np.ndarray:
    bits = np.int64(1) << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64)
    return ((units if mean is None else units - mean) @ planes > 0) @ bits


def made_up_pairs(units: np.ndarray, mean: np.ndarray, threshold: float) -> np.ndarray:
    """For each unit vector one exactly at the threshold, of the same kind.

    Part of what parts the vector from the mean is exchanged for what parts another
    one of its surroundings from it.
    """
    rng = np.random.default_rng([SEED, len(units)])
    cosine = units @ units.T
    cosine[cosine >= threshold] = -2
    near = np.argsort(-cosine, axis=1)[:, : max(len(units) // 32, 1)]
    other = units[near[np.arange(len(units)), rng.integers(0, near.shape[1], len(units))]] - mean
    own = units - mean
    other *= (np.linalg.norm(own, axis=1) / np.maximum(np.linalg.norm(other, axis=1), 1e-12))[:, None]
    low, high = np.full(len(units), -1.0), np.ones(len(units))
    for _ in range(50):
        kept = (low + high) / 2
        pair = units + (kept - 1)[:, None] * own + np.sqrt(1 - kept**2)[:, None] * other
        pair /= np.maximum(np.linalg.norm(pair, axis=1, keepdims=True), 1e-12)
        far = np.einsum("ij,ij->i", pair, units) < threshold
        low, high = np.where(far, kept, low), np.where(far, high, kept)
    return pair


def _between(vectors: DataFrame, means: dict[int, np.ndarray], threshold: float) -> np.ndarray:
    """How many vectors stand between the two of each made-up pair in each trial pass.

    Pairs of vectors that several links hold in their component are left out.
    """
    if not means:
        return np.zeros((0, TRIALS))
    dim = next(iter(means))  # the most common length
    mean = means[dim]
    drawn = vectors.where(F.col("dim") == dim).orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(SAMPLE)
    units = _units(np.array([r["vec"] for r in drawn.select("vec").collect()], np.float64))
    pairs = made_up_pairs(units, mean, threshold)
    ends = [(_codes(units, mean, _planes(k, dim)), _codes(pairs, mean, _planes(k, dim))) for k in range(TRIALS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(units), TRIALS + 1), np.int64)
        planes = [_planes(k, dim) for k in range(TRIALS)]
        for batch in batches:
            every = _units(_matrix(batch.column("vec")))
            for k in range(0, len(every), 4096):
                own = every[k : k + 4096]
                total[:, TRIALS] += (own @ units.T >= threshold).sum(axis=0)
                for n, (a, b) in enumerate(ends):
                    codes = np.sort(_codes(own, mean, planes[n]))
                    below, above = np.minimum(a, b), np.maximum(a, b)
                    # Vectors of equal code may stand on either side: half of them.
                    first = (np.searchsorted(codes, below, "left") + np.searchsorted(codes, below, "right")) // 2
                    last = (np.searchsorted(codes, above, "left") + np.searchsorted(codes, above, "right")) // 2
                    total[:, n] += last - first
        pair, trial = np.indices(total.shape)
        columns = [pa.array(x.ravel()) for x in (pair, trial, total)]
        yield pa.RecordBatch.from_arrays(columns, names=["pair", "trial", "n"])

    counted = vectors.where(F.col("dim") == dim).mapInArrow(run, "pair long, trial long, n long")
    out = np.zeros((len(units), TRIALS + 1), np.int64)
    for r in counted.groupBy("pair", "trial").agg(F.sum("n").alias("n")).collect():
        out[r["pair"], r["trial"]] = r["n"]
    # A vector links with itself.
    return out[out[:, TRIALS] - 1 < SAFE_LINKS, :TRIALS]


def _coded(vectors: DataFrame, numbers: range, means: dict[int, np.ndarray]) -> DataFrame:
    """A row for every vector and pass, with the code of that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                units = _units(_matrix(own.column("vec")))
                for number in numbers:
                    if (number, dim) not in planes:
                        planes[number, dim] = _planes(number, dim)
                    columns = [
                        pa.array(np.full(len(own), number, np.int32)),
                        own.column("dim"),
                        pa.array(_codes(units, means.get(dim), planes[number, dim])),
                        own.column("id"),
                        own.column("vec"),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["pass", "dim", "code", "id", "vec"])

    kind = vectors.schema["vec"].dataType.simpleString()
    return vectors.mapInArrow(run, f"pass int, dim int, code long, id long, vec {kind}")


def _labels(hits: np.ndarray) -> np.ndarray:
    """The first place of each one's group: ``hits`` tells which of all places the last ones link to."""
    places = hits.shape[1]
    label = np.arange(places)
    new = slice(places - len(hits), places)
    while True:
        before = label.copy()
        reached = np.where(hits, label[None, :], places)
        label[new] = np.minimum(label[new], reached.min(axis=1, initial=places))
        back = np.where(hits, label[new][:, None], places)
        label = np.minimum(label, back.min(axis=0, initial=places))
        if (label == before).all():
            return label


def _linked(coded: DataFrame, threshold: float, window: int, partitions: int) -> DataFrame:
    """Links between neighbours in code order, thinned to a forest in each task."""
    keys = ["pass", "dim", "code", "id"]
    ordered = coded.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        group, ids, units = None, np.zeros(0, np.int64), np.zeros((0, 0))
        for batch in batches:
            key = np.stack([batch.column("pass").to_numpy(), batch.column("dim").to_numpy()], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            pieces = [(k, min(k + _ROWS, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) for k in range(a, b, _ROWS)]
            for a, b in pieces:
                new_ids = batch.column("id").slice(a, b - a).to_numpy()
                new = _units(_matrix(batch.column("vec").slice(a, b - a)))
                same = group == tuple(key[a])
                group = tuple(key[a])
                ids = np.concatenate([ids[-window:], new_ids]) if same else new_ids
                units = np.concatenate([units[-window:], new]) if same else new
                cosine = new @ units.T
                hits = cosine >= threshold
                for i, j in np.argwhere(np.abs(cosine - threshold) < 1e-12).tolist():
                    hits[i, j] = np.einsum("i,i->", new[i], units[j]) >= threshold
                hits[np.arange(len(new)), len(ids) - len(new) + np.arange(len(new))] = False
                label = _labels(hits)
                moved = np.flatnonzero(label != np.arange(len(label)))
                for x, y in zip(ids[label[moved]].tolist(), ids[moved].tolist(), strict=True):
                    forest.join(x, y)
        links = forest.links()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"]
        )

    return ordered.mapInArrow(run, "a long, b long")


def _links(vectors: DataFrame, threshold: float) -> DataFrame:
    """Links of all passes, staged a group of passes at a time: only so many copies of the vectors exist at once."""
    spark, n = vectors.sparkSession, vectors.count()
    means = _means(vectors)
    window, passes = passes_for(_between(vectors, means, threshold))
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = []
    for first in range(0, passes, PASS_GROUP):
        numbers = range(first, min(first + PASS_GROUP, passes))
        # A partition has many windows, so that few pairs fall apart at its borders.
        rows = n * len(numbers)
        partitions = max(1, min(max(most, rows >> 20), rows // (int(1 / _BORDERS) * window)))
        found.append(stage(_linked(_coded(vectors, numbers, means), threshold, window, partitions), "vector-links"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _counts(members: DataFrame, threshold: float) -> DataFrame:
    """``id`` and ``n_links`` of the members (``id``, ``dim``, ``vec``, ``component``)."""
    limit = math.acos(threshold)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            component, dims = batch.column("component").to_numpy(), batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                at = at[np.argsort(component[at], kind="stable")]
                units = _units(_matrix(batch.column("vec").take(pa.array(at))))
                first = np.flatnonzero(np.append(True, component[at][1:] != component[at][:-1]))
                for key, total in zip(component[at][first].tolist(), np.add.reduceat(units, first), strict=True):
                    held[key, dim] = held.get((key, dim), 0) + total
            if len(held) > 1024:
                yield out(held)
                held = {}
        yield out(held)

    def out(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _ in held], pa.int64()),
                pa.array([list(map(float, v)) for v in held.values()], pa.list_(pa.float64())),
            ],
            names=["component", "total"],
        )

    parts = members.mapInArrow(sums, "component long, total array<double>")
    # A sum per place of the vector; partial sums are combined before the shuffle.
    places = (
        parts.select("component", F.posexplode("total").alias("place", "x"))
        .groupBy("component", "place")
        .agg(F.sum("x").alias("x"))
    )
    centres = (
        places.groupBy("component")
        .agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("p"))
        .select(F.col("component").alias("_c"), F.col("p.x").alias("centre"))
    )

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, centres = batch.column("vec"), batch.column("centre")
            found = np.full(batch.num_rows, math.pi)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                v, c = _units(_matrix(vecs.take(pa.array(at)))), _matrix(centres.take(pa.array(at)))
                norm = np.linalg.norm(c, axis=1)
                cosine = np.einsum("ij,ij->i", v, c) / np.where(norm > 0, norm, 1)
                found[at] = np.where(norm > 0, np.arccos(np.clip(cosine, -1, 1)), math.pi)
            core = found <= limit / 2 - _SLACK
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("id", "component", "vec")], pa.array(core)],
                names=["id", "component", "vec", "core"],
            )

    kind = members.schema["vec"].dataType.simpleString()
    placed = stage(
        members.join(centres, F.col("component") == F.col("_c"))
        .select("id", "component", "dim", "vec", "centre")
        .mapInArrow(angles, f"id long, component long, vec {kind}, core boolean"),
        "vector-members",
    )
    sizes = placed.groupBy(F.col("component").alias("_c")).agg(
        F.count("*").alias("_size"), F.count_if("core").alias("_core"), F.count_if(~F.col("core")).alias("_outer")
    )
    sized = placed.join(sizes, F.col("component") == F.col("_c"))
    certain = sized.where("core").select("id", (F.col("_core") - 1).alias("n"))
    mixed = sized.where("_outer > 0").select(
        "id", "component", "vec", "core",
        F.ceil(F.col("_size") / MEMBER_BLOCK).cast("int").alias("_members"),
        F.ceil(F.col("_outer") / OUTER_BLOCK).cast("int").alias("_outers"),
    )
    h = F.xxhash64("id")
    inner = mixed.select(
        "component",
        F.pmod(h, "_members").cast("int").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("_outers") - 1)).alias("q"),
        "id", "vec", "core", F.lit(False).alias("outer"),
    )
    outer = mixed.where(~F.col("core")).select(
        "component",
        F.explode(F.sequence(F.lit(0), F.col("_members") - 1)).alias("p"),
        F.pmod(F.shiftright(h, 20), "_outers").cast("int").alias("q"),
        "id", "vec", "core", F.lit(True).alias("outer"),
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("outer").to_numpy()
        a, b = (table.filter(pa.array(x)) for x in (~side, side))
        found: dict[int, int] = {}
        if len(a) and len(b):
            ua, ub = (_units(_matrix(t.column("vec").combine_chunks())) for t in (a, b))
            ia, ib = (t.column("id").to_numpy() for t in (a, b))
            near = (ua @ ub.T) >= threshold
            edge = np.argwhere(np.abs(ua @ ub.T - threshold) < 1e-12)
            for i, j in edge:
                near[i, j] = np.einsum("i,i->", ua[i], ub[j]) >= threshold
            near &= ia[:, None] != ib[None, :]
            core = a.column("core").to_numpy()
            for x, n in zip(ib.tolist(), near.sum(axis=0).tolist(), strict=True):
                found[x] = found.get(x, 0) + n
            for x, n in zip(ia[core].tolist(), near[core].sum(axis=1).tolist(), strict=True):
                found[x] = found.get(x, 0) + n
        return pa.table({"id": pa.array(list(found), pa.int64()), "n": pa.array(list(found.values()), pa.int64())})

    compared = inner.unionByName(outer).groupBy("component", "p", "q").applyInArrow(compare, "id long, n long")
    return certain.unionByName(compared).groupBy("id").agg(F.sum("n").alias("n_links"))


def near_duplicates(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Id, number of links, component and whether the vector is kept, one row per vector."""
    vectors = stage(usable(table, id_col, vector_col), "vectors")
    found = components(_links(vectors, threshold), "vectors")
    found = stage(found, "vector-components")
    members = vectors.join(found, "id")
    counts = _counts(members, threshold)
    own = table.select(F.col(id_col).alias("_id"))
    wide = found.join(counts, "id")
    return own.join(wide, F.col("_id") == F.col("id"), "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", F.col("_id").cast("long")).alias("component_id"),
        F.coalesce(F.coalesce("component", F.col("_id").cast("long")) == F.col("_id"), F.lit(True)).alias("kept"),
    )
