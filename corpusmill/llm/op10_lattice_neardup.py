"""Embedding near-dedup: vectors meet in cells of the E8 lattice, in several tables, and are verified by cosine."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import K1, mix, ranges, spans
from corpusmill.llm.shared import components, stored

#: Blocks of eight directions that make up a cell, and cells probed in each table besides the own one.
BLOCKS, PROBES = 2, 3
#: Members and visitors of a cell that one comparison takes at most, on the average.
MEMBERS, VISITORS = 256, 1024


def decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8, integer vectors of even sum, to each row."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(axis=-1).astype(np.int64) & 1)
    if len(odd):
        d = x[odd] - f[odd]
        worst = np.abs(d).argmax(axis=-1)
        f[odd, worst] += np.where(d[np.arange(len(odd)), worst] >= 0, 1, -1)
    return f


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8, the union of D8 and D8 + 1/2, to each row of eight coordinates (Conway and Sloane, 1982)."""
    a, b = decode_d8(x), decode_d8(x - 0.5) + 0.5
    closer = ((x - b) ** 2).sum(axis=-1) < ((x - a) ** 2).sum(axis=-1)
    return np.where(closer[:, None], b, a)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to neighbouring cells."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        v = np.array([0.5 if bits >> k & 1 else -0.5 for k in range(8)])
        if int((v < 0).sum()) % 2 == 0:
            out.append(v)
    return np.array(out)


_STEPS = minimal_vectors()


def plan(n: int) -> tuple[int, float]:
    """(tables, stretch) for n vectors: stretch is the lattice units that a unit vector's share of eight directions has on the
    average. Cells shrink as vectors grow in number, so that comparisons grow more slowly than n^1.5, and tables make up for
    what smaller cells miss: at cosine 0.9 the recall stays near 0.96."""
    stretch = 1.1 + 0.16 * max(0.0, math.log10(max(n, 1)) - 3.5)
    return math.ceil(6 * math.exp(2.35 * (stretch - 1.1))), stretch


def projections(table: int, dim: int) -> np.ndarray:
    """A table's random directions of `dim` coordinates, orthogonal within a block, and over blocks as far as there are dimensions."""
    rng = np.random.default_rng(1000 + table)
    if dim >= 8 * BLOCKS:
        return np.linalg.qr(rng.standard_normal((dim, 8 * BLOCKS)))[0]
    return np.concatenate([np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))[0][:dim] for _ in range(BLOCKS)], axis=1)


def cell_codes(vectors: np.ndarray, tables: int, probes: int, stretch: float, known: dict[tuple[int, int], np.ndarray] | None = None) -> np.ndarray:
    """(rows, tables, 1 + probes) codes of each unit vector's own cell and of the neighbouring cells nearest to it; those of
    vectors of another length differ. A cell is one lattice point in each block; neighbours differ in one block. `known` keeps
    the directions from call to call."""
    n, dim = vectors.shape
    steps = _STEPS
    known = {} if known is None else known
    out = np.zeros((n, tables, 1 + probes), np.int64)
    weights = mix(np.arange(1, 8 * BLOCKS + 1, dtype=np.uint64) * K1) | np.uint64(1)
    for t in range(tables):
        if (t, dim) not in known:
            known[t, dim] = projections(t, dim)
        x = (vectors @ known[t, dim] * (stretch * np.sqrt(dim / 8))).reshape(n * BLOCKS, 8)
        own = decode_e8(x)
        # |x - own - s| is least for the steps s along the error: |s|^2 is the same for all.
        gain = ((x - own) @ steps.T).reshape(n, BLOCKS * len(steps))
        near = np.argpartition(-gain, probes, axis=1)[:, :probes] if probes else np.zeros((n, 0), np.int64)
        points = np.repeat(own.reshape(n, 1, BLOCKS, 8), 1 + probes, axis=1)
        points[np.arange(n)[:, None], np.arange(1, 1 + probes), near // len(steps)] += steps[near % len(steps)]
        points = points.reshape(n, 1 + probes, 8 * BLOCKS)
        with np.errstate(over="ignore"):
            h = ((points * 2).astype(np.int64).view(np.uint64) * weights).sum(axis=-1, dtype=np.uint64)
            out[:, t] = mix(h + np.uint64(t + 1) * K1 + mix(np.full(1, dim, np.uint64))).view(np.int64)
    return out


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1, first brought by a power of two to a size whose square neither overflows nor vanishes."""
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, tables: int | None = None, probes: int = PROBES, stretch: float | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) of each vector; vectors link at cosine >= `cosine`, in double precision.

    Equal vectors form one class, which counts with its size. A class is a member of its own cell in each table and
    visits this cell and the `probes` nearest neighbouring ones. Cells of many members or visitors are cut into a grid of
    comparisons, each one block of either. A pair that meets more than once counts where it meets first. A comparison
    gives counts by class and a spanning forest of its links, never pairs.

    Found are the pairs that share a cell in some table, nearly all at such cosines; none below `cosine` are linked. Tables and
    the size of cells follow the number of classes (`plan`), unless they are given.
    Vectors that are null, empty, zero, or with null or non-finite components link with nothing; vectors of unlike lengths
    don't link with each other. Equal vectors are known by a digest of 128 bits. A null id: no links, component_id null,
    kept false. Rows that repeat an id count as that many vectors and have a component in common. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    if dict(rows.dtypes)["v"] != "array<float>":
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    kind = dict(rows.dtypes)["v"]
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fine = rows.where("id is not null and v is not null").where(finite & F.exists("v", lambda x: x != 0)).selectExpr("id", "v", "xxhash64(v) as h", "xxhash64(7, v) as g")
    ids = stored(fine.select("id", "h", "g"), "ids")
    classes = stored(fine.groupBy("h", "g").agg(F.min("id").alias("cls"), F.count("*").alias("many"), F.first("v").alias("v")), "classes")

    planned = plan(classes.count())
    tables, stretch = tables or planned[0], stretch or planned[1]

    def by_length(v: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and unit vectors of each length among lists."""
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        flat, length = np.asarray(v.flatten(), np.float64), np.asarray(pc.list_value_length(v), np.int64)
        starts = np.cumsum(length) - length
        for d in np.unique(length):
            at = np.flatnonzero(length == d)
            yield at, unit(flat[ranges(starts[at], length[at])].reshape(len(at), d))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, known = tables * (1 + probes), {}
        for batch in batches:
            codes = np.zeros((len(batch), width), np.int64)
            for at, v in by_length(batch.column("v")):
                codes[at] = cell_codes(v, tables, probes, stretch, known).reshape(len(at), width)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * width, pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("many"), batch.column("v"), lists], names=["cls", "many", "v", "codes"])

    coded = stored(classes.select("cls", "many", "v").mapInArrow(keyed, f"cls long, many long, v {kind}, codes array<long>"), "codes")
    # Members and visits of each cell; only cells that more than their one member visits matter.
    step = 1 + probes
    visit = coded.select("cls", F.posexplode("codes").alias("at", "cell")).selectExpr("cls", f"cast(at div {step} as int) as t", f"at % {step} = 0 as own", "cell")
    sizes = visit.groupBy("t", "cell").agg(F.count_if("own").alias("members"), F.count("*").alias("visits")).where("members > 0 and visits > 1")
    sizes = sizes.selectExpr("t", "cell + 0L as cell", f"cast(ceil(members / {MEMBERS}D) as int) as nm", f"cast(ceil(visits / {VISITORS}D) as int) as nv")
    dealt = visit.join(sizes, ["t", "cell"])
    # A visit goes to each block of members; a member also as such to each block of visitors.
    as_visit = dealt.selectExpr("cls", "t", "cell", "false as member", "explode(sequence(0, nm - 1)) as m", "cast(pmod(xxhash64(cls, 1), nv) as int) as q")
    as_member = dealt.where("own").selectExpr("cls", "t", "cell", "true as member", "cast(pmod(xxhash64(cls, 2), nm) as int) as m", "explode(sequence(0, nv - 1)) as q")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    role = as_visit.union(as_member).selectExpr("cls", f"pmod(xxhash64(t, cell, m, q), {parts}L) as part", "struct(t, cell, m, q, member) as place")
    # A class goes to a part once, with all its places there.
    placed = role.groupBy("cls", "part").agg(F.collect_list("place").alias("places")).join(coded.selectExpr("cls + 0L as cls", "many", "v", "codes"), "cls")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        found = [compare_equal_length(table.take(pa.array(at)), v) for at, v in by_length(table.column("v"))]
        return pa.concat_tables(found)

    def compare_equal_length(table: pa.Table, v: np.ndarray) -> pa.Table:
        table = table.combine_chunks()
        cls, many = table.column("cls").to_numpy(), table.column("many").to_numpy()
        codes = np.asarray(table.column("codes").combine_chunks().flatten(), np.int64).reshape(len(cls), tables, step)
        places = table.column("places").combine_chunks()
        owner = np.repeat(np.arange(len(cls)), np.diff(places.offsets.to_numpy()))
        t, cell, m, q, member = (x.to_numpy(zero_copy_only=False) for x in places.flatten().flatten())
        order = np.lexsort((member, q, m, cell, t))
        owner, t, cell, m, q, member = (x[order] for x in (owner, t, cell, m, q, member))
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (cell[1:] != cell[:-1]) | (m[1:] != m[:-1]) | (q[1:] != q[:-1])])
        cut = np.flatnonzero(new)
        count, root = np.zeros(len(cls), np.int64), np.arange(len(cls))
        edges = []
        for a, b in spans(cut, len(owner)):
            mid = a + int(np.searchsorted(member[a:b], True))
            x, y = owner[a:mid], owner[mid:b]
            if not len(x) or not len(y):
                continue
            i, j = np.nonzero(v[x] @ v[y].T >= cosine)
            i, j = x[i], y[j]
            off = i != j
            i, j = i[off], j[off]
            if not len(i):
                continue
            edges.append(np.stack([i, j]))
            # Where they met before: in an earlier table either way, or in this one with the smaller one as visitor.
            seen = np.zeros(len(i), bool)
            for k in range(int(t[a]) + 1):
                here = (codes[j, k, :1] == codes[i, k]).any(axis=1)
                there = (codes[i, k, :1] == codes[j, k]).any(axis=1)
                seen |= (here | there) if k < t[a] else (there & (cls[j] < cls[i]))
            i, j = i[~seen], j[~seen]
            np.add.at(count, i, many[j])
            np.add.at(count, j, many[i])
        if edges:
            u, w = np.concatenate(edges, axis=1)
            while True:  # labels sink to the smallest of each tree
                low = np.minimum(root[u], root[w])
                was = root.copy()
                np.minimum.at(root, u, low)
                np.minimum.at(root, w, low)
                root = root[root]
                if (root == was).all():
                    break
        out = np.flatnonzero((count > 0) | (root != np.arange(len(cls))))
        return pa.table([pa.array(cls[out]), pa.array(count[out]), pa.array(cls[root[out]])], names=["cls", "n", "other"])

    found = stored(placed.groupBy("part").applyInArrow(compare, "cls long, n long, other long"), "found")
    links = found.groupBy("cls").agg(F.sum("n").alias("n"))
    merged = components(found.select("cls", "other"), "cls", "other")
    facts = classes.select("h", "g", "cls", "many").join(links, "cls", "left").join(merged.withColumnRenamed("id", "cls"), "cls", "left")
    facts = stored(facts.selectExpr("h", "g", "coalesce(n, 0L) + many - 1 as n_links", "coalesce(component, cls) as component_id"), "facts")
    by_id = ids.join(facts, ["h", "g"]).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("id").join(by_id, "id", "left")
    return out.selectExpr(f"id as {id_col}", "coalesce(n_links, 0L) as n_links", "coalesce(component_id, id) as component_id", "coalesce(coalesce(component_id, id) = id, false) as kept")
