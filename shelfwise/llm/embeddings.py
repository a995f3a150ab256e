"""Near-duplicate embeddings by a subspace pigeonhole join.

Vectors of unit length with cosine >= c are at a squared distance of at most 2 - 2c. Rotated (by the principal axes of a
bounded sample, any rotation being right) and split into ``BLOCKS`` low-dimensional blocks, two such vectors must in at
least one block be within that block's share of the squared distance. Each block is range-joined on its own: a grid
over its ``AXES`` leading coordinates, whose cells are wide enough for partners to lie in the same or in adjacent cells;
a vector goes to its own cell and, as a guest, to those lesser neighbours that its range reaches. What is shuffled is an
id and the block's coordinates; only vectors that have a partner within the block's range there are fetched. The union
of candidates is verified exactly, in double precision on the vectors as given, and a pair that several blocks find is
counted where it is found first, so links add up without listing all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - as pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components, stars

COSINE = 0.98
BLOCKS, AXES = 4, 3
#: Width of a grid cell as a multiple of the block's range.
WIDTH = 3.0
#: Vectors that the rotation is fitted on: the bound of the sample.
SAMPLE = 20_000
#: Hosts, and guests, that one task compares at a time at most.
PIECE = 2048
SLACK = 1e-6
#: Steps of a coordinate as a 16-bit integer.
STEPS = 32767


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label``, ``v`` (components of the type given) and ``key``, a digest of ``v``, of the rows that can
    link at all. Null labels, and vectors that are null, empty, zero or hold null or non-finite components, are left out."""
    v = F.col("embedding")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.col("label").cast("long").alias("label"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))
    return rows.withColumn("key", F.unhex(F.sha2(F.col("v").cast("string"), 256)))


def rotation(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Per length of vector in the sample, an orthogonal matrix whose columns are dealt to blocks in turns, widest spread
    first. Vectors of other lengths stay as they are: any rotation finds all links."""
    sample = distinct.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select(F.col("v").cast("array<double>").alias("v")).toArrow()["v"].to_pylist()
    out = {}
    for n in {len(x) for x in sample}:
        rows = np.array([x for x in sample if len(x) == n])
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        _, axes = np.linalg.eigh(np.cov(rows.T).reshape(n, n) if len(rows) > 1 else np.eye(n))
        out[n] = axes[:, ::-1]
    return out


def spans(n: int) -> list[slice]:
    """The columns of each block of vectors of this length."""
    return [slice(b, n, min(BLOCKS, n)) for b in range(min(BLOCKS, n))]


def by_length(v: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vector: the length, the places of these vectors, and the vectors as rows of doubles."""
    lengths = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        yield n, at, v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)


def turned(v: np.ndarray, axes) -> np.ndarray:
    """Vectors of one length at unit length, rotated."""
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    return u @ axes.value[v.shape[1]] if v.shape[1] in axes.value else u


def reaches(n: int, cosine: float) -> list[float]:
    """The range of each block of vectors of this length."""
    return [np.sqrt((2 - 2 * cosine) * len(range(*s.indices(n))) / n) for s in spans(n)]


CELLS = "node long, cell string, home boolean, reach float, part binary"


def dealt(distinct: DataFrame, cosine: float, axes) -> DataFrame:
    """A row per vector, block and cell: ``cell`` (label, length, block and place), ``home``, the block's ``reach`` and
    the coordinates in it as 16-bit integers (``part``). Of two adjacent cells only the lesser gets the other's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, v in by_length(batch.column("v")):
                u = turned(v, axes)
                node, label = (batch.column(k).take(pa.array(at)) for k in ("node", "label"))
                for b, (span, reach) in enumerate(zip(spans(n), reaches(n, cosine), strict=True)):
                    yield from of_block(node, label, n, b, u[:, span], float(reach))

    def of_block(node, label, n: int, b: int, u: np.ndarray, reach: float) -> Iterator[pa.RecordBatch]:
        exact = u[:, :AXES] / (WIDTH * (reach + SLACK))
        home = np.floor(exact).astype(np.int64)
        low, high = np.floor(exact - 1 / WIDTH).astype(np.int64), np.floor(exact + 1 / WIDTH).astype(np.int64)
        parts = np.rint(u * STEPS).astype(np.int16)
        for step in itertools.product((-1, 0, 1), repeat=home.shape[1]):
            if step > (0,) * len(step):
                continue
            cell = home + np.array(step)
            at = np.flatnonzero(((cell >= low) & (cell <= high)).all(axis=1))
            if not len(at):
                continue
            places = [pa.array(cell[at, k]).cast(pa.string()) for k in range(cell.shape[1])]
            names = pa.compute.binary_join_element_wise(label.take(pa.array(at)).cast(pa.string()), str(n), str(b), *places, ":")
            bytes_each = 2 * u.shape[1]
            offsets = np.arange(len(at) + 1, dtype=np.int32) * bytes_each
            part = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(parts[at]))])
            columns = [node.take(pa.array(at)), names, pa.array(np.full(len(at), not any(step))), pa.array(np.full(len(at), reach, np.float32)), part]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "cell", "home", "reach", "part"])

    return distinct.select("node", "label", "v").mapInArrow(run, CELLS)


def survivors(cells: DataFrame) -> DataFrame:
    """The vectors of each cell that have a partner there within the block's range: ``node``, the group in which they
    are compared (``cell``, ``k``, ``g``), ``host``, ``home`` and ``alone``.

    A cell's hosts are its home vectors, its guests all vectors in it. Both are cut into pieces, and each piece of hosts
    meets each piece of guests in a group of its own, so no group exceeds ``2 * PIECE`` rows. The home vectors of a cell
    of one piece (``alone``) stand there once.
    """
    sizes = cells.groupBy("cell").agg(F.count("*").alias("guests"), F.sum(F.col("home").cast("int")).alias("hosts")).where("guests > 1 and hosts > 0")
    sizes = sizes.select("cell", F.ceil(F.col("guests") / PIECE).cast("int").alias("gp"), F.ceil(F.col("hosts") / PIECE).cast("int").alias("hp"))
    placed = cells.join(sizes, "cell").withColumn("h", F.hash("node")).withColumn("alone", F.expr("gp * hp = 1"))
    guests = placed.withColumn("g", F.pmod("h", "gp")).select("*", F.explode(F.sequence(F.lit(0), F.col("hp") - 1)).alias("k"), F.lit(False).alias("host"))
    hosts = placed.where("home and not alone").withColumn("k", F.pmod("h", "hp")).select("*", F.explode(F.sequence(F.lit(0), F.col("gp") - 1)).alias("g"), F.lit(True).alias("host"))
    both = guests.unionByName(hosts).select("cell", "k", "g", "node", "host", "home", "alone", "reach", "part")

    def run(key, group):  # no annotations: Spark reads them as a choice of interface
        node = group["node"].to_numpy()
        hs, gs = sides(group)
        u = np.frombuffer(b"".join(group["part"].to_pylist()), np.int16).reshape(len(node), -1) / STEPS
        near_to = (group["reach"][0].as_py() + 2 * SLACK + np.sqrt(u.shape[1]) / STEPS) ** 2
        size = (u**2).sum(axis=1)
        held = np.zeros((2, len(node)), bool)
        for start in range(0, len(hs), 256):
            x = hs[start : start + 256]
            near = (size[x][:, None] + size[gs][None, :] - 2 * (u[x] @ u[gs].T) <= near_to) & (node[x][:, None] != node[gs][None, :])
            held[0][x] |= near.any(axis=1)
            held[1][gs] |= near.any(axis=0)
        return group.filter(pa.array(held.any(axis=0))).select(["node", "cell", "k", "g", "host", "home", "alone"])

    return both.groupBy("cell", "k", "g").applyInArrow(run, "node long, cell string, k int, g int, host boolean, home boolean, alone boolean")


def sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The rows that are hosts and those that are guests in a group."""
    host, home, alone = (group[k].to_numpy(zero_copy_only=False) for k in ("host", "home", "alone"))
    return np.flatnonzero(home if alone[0] else host), np.flatnonzero(~host)


def joined(found: DataFrame, cosine: float, axes) -> DataFrame:
    """Links as partial sums: ``a``, ``links`` (vectors linked, copies counted), and for some links the partner ``b``
    (null otherwise), such that these connect all that the links connect. ``found``: survivors with their vectors."""

    def run(key, group):  # no annotations: Spark reads them as a choice of interface
        hs, gs = sides(group)
        home, b = group["home"].to_numpy(zero_copy_only=False), int(group["cell"][0].as_py().split(":")[2])
        rep, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        [(n, _, v)] = by_length(group["v"].combine_chunks())
        rotated, u = turned(v, axes), v / np.linalg.norm(v, axis=1, keepdims=True)
        hs, gs = hs[np.argsort(rep[hs])], gs[np.argsort(rep[gs])]
        links, tied = np.zeros(len(rep), np.int64), (np.empty(0, np.int64), np.empty(0, np.int64))
        for start in range(0, len(hs), 256):
            x = hs[start : start + 256]
            i, j = np.nonzero((u[x] @ u[gs].T >= cosine - 1e-9) & (rep[x][:, None] != rep[gs][None, :]))
            p, q = x[i], gs[j]
            for cut in range(0, len(p), 16384):  # pairs of long vectors are verified a few at a time
                s, t = p[cut : cut + 16384], q[cut : cut + 16384]
                exact = np.einsum("ij,ij->i", v[s], v[t]) / np.sqrt(np.einsum("ij,ij->i", v[s], v[s]) * np.einsum("ij,ij->i", v[t], v[t])) >= cosine
                s, t = s[exact], t[exact]
                gap = (rotated[s] - rotated[t]) ** 2
                first = np.full(len(s), -1)
                for block, (span, reach) in reversed(list(enumerate(zip(spans(n), reaches(n, cosine), strict=True)))):
                    first[np.sqrt(gap[:, span].sum(axis=1)) <= reach + SLACK / 2] = block
                s, t = s[first == b], t[first == b]
                np.add.at(links, s, copies[t])
                away = ~home[t]  # a guest from another cell is not a host here or there for this pair
                np.add.at(links, t[away], copies[s[away]])
                tied = stars(np.concatenate([tied[0], rep[s]]), np.concatenate([tied[1], rep[t]]))
        linked = np.flatnonzero(links)
        a, b_out = np.concatenate([rep[linked], tied[0]]), np.concatenate([np.zeros(len(linked), np.int64), tied[1]])
        n_out = np.concatenate([links[linked], np.zeros(len(tied[0]), np.int64)])
        return pa.table({"a": a, "links": n_out, "b": pa.array(b_out, mask=np.arange(len(a)) < len(linked))})

    return found.groupBy("cell", "k", "g").applyInArrow(run, "a long, links long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Vectors link within one label only. Rows that cannot link (see ``usable``) stand alone, rows with a null id have a
    null component and are not kept. Equal vectors of a label are compared once and link with each other. An empty table
    gives no rows. Other columns than ``vec_id``, ``embedding`` and ``label`` are not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    equal = rows.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v"))
    distinct = written(equal.withColumn("node", F.monotonically_increasing_id()), "vectors")
    members = rows.select("vec_id", "label", "key").join(distinct.select("label", "key", "rep", "copies"), ["label", "key"]).select("vec_id", "rep", "copies")
    axes = spark.sparkContext.broadcast(rotation(distinct))
    cells = written(dealt(distinct, cosine, axes), "vector-cells")
    near = written(survivors(cells), "vector-survivors")
    found = written(joined(near.join(distinct.select("node", "rep", "copies", "v"), "node"), cosine, axes), "vector-links")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    grouped = components(found.where("b is not null").select("a", "b").distinct())
    per_row = members.join(links.withColumnRenamed("a", "rep"), "rep", "left").join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
    per_row = per_row.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    per_id = per_row.groupBy(F.col("vec_id").alias("__id")).agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    told = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(per_id, F.col("vec_id") == F.col("__id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return told.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
