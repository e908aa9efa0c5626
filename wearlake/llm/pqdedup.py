"""Embedding near-duplicates by product quantisation over inverted lists.

Coarse centroids and, on the residuals, a codebook per subspace are fitted on a
bounded sample; every vector is then coded.  A vector is compared with the
members of the lists it probes: first by the asymmetric distance (its exact
residual against codes, by table lookup), dropping only members whose distance
less their own coding error is beyond the threshold, so coding loses nothing;
then by the exact cosine.  A list is probed if its centroid is at most
``slack`` of the worst case farther than the nearest one.

Equal vectors are one node.  Members and queries of a list are dealt to blocks
of at most about ``block`` rows, so a crowded list becomes many tasks.  A block
returns link counts and a spanning star of each of its local components, at
most a row per vector, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.llm.runtime import connected_components, discard, materialise, value_text


@dataclass
class Quantiser:
    """centroids: (lists, dim); books: (subspaces, codes, width); dim is padded to subspaces * width."""

    centroids: np.ndarray
    books: np.ndarray

    def assign(self, x: np.ndarray, radius: float, slack: float) -> tuple[
        np.ndarray, list[np.ndarray], np.ndarray, np.ndarray
    ]:
        """Nearest list, probed lists (nearest first), codes and coding error of each unit vector."""
        c = self.centroids
        d2 = np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T, 0)
        home = d2.argmin(axis=1)
        between = np.sqrt(np.maximum((c * c).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * c @ c.T, 0))
        near = d2 - d2.min(axis=1)[:, None] <= 2 * radius * slack * between[home]
        near[np.arange(len(x)), home] = True
        probes = [np.flatnonzero(row) for row in near]
        residual = (x - c[home]).reshape(len(x), len(self.books), -1)
        codes = np.empty((len(x), len(self.books)), np.uint8)
        error = np.zeros(len(x))
        for j, book in enumerate(self.books):
            r = residual[:, j]
            dj = (r * r).sum(1)[:, None] + (book * book).sum(1)[None, :] - 2 * r @ book.T
            codes[:, j] = dj.argmin(axis=1)
            error += ((r - book[codes[:, j]]) ** 2).sum(axis=1)
        return home, probes, codes, np.sqrt(error)

    def distances(self, x: np.ndarray, home: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of vectors to the coded members of one list."""
        residual = (x - self.centroids[home]).reshape(len(x), len(self.books), -1)
        total = np.zeros((len(x), len(codes)))
        for j, book in enumerate(self.books):
            r = residual[:, j]
            table = (r * r).sum(1)[:, None] + (book * book).sum(1)[None, :] - 2 * r @ book.T
            total += table[:, codes[:, j]]
        return np.sqrt(np.maximum(total, 0))


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """k centroids; an empty cluster takes a random row."""
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1)[None, :] - 2 * x @ c.T).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), k)])
    return c


def fit_quantiser(
    sample: np.ndarray, lists: int, subspaces: int, codes: int = 256, rounds: int = 8, seed: int = 7
) -> Quantiser:
    """Fit on unit vectors; their width must be a multiple of ``subspaces``."""
    rng = np.random.default_rng(seed)
    centroids = k_means(sample, lists, rounds, rng)
    home = ((centroids * centroids).sum(1)[None, :] - 2 * sample @ centroids.T).argmin(axis=1)
    residual = (sample - centroids[home]).reshape(len(sample), subspaces, -1)
    return Quantiser(
        centroids,
        np.stack([k_means(np.ascontiguousarray(residual[:, j]), codes, rounds, rng) for j in range(subspaces)]),
    )


def _nodes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, node, label, width, unit): unit is the normalised vector as doubles, null if the vector can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, units, widths = [], [], []
            for v, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                x = None if v is None or label is None or None in v else np.array(v, np.float64) + 0.0
                norm = np.linalg.norm(
                    x / np.abs(x).max()
                ) if x is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0 else 0.0
                if norm:
                    nodes.append(md5(x.tobytes() + label.encode()).hexdigest())
                    units.append((x / np.abs(x).max() / norm).tobytes())
                    widths.append(len(x))
                else:
                    nodes.append(None)
                    units.append(None)
                    widths.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(nodes, pa.string()), batch.column(2), pa.array(widths, pa.int32()),
                    pa.array(units, pa.binary()),
                ], ["vec_id", "node", "label", "width", "unit"]
            )

    return vectors.select(
        F.col(id_col).try_cast("long"), vec_col, value_text(vectors, label_col).alias("label")
    ).mapInArrow(run, "vec_id long, node string, label string, width int, unit binary")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, x in enumerate(column):
        own = np.frombuffer(x.as_buffer(), np.float64)
        out[i, : len(own)] = own
    return out


def _local_least(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For n vertices and edges (a, b): the smallest vertex of each one's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = 0.93, sample_rows: int = 16_384, most_lists: int = 1024, subspaces: int = 8, slack: float = 0.4, block: int = 1024,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal labels and widths link at a cosine of ``cosine`` or more.
    Null or zero vectors, vectors with null or non-finite components and those
    without a label link with nothing and are their own component.  Labels are
    equal by value (of whatever type the column is); ids are whole numbers, and
    text is read as such where it is one.  Equal vectors link; they are told by
    128 bits of vector and label.  n_links counts other rows; component_id is the
    smallest vec_id reachable; kept is vec_id = component_id.  Repeated rows count as
    rows; other columns are left out; an empty table gives an empty result.

    The quantiser is fitted on ``sample_rows`` vectors at most, with the square
    root of the number of distinct vectors (``most_lists`` at most) as lists.
    Every vector is indexed.  With ``slack`` 1 no link can be missed; less
    probes fewer lists and may miss links whose difference lies almost along
    the line between two centroids.
    """
    rows = materialise(_nodes(vectors, id_col, vec_col, label_col), "vectors")
    nodes = materialise(
        rows.filter("node is not null").groupBy("node").agg(
            F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("label").alias("label"),
            F.first("width").alias("width"), F.first("unit").alias("unit"),
        ),
        "vector-nodes",
    )
    count, wide = nodes.agg(F.count("*"), F.max("width")).first()
    radius = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    dim = -(-(wide or 1) // subspaces) * subspaces
    sample = nodes.select("unit").orderBy("node").limit(sample_rows).toArrow().column("unit")  # at most ``sample_rows`` vectors
    model = fit_quantiser(
        _matrix(sample, dim), max(1, min(most_lists, round(count**0.5))), subspaces, min(256, max(1, count))
    ) if count else Quantiser(np.zeros((1, dim)), np.zeros((subspaces, 1, dim // subspaces)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                home, probes, codes, error = model.assign(_matrix(part.column(4), dim), radius, slack)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns, pa.array(home.astype(np.int32)),
                        pa.array([p.astype(np.int32) for p in probes], pa.list_(pa.int32())),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                    ],
                    ["node", "copies", "label", "width", "unit", "home", "probes", "codes", "error"],
                )

    coded = materialise(
        nodes.select("node", "copies", "label", "width", "unit").mapInArrow(
            code,
            "node string, copies long, label string, width int, unit binary, home int, probes array<int>, codes binary, error double",
        ),
        "coded",
    )
    where = ["label", "width", "list"]
    members = coded.withColumn("list", F.col("home"))
    queries = coded.withColumn("list", F.explode("probes"))
    size = lambda df, name: df.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    blocks = size(members, "m_blocks").join(size(queries, "q_blocks"), where)
    columns = ["label", "width", "list", "q", "m", "role", "node", "copies", "unit", "home", "probes", "codes", "error"]
    number = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = queries.join(blocks, where).withColumn(
        "q", number("q_blocks")
    ).withColumn("m", every("m_blocks")).withColumn("role", F.lit(0))
    held = members.join(blocks, where).withColumn(
        "m", number("m_blocks")
    ).withColumn("q", every("q_blocks")).withColumn("role", F.lit(1))

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role = table.column("role").to_numpy()
        at_list = table.column("list")[0].as_py()
        get = lambda name, r: table.column(name).combine_chunks().filter(pa.array(role == r))
        digits = lambda r: np.array(get("node", r).to_pylist(), "S32")
        q_node, m_node = digits(0), digits(1)
        text = lambda x: pa.array(x.astype("U32").tolist(), pa.string())
        nothing = pa.table([pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.string())], names=["node", "links", "least"])
        if not len(q_node) or not len(m_node):
            return nothing
        x, y = _matrix(get("unit", 0), dim), _matrix(get("unit", 1), dim)
        codes = np.stack([np.frombuffer(c.as_buffer(), np.uint8) for c in get("codes", 1)])
        near = model.distances(x, at_list, codes) - get("error", 1).to_numpy()[None, :] <= radius
        near &= q_node[:, None] != m_node[None, :]
        a, b = np.nonzero(near)
        # one way for all pairs, so that a pair at the threshold is judged alike in every block
        exact = np.concatenate(
            [
                np.zeros(0),
                *(np.einsum("ij,ij->i", x[a[k : k + 65536]], y[b[k : k + 65536]]) for k in range(0, len(a), 65536)),
            ]
        )
        keep = exact >= cosine
        a, b = a[keep], b[keep]
        if not len(a):
            return nothing
        q_copies, m_copies, q_home = get("copies", 0).to_numpy(), get("copies", 1).to_numpy(), get("home", 0).to_numpy()
        q_links = np.bincount(a, m_copies[b], minlength=len(x)).astype(np.int64)
        # a member that doesn't probe the query's own list can't find it by itself
        m_probes = get("probes", 1)
        probed = np.zeros((len(y), len(model.centroids)), bool)
        probed[np.repeat(np.arange(len(y)), np.diff(m_probes.offsets.to_numpy())), m_probes.flatten().to_numpy()] = True
        alone = ~probed[b, q_home[a]]
        m_links = np.bincount(b[alone], q_copies[a[alone]], minlength=len(y)).astype(np.int64)
        both = np.concatenate((q_node, m_node))
        name, vertex = np.unique(both, return_inverse=True)
        least = name[_local_least(vertex[a], vertex[len(x) + b], len(name))]
        links = np.bincount(vertex, np.concatenate((q_links, m_links)), minlength=len(name)).astype(np.int64)
        touched = np.unique(np.concatenate((vertex[a], vertex[len(x) + b])))
        return pa.table(
            [text(name[touched]), pa.array(links[touched]), text(least[touched])],
            names=["node", "links", "least"],
        )

    found = asked.select(*columns).union(held.select(*columns)).groupBy(*where, "q", "m").applyInArrow(
        link, "node string, links long, least string"
    )
    found = materialise(found, "vector-links")
    discard(coded)
    parts = connected_components(found, "node", "least")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.select("node", "copies", "least").join(parts, "node", "left").join(links, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "component").select(
        F.col("node").alias("c_node"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        "component_id",
    )
    joined = rows.select("vec_id", "node").join(named, F.col("node") == F.col("c_node"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        F.col("vec_id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
