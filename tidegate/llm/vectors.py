"""Near-duplicate embeddings by product quantisation with exact rerank.

Unit vectors are dealt to inverted lists (the nearest of a few coarse centroids) and each vector's residual is coded by
its nearest codeword in every subspace. A query goes to every list that can hold a partner: a vector at most RADIUS away
lies beyond the plane halfway to another centroid only if the query is within RADIUS of that plane. In a list, distances come
from a table of the query's subspace distances to all codewords, one lookup per subspace and vector; a coded distance is off
by at most the coded vector's own error, which is stored, so vectors beyond RADIUS plus that error are passed over and none
within it. What remains is compared by exact cosine in double precision. No partner is lost.

Codebooks are fitted on a bounded sample (SAMPLE vectors); every vector is indexed. Equal vectors of a label form a class
and are compared once. Lists are cut into blocks of BLOCK_ROWS at most on both sides, which meet in pairs, one task
each; a task reports, per vector, how many vectors it met and the smallest vector it is joined with - never the pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and those without label or id,
link with nothing; so do vectors of different lengths. Rows with the same id are vectors of their own that share a
component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.frames import map_arrow, map_groups, stored

SIMILAR = 0.98
SAMPLE = 20_000
SUBSPACES, CODES = 8, 64
MOST_LISTS = 4096
BLOCK_ROWS = 1024
# Slack for rounding in the tests that only pass over vectors.
SLACK = 1e-6


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers ** 2).sum(1) - 2 * x @ centers.T).argmin(1)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Centers of at most k clusters."""
    distinct = np.unique(x, axis=0)
    random = np.random.default_rng(seed)
    centers = distinct[random.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        own = _nearest(x, centers)
        count = np.bincount(own, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, own, x)
        centers = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centers)
    return centers


class Codebook:
    def __init__(self, sample: np.ndarray, lists: int):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.coarse = kmeans(unit, lists)
        square = (self.coarse ** 2).sum(1)
        self.apart = np.sqrt(np.maximum(square[:, None] + square[None] - 2 * self.coarse @ self.coarse.T, 0))
        self.cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        rest = unit - self.coarse[_nearest(unit, self.coarse)]
        self.words = [kmeans(rest[:, a:b], CODES) for a, b in zip(self.cuts, self.cuts[1:])]

    def parts(self, x: np.ndarray):
        return (x[:, a:b] for a, b in zip(self.cuts, self.cuts[1:]))

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, distance to what the codes stand for) of each vector."""
        own = _nearest(unit, self.coarse)
        rest = unit - self.coarse[own]
        codes = np.stack([_nearest(p, w) for p, w in zip(self.parts(rest), self.words)], 1)
        shown = np.concatenate([w[codes[:, s]] for s, w in enumerate(self.words)], 1)
        return own, codes.astype(np.uint8), np.linalg.norm(rest - shown, axis=1)

    def probes(self, unit: np.ndarray, own: np.ndarray, radius: float) -> list[np.ndarray]:
        """Lists from the own one on (by number) that can hold a vector within the radius. Of two partners the one
        whose list has the smaller number asks."""
        far = ((self.coarse ** 2).sum(1) - 2 * unit @ self.coarse.T)
        gap = far - far[np.arange(len(unit)), own][:, None]
        near = gap <= 2 * (radius + SLACK) * self.apart[own] + SLACK
        near &= np.arange(len(self.coarse))[None] >= own[:, None]
        return [np.flatnonzero(row) for row in near]

    def distances(self, unit: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to the coded vectors of a list, by table lookup."""
        out = np.zeros((len(unit), len(codes)))
        for s, (part, words) in enumerate(zip(self.parts(unit - self.coarse[which]), self.words)):
            table = (part ** 2).sum(1)[:, None] - 2 * part @ words.T + (words ** 2).sum(1)[None]
            out += table[:, codes[:, s]]
        return np.sqrt(np.maximum(out, 0))


def fitted(classes: DataFrame, dim: int) -> Codebook:
    n = classes.count()
    rows = classes.where(F.size("vector") == dim).orderBy(F.xxhash64("vec", "label"), "vec").limit(SAMPLE).select("vector").collect()
    return Codebook(np.array([r["vector"] for r in rows], dtype=np.float64), min(MOST_LISTS, max(1, int(n ** 0.5 / 4))))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _joined(linked: np.ndarray, left: np.ndarray, right: np.ndarray, total: int) -> np.ndarray:
    """Labels of `total` things, equal where links (rows left, columns right) join them."""
    label = np.arange(total)
    for i in np.flatnonzero(linked.any(axis=1)):
        met = np.unique(np.append(label[right[linked[i]]], label[left[i]]))
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    return label


def links(classes: DataFrame, book: Codebook, similar: float) -> DataFrame:
    """class, met (vectors linked), other (a class it is joined with), one row per class and task in which it has links.

    classes: class, label, vector, n; all of one length.
    """
    radius = float(np.sqrt(2 - 2 * similar))
    shared = classes.sparkSession.sparkContext.broadcast(book)

    def place(batches):
        b = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                x = _matrix(part.column("vector"))
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                own, codes, error = b.encode(unit)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array([p.tolist() for p in b.probes(unit, own, radius)], pa.list_(pa.int32()))],
                    names=[*part.schema.names, "list", "codes", "error", "probes"])

    base = "class long, label string, vector array<double>, n long"
    coded = stored(map_arrow(classes.select("class", F.col("label").cast("string").alias("label"), F.col("vector").cast("array<double>").alias("vector"), "n"),
                             place, base + ", list int, codes binary, error double, probes array<int>"), "codes")
    asked = coded.select("class", "label", "vector", "n", F.col("list").alias("home"), F.explode("probes").alias("list"))
    cell = ["label", "list"]
    held = coded.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("held"))
    asks = asked.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("asks"))
    blocks = stored(held.join(asks, cell), "blocks")

    def dealt(df: DataFrame, mine: str, theirs: str, side: int) -> DataFrame:
        """Each row once for every block of the other side."""
        own = F.pmod(F.xxhash64("class"), F.col(mine)).cast("string")
        out = df.join(blocks, cell).withColumn("beside", F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)))
        pair = [F.col("beside").cast("string"), own]
        return out.withColumn("unit", F.concat_ws(":", "label", F.col("list").cast("string"), *(pair if side else reversed(pair)))).withColumn("side", F.lit(side))

    columns = ["unit", "side", "class", "vector", "n", "list", "home", "codes", "error"]
    queries = dealt(asked, "asks", "held", 0).withColumn("codes", F.lit(None).cast("binary")).withColumn("error", F.lit(None).cast("double"))
    lists = dealt(coded.withColumn("home", F.col("list")), "held", "asks", 1)
    met = queries.select(*columns).unionByName(lists.select(*columns))

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        q, y = table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))
        none = pa.table({"class": pa.array([], pa.int64()), "met": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        if not len(q) or not len(y):
            return none
        left, right = _matrix(q.column("vector")), _matrix(y.column("vector"))
        size_l, size_r = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
        which = int(y.column("list")[0].as_py())
        codes = np.frombuffer(b"".join(y.column("codes").to_pylist()), np.uint8).reshape(len(right), -1)
        near = shared.value.distances(left / size_l[:, None], which, codes) <= radius + y.column("error").to_numpy()[None] + SLACK
        id_l, id_r = q.column("class").to_numpy(), y.column("class").to_numpy()
        # Within a list both partners ask; the smaller class counts.
        home = q.column("home").to_numpy()
        near &= (home != which)[:, None] | (id_l[:, None] < id_r[None])
        a, b = np.nonzero(near)
        cosine = np.einsum("ij,ij->i", left[a], right[b]) / (size_l[a] * size_r[b])
        linked = np.zeros(near.shape, bool)
        linked[a, b] = cosine >= similar
        names, place_of = np.unique(np.concatenate([id_l, id_r]), return_inverse=True)
        row, column = place_of[:len(id_l)], place_of[len(id_l):]
        label = _joined(linked, row, column, len(names))
        amount = np.zeros(len(names), np.int64)
        np.add.at(amount, row, linked @ y.column("n").to_numpy())
        np.add.at(amount, column, q.column("n").to_numpy() @ linked)
        hit = np.flatnonzero(amount)
        return pa.table({"class": pa.array(names[hit]), "met": pa.array(amount[hit]), "other": pa.array(names[label[hit]])})

    return map_groups(met, "unit", compare, "class long, met long, other long")


def near_vectors(embeddings: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = embeddings.select("vec_id", F.col("label"), F.col("embedding").cast("array<double>").alias("vector"))
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.size("vector") > 0, F.lit(False))
            & F.forall("vector", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))) & F.exists("vector", lambda v: v != 0))
    valid = rows.where(F.coalesce(fine, F.lit(False)))
    # A class is named by its smallest row; ids may repeat, so classes of equal ids are kept apart by a number.
    classes = valid.groupBy("label", "vector").agg(F.min("vec_id").alias("vec"), F.count("*").alias("n"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    found = None
    for dim in [r[0] for r in classes.select(F.size("vector")).distinct().collect()]:
        part = classes.where(F.size("vector") == dim)
        one = links(part, fitted(part, dim), similar)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, "links")
    counts = found.groupBy("class").agg(F.sum("met").alias("met"))
    named = classes.select("class", "label", "vector", "vec", "n")
    met = named.join(counts, "class", "left").select("label", "vector", "vec", "class", (F.col("n") - 1 + F.coalesce("met", F.lit(0))).alias("n_links"))
    # Links between classes and rows alike, in terms of vec_id.
    name = classes.select("class", "vec")
    between = (found.where("class != other").join(name, "class").select("other", F.col("vec").alias("a"))
               .join(name.withColumnRenamed("class", "other"), "other").select("a", F.col("vec").alias("b")))
    member = stored(valid.join(met, ["label", "vector"]).select("vec_id", "vec", "n_links"), "members")
    joined = components(between.unionByName(member.select(F.col("vec_id").alias("a"), F.col("vec").alias("b"))))
    rest = rows.where(~F.coalesce(fine, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    component = F.coalesce("component", "vec_id")
    return (member.select("vec_id", "n_links").join(joined, F.col("vec_id") == F.col("node"), "left")
            .select("vec_id", "n_links", component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
            .unionByName(rest.select("vec_id", "n_links", F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))))
