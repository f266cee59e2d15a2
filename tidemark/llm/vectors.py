"""Near-duplicate embeddings by product quantisation.

Unit vectors lie in inverted lists of coarse centroids and are stored as subspace codes of their
residuals. A vector visits every list that can hold a neighbour: the distance to the hyperplane
between two cells bounds the distance to any member of the other. In a list, table-look-up distances
plus each member's own quantisation error leave few candidates, whose cosine is computed exactly.
Both bounds are triangle inequalities, so no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import stage

LINKS = "edge boolean, a long, cid long, b long"  # an edge (a, b), or b links of class (a, cid)
SLACK = 1e-6


@dataclass(frozen=True)
class Quantizer:
    """Coarse centroids (cells, d) and, per subspace, centroids of residuals (m, codes, d / m, padded)."""

    coarse: np.ndarray
    fine: np.ndarray
    d: int

    def split(self, x: np.ndarray) -> np.ndarray:
        m, _, width = self.fine.shape
        return np.pad(x, ((0, 0), (0, m * width - self.d))).reshape(len(x), m, width)

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes and quantisation error of each row, and its distances to all centroids."""
        far = np.sqrt(np.maximum(0, 1 - 2 * unit @ self.coarse.T + (self.coarse**2).sum(1)))
        cell = far.argmin(1)
        rest = self.split(unit - self.coarse[cell])
        codes = np.empty(rest.shape[:2], np.uint8)
        near = np.empty_like(rest)
        for j, book in enumerate(self.fine):
            codes[:, j] = ((book**2).sum(1) - 2 * rest[:, j] @ book.T).argmin(1)
            near[:, j] = book[codes[:, j]]
        return cell, codes, np.sqrt(((rest - near) ** 2).sum((1, 2))), far

    def tables(self, unit: np.ndarray, cell: int) -> np.ndarray:
        """(rows, m, codes): squared distances of the rows' residuals to each subspace centroid."""
        rest = self.split(unit - self.coarse[cell])
        return np.stack([((rest[:, j, None] - book) ** 2).sum(2) for j, book in enumerate(self.fine)], 1)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8) -> np.ndarray:
    centroids = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(steps):
        of = ((centroids**2).sum(1) - 2 * x @ centroids.T).argmin(1)
        n = np.bincount(of, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, of, x)
        centroids = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centroids)
    return centroids


def fit(sample: np.ndarray, cells: int, subspaces: int = 16, codes: int = 64) -> Quantizer:
    """Fit on unit vectors; the fit decides the speed, never the result."""
    rng = np.random.default_rng(7)
    d = sample.shape[1]
    coarse = _k_means(sample, cells, rng)
    m = min(subspaces, d)
    width = -(-d // m)
    empty = Quantizer(coarse, np.zeros((m, codes, width)), d)
    of = ((coarse**2).sum(1) - 2 * sample @ coarse.T).argmin(1)
    rest = empty.split(sample - coarse[of])
    return Quantizer(coarse, np.stack([_k_means(rest[:, j], codes, rng, 5) for j in range(m)]), d)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; scaled down first so that squares do not overflow."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, d)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays as bytes of doubles."""
    for batch in batches:
        values = batch.column("embedding")
        raw = [np.asarray(v.values, np.float64).tobytes() for v in values]
        yield batch.set_column(batch.schema.get_field_index("embedding"), "raw", pa.array(raw, pa.binary()))


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place that each place is connected with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _search(quantizer: Quantizer, threshold: float):
    """Links of one tile: visitors against a block of one list's members."""
    reach = math.sqrt(2 - 2 * threshold) + SLACK

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        member = tile["member"].to_numpy()
        tile = pd.concat([tile[member], tile[~member]], ignore_index=True)
        m, cell = int(member.sum()), int(tile["cell"].iat[0])
        raw = np.frombuffer(b"".join(tile["raw"]), np.float64).reshape(len(tile), -1)
        unit = _unit(raw)
        codes = np.frombuffer(b"".join(tile["codes"][:m]), np.uint8).reshape(m, -1)
        error = tile["error"].to_numpy()[:m]
        inside = bool(tile["inside"].iat[0])  # a block against itself: members visit too
        visitors = np.arange(m) if inside else np.arange(m, len(tile))
        found_i, found_j = [], []
        for at in range(0, len(visitors), 128):
            who = visitors[at : at + 128]
            table = quantizer.tables(unit[who], cell)
            far = np.zeros((len(who), m))
            for k in range(codes.shape[1]):
                far += table[:, k, codes[:, k]]
            i, j = np.nonzero(np.sqrt(far) <= reach + error)
            i = who[i]
            if inside:
                i, j = i[j < i], j[j < i]
            # Exact cosine of the candidates.
            keep = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            found_i.append(i[keep])
            found_j.append(j[keep])
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_i, found_j))
        rep, cid, copies = tile["rep"].to_numpy(), tile["cid"].to_numpy(), tile["copies"].to_numpy()
        links = np.bincount(i, copies[j], len(tile)) + np.bincount(j, copies[i], len(tile))
        some = np.flatnonzero(links)
        root = _local_roots(len(tile), i, j)
        child = np.flatnonzero(root != np.arange(len(tile)))
        return pd.DataFrame(
            {
                "edge": np.arange(len(some) + len(child)) >= len(some),
                "a": np.concatenate([rep[some], rep[child]]).astype(np.int64),
                "cid": np.concatenate([cid[some], np.zeros(len(child), np.int64)]).astype(np.int64),
                "b": np.concatenate([links[some].astype(np.int64), rep[root[child]]]).astype(np.int64),
            }
        )

    return run


def _tiles(coded: DataFrame, block: int) -> DataFrame:
    """Rows beside the rows they meet: (label, cell, mb, vb, inside, member, ...), each tile of bounded size.

    A list's members are cut into blocks and so are its visitors; each block of
    visitors meets each block of members, and members meet the blocks from their own on.
    """
    place = F.xxhash64("cid", F.lit(1))
    visits = coded.select("*", F.explode("probes").alias("to"))
    n_members = coded.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_m"))
    n_visits = visits.groupBy("label", F.col("to").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_v"))
    sizes = n_members.join(n_visits, ["label", "cell"], "left").na.fill(0, ["n_v"])

    base = ["label", "cid", "rep", "copies", "raw", "codes", "error"]
    own = coded.drop("probes").join(sizes, ["label", "cell"]).withColumn("mb", F.pmod(place, F.col("n_m")).cast("int"))
    none = F.array().cast("array<int>")

    def upto(n):  # 0 .. n - 1
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)

    # vb < 0: members of the same list, -1 - their block.
    as_member = own.select(
        *base, "cell", "mb", F.lit(True).alias("member"),
        F.explode(F.concat(upto(F.col("n_v")), F.transform(upto(F.col("mb") + 1), lambda x: -1 - x))).alias("vb"),
    )
    as_member = as_member.withColumn("inside", F.col("vb") == -1 - F.col("mb"))
    within = own.where("n_m > 1").select(
        *base, "cell", F.lit(False).alias("member"), (-1 - F.col("mb")).alias("vb"),
        F.explode(F.sequence(F.col("mb"), F.col("n_m") - 1)).alias("to_mb"),
    )
    within = within.where(F.col("to_mb") > -1 - F.col("vb")).withColumn("inside", F.lit(False)).withColumnRenamed("to_mb", "mb")
    guests = visits.drop("cell", "probes").withColumnRenamed("to", "cell").join(sizes, ["label", "cell"])
    guests = guests.withColumn("vb", F.pmod(place, F.col("n_v")).cast("int")).select(
        *base, "cell", "vb", F.lit(False).alias("member"), F.lit(False).alias("inside"), F.explode(upto(F.col("n_m"))).alias("mb")
    )
    return as_member.unionByName(within).unionByName(guests)


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = 0.93, sample: int = 20_000, block: int = 2_000,
) -> DataFrame:
    """One row per vector: (key, n_links, component_id, kept).

    Vectors of one label and dimension are linked where their cosine, in double
    precision, reaches ``threshold``. Vectors null, empty, zero or with a null or
    non-finite component, and those with a null label or key, link with nothing: they
    are their own component. Equal vectors are one row until the end, so copies cost
    nothing. A repeated key counts once per row. Quantisers are fitted on at most
    ``sample`` distinct vectors, chosen by a hash; every vector is indexed.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = (
        F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size(F.coalesce("embedding", F.array().cast(rows.schema["embedding"].dataType))) > 0)
        & ~bad & F.exists("embedding", lambda x: x != 0)
    )
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    rows = rows.withColumn("cid", F.when(F.col("good"), F.xxhash64("label", "embedding")))
    classes = rows.where("good").groupBy("label", "cid", "embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = classes.withColumn("d", F.size("embedding"))
    schema = classes.schema
    packed = f"label {schema['label'].dataType.simpleString()}, cid long, raw binary, rep long, copies long, d int"
    classes = stage(classes.mapInArrow(_pack, packed), "vector-classes")

    links = []
    # Dimensions are a property of the source: one, or few.
    for d, n in sorted(tuple(r) for r in classes.groupBy("d").count().collect()):
        own = classes.where(F.col("d") == d)
        few = own.orderBy(F.xxhash64("cid", F.lit(3)), "cid").limit(sample).select("raw").toPandas()
        unit = _unit(np.frombuffer(b"".join(few["raw"]), np.float64).reshape(-1, d))
        quantizer = fit(unit, cells=min(4096, max(1, math.isqrt(n) // 4)))
        kind = schema["label"].dataType.simpleString()
        coded = own.drop("d").mapInArrow(
            _coder(quantizer, threshold),
            f"label {kind}, cid long, raw binary, rep long, copies long, cell int, codes binary, error double, probes array<int>",
        )
        tiles = _tiles(stage(coded, "vector-codes"), block)
        links.append(tiles.groupBy("label", "cell", "mb", "vb").applyInPandas(_search(quantizer, threshold), LINKS))
    if links:
        found = links[0]
        for more in links[1:]:
            found = found.unionByName(more)
        found = stage(found, "vector-links")
    else:
        found = spark.createDataFrame([], LINKS)
    of = components(found.where("edge").select("a", "b"))
    counted = found.where("not edge").groupBy("a", "cid").agg(F.sum("b").alias("n"))
    classes = (
        classes.select("cid", "rep", "copies")
        .join(counted.select(F.col("a").alias("rep"), "cid", "n"), ["rep", "cid"], "left")
        .join(of.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select(
            "cid", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
        )
    )
    linked = rows.where("good").join(classes, "cid").select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _coder(quantizer: Quantizer, threshold: float):
    """Cell, codes, error and the later cells to visit of each vector."""
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    c = quantizer.coarse
    apart = np.sqrt(np.maximum(0, (c**2).sum(1)[:, None] + (c**2).sum(1) - 2 * c @ c.T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                unit = _unit(_matrix(part.column("raw"), quantizer.d))
                cell, codes, error, far = quantizer.encode(unit)
                gap = far**2 - far[np.arange(len(far)), cell][:, None] ** 2
                visit = (gap <= 2 * reach * apart[cell] + SLACK) & (np.arange(len(c)) > cell[:, None])
                probes = [np.flatnonzero(v).astype(np.int32) for v in visit]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(x) for x in ("label", "cid", "raw", "rep", "copies")], pa.array(cell.astype(np.int32)),
                        pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(error), pa.array(probes, pa.list_(pa.int32())),
                    ],
                    names=["label", "cid", "raw", "rep", "copies", "cell", "codes", "error", "probes"],
                )

    return run
