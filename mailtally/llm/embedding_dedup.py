"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them.

Equal vectors of a label are one class from the start. A bounded sample of the classes
gives the centres of spherical k-means; every vector lives in the cell of the centre it is
most alike. So that no link across a border is lost, a vector also visits each cell whose
residents it could be linked with: a resident y of cell b has y.b >= y.a, so a vector x of
cell a has to be no farther from the plane between both centres than a linked pair can be
apart, that is (x.a - x.b) / |a - b| <= sqrt(2 - 2 * cosine). Links of x are then counted
with the residents of every cell it is in, each exactly once.

Cells are cut into blocks of about ``block`` residents and visitors, so a label or a cell
that holds a third of all rows is spread over many tasks. A product emits one number and
the star of its links per vector, not its pairs.

Defined cases: vectors that are null, empty or zero, or hold nulls or non-finite numbers,
and rows with a null label link with nothing; vectors of unlike lengths do not link. Rows
that repeat an id count as vectors of their own. Vectors too small or too large for their
squares are compared like any other, after division by their largest component. A null id is never the smallest one.
Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import stage
from mailtally.llm.components import components
from mailtally.llm.simhash import star


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Unit centres; an empty cell takes over the vector that is least like its own centre."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        like = x @ centres.T
        home = like.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1)
        for cell in np.flatnonzero(size < 1e-9):
            sums[cell] = x[like.max(1).argmin()]
            size[cell] = 1
        centres = sums / size[:, None]
    return centres


def fit_centres(classes: DataFrame, sample: int, most_cells: int, seed: int) -> np.ndarray:
    """Centres from at most ``sample`` classes, the first by a seeded hash.

    The number of cells grows with the root of the number of vectors.
    """
    n = classes.count()
    k = int(np.clip(round(n**0.5 / 64), 1, most_cells))
    rows = classes.orderBy(F.xxhash64(F.lit(seed), "h1"), "h2").limit(sample).select("x").collect()
    width = pd.Series([len(r.x) for r in rows]).mode()
    if not len(width):
        return np.zeros((0, 0))
    x = np.array([r.x for r in rows if len(r.x) == width[0]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    return spherical_kmeans(x, min(k, len(x)), seed=seed)


def _placed(centres: np.ndarray, cosine: float):
    reach = np.sqrt(2 - 2 * cosine) + 1e-9
    gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2) if len(centres) else None

    def place(batches):
        for pdf in batches:
            row, cell, home = [], [], []
            for i, x in enumerate(pdf["x"]):
                if len(centres) and len(x) == centres.shape[1]:
                    like = centres @ (x / np.linalg.norm(x))
                    a = int(like.argmax())
                    at = np.flatnonzero(like[a] - like <= reach * gaps[a])
                else:
                    a, at = 0, np.zeros(1, np.int64)
                row += [i] * len(at)
                cell += at.tolist()
                home += (at == a).tolist()
            out = pdf.iloc[row][["label", "h1", "copies", "x"]].reset_index(drop=True)
            yield out.assign(cell=np.array(cell, "int32"), home=np.array(home, bool))

    return place


def _product(cosine: float):
    def product(key, residents: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        found = []
        for width in set(residents["x"].map(len)) & set(visitors["x"].map(len)):
            r = residents[residents["x"].map(len) == width]
            v = visitors[visitors["x"].map(len) == width]
            y, x = np.stack(r["x"].to_numpy()), np.stack(v["x"].to_numpy())
            ny, nx = np.linalg.norm(y, axis=1), np.linalg.norm(x, axis=1)
            rh, vh, copies = r["h1"].to_numpy(), v["h1"].to_numpy(), r["copies"].to_numpy()
            links, ii, jj = np.zeros(len(x), np.int64), [], []
            for at in range(0, len(x), 512):
                near = (x[at : at + 512] @ y.T) / (nx[at : at + 512, None] * ny) >= cosine
                near &= vh[at : at + 512, None] != rh
                links[at : at + 512] = near @ copies
                i, j = np.nonzero(near)
                ii.append(i + at)
                jj.append(j)
            i, j = np.concatenate(ii), np.concatenate(jj)
            nodes, pos = np.unique(np.concatenate([vh, rh]), return_inverse=True)
            root = star(pos[i], pos[len(vh) + j], len(nodes))
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            hit = links > 0
            found.append(pd.DataFrame({"a": vh[hit], "b": pd.NA, "links": links[hit]}))
            found.append(pd.DataFrame({"a": nodes[moved], "b": nodes[root[moved]], "links": 0}))
        out = pd.concat(found) if found else pd.DataFrame({"a": [], "b": [], "links": []})
        return out.astype({"a": "int64", "b": "Int64", "links": "int64"})

    return product


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.93,
    sample: int = 20_000,
    most_cells: int = 1024,
    block: int = 4096,
    seed: int = 5,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    x = F.col("embedding").cast("array<double>")
    good = F.coalesce(
        F.col("label").isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists(x, lambda v: v != 0),
        F.lit(False),
    )
    # numbers whose squares leave the range of doubles are taken relative to the largest
    most = F.array_max(F.transform(x, F.abs))
    usual = most.between(1e-100, 1e100)
    scaled = F.transform(x, lambda v: v / most)
    rows = vectors.select(
        "vec_id",
        F.col("label").cast("string").alias("label"),
        F.when(good & ~usual, scaled).otherwise(x).alias("x"),
        good.alias("good"),
    )
    keys = [F.xxhash64(F.lit(i), "label", "x").alias(f"h{i}") for i in (1, 2)]
    linked = rows.where("good").select("vec_id", "label", "x", *keys)
    classes = stage(
        linked.groupBy("h1", "h2", "label", "x").agg(
            F.count("*").alias("copies"), F.min("vec_id").alias("first")
        ),
        "classes",
    )
    centres = fit_centres(classes, sample, most_cells, seed)
    placed = classes.select("label", "h1", "copies", "x").mapInPandas(
        _placed(centres, cosine),
        "label string, h1 long, copies long, x array<double>, cell int, home boolean",
    )
    placed = stage(placed, "placed")
    sizes = placed.groupBy("label", "cell").agg(
        F.ceil(F.count_if("home") / block).alias("blocks"), F.ceil(F.count("*") / block).alias("parts")
    )
    placed = placed.join(sizes, ["label", "cell"])
    own = lambda n: F.pmod(F.xxhash64(F.lit(3), "h1"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    residents = placed.where("home").select(
        "label", "cell", own("blocks").alias("block"), every("parts").alias("part"), "h1", "copies", "x"
    )
    visitors = placed.where("blocks > 0").select(
        "label", "cell", every("blocks").alias("block"), own("parts").alias("part"), "h1", "x"
    )
    visitors = visitors.toDF(*visitors.columns)  # both sides of the cogroup come from one frame
    key = ["label", "cell", "block", "part"]
    found = stage(
        residents.groupBy(*key)
        .cogroup(visitors.groupBy(*key))
        .applyInPandas(_product(cosine), "a long, b long, links long"),
        "products",
    )
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "h1")
    counts = found.where("b is null").groupBy(F.col("a").alias("h1")).agg(F.sum("links").alias("links"))
    rooted = (
        classes.select("h1", "h2", "copies", "first")
        .join(roots, "h1", "left")
        .join(counts, "h1", "left")
        .withColumn("root", F.coalesce("root", "h1"))
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    rooted = rooted.join(heads, "root").select(
        "h1", "h2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    with_links = linked.select("vec_id", "h1", "h2").join(rooted, ["h1", "h2"])
    alone = rows.where("not good").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        with_links.select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
