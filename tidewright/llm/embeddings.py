"""Near-duplicate vectors by tiled comparison in the order of principal directions."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.graph import components
from tidewright.session import Scratch

THRESHOLD = 0.95
#: Rows of a tile, most tiles of a block on a side, and leading directions that cells may be cut along: at most (2 / width + 2) ** CELL_DIMS cells.
TILE = 2048
TILES = 16
CELL_DIMS = 4
#: Bytes of vectors that go to pairs of blocks at once; as many as all vectors have, if that is more.
MOVED = 256 << 20
#: Directions added up between two tests of the bound.
STEPS = (8, 24)
#: Products this near to the threshold are computed again from the vectors as given.
CLOSE = 1e-9


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def directions(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions of the unit vectors of each length, strongest first: length x length numbers, summed in tasks."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, own in batch.groupby(batch["v"].map(len)):
                y = unit(stacked(own["v"]))
                totals[dims] = totals.get(dims, 0) + y.T @ y
        for dims, total in totals.items():
            yield pd.DataFrame({"dims": dims, "at": np.arange(dims * dims), "value": total.ravel()})

    rows = vectors.select("v").mapInPandas(moments, "dims int, at int, value double").groupBy("dims", "at").agg(
        F.sum("value").alias("value")).toPandas()
    out = {}
    for dims, own in rows.groupby("dims"):
        moment = np.zeros(dims * dims)
        moment[own["at"]] = own["value"]
        moment = moment.reshape(dims, dims)
        _, vectors_ = np.linalg.eigh((moment + moment.T) / 2)
        out[int(dims)] = vectors_[:, ::-1].copy()
    return out


def cell_plan(counts: dict[tuple[int, ...], int], block: int) -> tuple[int, list]:
    """How many leading directions to cut vectors of one length along, and the pairs of cells that may hold linked vectors:
    (cell, rows, other, rows). Cut finer while cells hold more than a block on average."""
    dims = 1
    cells: dict[tuple[int, ...], int] = {}
    for dims in range(1, len(next(iter(counts))) + 1):
        cells = {}
        for key, n in counts.items():
            cells[key[:dims]] = cells.get(key[:dims], 0) + n
        if sum(cells.values()) <= block * len(cells):
            break
    steps = list(itertools.product((-1, 0, 1), repeat=dims))
    near = [s for s in steps if s >= (0,) * dims]  # each pair once
    out = []
    for cell, n in cells.items():
        for step in near:
            other = tuple(c + s for c, s in zip(cell, step, strict=True))
            if other in cells:
                out.append((cell, n, other, cells[other]))
    return dims, out


def plan_blocks(counts: dict[int, dict[tuple[int, ...], int]], width: int) -> tuple[int, list, list, int]:
    """Rows of a block, (length, directions cut along) and (length, pairs of cells) of each length, and in how many turns the pairs of
    blocks are compared; `counts` has the rows of each cell, `width` the bytes of a component.

    Every row goes to each block that may hold linked rows, so larger blocks move fewer bytes. They grow until what moves is MOVED
    bytes, or as many as all vectors have; what is more than that with the largest blocks goes in turns.
    """
    size = lambda dims: dims * width + 64
    most = max(MOVED, sum(n * size(dims) for dims, cells in counts.items() for n in cells.values()))
    block = TILE
    while True:
        cuts, pairs, moved = [], [], 0
        for dims, cells in counts.items():
            cut, near = cell_plan(cells, block)
            cuts.append((dims, cut))
            pairs.append((dims, near))
            moved += size(dims) * sum(n * -(-n // block) if cell == other else n * -(-m // block) + m * -(-n // block) for cell, n, other, m in near)
        if moved <= most or block >= TILE * TILES:
            return block, cuts, pairs, -(-moved // most)
        block *= 2


def compare(xa: np.ndarray, ya: np.ndarray, xb: np.ndarray, yb: np.ndarray, threshold: float, same: bool) -> np.ndarray:
    """Which pairs of rows have cosine >= threshold; x are the vectors as given, y those of length 1 along the principal directions.

    Leading directions are added up first. What the others can add is at most the product of what is
    left of both lengths; pairs, then rows and columns, then the tile are given up when even that
    does not reach the threshold.
    """
    found = np.zeros((len(xa), len(xb)), bool)
    ra, rb = np.arange(len(xa)), np.arange(len(xb))
    dims, low = ya.shape[1], 0
    product = np.zeros((len(ra), len(rb)))
    for high in [s for s in STEPS if s < dims] + [dims]:
        product += ya[ra, low:high] @ yb[rb, low:high].T
        low = high
        if high == dims:
            break
        left = np.sqrt(np.einsum("ij,ij->i", ya[ra, high:], ya[ra, high:]))
        right = np.sqrt(np.einsum("ij,ij->i", yb[rb, high:], yb[rb, high:]))
        alive = product + left[:, None] * right[None, :] >= threshold - CLOSE
        rows, cols = alive.any(1), alive.any(0)
        if not rows.any():
            return found
        ra, rb, product = ra[rows], rb[cols], product[np.ix_(rows, cols)]
    linked = product >= threshold
    for i, j in np.argwhere(np.abs(product - threshold) < CLOSE):
        u, v = (x / np.abs(x).max() for x in (xa[ra[i]], xb[rb[j]]))
        linked[i, j] = np.dot(u, v) / (np.sqrt(np.dot(u, u)) * np.sqrt(np.dot(v, v))) >= threshold
    found[np.ix_(ra, rb)] = linked
    if same:
        found |= found.T
        np.fill_diagonal(found, False)
    return found


def in_tiles(rows: pd.DataFrame, turn: np.ndarray, threshold: float) -> list[tuple]:
    """(id, n, x, y, least y, most y) of tiles of the rows, which are put in the order of their leading directions first."""
    x = stacked(rows["v"])
    y = unit(x) @ turn
    order = np.lexsort(np.floor(y[:, :CELL_DIMS] / max(np.sqrt(max(2 - 2 * threshold, 0.0)), 1e-9)).T[::-1])
    ids, n = rows["id"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    tiles = [order[low:low + TILE] for low in range(0, len(order), TILE)]
    return [(ids[t], n[t], x[t], y[t], y[t, :STEPS[0]].min(0), y[t, :STEPS[0]].max(0)) for t in tiles]


def links_of_tiles(a: tuple, b: tuple, threshold: float, same: bool) -> list[pd.DataFrame]:
    """(id, links, root) of the rows of two tiles that are linked."""
    ia, na, xa, ya, low_a, high_a = a
    ib, nb, xb, yb, low_b, high_b = b
    apart = np.maximum(np.maximum(low_b - high_a, low_a - high_b), 0)
    if np.dot(apart, apart) > 2 - 2 * threshold + CLOSE:
        return []
    found = compare(xa, ya, xb, yb, threshold, same)
    if not found.any():
        return []
    la, lb = ia.copy(), ib.copy()
    most = np.iinfo(np.int64).max
    while True:
        ma = np.minimum(la, np.where(found, lb[None, :], most).min(1))
        mb = ma if same else np.minimum(lb, np.where(found, ma[:, None], most).min(0))
        if (ma == la).all() and (mb == lb).all():
            break
        la, lb = ma, mb
    out = [pd.DataFrame({"id": ia, "links": found @ nb, "root": la})]
    if not same:
        out.append(pd.DataFrame({"id": ib, "links": na @ found, "root": lb}))
    return [x[x["links"] > 0] for x in out]


def block_links(frame: pd.DataFrame, turns: dict[int, np.ndarray], threshold: float) -> pd.DataFrame:
    """(id, links, root) of the rows of one pair of blocks that are linked: how many vectors, and the
    smallest row reachable within these blocks, so a block of copies gives a row each and not their pairs."""
    a, b = (frame[frame["side"] == side] for side in (0, 1))
    same = not len(b) and bool(frame["alone"].iloc[0])
    none = pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
    if not len(a) or (not len(b) and not same):
        return none
    turn = turns[len(a["v"].iloc[0])]
    own = in_tiles(a, turn, threshold)
    others = own if same else in_tiles(b, turn, threshold)
    found = [x for i, tile in enumerate(own) for j, other in enumerate(others) if not same or i <= j
             for x in links_of_tiles(tile, other, threshold, same and i == j)]
    if not found:
        return none
    linked = pd.concat(found)
    names, at = np.unique(np.concatenate([linked["id"], linked["root"]]), return_inverse=True)
    u, v = at[:len(linked)], at[len(linked):]
    least = np.arange(len(names))
    while True:
        before, now = least.copy(), np.minimum(least[u], least[v])
        np.minimum.at(least, u, now)
        np.minimum.at(least, v, now)
        if (least == before).all():
            break
    return linked.assign(root=names[least[u]]).groupby(["id", "root"], as_index=False, sort=False)["links"].sum()[["id", "links", "root"]]


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `vectors`: key, n_links, component_id, kept.

    Linked are rows whose vectors have cosine >= threshold in double precision. n_links counts the other
    rows linked directly, component_id is the smallest key reachable, kept says that it is the row's own.

    Equal vectors are first brought to one row with a count. Rows go to cells of the leading principal
    directions, as wide as linked vectors can be apart, so links lie in cells that touch; cells are cut
    into blocks, and each pair of blocks that touch is one group of bounded size, compared by tiles. A vector in a third of
    all rows is one row; a dense cell is many blocks. Blocks grow with the table, and their pairs are compared in turns, so that
    what is moved at once stays in proportion to the vectors (`plan_blocks`); the comparisons of a dense cell grow with its square.

    Vectors of each length are compared among themselves, in cells along directions of their own.

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing. Rows that repeat a key are rows of their own; a null key is
    never the name of a component with other keys; an empty table gives an empty result.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    # Floats stay floats, in half the bytes; they are compared as doubles.
    kind = "float" if vectors.select(vector).dtypes[0][1] == "array<float>" else "double"
    v = F.col(vector).cast(f"array<{kind}>")
    rows = vectors.select(F.col(key).alias("key"), v.alias("v"))
    sound = (F.col("v").isNotNull() & (F.size("v") > 0) & F.col("key").isNotNull()
             & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    members = scratch.settle(rows.select("key", F.when(F.coalesce(sound, F.lit(False)), F.col("v")).alias("v")))
    reps = scratch.settle(members.filter("v IS NOT NULL").groupBy("v").agg(F.min("key").cast("long").alias("id"), F.count("*").alias("n")))
    turns = directions(reps)
    if not turns:
        linked = spark.createDataFrame([], "id bigint, links bigint, root bigint")
    else:
        width = float(np.sqrt(max(2 - 2 * threshold, 0.0))) * (1 + 1e-9) + 1e-9

        def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dims, own in batch.groupby(batch["v"].map(len)):
                    y = np.floor(unit(stacked(own["v"])) @ turns[dims][:, :CELL_DIMS] / width).astype(np.int32)
                    yield own.assign(dims=dims, cell=list(y))

        located = scratch.settle(reps.mapInPandas(locate, f"v array<{kind}>, id bigint, n bigint, dims int, cell array<int>"))
        scratch.drop(reps)
        reps = located.select("v", "id", "n")
        counts: dict[int, dict[tuple[int, ...], int]] = {}
        for r in located.groupBy("dims", "cell").count().collect():  # bounded by CELL_DIMS for each length
            counts.setdefault(r["dims"], {})[tuple(r["cell"])] = r["count"]
        block_rows, cuts, near, turns_needed = plan_blocks(counts, 4 if kind == "float" else 8)
        blocks = lambda n: -(-n // block_rows)
        plan = []
        for dims, pairs in near:
            named = lambda c: ",".join(map(str, (dims, *c)))  # noqa: E731, B023
            # Pairs of cells start one turn after the other, the largest first.
            plan += [(named(c), side, named(o), blocks(m), blocks(k), c == o, at)
                     for at, (cell, n, other, m2) in enumerate(sorted(pairs, key=lambda p: -p[1] * p[3]))
                     for c, side, o, m, k in ([(cell, 0, other, m2, n)] + ([] if cell == other else [(other, 1, cell, n, m2)]))]
        to = spark.createDataFrame(plan, "at string, side int, other string, blocks long, own long, inner boolean, start long")
        cut_of = spark.createDataFrame(cuts, "dims int, cut int")
        placed = located.join(F.broadcast(cut_of), "dims").withColumn(
            "at", F.concat_ws(",", "dims", F.slice("cell", F.lit(1), F.col("cut")))).drop("dims", "cell", "cut").join(F.broadcast(to), "at")
        block = F.pmod(F.xxhash64("id"), F.col("own"))
        blocked = placed.withColumn("block", block)
        first, second = F.least("block", "with"), F.greatest("block", "with")
        side = F.when(F.col("inner"), F.when(F.col("block") <= F.col("with"), 0).otherwise(1)).otherwise(F.col("side"))
        left = F.when(F.col("inner"), F.concat_ws(":", "at", first)).when(
            F.col("side") == 0, F.concat_ws(":", "at", "block")).otherwise(F.concat_ws(":", "other", "with"))
        right = F.when(F.col("inner"), F.concat_ws(":", "at", second)).when(
            F.col("side") == 0, F.concat_ws(":", "other", "with")).otherwise(F.concat_ws(":", "at", "block"))

        def compared(k: int) -> DataFrame:
            # Blocks i and j meet in the turn of start + i + j, which both sides know.
            begin = F.pmod(F.lit(k) - F.col("start") - F.col("block"), F.lit(turns_needed))
            spread = blocked.withColumn("begin", begin).filter(F.col("begin") <= F.col("blocks") - 1).withColumn(
                "with", F.explode(F.sequence("begin", F.col("blocks") - 1, F.lit(turns_needed).cast("long"))))
            tiles = spread.select("id", "v", "n", side.alias("side"), left.alias("l"), right.alias("r"),
                                  (F.col("inner") & (F.col("block") == F.col("with"))).alias("alone"))
            return scratch.settle(tiles.groupBy("l", "r").applyInPandas(
                lambda frame: block_links(frame, turns, threshold), "id bigint, links bigint, root bigint"))

        found = [compared(k) for k in range(turns_needed)]
        linked = scratch.settle(functools.reduce(DataFrame.union, found)) if len(found) > 1 else found[0]
    counted = linked.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
    named = scratch.settle(reps.join(counted, "id", "left").join(named.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("v").alias("of"), F.coalesce("component", "id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    out = members.join(named, F.col("v") == F.col("of"), "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", F.col("key").cast("long")).alias("component_id"))
    scratch.keep(members, named)
    scratch.drop(*[df for df, _ in list(scratch.tables.values())])
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(False)))
