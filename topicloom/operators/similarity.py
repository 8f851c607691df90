"""Exact cosine self-join and best-partner search.

Vectors are dealt in a few blocks by id ranges, and each pair of blocks that can hold a pair with
partner > id is one task group: a vector is copied at most once per block, whatever the number of
cells. Inside a group the right vectors lie in cells around pivots, and a chunk of left vectors is
multiplied only with the cells that can hold a match: the half-space and cell-radius bounds used
are necessary conditions, so no pair is lost.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.vectors import vec_norm
from pyspark.sql.window import Window

from topicloom.operators.skew import dense_index, lookup_join
from topicloom.session import cut_lineage

BLOCK_ROWS = 2048
# Blocks of one side: a vector travels to half of them on average. Their rows grow with the data up
# to what a task holds at ease, so that from BLOCKS * BLOCK_ROWS vectors on a vector has the same
# number of copies; beyond BLOCKS * MAX_BLOCK_ROWS vectors there are more blocks.
BLOCKS = 6
MAX_BLOCK_ROWS = 65_536
# Products that a task holds at a time.
PRODUCTS = 1 << 22
# Matches that leave a task at a time.
PIECE_ROWS = 65_536
# Similarities are compared to this many decimals, so that the order of floating sums
# cannot change a tie.
DECIMALS = 12
SLACK = 1e-9


def with_unit(docs: DataFrame, key: str = "id", vec: str = "vec", measure: str = "cosine") -> DataFrame:
    """(id, u): the vectors to be multiplied. ``cosine`` divides by the norm and leaves out zero
    vectors, which match nothing; ``dot`` takes the vectors as they are."""
    v = F.col(vec).cast("array<double>")
    if measure == "dot":
        return docs.select(F.col(key).alias("id"), v.alias("u"))
    if measure != "cosine":
        raise ValueError(f"unknown measure: {measure}")
    scaled = docs.select(F.col(key).alias("id"), v.alias("v"), vec_norm(v).alias("n")).where("n > 0")
    return scaled.select("id", F.transform("v", lambda x: x / F.col("n")).alias("u"))


class _Cells:
    """Pivots in two levels, and the rules that place right rows and route left rows.

    About sqrt(P) upper pivots are drawn from the P pivots; each pivot belongs to its nearest upper
    one. A row's home is the nearest pivot of its nearest upper pivot's group, so placing a row costs
    about 2 sqrt(P) products however many cells there are. Routing is exact: a group is visited when
    the row lies within the threshold angle plus the group's radius of its upper pivot, a cell when
    it lies within the angle plus the cell's radius, and, in the row's own group (where homes are
    nearest pivots), when the half-space bound between the two pivots allows it.
    """

    def __init__(self, pivots: np.ndarray, thres: float):
        self.pivots = pivots
        self.sin = math.sqrt(max(0.0, 1.0 - min(thres, 1.0) ** 2))
        self.angle = math.acos(min(thres, 1.0))
        upper = max(1, math.isqrt(len(pivots) - 1) + 1)
        self.upper = pivots[:upper]
        owner = (pivots @ self.upper.T).argmax(axis=1)
        self.members = [np.flatnonzero(owner == g) for g in range(upper)]
        self.group_of = owner

    @staticmethod
    def _unit(u: np.ndarray) -> np.ndarray:
        norms = np.linalg.norm(u, axis=1, keepdims=True)
        return u / np.where(norms > 0, norms, 1.0)

    def home(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cell, cosine to it, group, cosine to the group's upper pivot) of each row."""
        q = self._unit(u)
        to_upper = q @ self.upper.T
        group = to_upper.argmax(axis=1)
        cell = np.empty(len(q), np.int64)
        near = np.empty(len(q))
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            sims = q[rows] @ self.pivots[self.members[g]].T
            best = sims.argmax(axis=1)
            cell[rows] = self.members[g][best]
            near[rows] = sims[np.arange(len(rows)), best]
        return cell, near, group, to_upper[np.arange(len(q)), group]

    def _routes(self, u: np.ndarray, radius: np.ndarray, group_radius: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, cells, which of these cells may hold a match of which of these rows), group by group."""
        q = self._unit(u)
        cell, near, group, _ = self.home(u)
        to_upper = np.arccos(np.clip(q @ self.upper.T, -1.0, 1.0))
        open_groups = to_upper <= self.angle + group_radius[None, :] + SLACK
        for g in np.flatnonzero(open_groups.any(axis=0)):
            rows = np.flatnonzero(open_groups[:, g])
            cells = self.members[g]
            sims = np.clip(q[rows] @ self.pivots[cells].T, -1.0, 1.0)
            ok = np.arccos(sims) <= self.angle + radius[cells][None, :] + SLACK
            own = group[rows] == g
            if own.any():
                mine = rows[own]
                home_sims = near[mine]
                gaps = np.sqrt(np.maximum(2.0 - 2.0 * np.clip(self.pivots[cell[mine]] @ self.pivots[cells].T, -1.0, 1.0), 0.0))
                ok[own] &= home_sims[:, None] - sims[own] <= self.sin * gaps + SLACK
            yield rows, cells, ok

    def reach(self, u: np.ndarray, radius: np.ndarray, group_radius: np.ndarray) -> np.ndarray:
        """Which cells may hold a match of any of the rows."""
        found = np.zeros(len(self.pivots), bool)
        for _, cells, ok in self._routes(u, radius, group_radius):
            found[cells] |= ok.any(axis=0)
        return found

    def visits(self, u: np.ndarray, radius: np.ndarray, group_radius: np.ndarray) -> list[np.ndarray]:
        """Per row, the cells that may hold a match of it."""
        found: list[list[np.ndarray]] = [[] for _ in range(len(u))]
        for rows, cells, ok in self._routes(u, radius, group_radius):
            for i, row in enumerate(rows):
                hit = cells[ok[i]]
                if len(hit):
                    found[row].append(hit)
        return [np.concatenate(f).astype("int32") if f else np.zeros(0, "int32") for f in found]


def _pick_pivots(rows: DataFrame, n: int, block_rows: int) -> np.ndarray | None:
    """A fixed choice of about one row per ``4 * block_rows``; only these reach the driver."""
    wanted = n // (4 * block_rows)
    if wanted < 2:
        return None
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(wanted).select("u").collect()
    units = np.array([r[0] for r in chosen], dtype=float)
    norms = np.linalg.norm(units, axis=1, keepdims=True)
    units = np.unique(units[norms[:, 0] > 0] / norms[norms[:, 0] > 0], axis=0)
    if len(units) < 2:
        return None
    # a fixed order independent of np.unique's sort, so that the upper pivots are spread
    return units[np.argsort(np.array([zlib.crc32(r.tobytes()) for r in units]), kind="stable")]


def _ranged(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows with ``block``: their place in id order within their cell, cut every ``block_rows``.

    One range-partitioned sort numbers all rows, so no task sees a whole cell; only one row per
    cell (its first number) is broadcast."""
    numbered = dense_index(rows, ["cell", "id"], "_nth")
    firsts = numbered.groupBy("cell").agg(F.min("_nth").alias("_first"))
    block = F.floor((F.col("_nth") - F.col("_first")) / F.lit(block_rows)).cast("int")
    return lookup_join(numbered, firsts, "cell").withColumn("block", block).drop("_nth", "_first")


def _range_blocks(routes: DataFrame, homes: DataFrame, block_rows: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Left and right rows, each copied to the block pairs that may hold a match (partner > id). Further
    columns come along, those of right rows with ``r_`` before their names.

    Blocks follow id ranges. A right block whose largest id is at most a left block's least id
    holds no partner of it, so each left block meets a suffix of the right blocks of its cell and
    each right block a prefix of the left blocks; mirrored and empty pairs are never dealt. Both
    ends come from one sort of the block bounds per cell (one row per block)."""
    more_l = [c for c in routes.columns if c not in ("cell", "id", "u")]
    more_r = [F.col(c).alias(f"r_{c}") for c in homes.columns if c not in ("cell", "id", "u")]
    left, right = _ranged(routes, block_rows), _ranged(homes, block_rows)
    tops = right.groupBy("cell", "block").agg(F.max("id").alias("bound")).withColumn("kind", F.lit(0))
    bottoms = left.groupBy("cell", "block").agg(F.min("id").alias("bound")).withColumn("kind", F.lit(1))
    # At equal bounds a right top comes first: it holds no partner of that left block.
    order = Window.partitionBy("cell").orderBy("bound", "kind").rowsBetween(Window.unboundedPreceding, 0)
    counted = tops.unionByName(bottoms).withColumns(
        {"tops_before": F.sum(1 - F.col("kind")).over(order), "bottoms_before": F.sum("kind").over(order) - F.col("kind")}
    )
    counted = cut_lineage(counted.join(tops.groupBy("cell").agg(F.count("*").alias("rbs")), "cell"))
    plan_l = counted.where((F.col("kind") == 1) & (F.col("tops_before") < F.col("rbs"))).select(
        "cell", "block", F.col("tops_before").cast("int").alias("first"), F.col("rbs").cast("int").alias("rbs")
    )
    plan_r = counted.where((F.col("kind") == 0) & (F.col("bottoms_before") > 0)).select(
        "cell", "block", (F.col("bottoms_before") - 1).cast("int").alias("last")
    )
    if plan_l.isEmpty():
        return None, None
    lefts = lookup_join(left, plan_l, ["cell", "block"]).select(
        "cell", F.col("block").alias("lb"), F.explode(F.sequence("first", F.col("rbs") - 1)).alias("rb"), "id", "u", *more_l
    )
    # Fresh names: both sides may come from one table.
    rights = lookup_join(right, plan_r, ["cell", "block"]).select(
        F.col("cell").alias("rcell"), F.explode(F.sequence(F.lit(0), "last")).alias("rlb"), F.col("block").alias("rrb"),
        F.col("id").alias("partner"), F.col("u").alias("v"), *more_r,
    )
    return lefts, rights


def _block_size(n: int, block_rows: int) -> int:
    """Rows of a block among ``n``."""
    return max(block_rows, min(MAX_BLOCK_ROWS, -(-n // BLOCKS)))


def _blocked(
    left: DataFrame, right: DataFrame, thres: float, pick: str | None, max_norm: float, n: int, block_rows: int
) -> DataFrame:
    """Matches (id, partner, sim) of left ids with larger right ids above ``thres``; with
    ``pick``, the best per left id and block pair.

    ``near`` and ``count`` are for rows with bucket numbers ``h``: the matches that share a bucket,
    and the numbers (exact, near) of all matches and of those, one row per block pair, where a row counts ``times``."""
    spark = left.sparkSession
    kind = "exact long, near long" if pick == "count" else "id string, partner string, sim double"
    pivots = _pick_pivots(right, n, block_rows)
    cells, homes = None, right
    if pivots is not None:
        cells = _Cells(pivots, thres / max(max_norm, 1.0) ** 2)
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in right.schema.fields)

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    cell, near, group, upper_near = cells.home(np.stack(b["u"].to_numpy()))
                    yield b.assign(home=cell.astype("int32"), near=near, grp=group.astype("int32"), unear=upper_near)

        # Written down: placed twice, a row whose last bits differ could land in a cell that no plan knows.
        homes = cut_lineage(right.mapInPandas(place, f"{fields}, home int, near double, grp int, unear double"))
        # one row per pivot and per upper pivot
        radius = np.full(len(pivots), -np.inf)
        for r in homes.groupBy("home").agg(F.min("near").alias("m")).collect():
            radius[r["home"]] = math.acos(max(-1.0, min(1.0, r["m"])))
        group_radius = np.full(len(cells.upper), -np.inf)
        for r in homes.groupBy("grp").agg(F.min("unear").alias("m")).collect():
            group_radius[r["grp"]] = math.acos(max(-1.0, min(1.0, r["m"])))
        homes = homes.drop("near", "grp", "unear")

    rows = _block_size(n, block_rows)
    lefts, rights = _range_blocks(left.withColumn("cell", F.lit(0)), homes.withColumn("cell", F.lit(0)), rows)
    if lefts is None:
        return spark.createDataFrame([], kind)
    if pick is None:
        return _all_matches(lefts, rights, thres, cells, *((radius, group_radius) if cells is not None else (None, None)))
    names_out = [part.split()[0] for part in kind.split(", ")]

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c: [] for c in names_out})
        b = b.sort_values("partner", ignore_index=True)
        names, ids = b["partner"].to_numpy(dtype=object), a["id"].to_numpy(dtype=object)
        # Place of each left id among the right ids: partners start there.
        start = np.searchsorted(names, ids, side="right")
        ua, ub = np.stack(a["u"].to_numpy()), np.stack(b["v"].to_numpy())
        ha, hb = (np.stack(a["h"].to_numpy()), np.stack(b["r_h"].to_numpy())) if pick in ("near", "count") else (None, None)
        # Neighbours come in one chunk, so that a chunk reaches few cells or buckets.
        order = np.arange(len(a))
        if cells is not None:
            home, order = b["r_home"].to_numpy(), np.argsort(cells.home(ua)[0], kind="stable")
        elif pick == "near":
            order = np.argsort(ha[:, 0], kind="stable")
        step = max(1, min(512, PRODUCTS // len(b)))
        out, exact, shared = [], 0, 0
        for lo in range(0, len(a), step):
            at = order[lo : lo + step]
            spots = np.arange(start[at].min(), len(b))
            if cells is not None:
                spots = spots[cells.reach(ua[at], radius, group_radius)[home[spots]]]
            if pick == "near":
                met = np.zeros(len(spots), bool)
                for t in range(ha.shape[1]):
                    met |= np.isin(hb[spots, t], ha[at, t])
                spots = spots[met]
            if not len(spots):
                continue
            sims = np.round(ua[at] @ ub[spots].T, DECIMALS)
            hit = (spots[None, :] >= start[at, None]) & (sims > thres)
            if pick in ("max", "first"):
                i = np.flatnonzero(hit.any(axis=1))
                j = hit[i].argmax(axis=1) if pick == "first" else np.where(hit[i], sims[i], -np.inf).argmax(axis=1)
            else:
                i, j = np.nonzero(hit)
            if pick in ("near", "count"):
                same = (ha[at[i]] == hb[spots[j]]).any(axis=1)
                times = a["times"].to_numpy()[at[i]] * b["r_times"].to_numpy()[spots[j]]
                exact, shared = exact + int(times.sum()), shared + int(times[same].sum())
                i, j = i[same], j[same]
            if pick != "count":
                out.append(pd.DataFrame({"id": ids[at[i]], "partner": names[spots[j]], "sim": sims[i, j]}))
        if pick == "count":
            return pd.DataFrame({"exact": [exact], "near": [shared]})
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: [] for c in names_out})

    units = rights.groupBy("rcell", "rlb", "rrb")
    return lefts.groupBy("cell", "lb", "rb").cogroup(units).applyInPandas(multiply, kind)


def _vectors(lists: pa.Array) -> np.ndarray:
    if pc.count_distinct(pc.list_value_length(lists)).as_py() > 1:
        raise ValueError("vectors differ in size")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _all_matches(
    lefts: DataFrame, rights: DataFrame, thres: float, cells: _Cells | None, radius: np.ndarray | None, group_radius: np.ndarray | None
) -> DataFrame:
    """(id, partner, sim): every match of each pair of blocks, whose number has no bound.

    The rows of a pair of blocks follow one another, right ones first: a task holds one right block, left rows pass by in
    batches, and matches leave in pieces of up to ``PIECE_ROWS``."""
    home = F.lit(None).cast("int") if cells is None else F.col("r_home")
    a = lefts.select("lb", "rb", F.lit(1).alias("side"), "id", "u", F.lit(None).cast("int").alias("home"))
    b = rights.select(F.col("rlb").alias("lb"), F.col("rrb").alias("rb"), F.lit(0).alias("side"), F.col("partner").alias("id"), F.col("v").alias("u"), home.alias("home"))
    piece = PIECE_ROWS

    def matches(run: pa.RecordBatch, names: np.ndarray, partners: pa.Array, ub: np.ndarray, homes: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, ua = run.column("id"), _vectors(run.column("u"))
        # Place of each left id among the right ids: partners start there.
        start = np.searchsorted(names, np.array(ids.to_pylist(), dtype=object), side="right")
        order = np.arange(len(ids)) if cells is None else np.argsort(cells.home(ua)[0], kind="stable")
        step = max(1, min(512, PRODUCTS // len(ub)))
        for lo in range(0, len(ids), step):
            at = order[lo : lo + step]
            spots = np.arange(start[at].min(), len(ub))
            if cells is not None and len(spots):
                spots = spots[cells.reach(ua[at], radius, group_radius)[homes[spots]]]
            if not len(spots):
                continue
            sims = ua[at] @ ub[spots].T
            # Only what may be above the threshold after rounding is rounded.
            i, j = np.nonzero((sims > thres - SLACK) & (spots[None, :] >= start[at, None]))
            sims = np.round(sims[i, j], DECIMALS)
            hit = sims > thres
            i, j, sims = at[i[hit]], spots[j[hit]], sims[hit]
            for k in range(0, len(sims), piece):
                part = slice(k, k + piece)
                yield pa.record_batch([ids.take(pa.array(i[part])), partners.take(pa.array(j[part])), pa.array(sims[part])], names=["id", "partner", "sim"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, parts, right = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("lb", "rb", "side")])
            bounds = [0, *(np.flatnonzero((np.diff(marks) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                if hi == lo:
                    continue
                run = batch.slice(lo, hi - lo)
                if pair != (marks[0, lo], marks[1, lo]):
                    pair, parts, right = (marks[0, lo], marks[1, lo]), [], None
                if marks[2, lo] == 0:
                    parts.append(run)
                elif parts or right:
                    if right is None:
                        block = pa.Table.from_batches(parts)
                        names = np.array(block.column("id").to_pylist(), dtype=object)
                        by_id = np.argsort(names, kind="stable")
                        held = (block.column(c).combine_chunks() for c in ("id", "u", "home"))
                        partners, units, homes = (c.take(pa.array(by_id)) for c in held)
                        right, parts = (names[by_id], partners, _vectors(units), pc.fill_null(homes, 0).to_numpy(zero_copy_only=False)), []
                    yield from matches(run, *right)

    rows = b.unionByName(a).repartition("lb", "rb").sortWithinPartitions("lb", "rb", "side")
    return rows.mapInArrow(multiply, "id string, partner string, sim double")


def _size(units: DataFrame) -> tuple[int, float]:
    row = units.agg(F.count("*"), F.max(vec_norm("u"))).first()
    return row[0], row[1] or 0.0


def cosine_self_join(
    docs: DataFrame, thres: float, measure: str = "cosine", key: str = "id", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All pairs (id, partner, sim) with id < partner (text order) and sim > thres."""
    _check(thres)
    units = with_unit(docs, key, measure=measure)
    n, max_norm = _size(units)
    return _blocked(units, units, thres, None, max_norm if measure == "dot" else 1.0, n, block_rows)


def _check(thres: float) -> None:
    if thres < 0:
        raise ValueError("thres must be >= 0")


def next_copies(units: DataFrame) -> DataFrame:
    """(id, partner): for documents whose unit vectors agree to 12 decimals, the next id among
    the copies. A third of all rows may be copies of one text: they are numbered by a range
    partitioned sort and meet their successor by its number, never in one group."""
    same = F.transform("u", lambda x: F.round(x, DECIMALS) + F.lit(0.0))
    marks = units.select("id", F.xxhash64(same).alias("h1"), F.xxhash64(F.lit(1), same).alias("h2"))
    numbered = dense_index(marks, ["h1", "h2", "id"], "n")
    follower = numbered.select((F.col("n") - 1).alias("n"), "h1", "h2", F.col("id").alias("partner"))
    return numbered.join(follower, ["n", "h1", "h2"]).select("id", "partner")


def _first_in_run(units: DataFrame, thres: float) -> DataFrame:
    """(id, partner, sim) found among the ids that directly follow in id order.

    Rows are range partitioned and sorted by id, so that a batch is a gapless run of ids and
    its first match is the first of all. Copies find one another here."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), BLOCK_ROWS):
                run = b.iloc[lo : lo + BLOCK_ROWS]
                names, u = run["id"].to_numpy(dtype=object), np.stack(run["u"].to_numpy())
                sims = np.round(u @ u.T, DECIMALS)
                hit = np.triu(sims > thres, 1)
                i = np.flatnonzero(hit.any(axis=1))
                j = hit[i].argmax(axis=1)
                yield pd.DataFrame({"id": names[i], "partner": names[j], "sim": sims[i, j]})

    runs = units.repartitionByRange("id").sortWithinPartitions("id")
    return runs.mapInPandas(search, "id string, partner string, sim double")


def best_partner(
    docs: DataFrame,
    thres: float,
    pick: str = "max",
    measure: str = "cosine",
    key: str = "id",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, partner, sim): for each document at most one later document above ``thres``.

    ``max`` takes the most similar (the first in id order on ties; copies count as similarity 1
    and come first), ``first`` the first in id order. Documents without a partner are left out.
    """
    _check(thres)
    if pick not in ("max", "first"):
        raise ValueError(f"unknown pick: {pick}")
    units = with_unit(docs, key, measure=measure)
    n, max_norm = _size(units)
    early = None
    if pick == "first":
        early = _first_in_run(units, thres)
    elif measure == "cosine" and thres < 1:
        early = next_copies(units).withColumn("sim", F.lit(1.0))
    waiting = units if early is None else units.join(early.select("id"), "id", "left_anti")
    found = _blocked(waiting, units, thres, pick, max_norm if measure == "dot" else 1.0, n, block_rows)
    best = F.min(F.struct((-F.col("sim")).alias("s"), "partner")) if pick == "max" else F.min(F.struct("partner", (-F.col("sim")).alias("s")))
    late = found.groupBy("id").agg(best.alias("b")).select("id", "b.partner", (-F.col("b.s")).alias("sim"))
    return late if early is None else early.unionByName(late)


# Opt-in approximate join: random projection hash tables and the seed of their projections.
LSH_TABLES = 8
LSH_SEED = 7


def approx_self_join(
    docs: DataFrame, thres: float, key: str = "id", tables: int = LSH_TABLES, bucket_length: float | None = None, seed: int = LSH_SEED
) -> DataFrame:
    """Opt-in approximate cosine self-join: pairs (id, partner, sim), id < partner, sim > thres, of
    vectors that share a bucket in one of ``tables`` random projections (Spark ML's bucketed random
    projection LSH on unit vectors, where cos > t means a distance below sqrt(2 - 2t)).

    Every returned pair is a true pair (similarity is computed exactly); pairs may be missed, so
    measure with :func:`lsh_recall`. The bucket width defaults to four times the typical projected
    distance of a pair at the threshold. Zero vectors match nothing, as in the exact join."""
    found = _bucketed(docs, thres, key, tables, bucket_length, seed)
    return _blocked(found, found, thres, "near", 1.0, found.count(), BLOCK_ROWS)


def _bucketed(docs: DataFrame, thres: float, key: str, tables: int, bucket_length: float | None, seed: int) -> DataFrame:
    """(id, u, times, h): unit vectors with their bucket number in each table; equal rows once, with their number."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    _check(thres)
    units = cut_lineage(with_unit(docs, key).groupBy("id", "u").agg(F.count("*").alias("times")))
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * min(thres, 1.0)))
    dims = units.agg(F.max(F.size("u"))).first()[0]
    if not dims:
        return units.withColumn("h", F.array().cast("array<double>"))
    width = bucket_length or max(4.0 * radius / math.sqrt(dims), 1e-6)
    features = units.withColumn("features", array_to_vector("u"))
    model = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=width, numHashTables=tables, seed=seed
    ).fit(features)
    numbers = F.array(*[vector_to_array(F.col("hashes")[t])[0] for t in range(tables)])
    return cut_lineage(model.transform(features).select("id", "u", "times", numbers.alias("h")))


def lsh_recall(
    docs: DataFrame, thres: float, key: str = "id", tables: int = LSH_TABLES, bucket_length: float | None = None, seed: int = LSH_SEED
) -> DataFrame:
    """One row: exact pairs, pairs the approximate join finds, and their ratio (1.0 without pairs).

    Both joins look at the same pairs of blocks, so the pairs are counted where they are found."""
    found = _bucketed(docs, thres, key, tables, bucket_length, seed)
    row = _blocked(found, found, thres, "count", 1.0, found.count(), BLOCK_ROWS).agg(F.sum("exact"), F.sum("near")).first()
    n_exact, n_found = row[0] or 0, row[1] or 0
    spark = docs.sparkSession
    return spark.createDataFrame(
        [(n_exact, n_found, n_found / n_exact if n_exact else 1.0)], "exact_pairs long, found_pairs long, recall double"
    )
