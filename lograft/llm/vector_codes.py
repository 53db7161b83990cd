"""Vector code compression with anchors-hierarchy metric trees over parts.

Vectors become integers, are cut into PARTS parts, and each part becomes the
index of the nearest entry of its position's codebook, learned in ROUNDS rounds
of exact k-means.

1. Rows are packed in blocks, in the order they come (nothing is shuffled). For
   each part of a block a tree of balls is built once, middle-out: about sqrt(n)
   anchors are set, each time at the point farthest from its anchor, taking the
   points nearer to it (the triangle inequality spares most tests); every
   anchor's points become a tree in the same way; the trees are joined pair by
   pair, smallest ball first. A ball holds the sum and the number of its points.
2. A round walks the trees with the codebooks. A ball inherits the entries that
   its parent could not rule out and strikes those that are farther than another
   one at every place in the ball. When one is left it owns the ball, whose
   cached sum and count are added without looking at points. Only leaves compare
   points, with the entries left.
3. Sums of a task are added up before they meet by key; a codebook is as large
   as PARTS x ENTRIES entries of each dimension that occurs.

Balls are struck by a margin that covers rounding; distances that decide are
integers. Vectors of different dimension are separate collections, each with its
own codebooks; one whose dimension is no multiple of PARTS is filled up with
zeros. The trees lie in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import land, lean, spread, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 4096            # rows of a block at most
COMPONENTS = 1 << 20    # of a block, about
LEAF = 48               # points of a leaf at most, unless they are equal
LARGEST = 1 << 26       # of a component as an integer: squares and sums stay within long
SLACK = 1e-9            # relative rounding that a strike must exceed


def anchors(x: np.ndarray, k: int) -> np.ndarray:
    """The anchor (0, 1, ...) of each point; at most `k`, fewer if points are equal."""
    owner = np.zeros(len(x), np.int64)
    far = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    pivots = x[:1].copy()
    for new in range(1, k):
        at = int(far.argmax())           # the farthest point of the widest anchor
        if far[at] == 0:
            break
        gap = np.sqrt(((pivots - x[at]) ** 2).sum(axis=1))
        test = np.flatnonzero(2 * far >= gap[owner])
        near = np.sqrt(((x[test] - x[at]) ** 2).sum(axis=1))
        won = near < far[test]
        owner[test[won]], far[test[won]] = new, near[won]
        pivots = np.concatenate([pivots, x[at:at + 1]])
    return owner


class Ball:
    """A node while its tree is built: points (or two balls), centre, radius bound."""

    __slots__ = ("centre", "n", "points", "radius", "two")

    def __init__(self, points: np.ndarray | None, two: tuple | None, centre: np.ndarray, radius: float, n: int):
        self.points, self.two, self.centre, self.radius, self.n = points, two, centre, radius, n


def _grow(x: np.ndarray, points: np.ndarray, leaf: int) -> Ball:
    mine = x[points]
    centre = mine.mean(axis=0)
    radius = float(np.sqrt(((mine - centre) ** 2).sum(axis=1)).max())
    if len(points) <= leaf or (mine == mine[0]).all():
        return Ball(points, None, centre, radius, len(points))
    owner = anchors(mine, int(np.ceil(np.sqrt(len(points)))))
    order = np.argsort(owner, kind="stable")
    return _join([_grow(x, points[g], leaf) for g in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)])


def _join(balls: list[Ball]) -> Ball:
    """Join the two balls that fit in the smallest one, until one is left."""
    n = len(balls)
    c, r = np.array([b.centre for b in balls]), np.array([b.radius for b in balls])
    cost = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)) + r[:, None] + r[None]
    cost[np.arange(n), np.arange(n)] = np.inf
    held = list(balls)
    for _ in range(n - 1):
        i, j = divmod(int(cost.argmin()), n)
        a, b = held[i], held[j]
        centre = (a.centre * a.n + b.centre * b.n) / (a.n + b.n)
        radius = max(float(np.sqrt(((centre - y.centre) ** 2).sum())) + y.radius for y in (a, b))
        held[i], held[j] = Ball(None, (a, b), centre, radius, a.n + b.n), None
        cost[j], cost[:, j] = np.inf, np.inf
        c[i], r[i] = centre, radius
        line = np.sqrt(((c - centre) ** 2).sum(axis=1)) + r + radius
        line[[k for k in range(n) if held[k] is None or k == i]] = np.inf
        cost[i], cost[:, i] = line, line
    return next(b for b in held if b is not None)


class Tree:
    """A tree of balls over integer points: every ball is a range of `order`."""

    FIELDS = ("order", "start", "stop", "left", "right", "sums", "radius")

    def __init__(self, x: np.ndarray, order, start, stop, left, right, sums, radius):
        self.order, self.start, self.stop, self.left, self.right, self.sums, self.radius = order, start, stop, left, right, sums, radius
        self.x = x[order]
        self.n = stop - start
        self.centre = sums / np.maximum(self.n, 1)[:, None]

    @classmethod
    def build(cls, x: np.ndarray, leaf: int = LEAF) -> Tree:
        order, nodes = [], []
        todo, at = [(_grow(x.astype(np.float64), np.arange(len(x)), leaf), -1, 0)], 0
        while todo:                                   # depth first, left first
            ball, parent, side = todo.pop()
            me = len(nodes)
            nodes.append([at, at + ball.n, -1, -1])
            if parent >= 0:
                nodes[parent][2 + side] = me
            if ball.two:
                todo += [(ball.two[1], me, 1), (ball.two[0], me, 0)]
            else:
                order.append(ball.points)
                at += ball.n
        start, stop, left, right = np.array(nodes, np.int64).T
        order = np.concatenate(order)
        before = np.concatenate([np.zeros((1, x.shape[1]), np.int64), np.cumsum(x[order], axis=0)])
        tree = cls(x, order, start, stop, left, right, before[stop] - before[start], np.zeros(len(nodes)))
        for k in range(len(nodes)):
            tree.radius[k] = np.sqrt(((tree.x[start[k]:stop[k]] - tree.centre[k]) ** 2).sum(axis=1).max())
        return tree

    def walk(self, book: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Who owns what: pairs (balls, entry of each), and of the points of
        leaves that none owns (place, entry, squared distance)."""
        c = book.astype(np.float64)
        apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))
        first = np.array([int((book == e).all(axis=1).argmax()) for e in book])
        may = (first == np.arange(len(book)))[None]    # of equal entries the lowest index
        at, owned, rest, rest_may = np.zeros(1, np.int64), [], [], []
        while len(at):
            d = ((self.centre[at][:, None] - c[None]) ** 2).sum(axis=2)
            best = np.where(may, d, np.inf).argmin(axis=1)
            low = d[np.arange(len(at)), best][:, None]
            reach = 2 * self.radius[at][:, None] * apart[best]
            may = may & ~(d - low - reach > SLACK * (1 + d + low + reach))
            alone = may.sum(axis=1) == 1
            owned.append((at[alone], best[alone]))
            at, may = at[~alone], may[~alone]
            end = self.left[at] < 0
            rest.append(at[end])
            rest_may.append(may[end])
            at, may = np.concatenate([self.left[at[~end]], self.right[at[~end]]]), np.concatenate([may[~end]] * 2)
        leaves, may = np.concatenate(rest), np.concatenate(rest_may)
        n = self.n[leaves]
        place = np.repeat(self.start[leaves] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        point, entry = np.nonzero(np.repeat(may, n, axis=0))
        if not len(point):
            none = np.empty(0, np.int64)
            return owned, (none, none, none)
        dist = ((self.x[place[point]] - book[entry]) ** 2).sum(axis=1)
        lowest = np.minimum.reduceat(dist, np.flatnonzero(np.r_[True, np.diff(point) > 0]))
        hit = np.flatnonzero(dist == lowest[point])
        hit = hit[np.r_[True, np.diff(point[hit]) > 0]]            # of equal distances the lowest entry
        return owned, (place, entry[hit], lowest)

    def add(self, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add the points of each entry to its sum and count."""
        owned, (place, entry, _) = self.walk(book)
        for balls, e in owned:
            np.add.at(sums, e, self.sums[balls])
            np.add.at(counts, e, self.n[balls])
        np.add.at(sums, entry, self.x[place])
        np.add.at(counts, entry, 1)

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every point, in the points' own order."""
        owned, (place, entry, dist) = self.walk(book)
        e, d = np.zeros(len(self.x), np.int64), np.zeros(len(self.x), np.int64)
        for balls, mine in owned:
            for ball, i in zip(balls, mine):
                some = slice(self.start[ball], self.stop[ball])
                e[some], d[some] = i, ((self.x[some] - book[i]) ** 2).sum(axis=1)
        e[place], d[place] = entry, dist
        out_e, out_d = np.empty_like(e), np.empty_like(d)
        out_e[self.order], out_d[self.order] = e, d
        return out_e, out_d


def _plant(parts: int, block: int):
    """Blocks of rows with a tree for each part: (dim, keys, ints, trees)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            got = held.pop(dim)
            keys, x = np.concatenate([k for k, _ in got]), np.concatenate([v for _, v in got])
            trees = [Tree.build(p) for p in np.split(x, parts, axis=1)]
            cols = [pa.array([[getattr(t, f).astype(np.float64 if f == "radius" else np.int64).tobytes() for t in trees]], pa.list_(pa.binary())) for f in Tree.FIELDS]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([keys.tobytes()]), pa.array([x.astype(np.int64).tobytes()]), *cols], ["dim", "keys", "ints", *Tree.FIELDS])

        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                mine = b.filter(pa.array(dims == dim))
                size = -(-dim // parts) * parts
                rows = max(LEAF, min(block, COMPONENTS // max(1, size)))
                x = mine.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(len(mine), size)
                keys = mine.column("key").to_numpy()
                for lo in range(0, len(keys), rows):
                    held.setdefault(dim, []).append((keys[lo:lo + rows], x[lo:lo + rows]))
                    if sum(len(k) for k, _ in held[dim]) >= rows:
                        yield out(dim)
            while sum(v.size for got in held.values() for _, v in got) > 4 * COMPONENTS:
                yield out(max(held, key=lambda k: sum(v.size for _, v in held[k])))
        for dim in list(held):
            yield out(dim)
    return lean(run)


def _trees(row: dict, parts: int) -> list[Tree]:
    keys = np.frombuffer(row["keys"], np.int64)
    x = np.frombuffer(row["ints"], np.int64).reshape(len(keys), -1)
    out = []
    for k, p in enumerate(np.split(x, parts, axis=1)):
        f = {n: np.frombuffer(row[n][k], np.float64 if n == "radius" else np.int64) for n in Tree.FIELDS}
        f["sums"] = f["sums"].reshape(len(f["start"]), p.shape[1])
        out.append(Tree(p, **f))
    return out


def _sums(books):
    """(dim, part, entry, pos, total, n) of a task's blocks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for row in b.to_pylist():
                book = books.value[row["dim"]]
                if row["dim"] not in held:
                    held[row["dim"]] = np.zeros_like(book), np.zeros(book.shape[:2], np.int64)
                sums, counts = held[row["dim"]]
                for k, tree in enumerate(_trees(row, len(book))):
                    tree.add(book[k], sums[k], counts[k])
        for dim, (sums, counts) in held.items():
            part, entry, pos = (a.ravel().astype(np.int32) for a in np.indices(sums.shape))
            n = np.repeat(counts.ravel(), sums.shape[2])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), dim, np.int32)), pa.array(part), pa.array(entry), pa.array(pos), pa.array(sums.ravel()), pa.array(n)],
                                             ["dim", "part", "entry", "pos", "total", "n"])
    return lean(run)


def _codes(books):
    """(key, code, error, codebooks_sha256) of every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = {dim: hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest() for dim, book in books.value.items()}
        for b in batches:
            for row in b.to_pylist():
                book = books.value[row["dim"]]
                got = [tree.assign(book[k]) for k, tree in enumerate(_trees(row, len(book)))]
                n, wide = len(got[0][0]), 2 * len(book)
                text = np.stack([e for e, _ in got], axis=1).astype(np.uint8).tobytes().hex()
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["keys"], np.int64)), pa.array([text[i:i + wide] for i in range(0, n * wide, wide)], pa.string()),
                                                  pa.array(sum(d for _, d in got)), pa.array([sha[row["dim"]]] * n)], ["key", "code", "error", "codebooks_sha256"])
    return lean(run)


def learn_codebooks(rows: DataFrame, trees: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    """{dimension: integers by part, entry and position}: the first `entries`
    rows by vec_id, then `rounds` rounds over all trees."""
    spark = rows.sparkSession
    by = Window.partitionBy("dim").orderBy(F.asc_nulls_last("vec_id"), "ints")
    seeds = rows.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= entries).select("dim", "r", "ints").collect()
    first: dict[int, list] = {}
    for s in sorted(seeds, key=lambda s: s.r):
        first.setdefault(s.dim, []).append(s.ints)
    books = {dim: np.stack(np.split(np.array(v, np.int64).reshape(len(v), -(-dim // parts) * parts), parts, axis=1)) for dim, v in first.items()}
    for _ in range(rounds):
        got = trees.mapInArrow(_sums(spark.sparkContext.broadcast(books)), "dim int, part int, entry int, pos int, total long, n long") \
            .groupBy("dim", "part", "entry", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).filter("n > 0").toPandas()
        books = {dim: book.copy() for dim, book in books.items()}
        for dim, g in got.groupby("dim"):
            at = tuple(g[c].to_numpy(int) for c in ("part", "entry", "pos"))
            books[dim][at] = g["total"].to_numpy(np.int64) // g["n"].to_numpy(np.int64)
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row for each row
    whose vector is not null and holds only finite components.

    Null and repeated ids are rows like others (null ids last in the order that
    seeds the codebooks, equal ids by their vectors); fewer rows than `entries`
    make fewer entries; null labels sum up together; an empty table gives an
    empty one; extra columns are ignored. A component beyond LARGEST as an
    integer ends the job with an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index takes two hex digits")
    spark = vectors.sparkSession
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), v.alias("v")) \
        .filter("v is not null and forall(v, x -> x is not null and abs(x) < double('infinity'))")
    bad = F.exists("v", lambda x: F.abs(x) * SCALE > LARGEST)
    ints = F.transform("v", lambda x: F.floor(x * SCALE).cast("long"))
    rows = rows.select("vec_id", "label", F.size("v").alias("dim"), F.when(bad, F.raise_error(F.lit("a vector component is too large"))).otherwise(
        F.concat(ints, F.array_repeat(F.lit(0).cast("long"), F.pmod(-F.size("v"), F.lit(parts))))).alias("ints"))
    rows = land(spread(rows).withColumn("key", F.monotonically_increasing_id()), "vector-ints")
    arrays = ", ".join(f"{f} array<binary>" for f in Tree.FIELDS)
    trees = land(rows.select("key", "dim", "ints").mapInArrow(_plant(parts, block), f"dim int, keys binary, ints binary, {arrays}"), "vector-trees")
    books = learn_codebooks(rows, trees, parts, entries, rounds)
    codes = trees.mapInArrow(_codes(spark.sparkContext.broadcast(books)), "key long, code string, error long, codebooks_sha256 string")
    done = land(codes.join(rows.select("key", "vec_id", "label"), "key"), "vector-codes")
    sums = done.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    big, small = done.alias("d"), sums
    return lookup_join(big, small, F.col("d.label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))
