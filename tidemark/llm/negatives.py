"""Hard negatives by angular triangle filtering.

Each vector is quantised to whole numbers; a score is the integer inner product of two
of them. Every row has its angles to a few reference directions. By the triangle
inequality the angle between two rows is at least the largest difference of their angles to a
reference, and at most the smallest sum (a sum beyond the half turn counts from the full
one). The two cosines times both lengths, rounded outwards, bound the score.

Anchors and rows are packed by nearest reference. Every pack of anchors meets every pack of
rows in one cell of a grid: a cell has a block of the anchors' packs, of bounded size,
and the rows' packs of one slot, which stream past it. A row's bounds against
the intervals of a pack decide, both ways, which rows of the two packs are scored at all:

* for positives, those that can reach the anchor's k-th best score in the cell so far;
* for negatives, those that can fall into the window of one of the anchor's positives
  and reach the k-th best score in it so far.

Where a score costs more than its bounds (long vectors, components beyond exact
doubles), each pair's own bounds decide too. A cell sends on the few best rows of an anchor (or
of an anchor and positive), so the shuffles that follow move no group as a whole. Nothing here is
broadcast, and only the sample for the references reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored
from tidemark.llm.vectors import by_width, matrix, unit_rows, usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # percent of the positive's score that a negative's must reach and keep to
REFERENCES = 8
SAMPLE = 2048  # rows that the references are chosen from, at most
SAMPLE_BYTES = 1 << 24
PACK = 512  # rows of a pack, at most
PACK_BYTES = 1 << 20
SCORES = 1 << 62  # no score may reach it: it bounds the quantised components of a vector
SLACK = 1e-6  # radians; an angle's rounding is far smaller
EXACT = 2.0**52  # whole numbers that doubles add without rounding
EXACT_SINGLE = 2.0**23  # and single floats
WIDE = 256  # components from which a score costs more than its bounds
BLOCK_BYTES = 1 << 25  # of a block of anchors, about
ANCHOR_BYTES = 128  # of an anchor beside its components, about
CHUNK = 1 << 16  # rows of a batch that a cell sends on
TINY = 1e-9

PACKED = (
    "pack bigint, width int, reach bigint, "
    "keys binary, ids binary, labels binary, vectors binary, windows binary"
)
NAMES = [x.split()[0] for x in PACKED.split(", ")]


def references(sample: list[list[float]]) -> dict[int, np.ndarray]:
    """Unit vectors of each length, chosen one after another: always the row farthest from those before."""
    chosen = {}
    lengths = np.array([len(x) for x in sample], np.int64)
    for width, at in by_width(lengths):
        units = unit_rows(np.array([sample[i] for i in at], np.float64))
        mean = unit_rows(units.mean(axis=0, keepdims=True))
        found = [mean[0] if mean.any() else units[0]]
        nearest = units @ found[0]
        for _ in range(REFERENCES - 1):
            found.append(units[int(np.argmin(nearest))])
            nearest = np.maximum(nearest, units @ found[-1])
        chosen[width] = np.array(found)
    return chosen


def quantised(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors * scale)


def angles_to(vectors: np.ndarray, directions: np.ndarray | None) -> np.ndarray:
    """Angle of each row to each direction; a zero row stands at a right angle to all."""
    if directions is None:
        return np.zeros((len(vectors), 0))
    return np.arccos(np.clip(unit_rows(vectors) @ directions.T, -1.0, 1.0))


def _packs(chosen: dict[int, np.ndarray], scale: int):
    """Rows (key, vec_id, label, vector, windows) in packs of one width and nearest reference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, int], list] = {}
        number = TaskContext.get().partitionId() << 33

        def batch_of(width: int, rows: list) -> pa.RecordBatch:
            nonlocal number
            keys, ids, labels, vectors, wanted = (np.array(x) for x in zip(*rows, strict=True))
            reach = int(np.abs(vectors).max(initial=0))
            small = np.int16 if reach <= np.iinfo(np.int16).max else np.int32
            pack = (
                number, width, reach, *[x.astype(np.int64).tobytes() for x in (keys, ids, labels)],
                vectors.astype(small).tobytes(), wanted.astype(np.int64).tobytes(),
            )
            number += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
            arrays = [pa.array([x], k) for x, k in zip(pack, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, NAMES)

        for batch in batches:
            vectors = batch.column("vector")
            lengths = np.asarray(pa.compute.list_value_length(vectors), np.int64)
            names = [batch.column(x).to_pylist() for x in ("key", "vec_id", "label", "windows")]
            for width, at in by_width(lengths):
                whole = quantised(matrix(vectors.take(pa.array(at)), width), scale)
                largest = min(math.isqrt(SCORES // width), np.iinfo(np.int32).max)
                fits = np.abs(whole).max(axis=1) <= largest
                angles = angles_to(whole, chosen.get(width))
                near = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(at), np.int64)
                room = max(1, min(PACK, PACK_BYTES // (4 * width)))
                for i in np.flatnonzero(fits).tolist():
                    key, vec_id, label, wanted = (x[int(at[i])] for x in names)
                    mine = waiting.setdefault((width, int(near[i])), [])
                    mine.append((key, vec_id, label, whole[i], wanted or []))
                    if len(mine) == room:
                        yield batch_of(width, waiting.pop((width, int(near[i]))))
        for (width, _), rows in waiting.items():
            yield batch_of(width, rows)

    return run


class Pack:
    """A pack's columns as arrays; angles that were not kept are counted again."""

    FIELDS = ("keys", "ids", "labels", "vectors", "angles", "windows", "lengths")

    def __init__(self, row: dict, side: str = "", directions: np.ndarray | None = None):
        width, mark = row["width"], side and f"_{side}"
        self.keys, self.ids, self.labels = (
            np.frombuffer(row[f"{x}{mark}"], np.int64) for x in ("keys", "ids", "labels")
        )
        n = len(self.ids)
        vectors = row[f"vectors{mark}"]
        self.vectors = np.frombuffer(vectors, np.int16 if len(vectors) == 2 * n * width else np.int32).reshape(n, width)
        angles = row.get(f"angles{mark}")
        if angles is None:
            self.angles = angles_to(self.vectors.astype(np.float64), directions)
        else:
            self.angles = np.frombuffer(angles, np.float64).reshape(n, -1)
        self.windows = np.frombuffer(row[f"windows{mark}"], np.int64).reshape(n, -1)
        self.reach = row[f"reach{mark}"]
        self.lengths = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))

    def taken(self, at: np.ndarray) -> Pack:
        """The rows at these places."""
        new = Pack.__new__(Pack)
        new.reach = self.reach
        for x in self.FIELDS:
            setattr(new, x, getattr(self, x)[at])
        return new

    @staticmethod
    def joined(packs: list[Pack]) -> Pack:
        new = Pack.__new__(Pack)
        new.reach = max(x.reach for x in packs)
        for x in Pack.FIELDS:
            setattr(new, x, np.concatenate([getattr(pack, x) for pack in packs]))
        return new


def bounds(a: Pack, b: Pack) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each pair of rows, rounded outwards."""
    apart = np.zeros((len(a.ids), len(b.ids)))
    within = np.full_like(apart, np.pi)
    for r in range(a.angles.shape[1]):
        x, y = a.angles[:, r, None], b.angles[None, :, r]
        np.maximum(apart, np.abs(x - y), out=apart)
        total = x + y
        np.minimum(within, np.minimum(total, 2 * np.pi - total), out=within)
    product = a.lengths[:, None] * b.lengths[None, :]
    high = np.cos(np.maximum(apart - SLACK, 0.0)) * product
    low = np.cos(np.minimum(within + SLACK, np.pi)) * product
    margin = TINY * product + 1.0
    return np.floor(low - margin), np.ceil(high + margin)


def scores(a: Pack, b: Pack, wanted: np.ndarray) -> np.ndarray:
    """Integer scores of the wanted pairs; others are zero."""
    exact = float(a.reach) * float(b.reach) * a.vectors.shape[1] <= EXACT
    kind = np.float64 if exact else np.int64
    x, y = a.vectors.astype(kind), b.vectors.astype(kind)
    found = np.zeros(wanted.shape, np.int64)
    if wanted.mean() > 1 / 16:
        found[wanted] = (x @ y.T)[wanted].astype(np.int64)
        return found
    i, j = np.nonzero(wanted)
    for k in range(0, len(i), 1 << 14):
        p, q = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
        found[p, q] = np.einsum("ij,ij->i", x[p], y[q]).astype(np.int64)
    return found


def best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of each row's best entries: by score, then id; equal ids and scores count once."""
    order = np.lexsort((ids, -score, row))
    r, i, s = row[order], ids[order], score[order]
    new = np.ones(len(order), bool)
    new[1:] = (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (s[1:] != s[:-1])
    order, r = order[new], r[new]
    begins = np.ones(len(r), bool)
    begins[1:] = r[1:] != r[:-1]
    first = np.maximum.accumulate(np.where(begins, np.arange(len(r)), 0))
    return order[np.arange(len(r)) - first < most]


def spans(a: Pack, b: Pack) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each row of ``a`` with any row of ``b``, rounded outwards.

    Only the intervals of the angles and lengths of ``b`` count.
    """
    low, high = b.angles.min(axis=0), b.angles.max(axis=0)
    short, long = a.lengths * b.lengths.min(), a.lengths * b.lengths.max()
    apart = np.maximum(a.angles - high, low - a.angles).max(axis=1, initial=0.0)
    within = np.minimum(a.angles + high, 2 * np.pi - a.angles - low).min(axis=1, initial=np.pi)
    most, least = np.cos(np.maximum(apart - SLACK, 0.0)), np.cos(np.minimum(within + SLACK, np.pi))
    margin = TINY * long + 1.0
    greatest = most * np.where(most >= 0, long, short) + margin
    return np.floor(least * np.where(least >= 0, short, long) - margin), np.ceil(greatest)


def pairs_within(a: Pack, b: Pack, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places in ``a`` and in ``b`` of the pairs that score from ``low`` to ``high``, given by row of ``a``, and their scores."""
    least, greatest = spans(a, b)
    rows = np.flatnonzero((low <= high) & (greatest >= low) & (least <= high))
    if not len(rows):
        return rows, rows, rows
    if len(rows) < len(a.ids):
        a, low, high = a.taken(rows), low[rows], high[rows]
    least, greatest = spans(b, a)
    columns = np.flatnonzero((greatest >= low.min()) & (least <= high.max()))
    if not len(columns):
        return columns, columns, columns
    if len(columns) < len(b.ids):
        b = b.taken(columns)
    largest = float(a.reach) * float(b.reach) * a.vectors.shape[1]
    if largest <= EXACT and a.vectors.shape[1] < WIDE:
        # Limits beyond the exact whole numbers are rounded, but no score lies there.
        kind = np.float32 if largest <= EXACT_SINGLE else np.float64
        score = a.vectors.astype(kind) @ b.vectors.astype(kind).T
        fits = score >= low[:, None].astype(kind)
        if high.min() < SCORES:
            fits &= score <= high[:, None].astype(kind)
    else:
        least, greatest = bounds(a, b)
        fits = (greatest >= low[:, None]) & (least <= high[:, None])
        score = scores(a, b, fits)
        fits &= (score >= low[:, None]) & (score <= high[:, None])
    i, j = np.nonzero(fits)
    return rows[i], columns[j], score[i, j].astype(np.int64)


class Leaders:
    """The best few (other, score) of each of many rows, as more and more are offered."""

    def __init__(self, rows: int, most: int):
        self.most = most
        self.bar = np.full(rows, -SCORES)  # the score to reach, and by ties the id to stay below
        self.bar_other = np.full(rows, np.iinfo(np.int64).max)
        self.held = [tuple(np.zeros(0, np.int64) for _ in range(3))]
        self.waiting, self.room = 0, max(1 << 15, rows * most)

    def offer(self, row: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
        bar = self.bar[row]
        fits = (score > bar) | ((score == bar) & (other <= self.bar_other[row]))
        if fits.any():
            self.held.append((row[fits], other[fits], score[fits]))
            self.waiting += len(self.held[-1][0])
            if self.waiting > self.room:
                self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Rows, others and scores of the best so far, by row."""
        row, other, score = (np.concatenate(x) for x in zip(*self.held, strict=True))
        kept = best(row, other, score, self.most)
        row, other, score = row[kept], other[kept], score[kept]
        self.held, self.waiting = [(row, other, score)], 0
        last = np.flatnonzero(np.append(row[1:] != row[:-1], True)) if len(row) else kept
        full = last[np.diff(last, prepend=-1) == self.most]
        self.bar[row[full]], self.bar_other[row[full]] = score[full], other[full]
        return row, other, score


class Block:
    """The anchors of a cell that have one width, by nearest reference, and their best rows so far."""

    def __init__(self, packs: list[Pack], most: int, windows: int, size: int):
        anchors = Pack.joined(packs)
        if anchors.angles.shape[1]:
            anchors = anchors.taken(np.argsort(anchors.angles.argmin(axis=1), kind="stable"))
        self.keys, self.windows = anchors.keys, windows
        self.leaders = Leaders(len(self.keys) * max(1, windows), most)
        self.parts = [
            (k, anchors.taken(np.arange(k, min(k + size, len(self.keys))))) for k in range(0, len(self.keys), size)
        ]

    def meet(self, b: Pack) -> None:
        for start, a in self.parts:
            if self.windows:
                self._negatives(start, a, b)
            else:
                self._positives(start, a, b)

    def _positives(self, start: int, a: Pack, b: Pack) -> None:
        low = self.leaders.bar[start : start + len(a.ids)]
        i, j, score = pairs_within(a, b, low, np.full(len(a.ids), SCORES))
        fits = (a.labels[i] == b.labels[j]) & (a.ids[i] != b.ids[j])
        self.leaders.offer(start + i[fits], b.ids[j[fits]], score[fits])

    def _negatives(self, start: int, a: Pack, b: Pack) -> None:
        n, count = len(a.ids), self.windows
        least, greatest = a.windows[:, :count], a.windows[:, count:]
        bar = self.leaders.bar[start * count : (start + n) * count].reshape(n, count)
        low, open_ = np.maximum(least, bar), least <= greatest
        i, j, score = pairs_within(
            a, b, np.where(open_, low, SCORES).min(axis=1), np.where(open_, greatest, -SCORES).max(axis=1)
        )
        differ = a.labels[i] != b.labels[j]
        i, j, score = i[differ], j[differ], score[differ]
        for p in range(count):
            fits = open_[i, p] & (score >= low[i, p]) & (score <= greatest[i, p])
            self.leaders.offer((start + i[fits]) * count + p, b.ids[j[fits]], score[fits])

    def found(self) -> Iterator[pa.RecordBatch]:
        row, other, score = self.leaders.settle()
        columns = {"key": self.keys[row // max(1, self.windows)], "other": other, "score": score}
        if self.windows:
            columns["nth"] = (row % self.windows + 1).astype(np.int32)
        for k in range(0, len(row), CHUNK):
            yield pa.RecordBatch.from_pydict({x: pa.array(y[k : k + CHUNK]) for x, y in columns.items()})


def _cells(chosen: dict[int, np.ndarray], most: int, windows: int = 0):
    """Best rows of each cell's anchors; a cell's anchors come first, then its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, blocks = None, {}, {}
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["cell"] != cell:
                    for block in blocks.values():
                        yield from block.found()
                    cell, waiting, blocks = row["cell"], {}, {}
                width = row["width"]
                if row["side"] == 0:
                    waiting.setdefault(width, []).append(Pack(row, directions=chosen.get(width)))
                    continue
                if width in waiting:
                    size = max(1, min(PACK, PACK_BYTES // (4 * width)))
                    blocks[width] = Block(waiting.pop(width), most, windows, size)
                if width in blocks:
                    blocks[width].meet(Pack(row, directions=chosen.get(width)))
        for block in blocks.values():
            yield from block.found()

    return run


def _grid(anchors: DataFrame, packs: DataFrame) -> tuple[int, int]:
    """Blocks of anchors, each of bounded size, and slots of rows.

    All anchors go to every slot and all rows to every block, so there are only as many slots
    as make the anchors' copies about as large as the rows', or keep all cores busy.
    """
    spark = anchors.sparkSession
    held = F.sum(F.octet_length("ids") / 8 * (4 * F.col("width") + ANCHOR_BYTES))
    of_anchors, of_rows = (df.agg(held).first()[0] or 1 for df in (anchors, packs))
    blocks = math.ceil(of_anchors / BLOCK_BYTES)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return blocks, max(1, min(most, max(2 * spark.sparkContext.defaultParallelism, int(blocks * of_rows / of_anchors))))


def _meeting(anchors: DataFrame, packs: DataFrame, run, schema: str) -> DataFrame:
    """What ``run`` makes of the cells: every pack of anchors beside every pack of rows of its width.

    Both sides are dealt out by cell and sorted, and ``run`` keeps a cell's anchors: no join, so no side
    is ever broadcast on the size it has before it is copied.
    """
    blocks, slots = _grid(anchors, packs)

    def dealt(df: DataFrame, side: int, cell: str) -> DataFrame:
        return df.select(F.expr(f"explode({cell})").alias("cell"), F.lit(side).alias("side"), *NAMES)

    def turn(n: int) -> str:
        return f"CAST(pmod(xxhash64(pack), {n}) AS INT)"

    every_slot = dealt(anchors, 0, f"transform(sequence(0, {slots - 1}), x -> {turn(blocks)} * {slots} + x)")
    every_block = dealt(packs, 1, f"transform(sequence(0, {blocks - 1}), x -> x * {slots} + {turn(slots)})")
    cells = every_slot.unionByName(every_block).repartitionById(blocks * slots, F.col("cell"))
    return cells.sortWithinPartitions("cell", "side").mapInArrow(run, schema)


def _sample(taken: DataFrame) -> list[list[float]]:
    """The vectors that the references are chosen from: those with the least hashes of their ids.

    Tasks merge them, so that the driver gets the sample only, not one of each task. A bound on the
    hash leaves out most other rows before; if too few ids lie below it, all rows are sorted.
    """
    size = taken.agg(F.max(F.size("vector")), F.count("*")).first()
    most = max(REFERENCES, min(SAMPLE, SAMPLE_BYTES // (8 * (size[0] or 1))))
    wanted, hashed = min(most, size[1]), F.xxhash64("vec_id")
    share = 4 * most / max(1, size[1])
    for below in (taken.filter(hashed < F.lit(int(share * 2.0**64) - (1 << 63))), taken) if share < 1 else (taken,):
        ordered = stored(below.select("vector", "vec_id").orderBy(hashed, "vec_id").limit(most).select("vector"), "sample")
        sample = ordered.collect()
        discard(ordered)
        if len(sample) == wanted:
            break
    return [row["vector"] for row in sample]


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
) -> DataFrame:
    """For each anchor and positive the best different-label rows inside the score window.

    Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. ``anchors`` is a condition on the columns of ``rows``. Positives
    are the anchor's best rows of its label; a negative's score s satisfies
    ``window[0] * p <= 100 * s <= window[1] * p`` for the positive's score p. Higher
    scores come first, ties by smaller id.

    Ids and labels are whole numbers. Rows with a null id or label, a null or empty
    vector, or null or non-finite components take no part; nor do vectors with a
    quantised component beyond the root of 2^62 by their length (2^28 at 64
    components), whose scores could leave 64 bits. Only vectors of
    one length meet. Rows that share an id are never each other's positives; among
    candidates, rows of one id and score count once; anchors of one id, label and
    vector count once. An anchor without positives, or with an empty window, gives no
    rows; neither does an empty table. Extra columns are ignored.
    """
    if len(window) != 2 or not 0 <= window[0] <= window[1]:
        raise ValueError("the window must be two ascending percentages")
    taken = rows.filter(usable(vector)).select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"),
        F.col(f"`{label}`").cast("bigint").alias("label"),
        F.col(f"`{vector}`").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL")
    chosen = references(_sample(taken))

    def packed(source: DataFrame) -> DataFrame:
        run = _packs(chosen, scale)
        return source.select("key", "vec_id", "label", "vector", "windows").mapInArrow(run, PACKED)

    none = F.lit(None).cast("array<bigint>").alias("windows")
    no_key = F.lit(0).cast("bigint").alias("key")
    packs = stored(packed(taken.select("*", no_key, none)), "row-packs")
    named = stored(
        taken.filter("anchor")
        .groupBy("vec_id", "label", "vector")
        .agg(F.count("*").alias("n"))
        .select(F.monotonically_increasing_id().alias("key"), "vec_id", "label", "vector"),
        "anchors",
    )

    def top(found: DataFrame, keys: list[str], most: int) -> DataFrame:
        # Rows that several packs repeat share a rank; a map task sends few rows of a key.
        rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "other"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= most).dropDuplicates([*keys, "rank"])

    first = stored(packed(named.select("*", none)), "anchor-packs")
    near = stored(
        _meeting(first, packs, _cells(chosen, positives), "key bigint, other bigint, score bigint"),
        "near-rows",
    )
    best_rows = stored(top(near, ["key"], positives).select("key", "rank", "other", "score"), "positives")

    # Whole scores inside the window, without leaving 64 bits; a negative score has none.
    least = f"(score DIV 100) * {window[0]} + ((score % 100) * {window[0]} + 99) DIV 100"
    greatest = f"(score DIV 100) * {window[1]} + ((score % 100) * {window[1]}) DIV 100"
    spans = best_rows.filter("score >= 0").select("key", "rank", F.expr(f"struct({least} AS least, {greatest} AS greatest) AS span"))
    closed = F.struct(F.lit(0).cast("bigint").alias("least"), F.lit(-1).cast("bigint").alias("greatest"))
    by_rank = spans.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("rank", "span"))).alias("spans"))
    listed = F.transform(
        F.sequence(F.lit(1), F.lit(positives)), lambda k: F.coalesce(F.try_element_at("spans", k), closed)
    )
    both = F.concat(F.transform(listed, lambda x: x["least"]), F.transform(listed, lambda x: x["greatest"]))
    second = stored(
        packed(named.join(by_rank.select("key", both.alias("windows")), "key")), "window-packs"
    )
    found = stored(
        _meeting(second, packs, _cells(chosen, negatives, positives), "key bigint, other bigint, score bigint, nth int"),
        "window-rows",
    )
    best_negatives = top(found, ["key", "nth"], negatives).select(
        "key", "nth", F.col("rank"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score")
    )
    result = stored(
        best_negatives.join(
            best_rows.select(
                "key",
                F.col("rank").alias("nth"),
                F.col("other").alias("positive_id"),
                F.col("score").alias("positive_score"),
            ),
            ["key", "nth"],
        )
        .join(named.select("key", F.col("vec_id").alias("anchor_id")), "key")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
        "hard-negatives",
    )
    discard(packs, first, near, second, found, best_rows, named)
    return result


SQL = r"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 3
"""
