"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors with a cosine of at least ``c`` lie within the squared distance
``2 - 2c``. Rotation keeps distances. Rotated vectors are split into blocks of a few
coordinates; the squared distance is the sum over the blocks, so at least one block
stays within its proportional share. Each block is range-joined under its share, and
every pair of the union of candidates is verified on the original vectors. No pair is
lost and no other pair is returned.

The range join works on packs: rows of one label in the order of a space-filling curve
over the strongest rotated coordinates, cut into packs of bounded size, each with its
bounding box. A pack meets another one if for some block their boxes are no farther
apart than the block's share. Boxes are brought together by slabs of the block's
leading coordinate, and each pair of packs is met once. Rows are then compared block
by block within the pair of packs, which is all a task holds. What a pair of packs
finds leaves it as one row per linked vector: its number of links there, and a link to
the smallest vector of its local component. So a large group of near copies is never
listed pair by pair.

Equal vectors of one label are joined as one, with their count.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored
from tidemark.llm.components import connected_components
from tidemark.llm.vectors import by_width, matrix, unit_rows, usable

COSINE = 0.98
BLOCK = 8  # coordinates of a block
PACK = 512  # vectors of a pack, at most
PACK_BYTES = 1 << 20  # bytes of a pack's vectors, unless one vector alone is longer
SAMPLE = 4096  # vectors that the rotation is fitted on, at most
SAMPLE_BYTES = 1 << 24  # bytes of that sample
ROTATED = 1024  # longest vectors that are rotated; others keep their own coordinates
CURVE = 12  # coordinates of the space-filling curve
CURVE_BITS = 5  # bits of each of them
SLACK = 1e-9  # rounding of squared distances between unit vectors


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        # Adding zero turns the negative zero into the positive one.
        raw = [(np.asarray(v.values, np.float64) + 0.0).tobytes() for v in vectors]
        marks = [hashlib.blake2b(x, digest_size=16).digest() for x in raw]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(marks, pa.binary()), vectors],
            ["vec_id", "label", "digest", "vector"],
        )


class Rotation:
    """An orthogonal matrix per vector length, its blocks, and the cuts of the curve."""

    def __init__(self, sample: list[list[float]]):
        self.turn: dict[int, np.ndarray] = {}
        self.cuts: dict[int, np.ndarray] = {}
        lengths = np.array([len(x) for x in sample], np.int64)
        for width, at in by_width(lengths):
            rows = unit_rows(np.array([sample[i] for i in at], np.float64))
            if width <= ROTATED:
                _, axes = np.linalg.eigh(np.cov(rows.T, bias=True).reshape(width, width))
                self.turn[width] = axes[:, ::-1][:, self.order(width)]
                rows = rows @ self.turn[width]
            lead = rows[:, self.leading(width)]
            steps = np.arange(1, 1 << CURVE_BITS) / (1 << CURVE_BITS)
            self.cuts[width] = np.quantile(lead, steps, axis=0).T

    @staticmethod
    def blocks(width: int) -> list[tuple[int, int]]:
        """The coordinates of each block, from and below."""
        n = -(-width // BLOCK)
        ends = [width * i // n for i in range(n + 1)]
        return list(zip(ends[:-1], ends[1:], strict=True))

    @classmethod
    def order(cls, width: int) -> list[int]:
        """Axes from the strongest down, dealt in turn, so that blocks have like shares of the variance."""
        blocks, dealt, axis = cls.blocks(width), [], 0
        places: list[list[int]] = [[] for _ in blocks]
        while axis < width:
            for k, (a, b) in enumerate(blocks):
                if len(places[k]) < b - a and axis < width:
                    places[k].append(axis)
                    axis += 1
        for place in places:
            dealt += place
        return dealt

    @classmethod
    def leading(cls, width: int) -> list[int]:
        """Places of the strongest coordinates, for the curve."""
        return np.argsort(cls.order(width), kind="stable")[:CURVE].tolist()

    def apply(self, units: np.ndarray) -> np.ndarray:
        turn = self.turn.get(units.shape[1])
        return units if turn is None else units @ turn

    def curve(self, rotated: np.ndarray) -> np.ndarray:
        """Place of each row on the curve: the bits of its cells, interleaved."""
        width = rotated.shape[1]
        key = np.zeros(len(rotated), np.int64)
        if width not in self.cuts:
            return key
        lead = self.leading(width)
        cells = [
            np.searchsorted(self.cuts[width][k], rotated[:, c]) for k, c in enumerate(lead)
        ]
        for bit in range(CURVE_BITS - 1, -1, -1):
            for cell in cells:
                key = key << 1 | cell >> bit & 1
        return key


def _placed(rotation: Rotation):
    """Classes with their place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            lengths = np.asarray(pa.compute.list_value_length(vectors), np.int64)
            place = np.zeros(len(lengths), np.int64)
            for width, at in by_width(lengths):
                rows = matrix(vectors.take(pa.array(at)), width)
                place[at] = rotation.curve(rotation.apply(unit_rows(rows)))
            columns = [batch.column(x) for x in ("node", "label", "size", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lengths), pa.array(place)],
                ["node", "label", "size", "vector", "width", "place"],
            )

    return run


def _packs(rotation: Rotation, single: bool):
    """Sorted rows cut into packs of one label and width, with their bounding boxes."""
    raw = np.float32 if single else np.float64

    def made(label, width: int, rows: list[tuple[int, int, np.ndarray]]):
        nodes = np.array([x[0] for x in rows], np.int64)
        sizes = np.array([x[1] for x in rows], np.int64)
        vectors = np.array([x[2] for x in rows], np.float64)
        turned = rotation.apply(unit_rows(vectors))
        low, high = turned.min(axis=0) - SLACK, turned.max(axis=0) + SLACK
        return (
            int(nodes[0]), label, width, low, high,
            nodes.tobytes(), sizes.tobytes(), vectors.astype(raw).tobytes(),
        )

    names = ["pack", "label", "width", "low", "high", "nodes", "sizes", "vectors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, of, kind = [], None, None

        def batch_of(pack) -> pa.RecordBatch:
            kinds = [pa.int64(), kind, pa.int64(), *[pa.list_(pa.float64())] * 2, *[pa.binary()] * 3]
            arrays = [pa.array([x], k) for x, k in zip(pack, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            kind = batch.schema.field("label").type
            rows = zip(
                batch.column("node").to_pylist(),
                batch.column("size").to_pylist(),
                batch.column("label").to_pylist(),
                batch.column("vector"),
                strict=True,
            )
            for node, size, label, vector in rows:
                values = np.asarray(vector.values, np.float64)
                mine = (label, len(values))
                full = len(waiting) >= min(PACK, max(1, PACK_BYTES // (8 * len(values))))
                if waiting and (full or mine != of):
                    yield batch_of(made(*of, waiting))
                    waiting = []
                of = mine
                waiting.append((node, size, values))
        if waiting:
            yield batch_of(made(*of, waiting))

    return run


def _gaps(a: Column, b: Column) -> Column:
    """Per coordinate the squared gap between two bounding boxes."""
    apart = F.zip_with(
        F.arrays_zip(a["low"].alias("l"), a["high"].alias("h")),
        F.arrays_zip(b["low"].alias("l"), b["high"].alias("h")),
        lambda x, y: F.greatest(F.lit(0.0), x["l"] - y["h"], y["l"] - x["h"]),
    )
    return F.transform(apart, lambda x: x * x)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def pack_pairs(packs: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs (a, b), a <= b, of packs whose boxes are within some block's share; each pair once.

    Only the boxes move. A pack stands under each slab of a block's leading coordinate
    that it reaches, widened upwards by the block's radius; of the slabs that two packs
    share, the one where the later box begins brings them together, and of the blocks the first
    whose share holds.
    """
    limit = F.lit(2.0 - 2.0 * cosine + SLACK)
    n = F.ceil(F.col("width") / BLOCK).cast("int")
    start = lambda k: F.floor(F.col("width") * k / n).cast("int")
    spans = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda k: F.struct(
            k.alias("block"),
            start(k).alias("first"),
            (start(k + 1) - start(k)).alias("count"),
            (limit * (start(k + 1) - start(k)) / F.col("width")).alias("share"),
        ),
    )
    boxes = packs.select("pack", "label", "width", "low", "high", spans.alias("spans"))
    radius = F.sqrt("span.share")
    # A slab is no narrower than a sixteenth, so a pack reaches few of them.
    wide = F.greatest(radius, F.lit(1.0 / 16))
    lead_low = F.element_at("low", F.col("span.first") + 1)
    lead_high = F.element_at("high", F.col("span.first") + 1)
    reached = boxes.select("*", F.explode("spans").alias("span")).select(
        "pack", "label", "width", "low", "high", "spans", "span", wide.alias("wide"),
        F.floor(lead_low / wide).alias("begins"),
        F.explode(F.sequence(F.floor(lead_low / wide), F.floor((lead_high + radius) / wide))).alias("slab"),
    )
    key = ["label", "width", "block", "slab"]
    side = reached.withColumn("block", F.col("span.block"))
    a = side.select(*key, F.struct("pack", "low", "high", "begins", "spans").alias("a"))
    b = side.select(*key, F.struct("pack", "low", "high", "begins").alias("b"))
    gaps = _gaps(F.col("a"), F.col("b"))
    met = a.join(b, key).filter(
        (F.col("a.pack") <= F.col("b.pack"))
        & (F.col("slab") == F.greatest("a.begins", "b.begins"))
    )
    near = met.select("a", "b", "block", gaps.alias("gaps")).filter(_sum(F.col("gaps")) <= limit)
    holds = F.filter(
        "a.spans", lambda s: _sum(F.slice("gaps", s["first"] + 1, s["count"])) <= s["share"]
    )
    first = F.get(F.transform(holds, lambda s: s["block"]), F.lit(0))
    return near.filter(first == F.col("block")).select(
        F.col("a.pack").alias("a"), F.col("b.pack").alias("b")
    )


def _smallest(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a link matrix: the smallest node of the local component."""
    most = np.iinfo(np.int64).max
    while True:
        low = np.minimum(left, np.where(mask, right[None, :], most).min(axis=1, initial=most))
        high = np.minimum(right, np.where(mask, low[:, None], most).min(axis=0, initial=most))
        if (low == left).all() and (high == right).all():
            return left, right
        left, right = low, high


def _verified(rotation: Rotation, cosine: float, single: bool):
    """One row per vector with links inside a pair of packs: node, smallest, links."""
    raw = np.float32 if single else np.float64
    limit = 2.0 - 2.0 * cosine + SLACK

    def opened(row: dict, side: str) -> tuple[np.ndarray, ...]:
        nodes, sizes = (np.frombuffer(row[f"{x}_{side}"], np.int64) for x in ("nodes", "sizes"))
        vectors = np.frombuffer(row[f"vectors_{side}"], raw).reshape(len(nodes), -1).astype(np.float64)
        units = unit_rows(vectors)
        return nodes, sizes, units, rotation.apply(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                nodes, sizes, units, turned = opened(row, "a")
                others, weights, theirs, rotated = opened(row, "b")
                close = np.zeros((len(nodes), len(others)), bool)
                width = units.shape[1]
                for first, last in Rotation.blocks(width):
                    x, y = turned[:, first:last], rotated[:, first:last]
                    apart = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
                    close |= apart <= limit * (last - first) / width
                at = np.nonzero(close)
                if len(at[0]) * 8 < close.size:
                    close[at] = np.einsum("ij,ij->i", units[at[0]], theirs[at[1]]) >= cosine
                else:
                    close &= units @ theirs.T >= cosine
                if row["a"] == row["b"]:
                    np.fill_diagonal(close, False)
                    here, _ = _smallest(close, nodes, nodes)
                    found = [(nodes, here, close @ weights)]
                else:
                    here, there = _smallest(close, nodes, others)
                    found = [(nodes, here, close @ weights), (others, there, sizes @ close)]
                for node, smallest, links in found:
                    linked = links > 0
                    if linked.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x[linked]) for x in (node, smallest, links)],
                            ["node", "smallest", "links"],
                        )

    return run


def linked_vectors(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Rows of one label and one vector length are linked if their cosine, in double
    precision, is at least ``cosine``. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest vec_id reachable, ``kept`` says that it
    is the row's own. Rows with a null label, and vectors that are null, empty, zero or
    hold null or non-finite components, have no links. Repeated rows count each;
    all rows of a kept id are kept. A null id is a component's only if it has no
    other. Extra columns are ignored; an empty table gives no rows.
    """
    if not 0.0 < cosine <= 1.0:
        raise ValueError("cosine must be above 0 and at most 1")
    column = F.col(f"`{vector}`")
    single = rows.schema[vector].dataType.elementType.typeName() == "float"
    taken = rows.select(
        F.col(f"`{vec_id}`").alias("vec_id"),
        F.col(f"`{label}`").alias("label"),
        F.when(usable(vector) & F.exists(column, lambda x: x != 0), column).alias("vector"),
    )
    id_kind, label_kind, kind = (taken.schema[x].dataType.simpleString() for x in taken.columns)
    usual = taken.filter(F.col("vector").isNotNull() & F.col("label").isNotNull())
    marked = stored(
        usual.mapInArrow(
            _digests, f"vec_id {id_kind}, label {label_kind}, digest binary, vector {kind}"
        ),
        "vectors",
    )
    classes = stored(
        marked.groupBy("label", "digest")
        .agg(F.min("vec_id").alias("lowest"), F.count("*").alias("size"), F.first("vector").alias("vector"))
        .select(F.monotonically_increasing_id().alias("node"), "*"),
        "vector-classes",
    )
    longest = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    most = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * longest)))
    # The digest is as good as random, so its order draws a sample without a scan of its own.
    sample = classes.select("digest", "vector").orderBy("digest").limit(most).collect()
    rotation = Rotation([row["vector"] for row in sample])
    placed = classes.select("node", "label", "size", "vector").mapInArrow(
        _placed(rotation),
        f"node bigint, label {label_kind}, size bigint, vector {kind}, width bigint, place bigint",
    )
    order = ["label", "width", "place", "node"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    boxes = "pack bigint, label {}, width bigint, low array<double>, high array<double>, ".format(label_kind)
    packs = stored(
        placed.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_packs(rotation, single), boxes + "nodes binary, sizes binary, vectors binary"),
        "vector-packs",
    )
    pairs = stored(pack_pairs(packs, cosine), "pack-pairs")

    def side(name: str) -> DataFrame:
        held = [F.col(x).alias(f"{x}_{name}") for x in ("nodes", "sizes", "vectors")]
        return packs.select(F.col("pack").alias(name), *held)

    found = stored(
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .mapInArrow(_verified(rotation, cosine, single), "node bigint, smallest bigint, links bigint"),
        "vector-links",
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select(F.col("node").alias("a"), F.col("smallest").alias("b")))
    tops = labels.withColumnRenamed("label", "top")
    lowest = (
        classes.select("node", "lowest").join(tops, "node").groupBy("top").agg(F.min("lowest").alias("first"))
    )
    result = (
        classes.select("node", "label", "digest", "size", "lowest")
        .join(counts, "node", "left")
        .join(tops, "node", "left")
        .join(lowest, "top", "left")
        .select(
            "label",
            "digest",
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("first", "lowest").alias("component_id"),
        )
    )
    settled = stored(result, "vector-components")
    discard(packs, pairs)
    again = F.xxhash64("label", "digest").alias("_hash")
    joined = marked.select("vec_id", "label", "digest", again).join(
        settled.select("*", again), ["label", "digest", "_hash"]
    )
    alone = taken.filter(F.col("vector").isNull() | F.col("label").isNull())
    none = F.lit(0).cast("bigint").alias("n_links")
    every = joined.select("vec_id", "n_links", "component_id").unionByName(
        alone.select("vec_id", none, F.col("vec_id").alias("component_id"))
    )
    return every.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = r"""
WITH RECURSIVE usable AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
links AS (
  SELECT a.r AS a, b.r AS b, b.vec_id AS other
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
  WHERE list_inner_product(a.v, b.v)
        / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.98),
reach AS (
  SELECT r AS a, r AS b FROM usable
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
found AS (
  SELECT reach.a AS r, min(usable.vec_id) AS component_id
  FROM reach JOIN usable ON reach.b = usable.r GROUP BY reach.a),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a),
settled AS (
  SELECT usable.vec_id, coalesce(n, 0) AS n_links, component_id
  FROM usable JOIN found USING (r) LEFT JOIN counted USING (r)
  UNION ALL
  SELECT vec_id, 0, vec_id FROM embeddings
  WHERE label IS NULL OR embedding IS NULL OR len(embedding) = 0
    OR len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) > 0
    OR len([x for x in embedding if x <> 0]) = 0)
SELECT vec_id, CAST(n_links AS BIGINT) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM settled
"""
