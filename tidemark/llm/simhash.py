"""Near-duplicates by SimHash, with pigeonring filtering.

A fingerprint's 64 bits form a ring of ``M`` segments. If two fingerprints differ in
at most ``T`` bits, some start on the ring has chains of every length whose
cumulative differences stay within the proportional budget: at most ``L * T / M`` bits
over ``L`` consecutive segments. Where that budget is below one bit the chain must be
equal, so those segments are the key that brings candidates together; the longer
chains prune pairs before the full Hamming check.

Keys shared by many fingerprints are never paired. They are first refined by one of
the remaining segments, and what is still crowded is linked through hubs: two
fingerprints differ in at most two bits exactly when one bit flip each (or none)
leads both to a common value. That is linear in the crowd and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, one_per, replacing, stored
from tidemark.llm.components import connected_components

SEED = 42
SHINGLE = 3
LIMIT = 2  # bits that linked fingerprints may differ in; the hubs rely on two
SEGMENTS = 5
REFINED = 3  # segments of the bits outside a crowded key
CROWD = 64  # fingerprints under one key that are still compared in pairs
CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, size: int = SHINGLE) -> bytes:
    """The 8-byte fingerprint of a text: bits set in over half of its shingles' hashes."""
    words = text.lower().split()
    if not words:
        return bytes(8)
    digest = xxhash.xxh64_digest
    if len(words) <= size:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(starts)).tobytes()


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(x.as_buffer().to_pybytes(), size) for x in batch.column("text")]
            bits = pa.array(np.frombuffer(b"".join(marks), ">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bits], ["doc_id", "bits"])

    return run


def with_bits(docs: DataFrame, doc_id: str, text: str, size: int = SHINGLE) -> DataFrame:
    """(doc_id, bits) per row; the bits are the fingerprint as a signed number."""
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_fingerprints(size), f"doc_id {kind}, bits bigint")


def _widths(bits: int, parts: int) -> list[int]:
    return [bits // parts + (i < bits % parts) for i in range(parts)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks() -> list[int]:
    """The ring's segments as bit masks, from the lowest bit up."""
    masks, at = [], 0
    for width in _widths(64, SEGMENTS):
        masks.append(((1 << width) - 1) << at)
        at += width
    return masks


def _chain(start: int, length: int) -> int:
    ring = _masks()
    return reduce(int.__or__, (ring[(start + i) % SEGMENTS] for i in range(length)))


def budget(length: int) -> int:
    """Whole bits that a chain of so many segments may differ in."""
    return length * LIMIT // SEGMENTS


# Segments from a chain's start that must be equal: where the budget is below one bit.
EQUAL = max(length for length in range(1, SEGMENTS) if budget(length) == 0)


def _keys(bits: Column) -> Column:
    """Each start of the ring with the equal segments that follow it."""
    return F.array(
        *[
            F.struct(
                F.lit(start).alias("start"),
                F.lit(0).alias("part"),
                bits.bitwiseAND(F.lit(_signed(_chain(start, EQUAL)))).alias("key"),
            )
            for start in range(SEGMENTS)
        ]
    )


def _refined_masks(start: int) -> list[int]:
    """The bits outside a key, dealt to ``REFINED`` parts; at two bits one part is equal."""
    free = [b for b in range(64) if not _chain(start, EQUAL) >> b & 1]
    masks, at = [], 0
    for width in _widths(len(free), REFINED):
        masks.append(sum(1 << b for b in free[at : at + width]))
        at += width
    return masks


def _refined_keys(bits: Column) -> Column:
    """The finer keys of a crowded key."""
    by_start = [
        F.array(
            *[
                F.struct(
                    F.lit(start).alias("start"),
                    F.lit(part + 1).alias("part"),
                    bits.bitwiseAND(F.lit(_signed(_chain(start, EQUAL) | mask))).alias("key"),
                )
                for part, mask in enumerate(_refined_masks(start))
            ]
        )
        for start in range(SEGMENTS)
    ]
    return F.get(F.array(*by_start), F.col("start"))


KEY = ["start", "part", "key"]


def _split(keyed: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key 2 to ``crowd`` fingerprints share, and rows of crowded keys."""
    sizes = keyed.groupBy(*KEY).agg(F.count("*").alias("size")).filter("size > 1")
    # The hash makes the join shuffle both sides anew, so that a hot key can be split.
    again = F.xxhash64(*KEY).alias("_hash")
    sized = stored(
        keyed.select("*", again).join(sizes.select("*", again), [*KEY, "_hash"]).drop("_hash"),
        "keys",
    )
    return sized.filter(F.col("size") <= crowd), sized.filter(F.col("size") > crowd)


def _pairs(keyed: DataFrame) -> DataFrame:
    """Pairs under one key that pass the chains and then the full Hamming check."""
    a = keyed.select(*KEY, F.col("bits").alias("a"))
    b = keyed.select(*KEY, F.col("bits").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    close = F.col("a") < F.col("b")
    for length in range(EQUAL + 1, SEGMENTS):
        masks = F.array(*[F.lit(_signed(_chain(s, length))) for s in range(SEGMENTS)])
        mask = F.get(masks, F.col("start"))
        close &= F.bit_count(differing.bitwiseAND(mask)) <= budget(length)
    return a.join(b, KEY).filter(close & (F.bit_count(differing) <= LIMIT)).select("a", "b")


def _hubs(crowded: DataFrame) -> DataFrame:
    """Links from crowded fingerprints to values one flip away that another one reaches too."""
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << b)) for b in range(64)])
    reach = (
        crowded.select("bits")
        .distinct()
        .select(F.col("bits").alias("a"), F.explode(flips).alias("flip"))
        .select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("b"))
    )
    met = reach.groupBy("b").agg(F.count("*").alias("n")).filter("n > 1").select("b")
    again = F.xxhash64("b").alias("_hash")
    return reach.select("*", again).join(met.select("*", again), ["b", "_hash"]).select("a", "b")


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) with the components of all pairs at most ``LIMIT`` bits apart.

    ``prints`` holds each fingerprint once, as ``bits``. A link's end may be a hub. Without
    crowded keys there is nothing to refine, and without finer ones that are, no hubs.
    """
    few, many = _split(prints.select("bits", F.inline(_keys(F.col("bits")))), crowd)
    found = _pairs(few)
    if many.isEmpty():
        return found
    finer = many.select("bits", "start").select("bits", F.inline(_refined_keys(F.col("bits"))))
    few_finer, still = _split(finer, crowd)
    found = found.unionByName(_pairs(few_finer))
    return found if still.isEmpty() else found.unionByName(_hubs(still))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per input row: doc_id, bits, fingerprint, component_id.

    ``component_id`` is the smallest doc_id reachable over links. Texts without words
    (null, empty) have the fingerprint zero and link like any other; texts shorter
    than a shingle are one shingle. Repeated rows give repeated results. A null id is
    never a component's id, unless it has no other. Other columns are ignored; an
    empty table gives no rows.
    """
    rows = stored(with_bits(docs, doc_id, text, size), "fingerprints")
    prints = stored(
        rows.groupBy("bits").agg(F.min("doc_id").alias("lowest")), "distinct-fingerprints"
    )
    labels = connected_components(links(prints, crowd))
    # Hubs that are no fingerprint drop out here; a component has a fingerprint below.
    labelled = prints.join(labels.withColumnRenamed("node", "bits"), "bits")
    ids = labelled.groupBy("label").agg(F.min("lowest").alias("component_id"))
    linked = labelled.join(ids, "label").select("bits", "component_id")
    components = stored(
        prints.join(linked, "bits", "left").select(
            "bits", F.coalesce("component_id", "lowest").alias("component_id")
        ),
        "components",
    )
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return rows.join(components, "bits").select("doc_id", "bits", digits, "component_id")


def nearest_links(rows: DataFrame, size: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b) of numbers of (n, text), for callers that test them further.

    Of each fingerprint that links to others, its smallest number beside the smallest one it
    meets, directly or in a hub; and each number beside the smallest of its own
    fingerprint. So there are at most two pairs per row, however large a group is.
    """
    numbered = stored(with_bits(rows, "n", "text", size), "fingerprints")
    prints = stored(numbered.groupBy("bits").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    found = links(prints, crowd)
    # The end of a link meets there too, unless it is a hub that is no fingerprint.
    meeting = found.select(F.col("a").alias("bits"), F.col("b").alias("hub")).unionByName(
        found.select(F.col("b").alias("bits"), F.col("b").alias("hub")).distinct()
    )
    met = stored(meeting.join(prints, "bits").select("hub", "low"), "meetings")
    smallest = met.groupBy("hub").agg(F.min("low").alias("a"))
    across = met.join(smallest, "hub").groupBy(F.col("low").alias("b")).agg(F.min("a").alias("a"))
    within = numbered.join(prints, "bits").select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
    pairs = stored(across.select("a", "b").unionByName(within).filter("a <> b").distinct(), "nearest-links")
    discard(numbered, prints, met)
    return pairs


def drop_near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    crowd: int = CROWD,
) -> DataFrame:
    """The row of each component with the smallest id, with all its columns.

    Rows with the same id and text count as one and stay as one. Rows that share an id
    with one that stays, but not its text, stay as well. A null id stays only when some
    component has no other.
    """
    columns = docs.columns
    keyed = replacing(docs, _known=F.col(f"`{doc_id}`"), _text=F.xxhash64(f"`{text}`"))
    distinct = one_per(keyed, [F.col("_known"), F.col("_text")], [F.lit(1)])
    found = near_duplicates(docs, doc_id, text, size, crowd)
    chosen = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("_known"))
        .distinct()
    )
    kept = distinct.join(chosen, distinct["_known"].eqNullSafe(chosen["_known"]), "left_semi")
    return kept.select(*[f"`{name}`" for name in columns])
