"""Removal of long repeated passages, found by difference-cover anchors.

A difference cover holds, for every shift, two positions that lie that far apart
modulo its period. Hashing short anchors only where a word's position is in the cover
(6 of 31) is therefore enough: two equal passages of a window's length always share
an anchor at the same place within them, whatever their positions in their documents.
Windows around shared anchors are then extended to full length and compared.

Both rounds first settle what one batch of documents shows by itself, so that a batch
sends one row for each different hash. A passage in a third of all documents then puts
one row for each batch under its hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WINDOW = 50
PERIOD = 31
# A perfect difference set modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
NULL_IDS = 1 << 31  # places after all ids, for rows without one
FIRST_NULL = (1 << 63) - NULL_IDS
CHUNK = 1 << 20  # bytes hashed at once
# Odd multipliers of the polynomial hashes and of the final mixing.
BYTE_BASE, WORD_BASE, CHECK_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    for factor in MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the documents ``data[offsets[i]:offsets[i + 1]]``, and each one's first word."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = ~space[heads]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    spans = np.diff(np.append(starts, len(data)))
    lead = starts[0]
    place = np.arange(lead, len(data)) - np.repeat(starts, spans)
    values = mixed(np.arange(1, 257, dtype=np.uint64))[data[lead:]]
    values *= powers(BYTE_BASE, int(spans.max()))[place]
    values[space[lead:]] = 0
    return mixed(np.add.reduceat(values, starts - lead)), first


def window_hashes(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of the ``length`` words from each word on; shorter by ``length - 1``."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * powers(inverse, n))


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, offsets) for runs of texts of about ``CHUNK`` bytes."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def positions(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its text, its position there, and how many words its text has from there on."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    return text, at, np.repeat(counts, counts) - at


def in_cover(at: np.ndarray) -> np.ndarray:
    table = np.zeros(PERIOD, bool)
    table[list(COVER)] = True
    return table[at % PERIOD]


def runs(order_break: np.ndarray) -> np.ndarray:
    """Number of the run each row is in, where ``order_break`` marks rows that begin one."""
    return np.cumsum(order_break) - 1


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _anchors(length: int):
    """Rows (hash, id, at, settled): one for each hash and document of a batch that has to ask.

    A hash that two documents of the batch have is settled for all of them; its
    smallest and largest id still tell other batches of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = _numbers(batch, "id"), _numbers(batch, "mark")
            found = []
            for start, data, offsets in chunks(batch.column("text")):
                words, first = word_hashes(data, offsets)
                text, at, left = positions(first)
                chosen = np.flatnonzero(in_cover(at) & (left >= length))
                hashes = window_hashes(words, length, WORD_BASE)
                found.append((hashes[chosen], text[chosen] + start, at[chosen]))
            if not found:
                continue
            hashes, text, at = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(hashes):
                continue
            order = np.lexsort((at, marks[text], ids[text], hashes))
            hashes, text, at = hashes[order], text[order], at[order].astype(np.int32)
            owner, mark = ids[text], marks[text]
            new = np.append(True, hashes[1:] != hashes[:-1])
            # A text's further places of a hash are found again from its first one, and
            # equal texts of one id are told once.
            once = new | np.append(True, (owner[1:] != owner[:-1]) | (mark[1:] != mark[:-1]))
            starts = np.flatnonzero(new)
            low = owner[starts][runs(new)]
            high = owner[np.append(starts[1:], len(hashes)) - 1][runs(new)]
            asks = once & ((owner == low) | (owner == high))
            yield _rows(hashes[asks], owner[asks], False, at=at[asks])
            told = once & (low != high)
            yield _rows(spread(hashes[told], owner[told]), owner[told], True, at=at[told])

    return run


def spread(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A key for rows that need no partner, different for each document."""
    return mixed(hashes ^ mixed(owner.astype(np.uint64)))


def _rows(hashes: np.ndarray, owner: np.ndarray, settled: bool, **more) -> pa.RecordBatch:
    columns = {"hash": hashes.view(np.int64), "id": owner, "settled": np.full(len(owner), settled)}
    return pa.RecordBatch.from_pydict(columns | more)


ANCHOR_ROW = "hash bigint, id bigint, settled boolean, at int"
WINDOW_ROW = "hash bigint, id bigint, settled boolean, check bigint"
RESULTS = (
    "n_words bigint, n_removed bigint, kept_text string, "
    "removed_spans array<struct<first: int, last: int>>"
)
RESULT_NAMES = ["n_words", "n_removed", "kept_text", "removed_spans"]


def _windows(length: int, anchor: int):
    """Full windows around shared anchors: one row for each of them that still has to ask.

    A window that a smaller document of the batch has too is settled: ``check`` then
    holds its hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _numbers(batch, "id")
            places = batch.column("places")
            flat, ends = places.flatten().to_numpy(), np.cumsum(places.value_lengths().to_numpy())
            found = []
            for start, data, offsets in chunks(batch.column("text")):
                words, first = word_hashes(data, offsets)
                text, at, left = positions(first)
                to = start + len(offsets) - 1
                low = ends[start - 1] if start else 0
                told_text = np.repeat(np.arange(to - start), np.diff(np.append(low, ends[start:to])))
                short = window_hashes(words, anchor, WORD_BASE)
                # Texts that share an id share its places, which may lie beyond a text's end.
                index = first[told_text] + flat[low : ends[to - 1]]
                inside = index <= first[told_text + 1] - anchor
                told_text, index = told_text[inside], index[inside]
                # Every place of a text whose anchor equals one that is shared.
                cover = np.flatnonzero(in_cover(at) & (left >= anchor))
                tag = mixed(np.arange(1, to - start + 1, dtype=np.uint64))
                known = np.unique(short[index] ^ tag[told_text])
                hit = cover[np.isin(short[cover] ^ tag[text[cover]], known)]
                # A window begins at most PERIOD - 1 words before an anchor it holds.
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, np.maximum(hit - (PERIOD - 1), first[text[hit]]), 1)
                np.add.at(edge, hit + 1, -1)
                chosen = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (left >= length))
                full = window_hashes(words, length, WORD_BASE)
                check = window_hashes(words, length, CHECK_BASE)
                found.append((full[chosen], check[chosen], ids[text[chosen] + start]))
            if not found:
                continue
            full, check, owner = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(full):
                continue
            order = np.lexsort((owner, check, full))
            full, check, owner = full[order], check[order], owner[order]
            new = np.append(True, (full[1:] != full[:-1]) | (check[1:] != check[:-1]))
            once = new | np.append(True, owner[1:] != owner[:-1])
            yield _rows(full[new], owner[new], False, check=check[new].view(np.int64))
            # The rows of a window are in order of id: those after its first are settled.
            smallest = owner[np.flatnonzero(new)][runs(new)]
            told = once & (owner != smallest)
            full, owner = full[told], owner[told]
            yield _rows(spread(full, owner), owner, True, check=full.view(np.int64))

    return run


def _cut(length: int, columns: list[str]):
    """Words outside the removed windows, joined by one space."""

    def kept(raw: bytes, gone: np.ndarray) -> tuple[int, int, bytes, list]:
        words = raw.split()
        if not len(gone) or len(words) < length:
            return len(words), 0, b" ".join(words), []
        hashed, _ = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        at = np.flatnonzero(np.isin(window_hashes(hashed, length, WORD_BASE), gone))
        edge = np.zeros(len(words) + 1, np.int64)
        edge[at] += 1
        edge[at + length] -= 1
        stay = np.cumsum(edge[:-1]) == 0
        bounds = np.flatnonzero(np.diff(np.concatenate([[True], stay, [True]])))
        spans = [{"first": int(a), "last": int(b) - 1} for a, b in bounds.reshape(-1, 2)]
        left = [word for word, keep in zip(words, stay.tolist(), strict=True) if keep]
        return len(words), len(words) - len(left), b" ".join(left), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = batch.column("removed")
            flat = removed.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(removed.value_lengths().fill_null(0).to_numpy())
            gone = np.split(flat, ends[:-1]) if len(ends) else []
            texts = (x.as_buffer().to_pybytes() for x in batch.column("text"))
            rows = [kept(raw, own) for raw, own in zip(texts, gone, strict=True)]
            n_words, n_removed, text, spans = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in columns],
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(text, pa.binary()).cast(pa.string()),
                    pa.array(spans, pa.list_(pa.struct({"first": pa.int32(), "last": pa.int32()}))),
                ],
                [*columns, *RESULT_NAMES],
            )

    return run


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` without the text, with n_words, n_removed, kept_text and removed_spans.

    A word goes if one of the ``window``-word windows over it has the same words as a
    window of a document with a smaller id. Windows are judged on the input. Spans are
    word positions, first to last. Null texts have no words. Rows that repeat an id are
    one document, so that they remove nothing from each other. Rows with a null id come
    after all others, in the order of their texts' hashes. Ids are whole numbers below
    2^63 - 2^31. Input columns with a result's name give way; empty tables give empty
    results.
    """
    anchor = window - PERIOD + 1
    if anchor < 1:
        raise ValueError(f"windows need at least {PERIOD} words")
    inner = ["id", "mark", "_text"]
    known = F.col(f"`{doc_id}`").cast("bigint")
    mark = F.xxhash64(f"`{text}`").bitwiseAND(F.lit(NULL_IDS - 1))
    source = docs.select(
        F.coalesce(known, F.lit(FIRST_NULL) + mark).alias("id"),
        mark.alias("mark"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("_text"),
        *[
            F.col(f"`{name}`")
            for name in docs.columns
            if name.lower() not in {text.lower(), doc_id.lower(), *RESULT_NAMES, *inner}
        ],
    )
    extra = source.columns[len(inner) :]

    same = Window.partitionBy("hash")
    shared = (
        source.select("id", "mark", F.col("_text").alias("text"))
        .mapInArrow(_anchors(anchor), ANCHOR_ROW)
        .withColumn("low", F.min("id").over(same))
        .withColumn("high", F.max("id").over(same))
        .filter("settled OR low < high")
    )
    places = shared.groupBy("id").agg(F.collect_list("at").alias("places"))
    same = Window.partitionBy("hash", "check")
    gone = (
        source.select("id", F.col("_text").alias("text"))
        .join(places, "id")
        .mapInArrow(_windows(window, anchor), WINDOW_ROW)
        .withColumn("low", F.min("id").over(same))
        .filter("settled OR low < id")
    )
    hashes = F.when(F.col("settled"), F.col("check")).otherwise(F.col("hash"))
    removed = gone.groupBy("id").agg(F.collect_list(hashes).alias("removed"))
    joined = source.join(removed, "id", "left").select(
        F.when(F.col("id") < FIRST_NULL, F.col("id")).alias(doc_id),
        *[F.col(f"`{name}`") for name in extra],
        F.col("_text").alias("text"),
        "removed",
    )
    columns = [doc_id, *extra]
    schema = StructType([*joined.select(*columns).schema, *StructType.fromDDL(RESULTS)])
    return joined.mapInArrow(_cut(window, columns), schema)
