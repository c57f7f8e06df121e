"""Ranked lexical search by a dual tree over items and documents.

Two passes over the documents. The first counts, per document, its terms and the
terms that items hold, and stores these sparse vectors in packs; sums over the packs
give the corpus statistics. The second scores: a document's coordinate for a term is
its saturated frequency, an item's coordinate the term's weight times its repeats, and
a score is the inner product.

Both sides form hierarchies whose nodes hold coordinate maxima: items in batches, a
pack's documents in nodes of 64 and of 8, put in the order of their weightiest term, so
that a node's documents resemble each other. All coordinates are non-negative, so the
product of two nodes' maxima bounds every score between them. A pair of nodes whose
bound is below the weakest k-th score of the batch's items so far is pruned whole;
what remains is split, and in the end scored exactly. Equality is never pruned, as a
smaller document id may win a tie. Nodes with high bounds go first.

A task keeps the best k of each item over all its packs and sends only those. Items go
in blocks of bounded size, each with its own two passes: a stated query set against all
documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored

MOST = 20
PACK = 1024  # documents of a pack
PACK_ENTRIES = 1 << 19  # terms with counts after which a pack is closed early
NODE, LEAF = 64, 8  # documents of an inner node and of a leaf
BATCH = 8  # items of a batch
BLOCK_ITEMS = 256  # items of a block, on average
BLOCK_BYTES = 1 << 19  # text of a block's items, on average
EXACT = 2**53  # whole numbers that doubles add without rounding

# Term characters: ASCII letters and digits, and every byte of a character beyond ASCII.
TERM = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
FOLD = TERM.lower()  # lower-cases A to Z alone


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return text.translate(FOLD).split()


class Items:
    """A block of items: their terms and how often each item holds them."""

    def __init__(self, texts: list[bytes]):
        self.index: dict[bytes, int] = {}  # from 1, so that no term's number is false
        self.held: list[dict[int, int]] = []
        for text in texts:
            counted = Counter(terms(text))
            self.held.append(
                {self.index.setdefault(term, len(self.index) + 1) - 1: n for term, n in counted.items()}
            )

    def order(self, weight: np.ndarray) -> list[int]:
        """Items by their weightiest term, so that those of a batch share terms."""
        top = [max(held, key=lambda t: (weight[t] * held[t], t), default=-1) for held in self.held]
        return sorted(range(len(top)), key=lambda i: (top[i], i))


COUNTED = (
    "docs bigint, length bigint, ids binary, known binary, sizes binary, ends binary, "
    "terms binary, counts binary"
)
COUNTED_NAMES = [x.split()[0] for x in COUNTED.split(", ")]


def _counted(items: Items):
    """Packs of the documents' sparse vectors over the items' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = items.index.get
        ids, sizes, ends, found, counts = [], [], [], [], []

        def batch_of() -> pa.RecordBatch:
            known = np.array([i is not None for i in ids], bool)
            row = [
                len(ids), sum(sizes),
                np.array([i or 0 for i in ids], np.int64).tobytes(), known.tobytes(),
                np.array(sizes, np.int64).tobytes(), np.array(ends, np.int64).tobytes(),
                np.array(found, np.int32).tobytes(), np.array(counts, np.int64).tobytes(),
            ]
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
            arrays = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
            for held in (ids, sizes, ends, found, counts):
                held.clear()
            return pa.RecordBatch.from_arrays(arrays, COUNTED_NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms(text.as_buffer().to_pybytes())
                if not words:
                    continue
                mine = Counter(filter(None, map(find, words)))
                ids.append(doc_id)
                sizes.append(len(words))
                found.extend(mine.keys())
                counts.extend(mine.values())
                ends.append(len(found))
                if len(ids) == PACK or len(found) >= PACK_ENTRIES:
                    yield batch_of()
        if ids:
            yield batch_of()

    return run


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, how many documents hold each term (numbers from 1)."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for value in batch.column("terms"):
            held = np.bincount(np.frombuffer(value.as_buffer(), np.int32))
            if len(held) > len(total):
                total, held = held, total
            total = total.copy()
            total[: len(held)] += held
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "held"])


def saturated(counts: np.ndarray, sizes: np.ndarray, docs: int, length: int) -> np.ndarray:
    """Whole-number saturation of term counts in documents of the given sizes."""
    kind = object if 25 * int(sizes.max(initial=0)) * docs >= 1 << 62 else np.int64
    norm = (75 + 25 * sizes.astype(kind) * docs // length).astype(np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 12 * norm)


def weights(held: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(n) + 1))) for n in held], np.int64)


class Search:
    """The best documents of each item of a block, over the packs given so far."""

    def __init__(self, items: Items, weight: np.ndarray, docs: int, length: int, most: int):
        self.docs, self.length, self.most = docs, length, most
        order = items.order(weight)
        self.number = np.array(order, np.int64)
        held = [items.held[i] for i in order]
        self.item = np.repeat(np.arange(len(held)), [len(x) for x in held])
        self.term = np.array([t for x in held for t in x], np.int64)
        self.value = np.array([weight[t] * n for x in held for t, n in x.items()], np.int64)
        self.weight = weight
        totals = np.bincount(self.item, self.value, minlength=len(held))
        self.kind = np.float64 if totals.max(initial=0) * 1_000_000 < EXACT else np.int64
        self.score = [np.zeros(0, np.int64) for _ in held]
        self.found = [(np.zeros(0, np.int64), np.zeros(0, bool)) for _ in held]
        # The k-th score of each item; documents below it cannot matter.
        self.bar = np.ones(len(held), np.int64)
        self.scored = 0

    @staticmethod
    def maxima(node: np.ndarray, term: np.ndarray, value: np.ndarray, shape: tuple[int, int], kind):
        """Dense coordinate maxima of nodes."""
        made = np.zeros(shape, kind)
        np.maximum.at(made, (node, term), value.astype(kind))
        return made

    def pack(self, ids, known, sizes, ends, term, count) -> None:
        """Search one pack: arrays as stored, terms from 0."""
        doc = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
        value = saturated(count, sizes[doc], self.docs, self.length)
        local, term = np.unique(term, return_inverse=True)
        width = len(local)
        mine = np.isin(self.term, local)
        items = np.zeros((len(self.bar), width), self.kind)
        items[self.item[mine], np.searchsorted(local, self.term[mine])] = self.value[mine]

        # Documents in the order of their weightiest term.
        heavy = self.weight[local][term] * value
        last = np.lexsort((heavy, doc))
        ending = np.flatnonzero(np.diff(doc[last], append=-1))
        top = np.full(len(ids), -1, np.int64)
        top[doc[last][ending]] = term[last][ending]
        order = np.argsort(top, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc, ids, known = place[doc], ids[order], known[order]
        by_doc = np.argsort(doc, kind="stable")
        doc, term, value = doc[by_doc], term[by_doc], value[by_doc]

        n = -(-len(ids) // NODE)
        batch = np.arange(len(self.bar)) // BATCH
        batches = np.zeros((batch[-1] + 1, width), self.kind)
        np.maximum.at(batches, batch, items)
        whole = self.maxima(np.zeros_like(doc), term, value, (1, width), self.kind)
        alive = np.flatnonzero(batches @ whole[0] >= self._weakest(batch))
        if not len(alive):
            return
        inner = self.maxima(doc // NODE, term, value, (n, width), self.kind)
        bound = batches[alive] @ inner.T
        starts = np.searchsorted(doc, np.arange(n + 1) * NODE)
        for node in np.argsort(-bound.max(axis=0), kind="stable").tolist():
            open_ = alive[bound[:, node] >= self._weakest(batch)[alive]]
            if not len(open_):
                continue
            wanted = np.flatnonzero(np.isin(batch, open_))
            span = slice(starts[node], starts[node + 1])
            self._node(node * NODE, items[wanted], wanted, doc[span], term[span], value[span], ids, known)

    def _weakest(self, batch: np.ndarray) -> np.ndarray:
        weakest = np.full(batch[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(weakest, batch, self.bar)
        return weakest

    def _node(self, first, items, wanted, doc, term, value, ids, known) -> None:
        """Leaves of a node, then the documents of those that are not pruned."""
        local, term = np.unique(term, return_inverse=True)
        items, here = items[:, local], min(NODE, len(ids) - first)
        leaves = self.maxima((doc - first) // LEAF, term, value, (-(-here // LEAF), len(local)), self.kind)
        open_ = items @ leaves.T >= self.bar[wanted, None]
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            return
        docs = np.zeros((here, len(local)), self.kind)
        docs[doc - first, term] = value
        leaf = np.flatnonzero(open_.any(axis=0))
        columns = np.flatnonzero(np.isin(np.arange(here) // LEAF, leaf))
        scores = (items[rows] @ docs[columns].T).astype(np.int64)
        self.scored += scores.size
        fits = (scores >= self.bar[wanted[rows], None]) & open_[rows][:, columns // LEAF]
        for k in np.flatnonzero(fits.any(axis=1)).tolist():
            at = columns[fits[k]] + first
            self._take(int(wanted[rows[k]]), scores[k][fits[k]], ids[at], known[at])

    def _take(self, item: int, score, ids, known) -> None:
        score = np.concatenate([self.score[item], score])
        ids = np.concatenate([self.found[item][0], ids])
        known = np.concatenate([self.found[item][1], known])
        best = np.lexsort((ids, ~known, -score))[: self.most]
        self.score[item], self.found[item] = score[best], (ids[best], known[best])
        if len(best) == self.most:
            self.bar[item] = max(1, score[best[-1]])

    def result(self) -> pa.RecordBatch:
        items = np.repeat(self.number, [len(x) for x in self.score])
        ids, known = (np.concatenate(x) for x in zip(*self.found, strict=True))
        columns = [pa.array(items), pa.array(ids, mask=~known), pa.array(np.concatenate(self.score))]
        return pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])


def _ranked(items: Items, weight: np.ndarray, docs: int, length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, weight, docs, length, most)
        kinds = (np.int64, np.bool_, np.int64, np.int64, np.int32, np.int64)
        for batch in batches:
            for row in zip(*(batch.column(x) for x in COUNTED_NAMES[2:]), strict=True):
                ids, known, sizes, ends, term, count = (
                    np.frombuffer(x.as_buffer(), kind) for x, kind in zip(row, kinds, strict=True)
                )
                search.pack(ids, known, sizes, ends, term.astype(np.int64) - 1, count)
        yield search.result()

    return run


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """Items with a block number, and how many blocks there are."""
    count, size = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    n = max(1, -(-count // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"))
        by_block = dealt.groupBy("block").agg(F.sum(F.length("text")).alias("size"), F.count("*").alias("n"))
        over = by_block.filter((F.col("n") > 1) & ((F.col("n") > 2 * BLOCK_ITEMS) | (F.col("size") > 2 * BLOCK_BYTES)))
        # A block above the bound is split, unless it is one item.
        if over.isEmpty() or n > 4 * count:
            return dealt, n
        n *= 2


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most: int = MOST,
) -> DataFrame:
    """Each item's ``most`` highest-scoring documents: item_id, rank (from 1), doc_id, score.

    Only scores above zero count; equal scores go by ascending doc_id, null ids last.
    Ids of documents are whole numbers. Texts that are null, empty or without terms
    hold nothing and do not count as documents; such items give no rows. Every row is a
    document or an item by itself, also when ids repeat. Extra columns are ignored;
    an empty table on either side gives no rows.
    """
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    wanted = stored(
        items.select(
            F.monotonically_increasing_id().alias("key"),
            F.col(f"`{item_id}`").alias("item_id"),
            F.coalesce(F.col(f"`{item_text}`"), F.lit("")).cast("binary").alias("text"),
        ),
        "items",
    )
    dealt, blocks = _blocks(wanted)
    parts = []
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("key", "text").orderBy("key").collect()
        if not rows:
            continue
        held_items = Items([bytes(row.text) for row in rows])
        counted = stored(source.mapInArrow(_counted(held_items), COUNTED), "term-counts")
        n, length = counted.agg(F.sum("docs"), F.sum("length")).first()
        if not n or not held_items.index:
            discard(counted)
            continue
        frequency = np.zeros(len(held_items.index), np.int64)
        by_term = counted.select("terms").mapInArrow(_held, "term bigint, held bigint")
        for term, held in by_term.groupBy("term").agg(F.sum("held")).collect():
            frequency[term - 1] = held
        ranked = counted.mapInArrow(
            _ranked(held_items, weights(frequency, n), n, length, most),
            "item bigint, doc_id bigint, score bigint",
        )
        keys = F.array(*[F.lit(row.key) for row in rows])
        part = ranked.select(F.get(keys, F.col("item").cast("int")).alias("key"), "doc_id", "score")
        parts.append(stored(part, "item-ranks"))
        discard(counted)
    if not parts:
        kind = wanted.schema["item_id"].dataType.simpleString()
        return items.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = (
        reduce(DataFrame.unionByName, parts)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= most)
    )
    return best.join(wanted.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH doc_terms AS (
  SELECT d, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)),
item_terms AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
  GROUP BY ALL),
sizes AS (SELECT d, doc_id, count(*) AS n FROM doc_terms GROUP BY ALL),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
normed AS (SELECT d, doc_id, 75 + (25 * n * docs) // length AS m FROM sizes, corpus),
counts AS (
  SELECT d, term, count(*) AS tf FROM doc_terms
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, corpus GROUP BY term, docs),
scores AS (
  SELECT item_id, d, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (term) JOIN counts USING (term) JOIN normed USING (d)
  GROUP BY item_id, d, doc_id)
SELECT item_id,
       CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
