"""Hierarchical multi-length packing of tokenised documents.

Context-size tiers are powers of two. A document longer than the longest tier gives
whole windows of it; what is left, like any shorter document, is routed to the
shortest tier that holds it. Windows are filled from the longest tier down: each takes
a document of its own tier and then documents of shorter tiers that fit its gap, and
the last gap is closed by a cut piece of a shorter document, whose rest goes back to
its tier. Where shorter tiers are empty, a document of the same tier is cut instead, so
that at most one document of each tier waits on. So every window is exactly as long as its tier and nothing is padded. What
the end of a partition leaves is cut into windows of ever smaller powers of two.

Windows of one pool and tier are dealt to step groups of equal token count, in an
order that also evens out their attention cost.

Each partition packs its own documents in one pass over pools of bounded size: there
is no shuffle, and a task that runs again gives the same windows from the same rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (256, 512, 1024, 2048)
END = 1  # the id that ends a document
END_BYTES = END.to_bytes(4, "little")
POOL = 1 << 19  # ids of the documents packed together
STEP = 1 << 16  # ids of a step group: 32 windows of 2,048 or 256 of 256
CHUNK = 1 << 19  # characters of the texts that are looked up together, unless one text is longer
CACHED = 400_000  # words whose ids a task remembers

# Text whose lower case and composition do not depend on context or Unicode version.
NOT_PLAIN = re.compile("[^\t-\r\x20-\x7e\xa1-įı-ɏ]")
SPACES = re.compile(r"[\t-\r ]+")
# The tokenizer's own split of lower-cased text.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Letters(dict):
    """How the model writes a character's bytes, asked from its own pre-tokenizer once each."""

    def __init__(self, by_bytes):
        self.by_bytes = by_bytes

    def __missing__(self, code: int) -> str:
        self[code] = self.by_bytes.pre_tokenize_str(chr(code))[0][0]
        return self[code]


def tokenizer_ids(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids (little-endian, four bytes each), without the end.

    The tokenizer drops white space and treats what stands between independently, so
    ids are looked up word by word; the words of the texts that were not met before go
    through its model together. Texts with its special tokens go through it whole, and
    words outside Latin script whole.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    tokenize = whole.model.tokenize
    letters = _Letters(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))
    split = regex.compile(PARTS).findall
    special = [token.content for token in whole.get_added_tokens_decoder().values()]
    plain: dict[str, bytes] = {}
    parts: dict[str, bytes] = {}
    other: dict[str, bytes] = {}

    def encoded(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def ids_of_part(part: str) -> bytes:
        found = parts.get(part)
        if found is None:
            # For ASCII the model's letters for bytes are the characters themselves.
            written = part if part.isascii() else part.translate(letters)
            found = parts[part] = encoded([token.id for token in tokenize(written)])
        return found

    def learn(words: set[str]) -> None:
        if len(plain) > CACHED:
            plain.clear()
            parts.clear()
        for word in words:
            # A word of letters alone is one part.
            if word.isalpha():
                plain[word] = ids_of_part(word)
            else:
                plain[word] = b"".join([ids_of_part(part) for part in split(word)])

    def others(text: str) -> bytes:
        words = SPACES.split(text)
        if len(other) > CACHED:
            other.clear()
        for word in words:
            if word not in other:
                found = whole.encode(word, add_special_tokens=False).ids if word else []
                other[word] = encoded(found)
        return b"".join([other[word] for word in words])

    def ids(texts: list[str]) -> list[bytes]:
        done: list[bytes | None] = []
        split_up: list[list[str]] = []
        for text in texts:
            if "<" in text and any(token in text for token in special):
                done.append(encoded(whole.encode(text, add_special_tokens=False).ids))
            elif NOT_PLAIN.search(text):
                done.append(others(text))
            else:
                done.append(None)
                split_up.append(text.lower().split())
        new = set().union(*split_up).difference(plain)
        if new:
            known = len(plain)
            learn(new)
            if len(plain) < known + len(new):  # the memory was cleared: learn what went with it
                learn(set().union(*split_up).difference(plain))
        looked_up = iter([b"".join(map(plain.__getitem__, words)) for words in split_up])
        return [next(looked_up) if x is None else x for x in done]

    return ids


class Packer:
    """Packs pieces (document number, start, length) into windows of the tiers."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = sorted(tiers)
        self.longest = self.tiers[-1]
        # Per tier: pieces as (length, document, start), in order of length.
        self.waiting: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self.tiers}

    def route(self, doc: int, start: int, length: int) -> list[tuple[int, list]]:
        """Whole windows of a piece; its rest waits in the shortest tier that holds it."""
        windows = []
        while length >= self.longest:
            windows.append((self.longest, [(doc, start, self.longest)]))
            start, length = start + self.longest, length - self.longest
        if length:
            tier = next(t for t in self.tiers if t >= length)
            insort(self.waiting[tier], (length, doc, start))
        return windows

    def _filler(self, gap: int, below: int, own: int) -> tuple[int, int, int] | None:
        """The longest waiting piece that fits the gap, from tiers under ``below``; else one to cut.

        Pieces of the window's own tier are cut only when all shorter ones are gone.
        """
        for tier in reversed(self.tiers):
            line = self.waiting[tier]
            if tier < below and line and line[0][0] <= gap:
                return line.pop(bisect_right(line, (gap, 1 << 62, 0)) - 1)
        for tier in self.tiers:
            if tier <= own and self.waiting[tier]:
                return self.waiting[tier].pop()
        return None

    def fill(self, last: bool = False) -> list[tuple[int, list]]:
        """Full windows from what waits; the rest waits on, or ends if this is the last call."""
        windows = []
        for tier in reversed(self.tiers):
            line = self.waiting[tier]
            shortest = tier == self.tiers[0]
            while line:
                below = tier + 1 if shortest else tier
                length, doc, start = line.pop()
                window, gap = [(doc, start, length)], tier - length
                while gap:
                    more = self._filler(gap, below, tier)
                    if more is None:
                        break
                    size, doc, start = more
                    taken = min(size, gap)
                    window.append((doc, start, taken))
                    gap -= taken
                    if size > taken:
                        self.route(doc, start + taken, size - taken)
                if gap == 0:
                    windows.append((tier, window))
                    continue
                if not last:
                    for doc, start, size in window:
                        self.route(doc, start, size)
                    break
                windows += self._ended(window)
        return windows

    @staticmethod
    def _ended(window: list[tuple[int, int, int]]) -> list[tuple[int, list]]:
        """An unfilled window as windows of smaller powers of two."""
        pieces, windows = list(window), []
        left = sum(size for _, _, size in pieces)
        while left:
            room = size = 1 << left.bit_length() - 1
            part = []
            while room:
                doc, start, length = pieces.pop(0)
                taken = min(room, length)
                part.append((doc, start, taken))
                room -= taken
                if length > taken:
                    pieces.insert(0, (doc, start + taken, length - taken))
            windows.append((size, part))
            left -= size
        return windows


def step_groups(windows: list[tuple[int, list]], step: int) -> list[int]:
    """Step group of each window: windows of one tier, ``step`` ids each, dealt back and forth by cost."""
    groups, first = [0] * len(windows), 0
    for tier in sorted({tier for tier, _ in windows}):
        mine = [i for i, (size, _) in enumerate(windows) if size == tier]
        mine.sort(key=lambda i: -sum(size * size for _, _, size in windows[i][1]))
        n = -(-len(mine) * tier // step)
        for rank, i in enumerate(mine):
            turn, place = divmod(rank, n)
            groups[i] = first + (place if turn % 2 == 0 else n - 1 - place)
        first += n
    return groups


COLUMNS = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, tier int, step_group bigint"
)


def _in_chunks(ids_of: Callable[[list[str]], list[bytes]], texts: pa.Array) -> Iterator[bytes]:
    """The texts' ids in order; a bounded number of texts is held at a time."""
    waiting, size = [], 0
    for text in texts:
        waiting.append(text.as_py())
        size += len(waiting[-1])
        if size >= CHUNK:
            yield from ids_of(waiting)
            waiting, size = [], 0
    yield from ids_of(waiting)


def _pack(path: str, tiers: tuple[int, ...], pool: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer_ids(path)
        base = TaskContext.get().partitionId() << 40
        packer, docs, fresh = Packer(tiers), {}, 0
        number, sequence, group = 0, base, base

        def batch_of(windows: list[tuple[int, list]]) -> pa.RecordBatch:
            nonlocal sequence, group
            groups = step_groups(windows, step)
            names, rows = [], []
            for (size, pieces), mine in zip(windows, groups, strict=True):
                offset = 0
                for doc, start, length in pieces:
                    name, data = docs[doc]
                    crc = zlib.crc32(memoryview(data)[4 * start : 4 * (start + length)])
                    names.append(name)
                    rows.append(
                        (start, length, crc, len(data) // 4, sequence, offset, size, group + mine)
                    )
                    offset += length
                sequence += 1
            group += max(groups, default=-1) + 1
            values = np.array(rows, np.int64).reshape(-1, 8).T
            columns = [pa.array(names, kind), *[pa.array(x) for x in values]]
            columns[7] = columns[7].cast(pa.int32())
            return pa.RecordBatch.from_arrays(columns, ["doc_id", *NAMES])

        windows, kind = [], pa.int64()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            names = batch.column("doc_id").to_pylist()
            for name, data in zip(names, _in_chunks(ids_of, batch.column("text")), strict=True):
                data += END_BYTES
                docs[number] = (name, data)
                windows += packer.route(number, 0, len(data) // 4)
                number += 1
                fresh += len(data) // 4
                if fresh >= pool:
                    yield batch_of(windows + packer.fill())
                    windows, fresh = [], 0
                    held = {doc for line in packer.waiting.values() for _, doc, _ in line}
                    docs = {doc: docs[doc] for doc in held}
        windows += packer.fill(last=True)
        if windows:
            yield batch_of(windows)

    return run


NAMES = [x.split()[0] for x in COLUMNS.split(", ")]


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tiers: tuple[int, ...] = TIERS,
    pool: int = POOL,
    step: int = STEP,
) -> DataFrame:
    """One row per piece of a document: where it lies and in which window.

    Columns: doc_id, start and length (in ids), ids_crc32, doc_tokens (with the end),
    sequence_id, offset (gapless in its sequence), tier (the sequence's length) and
    step_group. A null or empty text is its end alone. Every row is packed by itself,
    also when ids repeat or are null. An empty table gives no rows; other columns are
    ignored.
    """
    if any(tier & (tier - 1) for tier in tiers) or not tiers:
        raise ValueError("tiers must be powers of two")
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_pack(tokenizer, tuple(tiers), pool, step), f"doc_id {kind}, {COLUMNS}")
