"""Subword lattice likelihood of texts.

A text's lattice holds all its segmentations; its probability is the sum over all of
them. The edges inside a word are the pieces of an existing subword vocabulary. They
start from the vocabulary's own order (pieces it learned first are likelier) and are
fitted to the different words of the training texts by expectation maximisation: a
forward and a backward recursion in log space give expected piece counts, and only
sums per piece, as many as the vocabulary has, come to the driver. Bytes are pieces
too, so no text has probability zero.

A word met in training also has an edge over all of it, weighted by its discounted
count; what the discount frees weights the paths through pieces. Words in a text share
one component, its language, over which the text's probability is summed as well.

Pieces begin either at a word's start or inside a word, so a text's lattice splits at
word starts, and each different word needs its recursion only once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import stored

FOLDS, HELD_OUT = 7, 2
START = "▁"  # the vocabulary's mark of a word's start
SPACE = b" "  # the same in this module: no word holds it
ROUNDS = 2  # of expectation maximisation
PRIOR = 0.01  # added to each piece's expected count
COMPONENTS = 16  # most languages told apart; the rest share one more component
BLOCK_BYTES = 8 << 20  # text of documents scored together
CELLS = 1 << 20  # lattice edges handled at once
HASH_BASE = 0x9E3779B97F4A7C15  # odd


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Usable pieces of a sentencepiece model, all bytes among them, and starting log probabilities.

    Pieces with a word start inside or with capital letters cannot occur in lower-cased
    words and are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [bytes([b]) for b in range(256)], [float(model.get_piece_size())] * 256
    at = {piece: i for i, piece in enumerate(pieces)}
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number) or model.is_control(number) or model.is_unknown(number):
            continue
        raw = piece.replace(START, " ").encode()
        if b" " in raw[1:] or raw.lower() != raw:
            continue
        rank = 1.0 - model.get_score(number)
        if raw in at:
            ranks[at[raw]] = rank
        else:
            at[raw] = len(pieces)
            pieces.append(raw)
            ranks.append(rank)
    weight = 1 / (np.array(ranks) + 10)
    return pieces, np.log(weight / weight.sum())


class Lattice:
    """All ways to cut words into pieces, for many words at once."""

    def __init__(self, pieces: list[bytes]):
        self.longest = max(map(len, pieces))
        self.tables = []  # hash tables: slots of the first are tried first
        hashes = self._hash_all(pieces)
        left, bits = np.arange(len(pieces)), 20
        while len(left):
            slots = (hashes[left] >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(slots, return_index=True)
            table = np.full(1 << bits, -1, np.int32)
            table[slots[first]] = left[first]
            self.tables.append((bits, table))
            left = np.delete(left, first)
            bits = max(12, bits - 4)
        # The entry past the end belongs to no piece.
        self.hashes = np.append(hashes, np.uint64(0))

    @staticmethod
    def _hash_all(pieces: list[bytes]) -> np.ndarray:
        out = np.zeros(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            value = 0
            for byte in piece:
                value = (value * HASH_BASE + byte + 1) % (1 << 64)
            out[i] = value * HASH_BASE % (1 << 64)
        if len(set(out.tolist())) < len(pieces):
            raise ValueError("two pieces share a hash")
        return out

    def edges(self, words: np.ndarray) -> np.ndarray:
        """Piece ids [word, end - 1, length - 1] of padded words; -1 where no piece fits."""
        n, width = words.shape
        longest = min(self.longest, width)
        sums = np.zeros((n, width + 1), np.uint64)
        base = np.uint64(HASH_BASE)
        for j in range(width):
            sums[:, j + 1] = sums[:, j] * base + words[:, j] + np.uint64(1)
        ids = np.full((n, width, longest), -1, np.int32)
        power = np.uint64(1)
        with np.errstate(over="ignore"):
            for length in range(1, longest + 1):
                power = power * base
                h = (sums[:, length:] - sums[:, :-length] * power) * base
                got = np.full(h.shape, -1, np.int32)
                for bits, table in self.tables:
                    found = table[(h >> np.uint64(64 - bits)).astype(np.int64)]
                    got = np.where((got < 0) & (self.hashes[found] == h) & (found >= 0), found, got)
                ids[:, length - 1 :, length - 1] = got
        return ids

    def batches(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(numbers of the words, their lengths, ids of their edges), words of like length together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            width, to = int(lengths[order[at]]), at + 1
            limit = max(1, CELLS // (width * min(width, self.longest)))
            to = min(at + limit, int(np.searchsorted(lengths[order], width + 2, "right")), len(order))
            mine = order[at:to]
            width = int(lengths[mine[-1]])
            joined = b"".join([(SPACE + words[i]).ljust(width, b"\0") for i in mine.tolist()])
            padded = np.frombuffer(joined, np.uint8).reshape(len(mine), width).astype(np.uint64)
            yield mine, lengths[mine], self.edges(padded)
            at = to

    @staticmethod
    def _sum(values: np.ndarray) -> np.ndarray:
        """Log of the sum of exponentials over the last axis."""
        top = values.max(axis=1)
        top[~np.isfinite(top)] = 0
        with np.errstate(divide="ignore"):
            return np.log(np.exp(values - top[:, None]).sum(axis=1)) + top

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Log sums [word, position] over all segmentations up to each position."""
        n, width, longest = weights.shape
        out = np.zeros((n, width + 1))
        for j in range(1, width + 1):
            k = min(longest, j)
            out[:, j] = self._sum(weights[:, j - 1, :k] + out[:, j - k : j][:, ::-1])
        return out

    def backward(self, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log sums over all segmentations from each position to the word's end."""
        n, width, longest = weights.shape
        out = np.full((n, width + 1), -np.inf)
        out[np.arange(n), lengths] = 0
        steps = np.arange(longest)
        for j in range(width - 1, -1, -1):
            k = min(longest, width - j)
            ahead = weights[:, j + steps[:k], steps[:k]] + out[:, j + 1 : j + 1 + k]
            mine = j < lengths
            out[mine, j] = self._sum(ahead[mine])
        return out

    def weights(self, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return np.append(scores, -np.inf)[ids]

    def log_probabilities(self, words: list[bytes], scores: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability, summed over its segmentations."""
        out = np.zeros(len(words))
        for mine, lengths, ids in self.batches(words):
            ahead = self.forward(self.weights(ids, scores))
            out[mine] = ahead[np.arange(len(mine)), lengths]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in words that occur ``counts`` times."""
        total = np.zeros(len(scores))
        for mine, lengths, ids in self.batches(words):
            weights = self.weights(ids, scores)
            ahead, behind = self.forward(weights), self.backward(weights, lengths)
            n, width, longest = weights.shape
            whole = ahead[np.arange(n), lengths]
            for length in range(1, longest + 1):
                use = weights[:, length - 1 :, length - 1] + ahead[:, : width - length + 1]
                use = np.exp(use + behind[:, length:] - whole[:, None]) * counts[mine][:, None]
                here = ids[:, length - 1 :, length - 1]
                hit = here >= 0
                total += np.bincount(here[hit], use[hit], len(scores))
        return total


def split(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of all words of binary texts, capital letters A to Z lowered, in a row; where each
    text's words end; and the different words by number, in order of first occurrence."""
    chunks = texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]
    trimmed = pc.ascii_trim_whitespace(pa.chunked_array([x.view(pa.string()) for x in chunks], pa.string()))
    # A text without words is split into one empty word.
    empty = pc.equal(pc.binary_length(trimmed), 0).to_numpy()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(trimmed))
    lengths = np.where(empty, 0, pc.list_value_length(lists).to_numpy())
    every = pc.list_flatten(lists)
    words = every.filter(pc.greater(pc.binary_length(every), 0)).combine_chunks()
    parts = [x.dictionary_encode() for x in (words.chunks if isinstance(words, pa.ChunkedArray) else [words])]
    if len(parts) > 1:
        parts = pa.chunked_array(parts).unify_dictionaries().chunks
    numbers = np.concatenate([x.indices.to_numpy() for x in parts]) if parts else np.zeros(0, np.int32)
    distinct = parts[0].dictionary if parts else pa.array([], pa.string())
    return numbers, np.cumsum(lengths, dtype=np.int64), distinct.view(pa.binary())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, component, count) of a batch; words of held-out texts alone count zero times."""
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers, ends, words = split(batch.column("text"))
        held = np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)
        part = np.where(held, -1, batch.column("component").to_numpy())
        of = np.repeat(part, np.diff(ends, prepend=0))
        for k in sorted({0, *part[~held].tolist()}):
            counts = np.bincount(numbers[of == k], minlength=len(words))
            told = counts > 0
            if k == 0:
                told[numbers[of == -1]] = True
            mine = np.flatnonzero(told)
            yield pa.RecordBatch.from_arrays(
                [
                    words.take(pa.array(mine)),
                    pa.array(np.full(len(mine), k, np.int32)),
                    pa.array(counts[mine].astype(np.int64)),
                ],
                ["word", "component", "count"],
            )


def _expected(pieces: list[bytes], scores: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = Lattice(pieces), np.zeros(len(pieces))
        for batch in batches:
            words = batch.column("word").to_pylist()
            total += lattice.expected(words, np.ones(len(words)), scores)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "uses"]
        )

    return run


def _scored(pieces: list[bytes], scores: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for batch in batches:
            found = lattice.log_probabilities(batch.column("word").to_pylist(), scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("counts"), pa.array(found / np.log(10))],
                ["word", "counts", "log10_p"],
            )

    return run


def fit(words: DataFrame, pieces: list[bytes], scores: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces, fitted to the different words of training texts.

    Each word weighs the same: pieces only spell words whose own edge does not suffice,
    and those are like words met once rather than like frequent ones.
    """
    for _ in range(rounds):
        sums = (
            words.select("word")
            .mapInArrow(_expected(pieces, scores), "piece int, uses double")
            .groupBy("piece")
            .agg(F.sum("uses").alias("uses"))
            .collect()  # a row per piece of the vocabulary at most
        )
        uses = np.full(len(pieces), PRIOR)
        for piece, value in sums:
            uses[piece] += value
        scores = np.log(uses / uses.sum())
    return scores


@dataclass(frozen=True)
class Model:
    """Sizes of the training texts: for all of them first, then for each component."""

    texts: np.ndarray  # also the count of the end
    tokens: np.ndarray
    distinct: np.ndarray
    discount: float

    def base(self, counts: np.ndarray) -> np.ndarray:
        """Add-one log10 probabilities from total counts."""
        return np.log10((counts + 1.0) / (self.tokens[0] + self.distinct[0] + 1.0))

    def log10(self, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Log10 probability [word, component]: whole-word edges over all paths through pieces.

        ``counts`` has a column for each component; all components together stand
        between a component and the pieces.
        """
        below = spelled
        total = counts.sum(axis=1)
        rows = [self._level(0, total, below)]
        below = rows[0]
        for k in range(counts.shape[1]):
            if self.texts[k + 1]:
                rows.append(self._level(k + 1, counts[:, k], below))
            else:
                rows.append(np.full(len(total), -np.inf))
        return np.stack(rows[1:], axis=1)

    def _level(self, k: int, counts: np.ndarray, below: np.ndarray) -> np.ndarray:
        # The end is neither discounted nor spelled; all components together know words only.
        words = self.distinct[k] - (self.texts[k] > 0)
        tokens = self.tokens[k] - (0 if k else self.texts[0])
        if not tokens or not words:
            return below + (np.log10(0.5) if k else 0)
        spread = below + np.log10(self.discount * words / tokens)
        own = np.maximum(counts - self.discount, 0) / tokens
        return np.where(counts > 0, np.log10(np.maximum(own, 1e-300) + 10**spread), spread)

    def mixed(self, sums: np.ndarray) -> float:
        """Log10 probability of a text from its sum under each component."""
        if not self.texts[0]:
            return float(sums[0])
        with np.errstate(divide="ignore"):
            sums = sums + np.log10(self.texts[1:] / self.texts[0])
        top = sums.max()
        return float(top + np.log10((10 ** (sums - top)).sum()))


def _requests(table: pa.Table) -> pa.Table:
    words = split(table.column("text"))[2]
    words = words.take(pc.sort_indices(words))
    block = pa.repeat(table.column("block")[0], len(words))
    slots = pa.array(np.arange(len(words), dtype=np.int32))
    return pa.table({"block": block, "slot": slots, "word": words})


def _texts(model: Model):
    """Scores of a block's texts from the counts and probabilities of its words."""
    parts = len(model.texts) - 1
    # The end is never spelled: without training texts it has an even chance.
    ends = model.texts[None, 1:]
    end_base = float(model.base(model.texts[:1])[0])
    if model.texts[0]:
        with np.errstate(divide="ignore", invalid="ignore"):
            end = np.log10(np.where(ends > 0, ends, np.nan) / model.tokens[None, 1:])[0]
        end = np.where(np.isfinite(end), end, -np.inf)
    else:
        end = np.full(parts, np.log10(0.5))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        slots = answers.column("slot").to_numpy()
        counts, spelled = np.zeros((len(slots), parts), np.int64), np.zeros(len(slots))
        told = answers.column("counts").combine_chunks().flatten().to_numpy()
        counts[slots] = told.reshape(-1, parts)
        spelled[slots] = answers.column("log10_p").to_numpy()
        base, total = model.base(counts.sum(axis=1)), counts.sum(axis=1)
        found = model.log10(counts, spelled) if model.texts[0] else (
            np.repeat(spelled[:, None] + np.log10(0.5), parts, axis=1)
        )
        numbers, ends, words = split(texts.column("text"))
        # A word's slot is its place among the block's words in order, as in the request.
        slot = np.empty(len(words), np.int64)
        slot[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        places, rows = slot[numbers], []
        for begin, end_at in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            at = places[begin:end_at]
            rows.append(
                (
                    len(at) + 1,
                    int((total[at] > 0).sum()) + int(model.texts[0] > 0),
                    float(base[at].sum() + end_base),
                    model.mixed(found[at].sum(axis=0) + end),
                )
            )
        n_tokens, n_known, base_score, score = zip(*rows, strict=True) if rows else ((),) * 4
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([int(model.tokens[0])] * len(rows), pa.int64()),
                "base_score": pa.array(base_score, pa.float64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out of training; a null id never is."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _components(source: DataFrame, language: str | None, most: int) -> list[str]:
    """The most frequent languages of training texts; ties by name."""
    if language is None:
        return []
    rows = (
        source.filter("NOT held_out AND language IS NOT NULL")
        .groupBy("language")
        .count()
        .orderBy(F.desc("count"), "language")
        .limit(most)
        .collect()
    )
    return [row["language"] for row in rows]


RESULT = (
    "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def score_texts(
    docs: DataFrame,
    vocabulary_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    language: str | None = "lang",
    rounds: int = ROUNDS,
    block_bytes: int = BLOCK_BYTES,
    most_components: int = COMPONENTS,
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities: ``base_score`` of add-one word counts, ``score`` of
    the lattice model. The language only groups training texts; a text is scored under
    all of them. Null and empty texts are the end alone; null and rare languages share a
    component. Rows that repeat count and are scored as often. An empty table gives no
    rows; other columns are ignored.

    Documents are dealt to blocks. A block asks once for each of its words, and what it
    asked for comes back to it, so that a word in every text is one row per block.
    """
    known = F.col(f"`{doc_id}`")
    source = docs.select(
        known.alias("doc_id"),
        held_out(known).alias("held_out"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
        F.xxhash64(known, f"`{text}`").alias("_hash"),
        (F.col(f"`{language}`") if language else F.lit(None)).cast("string").alias("language"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, {RESULT}"
    if source.isEmpty():
        return docs.sparkSession.createDataFrame([], result)
    names = _components(source, language, most_components)
    place = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("language")) if names else None
    component = F.coalesce(place, F.lit(0)).cast("int") if names else F.lit(0)
    parts = range(len(names) + 1)

    seen = Observation()
    training = [
        F.sum((~F.col("held_out") & (F.col("component") == k)).cast("bigint")).alias(f"texts{k}")
        for k in parts
    ]
    counted = source.select("held_out", "text", component.alias("component")).observe(
        seen, F.sum(F.octet_length("text")).alias("bytes"), *training
    )
    words = stored(
        counted.mapInArrow(_word_counts, "word binary, component int, count bigint")
        .groupBy("word")
        .agg(
            F.array(
                *[F.sum(F.when(F.col("component") == k, F.col("count")).otherwise(0)) for k in parts]
            ).alias("counts")
        ),
        "word-counts",
    )
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    per_part = [F.get("counts", k) for k in parts]
    sizes = words.select(total.alias("all"), *[x.alias(f"c{k}") for k, x in enumerate(per_part)]).agg(
        *[F.coalesce(F.sum(x), F.lit(0)) for x in ("all", *[f"c{k}" for k in parts])],
        *[F.count_if(F.col(x) > 0) for x in ("all", *[f"c{k}" for k in parts])],
        F.count_if(F.col("all") == 1),
        F.count_if(F.col("all") == 2),
    ).first()
    n = len(parts) + 1
    texts = np.array([seen.get[f"texts{k}"] or 0 for k in parts], np.int64)
    texts = np.append(texts.sum(), texts)
    once, twice = sizes[2 * n], sizes[2 * n + 1]
    model = Model(
        texts,
        np.array(sizes[:n], np.int64) + texts,
        np.array(sizes[n : 2 * n], np.int64) + (texts > 0),
        min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5)),
    )

    pieces, scores = vocabulary(vocabulary_path)
    scores = fit(words.filter(total > 0), pieces, scores, rounds)
    scored = stored(
        words.mapInArrow(
            _scored(pieces, scores), "word binary, counts array<bigint>, log10_p double"
        ),
        "scored-words",
    )

    blocks = max(1, -(-(seen.get["bytes"] or 0) // block_bytes))
    dealt = source.select(
        "doc_id", "held_out", "text", F.pmod("_hash", F.lit(blocks)).alias("block")
    ).repartition("block")
    asked = dealt.groupBy("block").applyInArrow(_requests, "block bigint, slot int, word binary")
    answers = asked.join(scored, "word").select("block", "slot", "counts", "log10_p")
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_texts(model), result)
    )
