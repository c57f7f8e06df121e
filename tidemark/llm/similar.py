"""Near-duplicates by the Jaccard similarity of word shingles, without loss.

The fingerprints of ``simhash`` cannot carry this rule alone: texts that share four fifths of
their shingles differ in about ten of 64 bits, and chains over so wide a budget no longer
tell texts apart. So with ``fingerprints`` the pairs that SimHash finds by pigeonring come first and are
verified on their shingles; the rest of the rule has an exact way, whose candidates come from the shingles themselves.

1. Shingles are dealt to blocks by their hash, and each block finds those that more than one
   text holds. Only they can be common to two texts, so from here on a text is its shared
   shingles and the number of the others.
2. Under any fixed order of all shingles, two texts of similarity 0.8 share one among the
   first fifth (and one more) of each. The order goes from the rarest shingle up, so
   shingles of one text alone come first: most texts have no key left, and boilerplate is
   none unless nearly the whole text is.
3. Two texts under one key are a candidate pair if their sizes and their parity sketches
   allow 0.8. Each shared shingle flips one bit of a text's sketch, so two sketches never
   differ in more bits than the texts differ in shared shingles: no pair is lost.
4. Candidates are verified on their shared shingles.

Large groups of copies are never paired out. In a few rounds one text of each key is
compared with those of the key that do not hang together with it yet; then only keys that
still hold several components are looked at in packs of bounded size, by sketches: first each
text meets its nearest one of another component, at last all pairs across components are
compared. The components are those of all similar pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, one_per, replacing, stored, text_of
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import nearest_links

SHINGLE = 5
SIMILAR = (4, 5)  # least similarity, as a fraction
SEED = 43
BLOCK_BYTES = 12 << 20  # text whose shingles one block compares, on average
MOST_BLOCKS = 1 << 22
SKETCH = 8  # words of 64 bits of a parity sketch
ROUNDS = 2  # rounds of one text of each key against the others
PACK = 256  # texts of a key that are compared at once with as many others, on average

# Odd multipliers that mix 64 bits.
STEP, MIX_1, MIX_2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Ascending hashes of the distinct shingles; a text shorter than one is one shingle."""
    words = text.lower().split()
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(word, SEED) for word in words], np.uint64)
    n = len(words) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = mixed * STEP + hashes[k : k + n]
        mixed = (mixed ^ (mixed >> np.uint64(30))) * MIX_1
        mixed = (mixed ^ (mixed >> np.uint64(27))) * MIX_2
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def key_count(n: int) -> int:
    """Shingles from the order's start among which a similar text must share one."""
    return n - -(-SIMILAR[0] * n // SIMILAR[1]) + 1


DEALT = "block int, ns binary, sizes binary, counts binary, low binary, high binary"
DEALT_NAMES = [x.split()[0] for x in DEALT.split(", ")]


def _dealt(blocks: int):
    """Each batch's shingles as one row per block: 40 bits of each hash, text by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns = np.asarray(batch.column("n"), np.int64)
            found = [shingles(text.as_buffer().to_pybytes()) for text in batch.column("text")]
            if not found:
                continue
            sizes = np.array([len(x) for x in found], np.int64)
            owner = np.repeat(np.arange(len(ns), dtype=np.int32), sizes)
            hashes = np.concatenate(found)
            # The upper bits choose the block, the lower 40 stay.
            block = ((hashes >> np.uint64(40)) % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            ends = np.searchsorted(block[order], np.arange(blocks + 1))
            rows: list[tuple] = []
            for k in range(blocks):
                mine = order[ends[k] : ends[k + 1]]
                if len(mine):
                    holders, counts = np.unique(owner[mine], return_counts=True)
                    kept = hashes[mine]
                    rows.append((
                        k, ns[holders].tobytes(), sizes[holders].astype(np.uint32).tobytes(),
                        counts.astype(np.uint32).tobytes(), kept.astype(np.uint32).tobytes(),
                        (kept >> np.uint64(32)).astype(np.uint8).tobytes(),
                    ))
            kinds = [pa.int32(), *[pa.binary()] * 5]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, DEALT_NAMES)

    return run


SHARED = "part int, ns binary, sizes binary, counts binary, marks binary, held binary"
SHARED_NAMES = [x.split()[0] for x in SHARED.split(", ")]


def _joined(table: pa.Table, names: list[str], kinds: tuple) -> dict[str, np.ndarray]:
    """Binary columns, each as one array over all rows."""
    return {
        name: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        for name, kind in zip(names, kinds, strict=True)
    }


def _shared(parts: int):
    """The shingles of a block that more than one text holds, and how many do, for each part of the texts."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        joined = _joined(table, DEALT_NAMES[1:], (np.int64, np.uint32, np.uint32, np.uint32, np.uint8))
        values = joined["high"].astype(np.int64) << 32 | joined["low"]
        owner = np.repeat(np.arange(len(joined["ns"]), dtype=np.int32), joined["counts"])
        # By value, then text; a row that is there more than once is one text.
        order = np.lexsort((joined["ns"][owner], values))
        values, owner = values[order], owner[order]
        names = joined["ns"][owner]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (names[1:] != names[:-1])
        values, names, owner = values[new], names[new], owner[new]
        times = np.diff(np.flatnonzero(np.diff(values, prepend=-1)), append=len(values))
        held = np.repeat(times, times)
        common = held > 1
        marks, held = values[common] | np.int64(block) << 40, held[common].astype(np.int32)
        names, owner = names[common], owner[common]
        part = (names.view(np.uint64) % np.uint64(parts)).astype(np.int32)
        by_text = np.lexsort((names, part))
        marks, held, names, owner, part = (x[by_text] for x in (marks, held, names, owner, part))
        begins = np.flatnonzero(np.diff(names, prepend=names[:1] - 1))
        counts = np.diff(begins, append=len(names)).astype(np.uint32)
        ns, sizes, of = names[begins], joined["sizes"][owner[begins]], part[begins]
        rows = []
        for k in np.unique(of).tolist():
            texts = slice(*np.searchsorted(of, (k, k + 1)).tolist())
            entries = slice(*np.searchsorted(part, (k, k + 1)).tolist())
            packed = (ns[texts], sizes[texts], counts[texts], marks[entries], held[entries])
            rows.append((k, *[x.tobytes() for x in packed]))
        kinds = [pa.int32(), *[pa.binary()] * 5]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=SHARED_NAMES)

    return run


def sketch(marks: np.ndarray) -> np.ndarray:
    """Parity of the marks that fall on each bit."""
    mixed = marks.astype(np.uint64) * MIX_1
    bits = ((mixed ^ (mixed >> np.uint64(29))) * MIX_2 >> np.uint64(40)) % np.uint64(64 * SKETCH)
    parity = np.bincount(bits.astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


HOLDERS = "n bigint, size bigint, alone bigint, keys array<bigint>, sketch array<bigint>, shared binary"


def _holders(table: pa.Table) -> pa.Table:
    """Texts of a part that have keys: shingles of theirs alone, keys, sketch and shared shingles."""
    joined = _joined(table, SHARED_NAMES[1:], (np.int64, np.uint32, np.uint32, np.int64, np.int32))
    owner = np.repeat(np.arange(len(joined["ns"])), joined["counts"])
    names = joined["ns"][owner]
    # Each text's marks from the rarest up.
    order = np.lexsort((joined["marks"], joined["held"], names))
    names, marks, sizes = names[order], joined["marks"][order], joined["sizes"][owner[order]]
    begins = np.flatnonzero(np.diff(names, prepend=names[:1] - 1))
    rows = []
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(names)], strict=True):
        size = int(sizes[a])
        alone = size - (b - a)
        wanted = key_count(size) - alone
        if wanted > 0:
            mine = marks[a:b]
            rows.append((int(names[a]), size, alone, mine[:wanted], sketch(mine), np.sort(mine).tobytes()))
    many = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), many, many, pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    names_ = [x.split()[0] for x in HOLDERS.split(", ")]
    return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names_)


def holders(rows: DataFrame) -> DataFrame:
    """The texts of (n, text) that may be similar to another one."""
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = min(max(1, -(-total // BLOCK_BYTES)), MOST_BLOCKS)
    by_block = rows.mapInArrow(_dealt(blocks), DEALT).groupBy("block").applyInArrow(_shared(blocks), SHARED)
    # Of blocks and parts there are equally many: neither holds more than its share of all texts.
    return by_block.groupBy("part").applyInArrow(_holders, HOLDERS)


TEXT = ("n", "size", "alone", "sketch", "label")


def _may_be_similar(a: Column, b: Column) -> Column:
    """What sizes, shingles of one text alone and sketches say: false only if 0.8 is out of reach."""
    differing = reduce(
        lambda total, k: total + F.bit_count(a["sketch"][k].bitwiseXOR(b["sketch"][k])), range(SKETCH), F.lit(0)
    )
    total = a["size"] + b["size"]
    fits = SIMILAR[1] * F.least(a["size"], b["size"]) >= SIMILAR[0] * F.greatest(a["size"], b["size"])
    return fits & (9 * (differing + a["alone"] + b["alone"]) <= total)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        close = []
        columns = (batch.column(name) for name in ("x", "y", "total"))
        for x, y, total in zip(*columns, strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
            # Both ascend and hold a mark once, so a shared one stands twice in the merged row.
            merged = np.sort(np.concatenate([x, y]), kind="stable")
            both = int((merged[1:] == merged[:-1]).sum())
            close.append(SIMILAR[1] * both >= SIMILAR[0] * (total.as_py() - both))
        yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingles are similar."""
    left = texts.select(F.col("n").alias("a"), F.col("shared").alias("x"), F.col("size").alias("p"))
    right = texts.select(F.col("n").alias("b"), F.col("shared").alias("y"), F.col("size").alias("q"))
    met = pairs.join(left, "a").join(right, "b")
    return met.select("a", "b", "x", "y", (F.col("p") + F.col("q")).alias("total")).mapInArrow(
        _compare, "a bigint, b bigint"
    )


def _across(most: int | None):
    """Pairs of two packs of a key that lie in different components and may be similar.

    With ``most``, of each text of the first pack only so many partners, those whose sketches are nearest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                a, b = (
                    {name: np.array([text[name] for text in row[side]], np.int64) for name in TEXT}
                    for side in ("a", "b")
                )
                fits = a["label"][:, None] != b["label"][None, :]
                if row["same"]:
                    fits &= np.arange(len(a["n"]))[:, None] < np.arange(len(b["n"]))[None, :]
                less = np.minimum(a["size"][:, None], b["size"][None, :])
                total = a["size"][:, None] + b["size"][None, :]
                fits &= SIMILAR[1] * less >= SIMILAR[0] * (total - less)
                i, j = np.nonzero(fits)
                words = (a["sketch"][i] ^ b["sketch"][j]).view(np.uint64)
                apart = np.bitwise_count(words).sum(axis=1, dtype=np.int64) + a["alone"][i] + b["alone"][j]
                kept = 9 * apart <= total[i, j]
                i, j, apart = i[kept], j[kept], apart[kept]
                if most is not None and len(i):
                    order = np.lexsort((j, apart, i))
                    i, j = i[order], j[order]
                    begins = np.searchsorted(i, i)
                    near = np.arange(len(i)) - begins < most
                    i, j = i[near], j[near]
                if len(i):
                    x, y = a["n"][i], b["n"][j]
                    columns = [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def _labelled(keyed: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of keys with the component of their text so far."""
    if labels is None:
        return keyed.withColumn("label", F.col("n"))
    known = labels.select(F.col("node").alias("n"), "label")
    return keyed.join(known, "n", "left").withColumn("label", F.coalesce("label", "n"))


def _open_keys(labelled: DataFrame, *more: Column) -> DataFrame:
    """Keys that hold more than one component."""
    several = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), *more)
    return several.filter("low < high").drop("low", "high")


def similar_components(rows: DataFrame, rounds: int = ROUNDS, fingerprints: bool = False) -> DataFrame:
    """(node, label) for each text of (n, text) that is similar to another one, with the smallest
    ``n`` of its component; rows of equal ``n`` are equal. The result is the same with
    ``fingerprints``, where SimHash of the same shingles links first what it finds."""
    texts = stored(holders(rows), "holders")
    every = texts.select(F.explode("keys").alias("key"), "n", "size", "alone", "sketch")
    again = F.xxhash64("key").alias("_hash")
    tested: list[DataFrame] = []
    labels: DataFrame | None = None

    def verify(pairs: DataFrame) -> bool:
        """Test the candidates not met before, join the components of those that are similar; whether there are any.

        Rounds often meet nobody new: then nothing is compared, and the components stay as they are.
        """
        nonlocal labels
        new = reduce(lambda left, old: left.join(old, ["a", "b"], "left_anti"), tested, pairs.distinct())
        found = candidates = stored(new, "candidates")
        if not candidates.isEmpty():
            tested.append(candidates)
            found = stored(_similar(candidates, texts), "similar")
        links, some = found, found is not candidates and not found.isEmpty()
        if some and labels is not None:
            # What hung together before is told by a link to the component's label.
            links = found.unionByName(labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
        joined = connected_components(links)
        labels = joined if some or labels is None else labels
        discard(found)
        return some

    if fingerprints:
        first = nearest_links(rows, SHINGLE)
        verify(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        discard(first)
    for number in range(rounds):
        labelled = _labelled(every, labels)
        # The order of leaders is the same under all keys, so that copies have few different ones.
        order = F.xxhash64(F.lit(number), "n")
        leader = F.min_by(F.struct(*TEXT), order).alias("leader")
        chosen = _open_keys(labelled, leader)
        # The hash makes the join shuffle anew, so that a hot key can be split.
        met = labelled.select("key", again, F.struct(*TEXT).alias("text")).join(
            chosen.select("*", again), ["key", "_hash"]
        )
        a, b = F.col("text"), F.col("leader")
        verify(
            met.filter((a["label"] != b["label"]) & _may_be_similar(a, b)).select(
                F.least(a["n"], b["n"]).alias("a"), F.greatest(a["n"], b["n"]).alias("b")
            )
        )

    # First the nearest partner of each text, which joins most of a group; then all pairs across what is left.
    # The packs stay as they are if the first of these has joined nothing.
    packs: DataFrame | None = None
    for most in (1, None):
        if packs is None:
            labelled = _labelled(every, labels)
            sizes = _open_keys(labelled, F.ceil(F.count("*") / PACK).cast("int").alias("parts"))
            part = F.pmod(F.xxhash64(F.lit(SEED), "n"), F.col("parts")).cast("int").alias("part")
            packed = (
                labelled.select("*", again)
                .join(sizes.select("*", again), ["key", "_hash"])
                .select("key", part, F.struct(*TEXT).alias("text"))
                .groupBy("key", "part")
                .agg(F.collect_list("text").alias("texts"))
            )
            packs = stored(packed, "packs")
        a = packs.select("key", F.col("part").alias("p"), F.col("texts").alias("a"))
        b = packs.select("key", F.col("part").alias("q"), F.col("texts").alias("b"))
        met = a.join(b, "key").filter("p <= q AND (p < q OR size(a) > 1)")
        some = verify(met.select("a", "b", F.expr("p = q").alias("same")).mapInArrow(_across(most), "a bigint, b bigint"))
        if some or most is None:
            discard(packs)
            packs = None
    discard(*tested)
    return labels


def drop_similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, fingerprints: bool = False
) -> DataFrame:
    """``docs`` without near-duplicates: one row of each component of similar rows stays.

    It is the one with the smallest hash of id and text. Rows with the same id and text
    count as one; of them the first in the order of a hash of all columns stays. Null and
    empty texts are equal to each other and to nothing else. Columns stay as they were.
    """
    number = F.xxhash64(F.lit(SEED), f"`{doc_id}`", f"`{text}`")
    rows = docs.select(number.alias("n"), text_of(F.col(f"`{text}`")).cast("binary").alias("text"))
    labels = similar_components(rows, rounds, fingerprints)
    gone = labels.filter("label <> node").select(F.col("node").alias("_n"))
    kept = replacing(docs, _n=number).join(gone, "_n", "left_anti")
    columns = [f"`{name}`" for name in docs.columns]
    return one_per(kept, [F.col("_n")], [F.xxhash64(*columns)]).select(*columns)
