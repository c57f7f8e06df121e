import itertools
import math
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, chat, lattice, mixing, packing, pseudonyms, sharding

BPE = catalog.tokenizer_path("word_bpe_49k.json")
PIECES = catalog.tokenizer_path("piece_bpe_32k.model")


# Sharding


def turn_by_turn(shards, slots):
    """The table as its definition says: full preference lists, one claim a turn."""
    number = sharding._number
    lists = {}
    for name in shards:
        offset, step = number(f"offset:{name}") % slots, number(f"step:{name}") % (slots - 1) + 1
        lists[name] = [(offset + j * step) % slots for j in range(slots)]
        assert sorted(lists[name]) == list(range(slots))
    owner, turn = {}, itertools.cycle(sorted(shards))
    while len(owner) < slots:
        name = next(turn)
        owner[next(s for s in lists[name] if s not in owner)] = name
    return [owner[s] for s in range(slots)]


def test_lookup_table_against_its_definition():
    shards = [f"s{i}" for i in range(7)][::-1]
    table = [shards[i] for i in sharding.lookup_table(shards, 211)]
    assert table == turn_by_turn(shards, 211)
    sizes = Counter(table).values()
    assert max(sizes) - min(sizes) <= 1


def test_a_lost_shard_moves_little():
    before = [catalog.SHARDS[i] for i in sharding.lookup_table(catalog.SHARDS)]
    fewer = catalog.SHARDS[1:]
    after = [fewer[i] for i in sharding.lookup_table(fewer)]
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != catalog.SHARDS[0])
    assert moved < 0.1 * len(before)


def test_every_row_gets_its_slots_shard(spark):
    docs = corpus.odd_docs(spark).withColumn("shard", F.lit("clash"))
    placed = sharding.assign_shards(docs, "doc_id", catalog.SHARDS)
    table = sharding.lookup_table(catalog.SHARDS)
    rows = placed.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus.odd_rows())
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == sharding._number(key) % sharding.SLOTS
        assert r.shard == catalog.SHARDS[table[r.slot]]
    assert sharding.assign_shards(corpus.empty_docs(spark), "doc_id", ["a"]).count() == 0


@pytest.mark.parametrize(("shards", "slots"), [([], 7), (["a", "a"], 7), (["a"], 8)])
def test_bad_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)


# Packing


def check_packing(rows, pieces, tiers):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BPE)
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length, r.tier))
    for held in sequences.values():
        at = 0
        for offset, length, tier in sorted(held):
            assert offset == at
            at += length
        assert at == tier and tier & (tier - 1) == 0 and tier <= max(tiers)
    expected = Counter()
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        expected[(doc_id, tuple(ids))] += 1
    by_doc = defaultdict(list)
    for r in pieces:
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
    for (doc_id, ids), n in expected.items():
        own = by_doc[(doc_id, len(ids))]
        data = np.array(ids, "<u4")
        for r in own:
            assert r.ids_crc32 in {
                zlib.crc32(np.array(other, "<u4")[r.start : r.start + r.length].tobytes())
                for (d, other), _ in expected.items()
                if d == doc_id and len(other) == len(ids)
            }
        alike = sum(m for (d, other), m in expected.items() if d == doc_id and len(other) == len(ids))
        covered = Counter(i for r in own for i in range(r.start, r.start + r.length))
        assert covered == Counter({i: alike for i in range(len(data))})


@pytest.mark.parametrize(("tiers", "pool"), [(packing.TIERS, packing.POOL), ((64, 128), 500)])
def test_packing_of_odd_rows(spark, tiers, pool):
    rows = [(r[0], r[1]) for r in corpus.odd_rows()]
    rows += [(20, "<|endoftext|> and <|startoftext|>x < y"), (21, "é Å STRASSE ΣΑΣ İ"), (22, "don't we'll I'M")]
    rows += [(100 + i, corpus.prose(i, 5 + 37 * i % 300)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("clash"))
    pieces = packing.pack(docs.coalesce(1), BPE, tiers=tiers, pool=pool).collect()
    check_packing(rows, pieces, tiers)


def test_packing_of_nothing(spark):
    assert packing.pack(corpus.empty_docs(spark), BPE).count() == 0


def test_step_groups_hold_equal_tokens():
    rng = random.Random(1)
    windows = [(2048, [(0, 0, 1024)] * 2 if rng.random() < 0.5 else [(0, 0, 2048)]) for _ in range(256)]
    groups = packing.step_groups(windows, 1 << 16)
    cost = Counter()
    for g, (_, pieces) in zip(groups, windows, strict=True):
        cost[g] += sum(x * x for _, _, x in pieces)
    assert set(Counter(groups).values()) == {32}
    assert min(cost.values()) > 0.9 * max(cost.values())


# Chat

TURNS = "conv_id bigint, turn bigint, role string, text string"


def check_chat(rows, windows, budget, history):
    conversations = defaultdict(list)
    for conv_id, turn, role, text in rows:
        conversations[conv_id].append((-1 if turn is None else turn, role or "", text or ""))
    whole = {r.conv_id: r for r in chat.read_back(windows).collect()}
    assert set(whole) == set(conversations)
    for conv_id, turns in conversations.items():
        turns.sort()
        r = whole[conv_id]
        assert r.n_turns == len(turns)
        assert r.turns == "".join(f"{role}\n{text}\n" for _, role, text in turns)
        assert r.loss == "".join(text for _, role, text in turns if role == "assistant")


def test_chat_of_odd_turns(spark):
    rows = [
        (-1, 0, "user", "</s>[INST] ok [/INST]"),
        (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, 0, "system", "be <s> brief \\ <\\/s>"),
        (1, 1, "user", None),
        (1, 2, "assistant", ""),
        (1, 3, None, "no role"),
        (2, None, "user", "first"),
        (2, 5, "assistant", "b"),
        (2, 5, "assistant", "b"),
        (2, 5, "assistant", "a"),
        (None, 0, "user", "lost"),
        (None, 1, "assistant", "found </s><s>assistant\nnot a turn</s>"),
        (3, 0, "system", "only the system turn"),
        (4, 0, "odd role\n<s>", "\n\n漢字 😀"),
        (4, 1, "assistant", "😀 " * 40),
    ]
    turns = spark.createDataFrame(rows, TURNS).withColumn("window", F.lit("clash"))
    windows = chat.format_conversations(turns)
    check_chat(rows, windows, chat.WINDOW_TOKENS, chat.HISTORY_TOKENS)


def test_a_long_system_turn_is_said_once(spark):
    """5,000 words of system turn and 199 turns: the output stays in proportion, all windows but one in budget."""
    rows = [(1, 0, "system", corpus.prose(1, 5000))]
    rows += [(1, k, ("user", "assistant")[k % 2], corpus.prose(k, 60)) for k in range(1, 200)]
    rows += [(2, 0, "system", corpus.prose(2, 800)), (3, 0, "system", corpus.prose(3, 20)), (3, 1, "assistant", "yes")]
    turns = spark.createDataFrame(rows, TURNS)
    windows = chat.format_conversations(turns)
    check_chat(rows, windows, chat.WINDOW_TOKENS, chat.HISTORY_TOKENS)
    found = windows.select("conv_id", "formatted", chat.token_count(F.col("formatted")).alias("n")).collect()
    assert sum(len(r.formatted) for r in found) < 2 * sum(len(r[3]) for r in rows)
    # The template's own signs count as tokens here, which the budget does not hold against a turn.
    over = [r for r in found if r.n > 1.2 * chat.WINDOW_TOKENS]
    assert len(over) == 1 and over[0].formatted.startswith("<s>system")
    assert sum("<s>system" in r.formatted for r in found if r.conv_id == 1) == 1


def test_chat_query_digests_by_hand(spark, monkeypatch):
    """The registered query's columns, computed from the turns alone."""
    from tidemark.llm import catalog
    from tidemark.sources.tables import read_table

    sf, control = "/root/testdata/sf0.001", "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    told = defaultdict(list)
    for conv_id, turn, role, text in rows:
        told[conv_id].append((-1 if turn is None else turn, role or "", text or ""))
    for r in catalog.QUERIES["op3_chat_formatting"](spark, sf).collect():
        turns = sorted(told.pop(r.conv_id))
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars >= len(whole)
    assert not told


@pytest.mark.parametrize(("budget", "history"), [(64, 16), (200, 50), (64, 0)])
def test_chat_windows_keep_to_the_budget(spark, budget, history):
    rng = random.Random(budget)
    rows = []
    for conv in range(20):
        for turn in range(rng.choice([2, 9, 60])):
            role = "system" if turn == 0 and conv % 2 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn * rng.choice([1, 40]) if conv == 3 else turn, role, corpus.prose(rng.random(), rng.randint(1, 12))))
    turns = spark.createDataFrame(rows, TURNS)
    windows = chat.format_conversations(turns, budget=budget, history=history)
    check_chat(rows, windows, budget, history)
    counted = windows.select(
        "*", F.transform(F.filter(F.split("formatted", "</s>"), lambda x: x != ""), lambda x: chat.token_count(F.substring_index(x, "\n", -1))).alias("tokens")
    ).collect()
    for r in counted:
        own = [t for t, again in zip(r.tokens, r.repeated, strict=True) if not again]
        assert sum(r.tokens) <= budget or len(own) <= 2
        roles = [x.split("\n")[0] for x in r.formatted.split("<s>")[1:]]
        assert (roles[0] == "system") == (r.conv_id % 2 == 1)
    assert any(any(r.repeated) for r in counted)


def test_chat_of_nothing(spark):
    windows = chat.format_conversations(spark.createDataFrame([], TURNS))
    assert windows.count() == 0 and chat.read_back(windows).count() == 0


# Lattice


def test_lattice_against_all_segmentations():
    pieces = [bytes([b]) for b in range(256)] + [b" a", b" ab", b"ba", b"bab", b" aba"]
    rng = np.random.default_rng(1)
    scores = np.log(rng.dirichlet(np.ones(len(pieces))))
    found = lattice.Lattice(pieces)

    def ways(text):
        if not text:
            yield []
        for i, piece in enumerate(pieces):
            if text.startswith(piece):
                for rest in ways(text[len(piece) :]):
                    yield [i, *rest]

    words = [b"", b"a", b"ab", b"abab", b"babab", b"c", b"ababab", b"ab" * 60]
    ours = found.log_probabilities(words, scores)
    expected = found.expected(words[:-1], np.arange(1, 8), scores)
    brute = np.zeros(len(pieces))
    for n, (word, mine) in enumerate(zip(words[:-1], ours, strict=False), 1):
        paths = list(ways(b" " + word))
        weights = np.array([math.exp(sum(scores[i] for i in path)) for path in paths])
        assert math.isclose(mine, math.log(weights.sum()), rel_tol=1e-9)
        for path, weight in zip(paths, weights / weights.sum(), strict=True):
            for i in path:
                brute[i] += n * weight
    assert np.allclose(expected, brute)
    assert np.isfinite(ours[-1])


def test_words_of_a_batch_are_those_of_its_texts():
    """Split in whole batches, not text by text: the same words in the same order."""
    texts = [b"", b" \t\n\x0b\x0c\r ", b" Ab\x00c  d\xff\xfe ", b"a\xc2\xa0b \xe2\x80\x83c", "É éA".encode(), b"x", b"", b"ab X x"]
    array = pa.array(texts, pa.binary())
    halves = pa.chunked_array([array.slice(0, 4), array.slice(4, 0), array.slice(4)])
    for column, expected in ((array, texts), (halves, texts), (array.slice(2, 3), texts[2:5]), (array.slice(0, 2), texts[:2])):
        numbers, ends, words = lattice.split(column)
        words = words.to_pylist()
        found = [[words[i] for i in x] for x in np.split(numbers, ends)[:-1]]
        assert found == [text.lower().split() for text in expected]
        assert len(set(words)) == len(words) == len(set(numbers.tolist()))
    assert len(lattice.split(pa.chunked_array([], pa.binary()))[2]) == 0


def check_scores(rows, result):
    tokens = [(text or "").encode().lower().split() + [None] for _, text in rows]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows]
    counts = Counter(t for ts, out in zip(tokens, held, strict=True) if not out for t in ts)
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for (doc_id, _), ts, out in zip(rows, tokens, held, strict=True):
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        expected[(doc_id, out, len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 6))] += 1
    assert Counter((*r[:5], round(r[5], 6)) for r in result) == expected
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in result)


def test_scores_of_odd_rows(spark):
    docs = corpus.odd_docs(spark).withColumn("count", F.lit("clash"))
    result = corpus.collected(lattice.score_texts(docs, PIECES, block_bytes=5000))
    check_scores([(r[0], r[1]) for r in corpus.odd_rows()], result)


def test_scores_when_all_is_held_out_and_of_nothing(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = [(i, "some words here") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_scores(rows, corpus.collected(lattice.score_texts(docs, PIECES, language=None)))
    assert lattice.score_texts(corpus.empty_docs(spark), PIECES).count() == 0


def test_the_model_is_a_distribution_over_words():
    """Words and the end: their probabilities sum to one if those of the spellings do."""
    model = lattice.Model(np.array([4, 3, 1]), np.array([40, 30, 10]), np.array([5, 4, 3]), 0.6)
    counts = np.array([[5, 0], [20, 3], [0, 6], [2, 0], [0, 0]])
    # Spelling probabilities of these words, and of the end, which has no spelling.
    spelled = np.log10(np.array([0.3, 0.2, 0.1, 0.2, 0.2]))
    total = (10 ** model.log10(counts, spelled)).sum(axis=0) + model.texts[1:] / model.tokens[1:]
    assert np.allclose(total, 1)


def test_likely_texts_score_higher(spark):
    rows = [(i, corpus.prose(i % 5, 60), "en", "a", 1) for i in range(100)]
    rare = " ".join("".join(random.Random(i).choices("qzxjkvw", k=6)) for i in range(50))
    rows += [(1000, corpus.prose(1, 50), "en", "a", 1), (1001, rare, "en", "a", 1)]
    docs = spark.createDataFrame(rows, corpus.SCHEMA)
    score = {r.doc_id: r.score for r in lattice.score_texts(docs, PIECES).collect()}
    assert score[1000] > score[1001]


# Mixing


def labelled(spark, n=200):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        domain = rng.choices(["good", "poor", "toxic"], [6, 3, 1])[0]
        text = " ".join(rng.choice([domain + str(rng.randint(0, 20)), "shared"]) for _ in range(rng.randint(20, 80)))
        rows.append((i, text, "en", "a", 1))
        if i % 3 == 0:
            labels.append((i, domain))
    docs = spark.createDataFrame(rows, corpus.SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id bigint, domain string")


@pytest.mark.parametrize("most", [None, 1.0])
def test_expected_totals_match_the_targets(spark, most):
    docs, labels = labelled(spark)
    targets = {"good": 0.4, "poor": 0.5, "toxic": 0.1}
    budget = 1.0 if most is None else 0.4
    rows = mixing.mixing_rates(docs, labels, targets, budget=budget, most=most).collect()
    tokens = sum(r.n_tokens for r in rows)
    for domain, weight in targets.items():
        held = sum(r.n_tokens * r.rate * r[f"p_{domain}"] for r in rows) / tokens
        assert abs(held - budget * weight) < 0.01
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    assert most is None or max(r.copies for r in rows) <= 1


def test_posteriors_follow_the_labels(spark):
    docs, labels = labelled(spark)
    rows = mixing.mixing_rates(docs, labels, {"good": 1, "poor": 1, "toxic": 1}).collect()
    right = 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        best = max(("good", "poor", "toxic"), key=lambda d: r[f"p_{d}"])
        right += best in texts[r.doc_id]
    assert right > 0.95 * len(rows)


def test_mixed_documents_are_the_copies(spark):
    docs, labels = labelled(spark)
    targets = {"good": 0.2, "poor": 0.6, "toxic": 0.2}
    copies = {r.doc_id: r.copies for r in mixing.mixing_rates(docs, labels, targets).collect()}
    mixed = mixing.mix_documents(docs, labels, targets)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})


def test_mixing_of_odd_rows_and_nothing(spark):
    docs = corpus.odd_docs(spark).withColumn("rate", F.lit("clash"))
    none = spark.createDataFrame([(1, None), (None, "good")], "doc_id bigint, domain string")
    rows = mixing.mixing_rates(docs, none, {"good": 1, "poor": 1}).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in corpus.odd_rows())
    assert {(r.p_good, r.p_poor) for r in rows} == {(0.5, 0.5)}
    empty = mixing.mixing_rates(corpus.empty_docs(spark), none, {"good": 1})
    assert empty.count() == 0
    one = spark.createDataFrame([(1, "good"), (3, "good")], "doc_id bigint, domain string")
    assert mixing.mix_documents(docs, one, {"good": 1, "poor": 1}).columns == docs.columns


# Pseudonyms


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_the_permutation_is_one(size):
    f = pseudonyms.Feistel(b"k")
    images = [f.permute(x, size, "t") for x in range(size)]
    assert sorted(images) == list(range(size))
    assert [f.permute(x, size, "t", undo=True) for x in images] == list(range(size))


PRIVATE = {
    "card": ["4539 1488 0343 6467", "4539148803436467"],
    "ip": ["192.168.10.254"],
    "date": ["1984-02-29", "3/11/2001", "31.12.1999"],
    "phone": ["+1 (017) 555-7713", "(974) 555-3436", "+49 30 1234567"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "email": ["ann.b+c@mail.example.com", "éa.34@mail7.example.com"],
    "secret": ["0123456789abcdef0123456789abcdef01234567"],
}


@pytest.mark.parametrize(("kind", "value"), [(k, v) for k, vs in PRIVATE.items() for v in vs])
def test_values_are_replaced_within_their_format_and_come_back(kind, value):
    f = pseudonyms.Feistel(b"key")
    text = f"before {value}, after"
    masked, spans = pseudonyms.pseudonymise(text, f)
    (found, start, length) = spans[0]
    other = masked[start : start + length]
    assert len(spans) == 1 and found == kind and other != value
    assert pseudonyms.pseudonymise(masked, f, undo=True)[0] == text
    assert pseudonyms.pseudonymise(other, f)[1][0][0] == kind
    assert pseudonyms.pseudonymise(text, pseudonyms.Feistel(b"other"))[0] != masked


@pytest.mark.parametrize(
    "text",
    [
        "version 4.0. and 3.0.1", "4539148803436468", "999.1.1.1", "1984-02-30", "000-12-3456",
        "DE89 3704 0044 0532 0130 01", "12345", "1.2.3.4.5", "0000000000000000", "a@b", "",
    ],
)
def test_what_is_not_valid_stays(text):
    assert pseudonyms.pseudonymise(text, pseudonyms.Feistel(b"key")) == (text, [])


def test_masking_of_odd_rows(spark):
    docs = corpus.odd_docs(spark).withColumn("pii_spans", F.lit("clash"))
    masked = pseudonyms.mask_private(docs, b"key")
    assert Counter((r.doc_id, r.text) for r in masked.collect()) == Counter(
        (r[0], r[1]) for r in corpus.odd_rows()
    )
    assert pseudonyms.mask_private(corpus.empty_docs(spark), b"key").count() == 0


def test_equal_values_stay_linked_across_documents(spark):
    rows = [(i, f"call +1 (974) 555-3436 on 1984-05-0{i} or 4539148803436467") for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    masked = pseudonyms.mask_private(docs, b"key").collect()
    parts = [r.text.split() for r in masked]
    assert len({p[-1] for p in parts}) == 1 and len({" ".join(p[1:4]) for p in parts}) == 1
    assert len({p[5] for p in parts}) == 8
    back = pseudonyms.mask_private(pseudonyms.mask_private(docs, b"key"), b"key", undo=True)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
