"""Packing, hard negatives and spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskmart.llm import negatives, packing, spelling
from riskmart.llm.queries import QUERIES
from riskmart.session import cut_lineage

PATH = public_tokenizers.path("byte_bpe_50k.json")


# --------------------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_by_library(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def check_packed(rows, docs, library, longest):
    """Every id in one piece, sequences of one piece at offset 0, lengths as the binary form of the number says, ids as the library's."""
    by_doc = defaultdict(list)
    for r in rows:
        assert r["offset"] == 0 and zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"]].append(r)
    wanted = defaultdict(list)
    for doc_id, text in docs:
        wanted[doc_id].append(ids_by_library(library, text))
    assert set(by_doc) == set(wanted)
    for doc_id, texts in wanted.items():
        found = Counter((r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])) for r in by_doc[doc_id])
        expected = Counter()
        for ids in texts:
            start, bits = 0, bin(len(ids) % longest)[2:]
            sizes = [longest] * (len(ids) // longest) + [2 ** (len(bits) - 1 - i) for i, b in enumerate(bits) if b == "1"]
            for n in sizes:
                expected[start, n, len(ids), np.array(ids[start : start + n], dtype="<u4").tobytes()] += 1
                start += n
        assert found == expected
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    in_order = sorted(rows, key=lambda r: r["sequence_id"])
    assert all(a["length"] >= b["length"] for a, b in zip(in_order, in_order[1:]))


def test_packing(messy, pairs, library):
    check_packed(packing.pack(messy, packing.PackConfig(PATH)).collect(), pairs, library, 2048)


def test_packing_in_short_parts(spark, library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(["word", " ", "  ", "\n", "\t", "é", "x1", "'s", "日本", " ", "<|endoftext|>"], k=rng.randint(0, 400))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check_packed(packing.pack(docs, packing.PackConfig(PATH, length=64, chunk=50)).collect(), list(enumerate(texts)), library, 64)


def test_packing_of_nothing(empty):
    assert packing.pack(empty, packing.PackConfig(PATH)).count() == 0


def test_length_must_be_a_power_of_two():
    with pytest.raises(ValueError):
        packing.PackConfig(PATH, length=1000)


def test_other_vocabularies_use_the_library(library):
    other = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, and 123 more"
    assert packing.encoder(other)(text).tolist() == Tokenizer.from_file(other).encode(text, add_special_tokens=False).ids


def test_written_buckets(spark, messy, tmp_path):
    packed = packing.pack(messy, packing.PackConfig(PATH, length=32))
    packing.write_buckets(packed, f"{tmp_path}/packed")
    back = spark.read.parquet(f"{tmp_path}/packed")
    assert back.filter("length = 32").count() == packed.filter("length = 32").count() > 0
    assert back.agg(F.sum("length")).first()[0] == packed.agg(F.sum("length")).first()[0]


def test_packing_query(spark, sf):
    rows = QUERIES["op11_packing"](spark, sf)
    assert rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    per_doc = rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert per_doc.filter("n <> t").isEmpty()


# --------------------------------------------------------------------------- hard negatives


def mined_by_hand(rows, is_anchor, config):
    rows = list(dict.fromkeys((i, label, tuple(v)) for i, label, v in rows))
    out = Counter()
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a in rows:
        if not is_anchor(a[0]):
            continue
        scored = [(sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1] == a[1]) for b in rows if b is not a]
        for p in sorted((s for s in scored if s[2]), key=order)[: config.positives]:
            inside = [s for s in scored if not s[2] and config.low_pct * p[0] <= 100 * s[0] <= config.high_pct * p[0]]
            for rank, s in enumerate(sorted(inside, key=order)[: config.negatives], 1):
                out[a[0], p[1], rank, s[1], p[0], s[0]] += 1
    return out


def mined(spark, rows, config=negatives.MineConfig(), every=5):
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(4)
    return Counter(tuple(r) for r in negatives.mine(df, F.col("id") % every == 0, config).collect())


@pytest.mark.parametrize("seed", range(3))
def test_hard_negatives(spark, seed):
    """Small integers make many ties and zero and negative scores."""
    rng = random.Random(seed)
    rows = [(i, rng.randint(0, 2), [rng.randint(-1, 3) for _ in range(4)]) for i in range(200)]
    rows += [(1000 + i, 7, [1, 1, 1, 1]) for i in range(40)]
    config = negatives.MineConfig(block=7, part=40, scores=300)
    by_hand = mined_by_hand(rows, lambda i: i % 5 == 0, config)
    assert sum(by_hand.values()) > 300
    assert mined(spark, rows, config) == by_hand


def test_hard_negatives_on_messy_rows(spark):
    rng = random.Random(9)
    rows = [(i, i % 3, [rng.randint(-50, 99) for _ in range(rng.choice([3, 3, 5, 0]))]) for i in range(60)]
    rows += rows[:10] + [(None, 1, [5, 5, 5]), (None, 1, [5, 5, 5]), (10**18, 0, [1, 2])]
    assert mined(spark, rows) == mined_by_hand(rows, lambda i: i is not None and i % 5 == 0, negatives.MineConfig())


def test_hard_negatives_of_huge_components(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.randint(0, 2**30) for _ in range(3)]) for i in range(40)]
    assert mined(spark, rows) == mined_by_hand(rows, lambda i: i % 5 == 0, negatives.MineConfig())


def test_hard_negatives_of_nothing(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(1, 1, [1]), (2, 2, [1])])


def test_quantised_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 1, [nan, 1.0]), (5, 1, [inf, 1.0]), (6, 1, [-inf, 1.0]), (7, 1, [None, 1.0]), (None, 2, []), (8, 2, [3e38, -3e38])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, label int, embedding array<float>, hash int, vector string")
    found = {r["id"]: (r["label"], r["vector"]) for r in negatives.quantised(df).collect()}
    assert set(found) == {1, None, 8} and found[1] == (1, [128, -1]) and found[None] == (2, [])
    assert found[8][1] == [2**63 - 1, -(2**63)]


# --------------------------------------------------------------------------- spelling variants


def words_by_hand(docs, config):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if config.drop_every and h % config.drop_every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= config.min_length and n >= config.min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def variants_by_hand(docs, config):
    n = words_by_hand(docs, config)
    links = defaultdict(list)
    for a, b in combinations(sorted(n), 2):
        if near(a, b):
            links[a].append(b)
            links[b].append(a)
    form = {}
    for w in n:
        best = min(links[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= config.ratio * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return rows


def edited(rng, word):
    k, c = rng.randrange(len(word)), rng.choice("abcàé")
    return rng.choice([word[:k] + c + word[k + 1 :], word[:k] + word[k + 1 :], word[:k] + c + word[k:]])


def corpus(seed, n_words=60):
    rng = random.Random(seed)
    text = []
    for _ in range(n_words):
        word, n = "".join(rng.choices("abcdeABàé", k=rng.randint(5, 9))), 1500
        while n >= 2:  # chains of ever rarer variants
            text += [word] * rng.randint(n // 2, n)
            word, n = edited(rng, word), n // rng.randint(3, 8)
    rng.shuffle(text)
    return [(i if i % 11 else None, " ".join(text[at : at + 500]) + rng.choice(["", ". x1y ", "×÷ﬁ"])) for i, at in enumerate(range(0, len(text), 500))]


@pytest.mark.parametrize(("seed", "config"), [(0, spelling.SpellingConfig()), (1, spelling.SpellingConfig(parts=4, held_words=50)), (2, spelling.SpellingConfig(drop_every=7, chunk=100))])
def test_spelling_variants(spark, seed, config):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    by_hand = variants_by_hand(docs, config)
    assert sum(r[1] is not None for r in by_hand) > 30 and any(r[2] not in (r[0], r[1]) for r in by_hand)
    assert {tuple(r) for r in spelling.variants(df, config).collect()} == by_hand


def test_vocabulary_is_not_sent_to_every_task(spark):
    df = spark.createDataFrame(corpus(0), "doc_id long, text string")
    words = cut_lineage(spelling.vocabulary(df), "test-words")
    forms = cut_lineage(words.limit(1).select("word", F.lit("form").alias("form")), "test-forms")
    for found in (spelling.near_words(words), spelling.variants(df), spelling.follow(forms)):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_spelling_on_messy_rows(messy, pairs, empty):
    config = spelling.SpellingConfig(min_count=2)
    assert {tuple(r) for r in spelling.variants(messy, config).collect()} == variants_by_hand(pairs, config)
    assert spelling.variants(empty).count() == 0


def test_signatures_meet_for_every_edit():
    """Every pair within one edit shares a signature of matching roles."""
    rng = random.Random(4)
    for _ in range(300):
        word = "".join(rng.choices("abcdefé", k=rng.randint(6, 12)))
        other = edited(rng, word)
        if other == word:
            continue
        rows, roles, found = spelling.signatures([word, other], 6)
        sides = [{(int(r), int(s)) for w, r, s in zip(rows, roles, found) if w == k} for k in (0, 1)]
        swap = {spelling.SAME: spelling.SAME, spelling.LONGER: spelling.SHORTER, spelling.SHORTER: spelling.LONGER}
        assert sides[0] & {(swap[r], s) for r, s in sides[1]}
