"""Operators that give one row per row: quality rules, token counts, classifier, secrets."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from riskmart.llm import boosting, classifier, quality_rules, secrets, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(24)] + [(None, 1, 0), (3, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


def counts_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_counts(messy, labels, pairs):
    found = rows_of(quality_rules.quality_rules(messy, labels), "doc_id", *quality_rules.COUNTS, "base_failed")
    hand = []
    for i, t in pairs:
        c = counts_by_hand(t)
        hand.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert found == sorted(hand, key=repr)


@pytest.mark.parametrize("seed", range(20))
def test_repeat_words(seed):
    rng = random.Random(seed)
    text = " ".join(rng.choices(["a", "b", "#c"], k=rng.randint(0, 60)))
    assert quality_rules.measure(text.encode())[0] == list(counts_by_hand(text))


def test_quality_on_empty_tables(spark, empty, messy, labels):
    assert quality_rules.quality_rules(empty, labels).count() == 0
    assert quality_rules.quality_rules(messy, labels.limit(0)).count() == messy.count()


def test_keep_good_keeps_columns(messy, labels):
    kept = quality_rules.keep_good(messy, labels)
    assert kept.columns == messy.columns
    judged = quality_rules.quality_rules(messy, labels).filter("kept")
    assert rows_of(kept, "doc_id") == rows_of(judged, "doc_id")


def test_trees_are_monotonic_and_separate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = (x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=800) > 0).astype(float)
    model = boosting.fit(x, y, [1, -1, 0])
    assert ((model.probability(x) > 0.5) == (y > 0)).mean() > 0.95
    grid = np.repeat(x[:50], 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(-3, 3, 40), 50)
    assert (np.diff(model.margin(grid).reshape(50, 40), axis=1) >= -1e-12).all()
    grid[:, 1], grid[:, 0] = grid[:, 0].copy(), 0.3
    assert (np.diff(model.margin(grid).reshape(50, 40), axis=1) <= 1e-12).all()


def test_trees_without_a_second_class():
    assert boosting.fit(np.zeros((0, 2)), np.zeros(0)).probability(np.ones((3, 2))).tolist() == [0.5] * 3
    assert (boosting.fit(np.ones((4, 2)), np.ones(4)).probability(np.ones((1, 2))) > 0.5).all()


def test_quality_on_labelled_documents(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.quality_rules(docs, labels).join(labels, "doc_id")
    wrong = judged.filter("kept <> (quality = 1) and not base_failed").count()
    assert wrong <= 0.05 * judged.count()


def test_token_counts(messy, empty, pairs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    config = tokens.TokenConfig(path, chunk=200, overlap=16)
    library = tokens.load(path)
    hand = []
    for i, t in pairs:
        n = len(library.encode(t or "", add_special_tokens=False))
        hand.append((i, len((t or "").encode()), n, n > 512))
    assert rows_of(tokens.token_counts(messy, config), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(hand, key=repr)
    assert tokens.token_counts(empty, config).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_short_texts_are_counted_without_offsets(seed, monkeypatch):
    rng = random.Random(seed)
    config = tokens.TokenConfig(public_tokenizers.path("byte_bpe_50k.json"))
    library = tokens.load(config.path)
    monkeypatch.setattr(tokens, "load", None)  # what gives offsets is for long texts
    alphabet = rng.choice(["ab \n", "abcdé ß日 '\ts1 \u00a0\u2028", "x", "   \n\r", "   a\x85", "".join(map(chr, rng.choices([*range(0xD800), *range(0xE000, 0x11000)], k=300)))])
    bits = [*alphabet, *rng.choice([[], ["<|endoftext|>"]]), "'s ", " the", "\n\n", "   ", "'LL", "12345"]
    for n in (0, 1, 30, 3000):
        text = "".join(rng.choices(bits, k=n))
        assert tokens.count_text(text, config) == len(library.encode(text, add_special_tokens=False))


@pytest.mark.parametrize("seed", range(40))
def test_overlaps_resynchronise(seed):
    rng = random.Random(seed)
    library = tokens.load(public_tokenizers.path("byte_bpe_50k.json"))
    alphabet = rng.choice(["ab \n", "abcdé ß日 '\ts1 ", "x", "   \n", "   a\x85"])
    bits = [*alphabet, "<|endoftext|>", "'s ", " the", "\n\n", "   "]
    text = "".join(rng.choices(bits, k=rng.randint(0, 500)))
    for chunk, overlap in ((16, 2), (50, 8), (200, 16)):
        assert tokens.count_long(library, text, chunk, overlap) == len(library.encode(text, add_special_tokens=False))


def test_classifier_rows(spark, messy, empty, labels, pairs):
    scored = classifier.quality_classifier(messy, labels)
    assert rows_of(scored, "doc_id") == sorted([(i,) for i, _ in pairs], key=repr)
    assert scored.filter("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    assert classifier.quality_classifier(empty, labels).count() == 0
    none = classifier.quality_classifier(messy, labels.limit(0))
    assert none.select("predicted").distinct().count() == 1


def test_classifier_held_out(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = classifier.quality_classifier(docs, labels).filter("held_out").join(labels, "doc_id")
    assert held.filter("predicted <> quality").count() <= 0.2 * held.count()


def test_classifier_learns_from_text_alone():
    good, bad = b"calm river stone " * 5, b"##x %%y &&z " * 5
    config = classifier.ClassifierConfig(buckets=512, epochs=30)
    rows = [(*classifier.document_buckets(d, config.grams, config.buckets), k) for d, k in [(good, 1), (bad, 0)] * 10]
    score = classifier.scorer(classifier.learn(rows, config))
    assert score(b"river calm stone") > 0.8 > 0.2 > score(b"%%y ##x")


def test_scores_equal_a_plain_forward_pass():
    """The scorer's sums per word against shares of all buckets times their weights, on texts it has not learned from."""
    rng, config = random.Random(9), classifier.ClassifierConfig(buckets=1024, epochs=3)
    words = ["".join(rng.choices("abcé#", k=rng.randint(1, 7))) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 80))).encode() for _ in range(40)]
    rows = [(*classifier.document_buckets(t, config.grams, config.buckets), k % 2) for k, t in enumerate(texts[:20])]
    model = classifier.learn(rows, config)
    score = classifier.scorer(model)
    for t in texts:
        ids, shares = classifier.document_buckets(t, config.grams, config.buckets)
        assert score(t) == pytest.approx(1 / (1 + math.exp(-(model.bias + float(shares @ model.weight[ids])))))


def spans_by_hand(text):
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    base = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    config, dense = secrets.SecretConfig(), []
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        words = [w.span() for w in re.finditer(config.allow_words, m[0])]
        for at, until in zip([0, *[w[1] for w in words]], [*[w[0] for w in words], len(m[0])]):
            run = m[0][at:until]
            if len(run) < 20 or any(re.search(p, run) for p in config.allow):
                continue
            bits = config.hex_bits if re.fullmatch("[0-9a-fA-F]+", run) else config.alpha_bits if re.fullmatch("[A-Za-z]+", run) else config.mixed_bits
            own: list[list[int]] = []
            for i in range(len(run) - 19):
                if -sum(n / 20 * math.log2(n / 20) for n in Counter(run[i : i + 20]).values()) >= bits:
                    if own and own[-1][1] >= i:
                        own[-1][1] = i + 20
                    else:
                        own.append([i, i + 20])
            dense += [(m.start() + at + a, 3, m.start() + at + b) for a, b in own]
    dense = [d for d in dense if not any(b[0] <= d[0] and d[2] <= b[2] for b in base)]

    def joined(spans):
        return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))

    return *[sum(b[1] == k for b in base) for k in range(3)], hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + dense)


def test_secrets(spark, messy, empty, pairs):
    rng = random.Random(5)
    bits = ["é", "ñ word ", "\n", "token: ", "Password='", "api_key=", "AKIA", " ", "secret: x ", "EXAMPLE", "Sample_", "xxxxx"]
    rows = [(2, "é token=abcdefgh12 AKIAABCDEFGHIJKL0 " + "a" * 40), (3, "token: secret: abcdefgh1"), (4, "".join(rng.choices(secrets.ALPHABET, k=5000)))]
    for i in range(10, 200):
        parts = []
        for _ in range(rng.randint(0, 9)):
            parts.append(
                rng.choice(
                    [
                        *bits, "".join(rng.choices(secrets.ALPHABET, k=rng.randint(1, 70))), "".join(rng.choices("ABCDEFabc", k=30)),
                        "".join(rng.choices("0123456789abcdef", k=rng.randint(10, 60))),
                    ]
                )
            )
        rows.append((i, "".join(parts)))
    rows += pairs
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(secrets.secret_scan(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    hand = sorted([(i, *spans_by_hand(t)) for i, t in rows], key=repr)
    assert found == hand
    assert any("entropy" in h[-1] for h in hand)
    assert secrets.secret_scan(empty).count() == 0


def test_listed_words_hide_only_themselves(spark):
    """A secret beside a listed word is found, up to that word; windows over the word do not count."""
    secret = "".join(random.Random(3).sample(secrets.ALPHABET, 40))
    texts = [f"SAMPLE_DB={secret}", f"{secret}example", f"{secret[:15]}example{secret[15:30]}", "example" * 9, f"/home/sample/{'abc/' * 9}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in secrets.secret_scan(docs).collect()}
    assert found == {i: spans_by_hand(t)[-1] for i, t in enumerate(texts)}
    assert found[0].startswith("entropy:") and found[1] == "entropy:0:40" and found[2] == found[3] == found[4] == ""


def test_secrets_of_long_texts(spark):
    """Many hits and very long runs: the work is linear, and spans do not depend on where stretches and blocks end."""
    rng = random.Random(8)
    hits = [f"{rng.getrandbits(128):032x}" for _ in range(100_000)]
    mixed = "".join(rng.choices(["".join(rng.sample(secrets.ALPHABET, 24)), "aaaa" * 7, "ab" * 11], k=12_000))
    rows = [(1, " ".join(hits)), (2, mixed), (3, "".join(rng.choices(secrets.ALPHABET, k=1_000_000)))]
    start = time.monotonic()
    found = {r["doc_id"]: r for r in secrets.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.monotonic() - start < 90
    assert found[1]["n_hex"] == 100_000 and found[1]["spans"].endswith(f"hex:{33 * 99_999}:{33 * 100_000 - 1}")
    for i in (2, 3):
        assert tuple(found[i])[1:6] == spans_by_hand(rows[i - 1][1])


def test_secrets_are_native(messy):
    plan = secrets.secret_scan(messy)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
