"""Operators that compare rows: components, line dedup, SimHash, decontamination, passages."""

from __future__ import annotations

import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from riskmart.llm import chaining, components, decontaminate, line_dedup, simhash, substring_dedup
from riskmart.llm.groups import whole_groups


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def edits(a, b):
    """Edit distance of two strings."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.root(x), self.root(y)))
        self.up[y] = x


@pytest.mark.parametrize("shape", ["path", "star", "random", "loops", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(7, i) for i in range(300)] + [(1000, 1001)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4)],
        "none": [],
    }[shape]
    found = {r["id"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    hand = Union()
    for a, b in edges:
        if a is not None and a != b:
            hand.join(a, b)
    assert found == {x: hand.root(x) for x in list(hand.up)}


def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_by_hand(rows):
    marks, hand = [(i, fingerprint_by_hand(t)) for i, t in rows], Union()
    for k, (_, f) in enumerate(marks):
        for j, (_, g) in enumerate(marks[:k]):
            if (f ^ g).bit_count() <= 3:
                hand.join(j, k)
    least = {}
    for k, (i, _) in enumerate(marks):
        r = hand.root(k)
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (i is not None or least.get(r) is not None) else None
    return sorted(((i, f"{f:016x}", least[hand.root(k)]) for k, (i, f) in enumerate(marks)), key=repr)


def test_simhash(messy, empty, pairs):
    found = simhash.near_duplicates(messy).select("doc_id", simhash.hex_digits("fp").alias("f"), "component_id")
    assert sorted(map(tuple, found.collect()), key=repr) == simhash_by_hand(pairs)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [4, 512])
def test_fingerprint_links_in_crowded_cells(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    marks = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
            marks.add(x)
    signed = [int(np.uint64(x).view(np.int64)) for x in sorted(marks)]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), simhash.SimHashConfig(block=block))
    found, hand = Union(), Union()
    for r in links.collect():
        assert ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 3
        found.join(r["a"], r["b"])
    for k, x in enumerate(signed):
        for y in signed[:k]:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= 3:
                hand.join(x, y)
    assert all(found.root(x) == hand.root(x) for x in signed)


def test_keep_one(messy, pairs):
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    by_hand = {i for i, _, c in simhash_by_hand(pairs) if i is not None and i == c}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(by_hand)
    assert ids.count(None) == sum(i is None for i, _ in pairs)


def test_keep_one_of_unlike_texts_under_one_id(spark):
    rng = random.Random(14)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(4000)]
    one, two, three, four = (" ".join(rng.choices(words, k=300)) for _ in range(4))
    rows = [(1, one), (5, one), (5, two), (5, three), (5, three), (9, two), (9, four), (None, one)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, one), (5, two), (5, three), (9, four), (None, one)], key=repr)


def lines_by_hand(rows, config):
    """{doc_id: dropped positions} by comparing all pairs of lines."""
    docs = {}
    for i, t in rows:
        if i is not None:
            docs.setdefault(i, (t or "").split("\n"))
    texts = sorted({line for lines in docs.values() for line in lines if line.strip(" \t\x0b\f\r\n")})
    k, hand = config.shingle, Union()
    sets = {t: {t[i : i + k] for i in range(max(1, len(t) - k + 1))} for t in texts}
    for n, a in enumerate(texts):
        for b in texts[:n]:
            common = len(sets[a] & sets[b])
            if common and common >= config.similarity * (len(sets[a]) + len(sets[b]) - common):
                hand.join(a, b)
    seen, dropped = set(), {}
    for i in sorted(docs):
        dropped[i] = []
        for pos, line in enumerate(docs[i]):
            if line in sets:
                if hand.root(line) in seen:
                    dropped[i].append(pos)
                seen.add(hand.root(line))
    return dropped


@pytest.fixture(scope="module")
def near_lines(spark):
    """Documents whose lines are edited copies of few, so that buckets hold lines that are near and lines that are not."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(300)]
    base = [rng.choices(words, k=40) for _ in range(4)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(3):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 2, 6, 12])):
                line[rng.randrange(40)] = rng.choice(words)
            lines.append(" ".join(line))
        rows.append((i, "\n".join([*lines, "", "short"])))
    return rows


@pytest.mark.parametrize("settings", [{}, {"block": 2}, {"broadcast_ids": 0}])
def test_line_dedup(spark, near_lines, settings):
    config = line_dedup.LineConfig(**settings)
    docs = spark.createDataFrame(near_lines, "doc_id long, text string")
    found = {r["doc_id"]: r["dropped"] for r in line_dedup.line_decisions(docs, config).collect()}
    assert found == lines_by_hand(near_lines, config)


def test_line_dedup_on_messy_rows(messy, empty, pairs):
    config = line_dedup.LineConfig()
    found = {r["doc_id"]: r["dropped"] for r in line_dedup.line_decisions(messy).collect()}
    hand = lines_by_hand(pairs, config)
    assert found == hand
    left = line_dedup.dedup_lines(messy)
    assert left.columns == messy.columns
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in left.collect()), key=repr)
    want = []
    for i, t in pairs:
        gone = hand.get(i, [])
        text = t if not gone else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        if not gone or text.strip(" \t\x0b\f\r\n"):
            want.append((i, text, None if text is None else len(text)))
    assert got == sorted(want, key=repr)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_of_a_very_long_text(spark):
    """200 000 lines, each twice, and a repeated id whose second text is shorter: the work does not grow with the square."""
    rng = random.Random(4)
    once = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=14)) for _ in range(100_000)]
    docs = spark.createDataFrame([(1, "\n".join([*once, *once])), (2, f"own line of two\n{once[7]}"), (2, "own line of two")], "doc_id long, text string")
    start = time.monotonic()
    found = {r["doc_id"]: (r["n_lines"], r["dropped"]) for r in line_dedup.line_decisions(docs).collect()}
    assert found == {1: (200_000, list(range(100_000, 200_000))), 2: (2, [1])}
    left = sorted(r["text"] for r in line_dedup.dedup_lines(docs).collect())
    assert left == sorted(["\n".join(once), "own line of two", "own line of two"])
    assert time.monotonic() - start < 150


def test_small_edits_of_short_lines(spark):
    """The least length from which each edit of a line is linked to it; no other line is."""
    rng = random.Random(12)

    def letters(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))

    edits = {" cut ": 80, " ct ": 80, " dog ": 100, " ": 90, None: 1000}
    rows, linked = [], set()
    for n in (50, 60, 70, 80, 90, 100):
        for edit, least in [*edits.items()] * 3:
            head, tail = letters(n // 2 - 4), letters(n - n // 2 - 1)
            rows += [(len(rows), f"{head} cat {tail}"), (len(rows) + 1, letters(n) if edit is None else head + edit + tail)]
            if n >= least:
                linked.add(len(rows) - 1)
    found = line_dedup.line_decisions(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in found.collect() if r["dropped"]} == linked


@pytest.mark.parametrize("union", [10, 20])
def test_recall_on_short_lines(spark, union):
    """Of pairs at similarity 0.8, as many share a bucket when a line has few shingles as the number of bands promises."""
    rng, config, n = random.Random(5), line_dedup.LineConfig(), 3000
    rows = []
    for _ in range(n):
        text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=union + config.shingle - 1))
        cut = union // 5 - union // 10
        rows += [(len(rows), text[: len(text) - cut]), (len(rows) + 1, text[union // 10 :])]
    found = line_dedup.line_decisions(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(len(r["dropped"]) for r in found.collect()) >= 0.989 * n


@pytest.mark.parametrize("stride", [1, 4, 7])
def test_bucket_keys_do_not_depend_on_the_stride(spark, messy, stride):
    """A row takes several shingles; lines of every length have the keys that one shingle a row gives."""
    rng = random.Random(13)
    texts = ["".join(rng.choices("abcdeé日😀", k=n)) for n in range(1, 40)]
    docs = messy.select("doc_id", "text").union(spark.createDataFrame([(200 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    every = line_dedup.lines(docs)
    one, several = (line_dedup.signatures(every, line_dedup.LineConfig(stride=n)) for n in (1, stride))
    assert several.columns == ["h1", "h2", "keeper", "n", *[f"k{b}" for b in range(7)]]
    assert sorted(map(tuple, several.collect()), key=repr) == sorted(map(tuple, one.collect()), key=repr)


def test_minhash_values_of_one_hash_are_independent(spark):
    """Of pairs of lines at similarity 0.5, as many share all values of a band as three independent values would."""
    rng, n = random.Random(14), 4000
    config = line_dedup.LineConfig(bands=4)
    size = 60
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size + config.shingle - 1)) for _ in range(n)]
    cut = size // 4  # two of 45 shingles out of 60, 30 in common
    rows = [(2 * i + s, t[s * cut : len(t) - (1 - s) * cut]) for i, t in enumerate(texts) for s in (0, 1)]
    signed = line_dedup.signatures(line_dedup.lines(spark.createDataFrame(rows, "doc_id long, text string")), config)
    keys = {r["keeper"]: [r[f"k{b}"] for b in range(4)] for r in signed.collect()}
    shared = [[keys[2 * i][b] == keys[2 * i + 1][b] for b in range(4)] for i in range(n)]
    assert 0.115 <= sum(map(sum, shared)) / (4 * n) <= 0.135
    assert abs(sum(map(any, shared)) / n - (1 - 0.875**4)) <= 0.025


def test_line_dedup_is_native(messy):
    every = line_dedup.lines(messy)
    plan = line_dedup.signatures(every, line_dedup.LineConfig())._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("block", [128, 10])
def test_a_line_of_many_pairs_is_cut_into_shingles_before_it_meets_them(spark, near_lines, block):
    config = line_dedup.LineConfig(block=block)
    lines = sorted({line for _, text in near_lines for line in text.split("\n") if line})
    texts = spark.createDataFrame(list(enumerate(lines)), "h1 long, line string")
    pairs = [(a, b) for b in range(0, len(lines), 5) for a in range(len(lines)) if a != b]
    found = line_dedup._verified(spark.createDataFrame(pairs, "a long, b long"), texts, config)
    sets = [{t[i : i + 8] for i in range(max(1, len(t) - 7))} for t in lines]
    near = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= config.similarity * len(sets[a] | sets[b])]
    assert 0 < len(near) < len(pairs) and rows_of(found, "a", "b") == sorted(near, key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    compared = [line for line in plan if "array_intersect" in line or "array_except" in line]
    assert len(compared) == 1 and "transform(" not in compared[0]


def nearest_by_hand(pattern, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before), before.index(min(before))


@pytest.mark.parametrize("seed", range(30))
def test_bit_parallel_distance(seed):
    rng = random.Random(seed)
    pattern, text = "".join(rng.choices("abc", k=rng.randint(1, 90))), "".join(rng.choices("abc", k=rng.randint(0, 120)))
    assert decontaminate.best_match(decontaminate.character_masks(pattern), len(pattern), text) == nearest_by_hand(pattern, text)


@pytest.mark.parametrize("block_chars", [40, 1_000_000])
def test_leaks(spark, messy, empty, block_chars):
    rng = random.Random(3)
    items = [(i, "".join(rng.choices("abcd ", k=rng.randint(20, 60)))) for i in range(12)] + [(50, None), (51, "  "), (None, "zzzz yyyy xxxx wwww")]
    rows = [(500, "zzzz  YYYY\nxxxx wwww"), (None, items[0][1]), (501, None), (502, "")]
    for i in range(60):
        text = list(items[rng.randrange(12)][1])
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randint(0, 1)] = rng.choices("abcd", k=rng.randint(0, 1))
        rows.append((i, "".join(rng.choices("abcd ", k=30)) + "".join(text).upper() + "".join(rng.choices("abcd\n", k=30))))
    config = decontaminate.DecontaminationConfig(block_chars=block_chars)
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.leaks(docs, benchmark, config).collect()), key=repr)
    hand = []
    for i, t in rows:
        for k, x in items:
            item = decontaminate.normal_form(x)
            if item:
                distance = nearest_by_hand(item, decontaminate.normal_form(t))[0]
                if distance <= math.floor(config.error_rate * len(item)):
                    hand.append((i, k, distance))
    assert found == sorted(hand, key=repr) and found
    texts, wanted = dict(rows), {k: decontaminate.normal_form(x) for k, x in items}
    for r in decontaminate.leaks(docs, benchmark, config).collect():
        place = decontaminate.normal_form(texts[r["doc_id"]])[r["start"] : r["end"]]
        assert edits(wanted[r["item_id"]], place) == r["distance"]
    kept = decontaminate.drop_contaminated(docs, benchmark, config)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {i for i, _, _ in hand}
    assert decontaminate.leaks(empty, benchmark).count() == 0
    assert decontaminate.drop_contaminated(messy, benchmark.limit(0)).count() == messy.count()


def test_leaks_in_messy_rows(spark, messy, pairs):
    """Nulls, repeated rows and ids, clashing names and long texts against a benchmark that meets some of them."""
    base = dict(pairs)
    items = [(1, base[0][:80]), (2, base[7][5:95]), (2, None), (3, base[3][:60]), (3, base[3][:60]), (None, base[5][:70]), (4, "")]
    benchmark = spark.createDataFrame([(*i, 0, "x") for i in items], "item_id long, text string, doc_id int, distance string")
    found = rows_of(decontaminate.leaks(messy, benchmark), "doc_id", "item_id", "distance")
    hand, wanted = [], {(k, decontaminate.normal_form(x)) for k, x in items if x}
    for i, t in pairs:
        text = decontaminate.normal_form(t)
        hand += [(i, k, 0) for k, item in wanted if item in text]
    # base texts are random words: whoever is near an item here holds it, but for the one changed word of document 102
    assert sorted((r for r in found if r[2] == 0), key=repr) == sorted(hand, key=repr)
    assert all(r[0] == 102 for r in found if r[2] > 0)
    kept = decontaminate.drop_contaminated(messy, benchmark)
    gone = [r[0] for r in found]
    assert kept.columns == messy.columns and rows_of(kept, "doc_id") == sorted([(i,) for i, _ in pairs if i is not None and i not in gone] + [
        (None,) for i, t in pairs if i is None and not any(x in decontaminate.normal_form(t) for _, x in wanted)
    ], key=repr)


def test_groups_across_batches():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 30, 500))
    rows = np.stack([keys, np.arange(500)], axis=1)
    for size in (1, 7, 100, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in rows[i : i + size].T], ["k", "v"]) for i in range(0, 500, size)]
        parts = list(whole_groups(iter(batches), 1))
        assert (np.concatenate(parts) == rows).all()
        ends = [set(p[:, 0]) for p in parts]
        assert all(not (a & b) for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("seed", range(20))
def test_best_chain(seed):
    rng = np.random.default_rng(seed)
    x, y, n = rng.integers(0, 60, 14), rng.integers(0, 60, 14), rng.integers(1, 6, 14)
    runs = np.stack([x, x + n, y, y + n], axis=1)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    score = []
    for i, (x0, x1, y0, y1) in enumerate(runs):
        before = [score[j] - 0.5 * (x0 - runs[j][1] + y0 - runs[j][3]) for j in range(i) if runs[j][1] <= x0 and runs[j][3] <= y0]
        score.append(float(x1 - x0) + max([0.0, *before]))
    chain = chaining.chains(runs, 0.5)[0]
    got = (chain[:, 1] - chain[:, 0]).sum() - 0.5 * sum((b[0] - a[1]) + (b[2] - a[3]) for a, b in zip(chain, chain[1:]))
    assert got == pytest.approx(max(score))


@pytest.mark.parametrize("seed", range(20))
def test_common_words(seed):
    rng = random.Random(seed)
    a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(0, 40))] for _ in range(2))
    row = [0] * (len(b) + 1)
    for u in a:
        now = [0]
        for j, v in enumerate(b, 1):
            now.append(row[j - 1] + 1 if u == v else max(row[j], now[-1]))
        row = now
    assert chaining.common_words(a, b) == row[-1]


def test_passages(spark, messy, empty):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(5000)]
    shared, rows, places = rng.choices(words, k=80), [], {}
    for i in range(30):
        own, passage = rng.choices(words, k=120), list(shared)
        if i % 3 == 0:
            for _ in range(4):
                passage[rng.randrange(5, 75)] = rng.choice(words)
            places[i] = at = rng.randrange(100)
            own[at:at] = passage
        rows.append((i, " ".join(own)))
    rows += [(100, " ".join(shared[:30])), (None, " ".join(shared)), (101, None), (102, ""), (103, rows[4][1]), (103, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in substring_dedup.passages(docs).collect()}
    assert set(found) == {*places, 103} - {0}
    for i, r in found.items():
        if i != 103:
            assert r["other_id"] == 0 and r["identity"] >= 0.8
            assert abs(r["start"] - places[i]) <= 8 and abs(r["end"] - places[i] - 80) <= 8
    assert (found[103]["start"], found[103]["end"], found[103]["other_id"]) == (0, 120, 4)
    assert substring_dedup.passages(empty).count() == 0
    assert {r["doc_id"] for r in substring_dedup.passages(messy.select("doc_id", "text", "lang", "a")).collect()} <= {107, 100, 101, 102}


def test_passages_on_both_sides_of_a_gap(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(20_000)]
    gaps = [(0, 0), (5, 5), (20, 20), (70, 70), (0, 120), (120, 0), (20, 120), (150, 150), (20, 300), (300, 300), (0, 300)]
    rows, wanted = [], {}
    for n, (gap_a, gap_b) in [(n, g) for n in (100, 200) for g in gaps]:
        one, two = rng.choices(words, k=n), rng.choices(words, k=n)
        rows += [(len(rows), " ".join([*one, *rng.choices(words, k=gap_a), *two])), (len(rows) + 1, " ".join([*one, *rng.choices(words, k=gap_b), *two]))]
        wanted[len(rows) - 1] = {*range(n), *range(n + gap_b, 2 * n + gap_b)}
    found = {i: set() for i in wanted}
    for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r["other_id"] == r["doc_id"] - 1 and r["identity"] >= 0.8
        found[r["doc_id"]] |= {*range(r["start"], r["end"])}
    assert all(wanted[i] <= found[i] for i in wanted)


def test_exact_passage_before_sparse_matches():
    """An exact passage is found where single words on the same diagonal go on after it."""
    config = substring_dedup.SubstringConfig()
    same, one, two = ([f"{c}{i}".encode() for i in range(n)] for c, n in (("s", 60), ("a", 200), ("b", 200)))
    for i in range(0, 200, 20):
        one[i : i + 5] = two[i : i + 5] = [b"the", b"same", b"five", b"common", b"words"]
    (found,) = substring_dedup.align(np.array([[0, 245, 0, 245]]), 0, same + one, 0, same + two, config)
    assert found[0] == 0 and 60 <= found[1] <= 85 and found[4] >= 0.8


@pytest.mark.parametrize("copies, split", [(2, False), (40, False), (40, True)])
def test_passage_whose_seeds_are_scattered_over_first_documents(spark, monkeypatch, copies, split):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(20_000)]
    shared = rng.choices(words, k=72)
    rows = [(i, " ".join([*rng.choices(words, k=30), *shared[12 * i : 12 * i + 16], *rng.choices(words, k=30)])) for i in range(6)]
    rows += [(50 + i, " ".join([*rng.choices(words, k=40), *shared, *rng.choices(words, k=40)])) for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if split:
        monkeypatch.setattr(substring_dedup, "hot_seeds", lambda seeds, config: [r.seed for r in seeds.groupBy("seed").count().filter("count > 4").collect()])
    found = substring_dedup.passages(docs, substring_dedup.SubstringConfig(ranges=5)).collect()
    assert {r["doc_id"]: (r["start"], r["end"], r["other_id"]) for r in found} == {50 + i: (40, 112, 49 + i) for i in range(1, copies)}


@pytest.mark.parametrize("copies, split", [(1, False), (5, True)])
def test_passage_whose_seeds_are_scattered_over_first_documents_and_those_before(spark, monkeypatch, copies, split):
    """Of the two documents with the whole passage neither is the first holder nor the holder before for most of its seeds."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(20_000)]
    shared = rng.choices(words, k=72)

    def text(passage):
        return " ".join([*rng.choices(words, k=40), *passage, *rng.choices(words, k=40)])

    parts = [shared[low : low + 30] for low in range(0, 48, 6)]
    rows = [(low + i, text(part)) for low in (0, *range(100, 100 * copies + 1, 100)) for i, part in enumerate(rng.sample(parts, k=len(parts)))]
    rows += [(50, text(shared))] + [(100 * n + 50, text(shared)) for n in range(1, copies + 1)]
    if split:
        monkeypatch.setattr(substring_dedup, "hot_seeds", lambda seeds, config: [r.seed for r in seeds.groupBy("seed").count().filter("count > 4").collect()])
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    whole = {(r["doc_id"], r["other_id"]) for r in found if (r["start"], r["end"], r["other_start"], r["other_end"]) == (40, 112, 40, 112)}
    assert whole == {(100 * n + 50, 100 * m + 50) for n in range(1, copies + 1) for m in range(n)}


def test_every_document_with_an_unsettled_pair_of_seeds_is_matched(spark):
    """Two seeds that ten documents share at one distance, settled in two of them by a passage told."""
    config = substring_dedup.SubstringConfig()
    rows = [(seed, d, 100 * d + pos) for d in range(10) for seed, pos in ((1, 30), (2, 45))] + [(1, 20, 0), (2, 20, 400)]
    seeds = spark.createDataFrame(rows, "seed long, doc_id long, pos int").repartition(4)
    told = spark.createDataFrame([(3, 320, 380, 0, 0, 0, 1.0), (5, 531, 600, 0, 0, 0, 1.0), (5, 500, 520, 0, 0, 0, 1.0), (6, 630, 650, 0, 0, 0, 1.0)], substring_dedup.PASSAGE)
    found = substring_dedup.remaining_matches(seeds, told, config).collect()
    by_hand = {(d, e, 100 * d + pos, 100 * e + pos) for d in range(10) for e in range(d) for pos in (30, 45) if d not in (3, 6)}
    assert sorted((r["doc_id"], r["other_id"], r["at"] >> 32, (r["at"] & 0xFFFFFFFF) >> 1) for r in found) == sorted(by_hand)


def matches_by_hand(rows):
    out = []
    for seed in {r[0] for r in rows}:
        mine = sorted((d, p) for s, d, p in rows if s == seed)
        for d, p in mine:
            if d == mine[0][0]:
                continue
            out.append((d, mine[0][0], p, mine[0][1], 0))
            before = max((e, -q) for e, q in mine if e < d)
            if before[0] != mine[0][0]:
                out.append((d, before[0], p, -before[1], 1))
    return sorted(out)


@pytest.mark.parametrize("hot, ranges, batch", [([], 7, 10_000), ([], 7, 3), ([0, 1, 2], 7, 5), ([1], 200, 1), ([0, 1, 2], 1, 4)])
def test_seed_matches(spark, monkeypatch, hot, ranges, batch):
    rng = random.Random(10)
    rows = sorted({(rng.randrange(3), rng.randrange(60), rng.randrange(9)) for _ in range(300)} | {(5 + i, i, 2**31 - 1 - i) for i in range(5)} | {(9, 2, 1), (9, 3, 2**31 - 1)})
    seeds = spark.createDataFrame(rows, "seed long, doc_id long, pos int").repartition(4)
    monkeypatch.setattr(substring_dedup, "hot_seeds", lambda seeds, config: hot)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = substring_dedup.seed_matches(seeds, substring_dedup.SubstringConfig(ranges=ranges)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["doc_id"], r["other_id"], r["at"] >> 32, (r["at"] & 0xFFFFFFFF) >> 1, r["at"] & 1) for r in found) == matches_by_hand(rows)


def test_seeds_of_many_documents_are_found(spark):
    rows = [(7, d, 0) for d in range(0, 6000, 3)] + [(100 + d, d, 5) for d in range(6000)]
    config = substring_dedup.SubstringConfig()
    assert substring_dedup.hot_seeds(spark.createDataFrame(rows, "seed long, doc_id long, pos int"), config) == [7]
    assert substring_dedup.hot_seeds(spark.createDataFrame(rows[:0], "seed long, doc_id long, pos int"), config) == []


class Plain:
    """Stands for a table: gives the function over batches that it would run."""

    def repartition(self, *columns):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, run, schema):
        return run


@pytest.mark.parametrize("step", [7, 10_000])
def test_one_run_of_matches_is_its_own_chain(monkeypatch, step):
    config, rng, called = substring_dedup.SubstringConfig(), np.random.default_rng(21), []
    least, best = substring_dedup.least_chain(config), chaining.chains
    rows, many, wanted = [], 0, set()
    for doc in range(300):
        later, shift = rng.integers(0, 2, size=2)
        x = np.unique(rng.integers(0, 60, size=rng.integers(1, 12)))
        if doc % 3 == 0:  # on two diagonals, in both rounds
            found = [(int(p), int(p + d), r) for r, d in ((0, 0), (1, 30)) for p in x]
        else:
            x = x[: np.flatnonzero(np.append(np.diff(x) > 2 * config.window, True))[0] + 1]
            found = [(int(p), int(p + shift), int(later)) for p in x]
        many += doc % 3 == 0
        for r in (0, 1):
            some = [(p, q) for p, q, other in found if other <= r]
            if not some or not any(other == r for _, _, other in found):
                continue
            runs = chaining.segments(np.zeros(len(some), dtype=np.int64), *np.array(some, dtype=np.int64).T, config.k, 2 * config.window)[1]
            for chain in best(runs, config.gap_cost):
                key = (doc, 7, chain[0, 0], chain[-1, 1], chain[0, 2], chain[-1, 3], np.ascontiguousarray(chain).tobytes())
                if chain[-1, 1] - chain[0, 0] >= least and (*key, False) not in wanted:
                    wanted.add((*key, r == 1))
        rows += [(doc, 7, p << 32 | q << 1 | r) for p, q, r in sorted(found)]
    monkeypatch.setattr(substring_dedup, "chains", lambda *a: called.append(1) or best(*a))
    names = ["doc_id", "other_id", "at"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + step])], names) for i in range(0, len(rows), step)]
    got = [tuple(r.values()) for b in substring_dedup.chain_table(Plain(), config)(iter(batches)) for r in b.to_pylist()]
    assert len(got) == len(set(got)) > many and set(got) == wanted
    assert len(called) <= 2 * many


@pytest.mark.parametrize("most", [0, 1000])
def test_only_documents_of_chains_take_part(spark, most):
    ids = [0, 63, 64, -1, -64, 2**62, 5]
    docs = spark.createDataFrame([(i, f"t{i}") for i in [*ids, 1, 65, -2, None]], "doc_id long, text string")
    found = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(6)], "doc_id long, other_id long")
    kept = substring_dedup.taking_part(docs, found, substring_dedup.SubstringConfig(most_blocks=most)).collect()
    assert {r["doc_id"] for r in kept} == (set(ids) if most else {*ids, 1, 65, -2, None})
