"""Mixing, archives, running totals and the pipeline."""

from __future__ import annotations

import hashlib
import re

import pyarrow.fs as pafs
import pytest

import corpus_pipeline
from riskmart.llm import decontaminate, line_dedup, mixing, quality_rules, simhash, warc
from riskmart.llm.queries import ORACLES, QUERIES
from riskmart.session import cut_lineage, scratch_path
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == []


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_running_total(spark):
    rows = [(k % 3 if k % 7 else None, (k * 37) % 50, k, k % 5) for k in range(300)]
    df = spark.createDataFrame(rows, "grp int, ord int, id int, value int")
    order = ["grp", "ord", "id"]
    got = {r["id"]: r["total"] for r in mixing.queue(df.repartition(7), order, "value", "total", "t", by="grp").collect()}
    for g in (None, 0, 1, 2):
        total = 0
        for _, i, v in sorted((o, i, v) for x, o, i, v in rows if x == g):
            total += v
            assert got[i] == total


def targets_by_hand(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = budget * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in names if s not in capped)
        share = {s: most * sizes[s] if s in capped else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in capped and share[s] > most * sizes[s]}
        if not over:
            return share
        capped |= over


def test_targets(spark):
    sizes = {"a": 10, "b": 900, "c": 300, None: 50, "d": 0, "é": 77}
    rows = spark.createDataFrame([(1, s, n) for s, n in sizes.items()], "doc_id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(targets_by_hand(sizes))


def test_mix(messy, empty, pairs):
    rows = [tuple(r) for r in mixing.mix(messy).collect()]
    again = [tuple(r) for r in mixing.mix(messy.repartition(3)).collect()]
    assert sorted(rows, key=repr) == sorted(again, key=repr)
    assert sum(r[2] for r in rows) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in pairs)
    sizes, taken, target, largest = {}, {}, {}, {}
    for _, source, size, source_size, goal, words in rows:
        assert words in (0, size, 2 * size)
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + words
        target[source], largest[source] = goal, max(largest.get(source, 0), size)
    assert target == pytest.approx(targets_by_hand(sizes))
    assert all(abs(taken[s] - target[s]) <= 2 * max(largest.values()) for s in sizes)
    assert mixing.mix(empty).count() == 0


def test_mixed_documents(messy):
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == [*messy.columns, "_mix_pass", "mix_finish"]
    assert mixed.filter("mix_finish < 0").count() == 0 and mixed.count() > 0


def test_rows_without_id_have_their_own_places(spark):
    """Texts under a null id, or under one id, are taken or left one by one; equal rows share a place."""
    texts = [f"text {k} " + "word " * (k % 9) for k in range(60)]
    rows = [(None, "a", t) for t in texts] + [(None, "a", texts[0])] * 3 + [(7, "a", "one two three"), (7, "a", "four five")]
    rows += [(100 + k, "b", "some more words here") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    result = {(r["doc_id"], r["source"]): r for r in mixing.mix(docs).collect()}
    copies = [(r["doc_id"], r["text"], r["mix_pass"]) for r in mixing.mixed_documents(docs).collect()]
    passes: dict = {}
    for doc_id, text, number in copies:
        passes.setdefault((doc_id, text), []).append(number)
    nameless = [len(passes.get((None, t), [])) for t in texts]
    assert nameless[0] in (0, 4, 8) and set(nameless[1:]) <= {0, 1, 2} and len(set(nameless[1:])) > 1
    size = lambda t: len(t.split())
    for key in ((None, "a"), (7, "a")):
        assert result[key]["size"] == sum(size(t) for i, s, t in rows if (i, s) == key)
        assert result[key]["taken"] == sum(size(t) for i, t, _ in copies if i == key[0])
    assert len(result) == 62


@pytest.fixture(scope="module")
def pages(spark):
    same = "<p>" + "same page " * 20 + "</p>"
    rows = [(k, f"http://h{k % 3}/é{k}", f"<html>{k} " + "word " * (k * 7 % 90) + "</html>") for k in range(40)]
    rows += [(100, "u", same), (90, None, same), (101, "a\r\nb", same), (None, "u", same), (102, "u", None), (103, "u", ""), (104, "x", ""), (104, "x", "")]
    rows += [(105, "big", "long \r\n\r\n WARC/1.1 " * 50_000), (90, "u", same)]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, payload int, refers_to int").repartition(4)


def test_archive_round_trip(pages):
    rows, df = pages
    config = warc.WarcConfig(frame_bytes=2_000, bundle_bytes=4_000)
    found = sorted((tuple(r) for r in warc.archive_round_trip(df, config=config).collect()), key=repr)
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    hand = []
    for i, _, html in rows:
        data = (html or "").encode()
        twice = sum((h or "").encode() == data for _, _, h in rows) > 1
        refers = first.get(data) if twice and i != first.get(data) else None
        hand.append((i, "response" if refers is None else "revisit", refers, len(data), hashlib.sha256(data).hexdigest()))
    assert found == sorted(hand, key=repr)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_bundles_are_plain_zstandard(spark, pages):
    import zstandard

    folder = warc.shared_uri(scratch_path(spark, "warc-test"))
    index = warc.write_archive(warc.plan_records(pages[1]), folder, warc.WarcConfig(frame_bytes=2_000))
    places = [r.asDict() for r in index.collect()]
    fs, root = pafs.FileSystem.from_uri(folder)
    for name in {p["bundle"] for p in places}:
        with fs.open_input_file(f"{root}/{name}") as file:
            data = file.read()
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        table, start, at = warc.read_seek_table(data), [], 0
        for begin, size in table:
            start.append(at)
            at += len(zstandard.ZstdDecompressor().decompress(data[begin : begin + size]))
        assert at == len(whole)
        for p in places:
            if p["bundle"] == name:
                begin = start[p["frame"]] + p["offset"]
                head, _, end = warc.parse_record(whole, begin)
                assert end - begin == p["length"]
                assert head["WARC-Record-ID"] == f"<urn:page:{'' if p['page_id'] is None else p['page_id']}>"
                # what every record must have
                assert head["WARC-Date"] == warc.WarcConfig.date and {"WARC-Type", "Content-Length"} <= set(head)


def test_pipeline_stages(spark, sf):
    """Each stage against the decision of its own operator on the rows it was given; no stage takes more than it decided on."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    labels, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    def stage(k, given):
        return cut_lineage(corpus_pipeline.STAGES[k][1](spark, given, sf), "pipeline-test")

    good = stage(0, docs)
    assert ids(good) == ids(quality_rules.quality_rules(docs, labels).filter("kept"))
    unique = stage(1, good)
    gone = {r["doc_id"]: set(r["dropped"]) for r in line_dedup.line_decisions(good).collect()}
    want = {}
    for r in good.collect():
        kept = [x for n, x in enumerate(r["text"].split("\n")) if n not in gone[r["doc_id"]]]
        if not gone[r["doc_id"]] or "".join(kept).split():
            want[r["doc_id"]] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in unique.collect()} == want
    single = stage(2, unique)
    assert ids(single) == ids(simhash.near_duplicates(unique).filter("doc_id = component_id"))
    clean = stage(3, single)
    leaked = {r["doc_id"] for r in decontaminate.leaks(single, benchmark).collect()}
    assert ids(clean) == [i for i in ids(single) if i not in leaked]
    for df in (good, unique, single, clean):
        assert df.columns == columns
    mixed = stage(4, clean)
    taken = {r["doc_id"]: r["taken"] // max(r["size"], 1) for r in mixing.mix(clean).collect() if r["taken"]}
    got = ids(mixed)
    assert {i: got.count(i) for i in set(got)} == taken
