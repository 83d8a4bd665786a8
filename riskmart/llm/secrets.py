"""Secret scans in SQL expressions: fixed patterns, and sliding-window entropy of candidate strings.

A candidate is a maximal run of token characters, or what listed words leave of it. A window of ``window`` characters slides over it; the counts of its
characters and the sum of c * log2(c) change by the character that leaves and the one that enters, so a step costs the
same at any window size. Windows whose Shannon entropy reaches the threshold of the candidate's character class
are joined into spans. Words on the allow-list part the run they stand in; candidates that match it as a whole, and spans
inside a pattern's span, are not added. Work grows with the text, not with the square of its hits.

Positions are code points, the end exclusive. Nulls: a null text is empty, a null id is passed through. Repeated rows each give
their own row, ties at a start are settled by the order of kinds, and only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.text import let

# fixed values: the patterns of the three kinds
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# both take maximal runs, so the least length can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
CANDIDATE_CLASS = "[A-Za-z0-9+/_=-]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "entropy")
MIN_SECRET = 8
SPANS = "array<struct<start:bigint,end:bigint>>"
#: values of a running sum that grow in one list, and windows that one walk takes
BLOCK, STRETCH = 128, 2048
#: code of a count of zero in a string of counts
ZERO = 48


@dataclass(frozen=True)
class SecretConfig:
    """Thresholds are bits per character for each class: hex digits only, letters only, anything else.

    ``allow_words`` part the run they stand in: no window that overlaps one counts (empty: none). A candidate in which a pattern of
    ``allow`` is found is not scanned.
    """

    window: int = 20
    hex_bits: float = 3.05
    alpha_bits: float = 4.05
    mixed_bits: float = 3.85
    allow_words: str = r"(?i)(?:example|sample|dummy|placeholder|changeme|xxxxx|0123456789|abcdefghij)"
    allow: tuple[str, ...] = field(
        default=(
            r"^[0-9]+$",
            r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
            r"^/?([a-z0-9_-]+/){2,}[a-z0-9_-]*$",
        )
    )


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """array<bigint>: sums or maxima up to and with each value, in two levels.

    A list that grows is copied at every step, so only the values of one block, and one value per block, grow in a list.
    """
    nothing = F.array().cast("array<bigint>")
    none = F.lit(0).cast("bigint")

    def grown(items: Column, first: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            at = combine(acc["at"], x)
            return F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

        return F.aggregate(items, F.struct(first.alias("at"), nothing.alias("out")), step, lambda acc: acc["out"])

    def in_blocks(all_values: Column) -> Column:
        last = (F.ceil(F.size(all_values) / BLOCK) - 1).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_values, b * BLOCK + 1, F.lit(BLOCK)))

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, none, combine))
        before = F.concat(F.array(none), F.slice(grown(totals, none), 1, F.size(blocks) - 1))
        return F.flatten(F.zip_with(blocks, before, grown))

    return F.when(F.size(values) > 0, let(let(values, in_blocks), whole)).otherwise(nothing)


def _spans_between(between: Column, hits: Column) -> Column:
    """array<struct<gap_start, start, end>>: where the text before each hit begins, and the hit; the text after the last hit
    comes last, with an empty hit."""
    lengths = F.zip_with(
        between, hits, lambda g, h: F.struct(F.length(g).cast("bigint").alias("gap"), F.coalesce(F.length(h), F.lit(0)).cast("bigint").alias("hit")),
    )

    def place(both: Column) -> Column:
        ends = _running(F.transform(both, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b)
        return F.zip_with(
            both, ends,
            lambda x, end: F.struct((end - x["hit"] - x["gap"]).alias("gap_start"), (end - x["hit"]).alias("start"), end.alias("end")),
        )

    return let(lengths, place)


def _places(text: Column, pattern: str, hits: Column) -> Column:
    """array<struct<start, end>> of the matches of ``pattern``, from the lengths of matches and of what lies between."""
    places = _spans_between(F.slice(F.split(text, pattern, -1), 1, F.size(hits)), hits)
    spans = F.transform(places, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))
    return F.when(F.size(hits) > 0, spans).otherwise(F.array().cast(SPANS))


def _candidates(runs: Column, config: SecretConfig) -> Column:
    """array<struct<start, end, run>>: what is left of each run between the listed words, if no whole pattern allows it."""

    def parts(r: Column) -> Column:
        if not config.allow_words:
            return F.array(r)
        between = F.split(r["run"], config.allow_words, -1)
        places = _spans_between(between, F.regexp_extract_all(r["run"], F.lit(config.allow_words), F.lit(0)))
        return F.zip_with(between, places, lambda g, p: F.struct((r["start"] + p["gap_start"]).alias("start"), (r["start"] + p["start"]).alias("end"), g.alias("run")))

    def wanted(c: Column) -> Column:
        allowed = reduce(lambda a, b: a | b, [c["run"].rlike(p) for p in config.allow], F.lit(False))
        return (F.length(c["run"]) >= config.window) & ~allowed

    return F.filter(F.flatten(F.transform(runs, parts)), wanted)


def _term(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _dense_spans(candidate: Column, config: SecretConfig) -> Column:
    """array<struct<start, end>> inside the candidate: unions of the windows that reach the threshold.

    Stretches of ``STRETCH`` windows are walked one by one; spans that touch where two stretches meet are joined at the end.
    """
    w = config.window
    bits = (
        F.when(candidate.rlike("^[0-9a-fA-F]+$"), config.hex_bits)
        .when(candidate.rlike("^[A-Za-z]+$"), config.alpha_bits)
        .otherwise(config.mixed_bits)
    )
    # entropy = log2(w) - sum(c * log2(c)) / w
    most = F.lit(float(w)) * (F.lit(math.log2(w)) - bits)
    last = ((F.length(candidate) - w) / STRETCH).cast("int")
    found = let(most, lambda limit: F.flatten(F.transform(
        F.sequence(F.lit(0), last),
        lambda k: let(
            F.substring(candidate, k * STRETCH + 1, F.lit(STRETCH + w - 1)), lambda part: _stretch_spans(part, k * STRETCH, limit, config),
        ),
    )))

    def joined(spans: Column) -> Column:
        n = F.size(spans)
        starts = F.filter(spans, lambda s, i: (i == 0) | (F.try_element_at(spans, F.greatest(i, F.lit(1)))["end"] < s["start"]))
        ends = F.filter(spans, lambda s, i: (i == n - 1) | (F.try_element_at(spans, i + 2)["start"] > s["end"]))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    return let(found, joined)


def _stretch_spans(part: Column, offset: Column, most: Column, config: SecretConfig) -> Column:
    """The spans of one stretch, in places of the candidate, by one walk over its windows.

    The counts are a string with a character per letter, so that a step rewrites two places of it.
    """
    w = config.window
    letters = F.array(*[F.lit(c) for c in ALPHABET])
    head = F.substring(part, 1, w)
    first = F.transform(letters, lambda c: F.lit(w) - F.length(F.replace(head, c, F.lit(""))))
    counts = F.array_join(F.transform(first, lambda n: F.chr((n + ZERO).cast("bigint"))), "")
    total = F.aggregate(first, F.lit(0.0), lambda s, c: s + _term(c))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    whole = F.array(F.struct(offset.alias("start"), (offset + w).alias("end")))
    zero = F.struct(counts.alias("counts"), total.alias("total"), F.when(total <= most + 1e-6, whole).otherwise(nothing).alias("out"))
    # one struct per step: the character that leaves, the one that enters, and where the new window starts
    chars = F.split(part, "")
    more = F.length(part) - w
    steps = F.zip_with(
        F.slice(chars, 1, more), F.slice(chars, w + 1, more),
        lambda a, b: F.struct(F.instr(F.lit(ALPHABET), a).alias("a"), F.instr(F.lit(ALPHABET), b).alias("b")),
    )
    steps = F.transform(steps, lambda x, i: F.struct(x["a"].alias("a"), x["b"].alias("b"), (offset + i + 1).alias("at")))

    def step(acc: Column, x: Column) -> Column:
        def count(place: Column) -> Column:
            return F.ascii(F.substring(acc["counts"], place, F.lit(1))) - ZERO

        def moved(n: Column) -> Column:
            less = F.overlay(acc["counts"], F.chr((n["out"] - 1 + ZERO).cast("bigint")), x["a"], F.lit(1))
            both = F.overlay(less, F.chr((n["in"] + 1 + ZERO).cast("bigint")), x["b"], F.lit(1))
            change = _term(n["out"] - 1) - _term(n["out"]) + _term(n["in"] + 1) - _term(n["in"])
            return F.struct(both.alias("counts"), (acc["total"] + change).alias("total"))

        same = F.struct(acc["counts"].alias("counts"), acc["total"].alias("total"))
        now = F.when(x["a"] == x["b"], same).otherwise(let(F.struct(count(x["a"]).alias("out"), count(x["b"]).alias("in")), moved))
        return let(now, lambda state: F.struct(state["counts"].alias("counts"), state["total"].alias("total"), added(acc["out"], x, state).alias("out")))

    def added(out: Column, x: Column, state: Column) -> Column:
        end = x["at"] + w
        before = F.try_element_at(out, F.lit(-1))
        touches = (F.size(out) > 0) & (before["end"] >= x["at"])
        longer = F.concat(
            F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(before["start"].alias("start"), end.alias("end"))),
        )
        another = F.concat(out, F.array(F.struct(x["at"].alias("start"), end.alias("end"))))
        # sums of many small changes keep a rounding error: the margin is far below the step between two entropies
        return F.when(state["total"] > most + 1e-6, out).when(touches, longer).otherwise(another)

    return F.aggregate(steps, zero, step, lambda acc: acc["out"])


def _not_inside(new: Column, base: Column) -> Column:
    """Those of ``new`` (structs that begin with start, end) that lie in no span of ``base``: with both in order of start, a span lies
    in another if the greatest end of the base spans up to it reaches its own end."""

    def outside(every: Column) -> Column:
        reach = _running(F.transform(every, lambda e: F.when(e["new"] == 0, e["end"]).otherwise(F.lit(0).cast("bigint"))), lambda a, b: F.greatest(a, b))
        places = F.zip_with(every, reach, lambda e, r: F.when((e["new"] == 1) & (r < e["end"]), e["at"]))
        return F.filter(places, lambda at: at.isNotNull())

    def kept(items: Column) -> Column:
        events = F.sort_array(F.concat(
            F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("new"), s["end"].alias("end"), F.lit(0).alias("at"))),
            F.transform(items, lambda s, i: F.struct(s["start"].alias("start"), F.lit(1).alias("new"), s["end"].alias("end"), i.alias("at"))),
        ))
        return F.transform(let(events, outside), lambda at: F.element_at(items, at + 1))

    return let(new, kept)


def _named(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].cast("bigint").alias("start"), F.lit(k).alias("kind"), s["end"].cast("bigint").alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(one, ",")


def secret_spans(docs: DataFrame, config: SecretConfig = SecretConfig()) -> DataFrame:
    """``doc_id, text, assign, access, hex, entropy``: the spans of each kind as array<struct<start, end>>."""
    candidate = f"(?<!{CANDIDATE_CLASS}){CANDIDATE_CLASS}{{{config.window},}}"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    text = F.col("text")

    def hits(pattern: str, group: int = 0) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    found = rows.select(
        "doc_id", "text", hits(ASSIGN).alias("assign_hits"), hits(ACCESS).alias("access_hits"), hits(HEX).alias("hex_hits"),
        hits(candidate).alias("runs"),
    )
    secret = F.when(F.size("assign_hits") > 0, hits(ASSIGN, 2))
    long_enough = F.zip_with(
        _places(text, ASSIGN, F.col("assign_hits")), F.coalesce(secret, F.array().cast("array<string>")),
        lambda p, s: F.struct(p["start"].alias("start"), p["end"].alias("end"), (F.length(s) >= MIN_SECRET).alias("ok")),
    )
    kept = F.transform(F.filter(long_enough, lambda p: p["ok"]), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))
    placed = found.select(
        "doc_id", "text", "runs", kept.alias("assign"), _places(text, ACCESS, F.col("access_hits")).alias("access"),
        _places(text, HEX, F.col("hex_hits")).alias("hex"), _places(text, candidate, F.col("runs")).alias("run_places"),
    )
    runs = F.zip_with("run_places", "runs", lambda p, r: F.struct(p["start"].alias("start"), p["end"].alias("end"), r.alias("run")))
    base = F.concat("assign", "access", "hex")
    # spans of a candidate inside a base span would all go
    scanned = F.transform(
        _not_inside(_candidates(runs, config), base),
        lambda c: F.transform(
            _dense_spans(c["run"], config),
            lambda s: F.struct((c["start"] + s["start"]).alias("start"), (c["start"] + s["end"]).alias("end")),
        ),
    )
    new = _not_inside(F.flatten(scanned), base)
    return placed.select("doc_id", "text", "assign", "access", "hex", F.when(F.size("runs") > 0, new).otherwise(F.array().cast(SPANS)).alias("entropy"))


def secret_scan(docs: DataFrame, config: SecretConfig = SecretConfig()) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy``, one row per row of ``docs``."""
    found = secret_spans(docs, config)
    base = F.concat(*[_named(F.col(k), k) for k in KINDS[:3]])
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]], F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, _named(F.col("entropy"), "entropy"))).alias("spans"), F.size("entropy").cast("bigint").alias("n_entropy"),
    )
