"""Personal data: fixed patterns, and what boosted trees take from wider candidates.

Everything runs in Spark's own expressions.  The patterns give the base spans.  Generators with high
recall propose spans that may overlap; each is described by its format and by what stands before it.
Candidates that a strict rule confirms are the positive examples, all others the negative ones.  Trees
are grown on four fifths of them, and a threshold per kind is calibrated on the rest, so that a
candidate is added where what looks like it is nearly always confirmed.  Where there is nothing to
learn or calibrate a kind on, the strict rule itself decides.

The patterns are written without backtracking into groups, so a text of any length needs bounded
stack and time in proportion: a run of characters that failed once is not tried again from its middle.
Arrays of spans are folded in blocks and swept in order of their places, never compared all with all.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm import boosting
from marketloom.llm.common import free_name
from marketloom.sources.scratch import stored

# Kinds in their order, and the patterns of the first four.
KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# only runs of 12 to 19 digits: a maximal run starts where no digit, or digit and separator, stands before
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# generators
_KEY = "[A-Za-z0-9_/+-]"
LONG_TOKEN = rf"(?<!{_KEY}){_KEY}{{16,}}+"
NUMBER = r"(?<![0-9.+-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}+(?![0-9])"
SPELLED = rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(]at[\])]\x20?{_HOST}++(?:\x20?(?:[\[(]dot[\])]|\.)\x20?{_HOST}++)++"

SPAN = "array<struct<start:int,end:int,kind:int>>"
FEATURES = ("kind", "digits", "size", "separators", "before", "alphabet", "turns", "checks")
HELD_OUT = 5  # one candidate in so many, by a hash of its text, is used for calibration only
PRECISION = 0.98
CONTEXT = 24  # characters before a candidate that are looked at
_NAMES = "(?i)(pass(word|wd)?|token|secret|api[_-]?key|access[_-]?key|bearer|auth|card|iban|phone|tel|mail)[^A-Za-z0-9]{0,4}$"


BLOCK = 64  # items of an array that are folded together
CHUNK = 1024  # code points of a text that are cut from together


def _later(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also inside further lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(items: Column, zero: Column, value, combine, emit) -> Column:
    """``emit(state, item)`` for every item, where ``state`` folds the ``value`` of all items before it.

    ``combine`` is associative and ``zero`` neutral.  Blocks are folded by themselves and their totals
    after one another, so the work is about the number of items to the power 1.5, with small factors.
    """

    def fold(part):
        return F.aggregate(part, zero, lambda state, x: combine(state, value(x)))

    def over(all_items):
        last = F.greatest(F.floor((F.size(all_items) - 1) / BLOCK).cast("int"), F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_items, b * BLOCK + 1, F.lit(BLOCK)))

        def with_blocks(parts):
            def with_totals(totals):
                def one(part, b):
                    before = F.aggregate(F.slice(totals, F.lit(1), b), zero, combine)
                    return _let(
                        before,
                        lambda at: F.transform(part, lambda x, i: emit(combine(at, fold(F.slice(part, F.lit(1), i))), x)),
                    )

                return F.flatten(F.transform(parts, one))

            return _let(F.transform(parts, fold), with_totals)

        return _let(blocks, with_blocks)

    return _let(items, over)


def _occurrences(text: Column, pattern: str) -> Column:
    """array<struct<start,end,found>> in code points: what is between the matches gives the places."""
    between = F.split(text, pattern, -1)

    def placed(found):
        pairs = F.zip_with(
            F.slice(between, F.lit(1), F.size(found)), found, lambda gap, f: F.struct(gap.alias("gap"), f.alias("found"))
        )
        return _running(
            pairs, F.lit(0), lambda p: F.length(p["gap"]) + F.length(p["found"]), lambda a, b: a + b,
            lambda at, p: F.struct(
                (at + F.length(p["gap"])).alias("start"),
                (at + F.length(p["gap"]) + F.length(p["found"])).alias("end"),
                p["found"].alias("found"),
            ),
        )

    return F.when(
        F.rlike(text, F.lit(pattern)), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    )


def _with_reach(items: Column, base: Column, key) -> Column:
    """array<struct<item,reach>> in order of the items: the largest end of the base spans that start before ``key``."""
    nothing = F.get(F.slice(items, F.lit(1), F.lit(0)), F.lit(0))  # a NULL of the items' type
    asks = F.transform(
        items, lambda x: F.struct(key(x).alias("key"), F.lit(0).alias("late"), F.lit(0).alias("end"), x.alias("item"))
    )
    spans = F.transform(
        base, lambda b: F.struct(b["start"].alias("key"), F.lit(1).alias("late"), b["end"].alias("end"), nothing.alias("item"))
    )
    swept = _running(
        F.array_sort(F.concat(asks, spans)), F.lit(0), lambda e: e["end"], _later,
        lambda reach, e: F.struct(e["item"].alias("item"), reach.alias("reach")),
    )
    return F.array_sort(F.filter(swept, lambda e: e["item"].isNotNull()))


def _spans(occurrences: Column, kind: int) -> Column:
    return F.transform(
        occurrences, lambda o: F.struct(o["start"].alias("start"), o["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(found: Column) -> Column:
    backwards = F.reverse(_digits(found))

    def add(total, i):
        digit = F.substring(backwards, i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(backwards) - 1), F.lit(0), add) % 10 == 0


def _octets(found: Column) -> Column:
    def small(part):
        plain = F.regexp_replace(part, "^0+(?=.)", "")
        return (F.length(plain) <= 3) & (F.substring(plain, 1, 3).cast("int") <= 255)

    return F.forall(F.split(found, r"\."), small)


def _base(text: Column) -> list[tuple[int, Column]]:
    """(kind, array of valid occurrences)."""
    length = lambda f: F.length(_digits(f))
    with_at = F.when(F.contains(text, F.lit("@")), text).otherwise("")
    with_plus = F.when(F.contains(text, F.lit("+")), text).otherwise("")
    return [
        (0, _occurrences(with_at, EMAIL)),
        (1, F.filter(_occurrences(text, IP), lambda o: _octets(o["found"]))),
        (2, F.filter(_occurrences(text, CARD), lambda o: _luhn(o["found"]))),
        (3, F.filter(_occurrences(with_plus, PHONE), lambda o: (length(o["found"]) >= 9) & (length(o["found"]) <= 15))),
    ]


def _count_bucket(n: Column, *upto: int) -> Column:
    return reduce(lambda rest, i: F.when(n <= upto[i], i).otherwise(rest), reversed(range(len(upto))), F.lit(len(upto)))


def _described(text: Column, kind: int, occurrence: Column, confirmed: Column) -> Column:
    """A candidate with its features (small integers) and its label."""
    found = occurrence["found"]
    before = F.substring(text, F.greatest(occurrence["start"] - (CONTEXT - 1), F.lit(1)), F.least(occurrence["start"], F.lit(CONTEXT)))
    count = lambda pattern: F.length(found) - F.length(F.regexp_replace(found, pattern, ""))
    turns = F.length(F.regexp_replace(F.regexp_replace(found, "[0-9]+", "9"), "[^9]+", ""))
    alphabet = (
        F.when(~F.rlike(found, F.lit("[A-Za-z]")), 0)
        .when(F.rlike(found, F.lit("^[0-9a-f]+$")), 1)
        .when(F.rlike(found, F.lit("^[0-9A-Z]+$")), 2)
        .otherwise(3)
    )
    context = F.when(F.rlike(before, F.lit(_NAMES)), 2).when(F.rlike(before, F.lit("[=:\"'+]\\s?$")), 1).otherwise(0)
    digits = _digits(found)
    checks = F.when((F.length(digits) >= 12) & (F.length(digits) <= 19), _luhn(found).cast("int")).otherwise(0)
    return F.struct(
        occurrence["start"].alias("start"),
        occurrence["end"].alias("end"),
        F.lit(kind).alias("kind"),
        _count_bucket(F.length(digits), 0, 3, 8, 11, 15, 19).alias("digits"),
        _count_bucket(F.length(found), 11, 17, 19, 23, 31, 39, 40, 64).alias("size"),
        _count_bucket(count("[ ().-]"), 0, 1, 3, 6).alias("separators"),
        context.alias("before"),
        alphabet.alias("alphabet"),
        _count_bucket(turns, 0, 1, 2, 4, 8).alias("turns"),
        checks.alias("checks"),
        confirmed.cast("int").alias("label"),
        (F.pmod(F.xxhash64(found), F.lit(HELD_OUT)) == 0).alias("held_out"),
    )


def _candidates(text: Column, base: Column) -> Column:
    """All proposals of the generators, described; empty where there are none."""
    def keyed(o):
        before = F.substring(text, F.greatest(o["start"] - (CONTEXT - 1), F.lit(1)), F.least(o["start"], F.lit(CONTEXT)))
        letters_and_digits = F.rlike(o["found"], F.lit("[0-9]")) & F.rlike(o["found"], F.lit("[A-Za-z]"))
        return letters_and_digits & (F.rlike(before, F.lit(_NAMES)) | F.rlike(o["found"], F.lit("^AKIA[0-9A-Z]{16}$")))

    tokens = F.filter(_occurrences(text, LONG_TOKEN), lambda o: F.rlike(o["found"], F.lit("[0-9]")))
    spelled = _occurrences(F.when(F.rlike(text, F.lit(r"[\[(]at[\])]")), text).otherwise(""), SPELLED)
    numbers = _occurrences(text, NUMBER)
    reached = F.when(numbers.isNotNull(), _let(numbers, lambda found: _with_reach(found, base, lambda o: o["end"])))
    proposals = [
        F.transform(tokens, lambda o: _described(text, 4, o, keyed(o))),
        F.transform(reached, lambda r: _described(text, 3, r["item"], r["reach"] > r["item"]["start"])),
        F.transform(spelled, lambda o: _described(text, 0, o, F.lit(True))),
    ]
    return F.flatten(F.filter(F.array(*proposals), lambda p: p.isNotNull()))


def _fit(scanned: DataFrame, candidates: str) -> boosting.Boosted | None:
    """Trees from the cells of all candidates.

    A cell is a combination of feature values, label and part: at most 5 * 7 * 9 * 5 * 3 * 4 * 6 * 2 * 4
    rows come to the driver, however many documents there are (some dozens in practice).
    """
    cells = (
        scanned.select(F.explode(candidates).alias("c"))
        .groupBy(*[F.col(f"c.{f}").alias(f) for f in (*FEATURES, "label", "held_out")])
        .count()
        .collect()
    )
    if not cells:
        return None
    rows = sorted(tuple(r) for r in cells)
    x = np.array([r[: len(FEATURES)] for r in rows])
    label, held, weight = (np.array([r[len(FEATURES) + i] for r in rows], float) for i in range(3))
    train = held == 0
    model = boosting.fit(FEATURES, x[train], label[train], weight[train]) if train.any() else None
    if model is not None:
        part = ~train
        boosting.calibrate(model, x[part, 0], x[part], label[part], weight[part], PRECISION)
    return model


def find_spans(df: DataFrame, text: str, keep_text: bool = True) -> DataFrame:
    """All columns of ``df`` with ``base_spans`` and ``spans``: (start, end, kind) by start, then kind.

    Places are code points, the end is exclusive, ``kind`` is a place in ``KINDS``.  ``spans`` holds the
    base spans and the added ones; an added span overlaps no base span (a secret may hold one), and of
    added spans that overlap the one with the higher score stays.  A kind without a threshold, and every
    kind where all candidates have one label, takes the candidates that the strict rule confirms.  A
    NULL or empty text has no spans; a text of any length, or with any number of spans, is one row.
    Repeated rows are treated alike, and an empty table gives an empty result.  The frame is stored
    once, so the trees and the result come from the same scan.  Columns of ``df`` that are called like
    a result, in upper or lower case, are replaced.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in ("base_spans", "spans") and c != text])
    names = [c for c in df.columns if keep_text or c != text]
    t, cands, parts = free_name(df, "_t"), free_name(df, "_candidates"), []
    rows = df.withColumn(t, F.coalesce(F.col(text).cast("string"), F.lit("")))
    for kind, valid in _base(F.col(t)):
        part = free_name(df, f"_kind{kind}")
        rows = rows.withColumn(part, _spans(valid, kind))
        parts.append(part)
    by_place = lambda spans: F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    base = F.flatten(F.filter(F.array(*parts), lambda p: p.isNotNull()))
    rows = rows.withColumn("base_spans", by_place(base).cast(SPAN))
    rows = rows.withColumn(cands, _candidates(F.col(t), F.col("base_spans")))
    scanned = stored(rows.select(*names, "base_spans", cands), "scanned")
    model = _fit(scanned, cands)
    thresholds = model.thresholds if model else {}

    def enough(c):
        """The least score; for kinds without a threshold the label decides."""
        confirmed = F.when(c["label"] == 1, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        for k, threshold in thresholds.items():
            confirmed = F.when(c["kind"] == k, F.lit(threshold)).otherwise(confirmed)
        return confirmed

    scored = F.transform(
        cands,
        lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
            (model.expression(lambda f: c[f]) if model else c["label"].cast("double")).alias("score"), enough(c).alias("least"),
        ),
    )
    taken = F.filter(scored, lambda c: c["score"] >= c["least"])
    added = F.when(F.size(cands) > 0, _let(taken, lambda found: _alone(_beside(found, F.col("base_spans")))))
    spans = F.transform(added, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))
    every = F.concat("base_spans", F.coalesce(spans.cast(SPAN), F.array().cast(SPAN)))
    return scanned.withColumn("spans", by_place(every).cast(SPAN)).drop(cands)


def _beside(taken: Column, base: Column) -> Column:
    """The taken candidates that overlap no base span; a secret may hold whole ones."""
    secret = KINDS.index("secret")
    at_end = _with_reach(taken, base, lambda c: c["end"])
    fits = F.filter(at_end, lambda r: r["reach"] <= F.when(r["item"]["kind"] == secret, r["item"]["end"]).otherwise(r["item"]["start"]))
    at_start = _let(F.transform(fits, lambda r: r["item"]), lambda found: _with_reach(found, base, lambda c: c["start"]))
    return F.transform(F.filter(at_start, lambda r: r["reach"] <= r["item"]["start"]), lambda r: r["item"])


def _alone(spans: Column) -> Column:
    """Without spans that overlap one of a better rank: higher score, then by place.

    Spans in order of their places fall into runs that hang together; only these are compared.
    """
    clash = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    rank = lambda c: F.struct(-c["score"], c["start"], -c["end"], c["kind"])

    def runs(found):
        opens = _running(
            found, F.lit(0), lambda c: c["end"], _later, lambda reach, c: reach <= c["start"]
        )
        numbered = F.transform(opens, lambda new, i: F.when(new, i))
        first = F.filter(numbered, lambda i: i.isNotNull())

        def cut(starts):
            part = lambda i, j: F.slice(found, i + 1, F.coalesce(F.get(starts, j + 1), F.size(found)) - i)
            best = lambda run: F.filter(run, lambda c: ~F.exists(run, lambda d: clash(c, d) & (rank(d) < rank(c))))
            return F.flatten(F.transform(F.transform(starts, part), best))

        return _let(first, cut)

    return _let(F.array_sort(spans), runs)


def spans_text(spans: Column | str) -> Column:
    """kind:start:end, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_kind(spans: Column | str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(df: DataFrame, text: str) -> DataFrame:
    """``df`` with every span of the text replaced by its kind in brackets; overlapping spans become one.

    A text without spans, NULL included, stays as it is; rows, columns and their order stay.
    """
    found = find_spans(df, text)
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    t = F.col(text)
    # of spans that start together the longest gives its name
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))

    def written(chunks):
        def cut(begin, end):
            here = F.slice(chunks, F.floor(begin / CHUNK).cast("int") + 1, (F.floor(end / CHUNK) - F.floor(begin / CHUNK) + 1).cast("int"))
            return F.substring(F.array_join(here, ""), begin % CHUNK + 1, end - begin)

        def put(at, s):
            return F.when(s["start"] >= at, F.concat(cut(at, s["start"]), F.element_at(name, s["kind"] + 1))).otherwise("")

        pieces = _running(ordered, F.lit(0), lambda s: -s["back"], _later, put)
        last = F.array_max(F.transform("spans", lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), _let(last, lambda at: cut(at, F.length(t))))

    in_chunks = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    redacted = F.when(F.size("spans") > 0, _let(in_chunks, written)).otherwise(t)
    return found.withColumn(text, redacted).select(*df.columns)
