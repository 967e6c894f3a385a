"""Personal data by candidate gradient boosting, in DataFrame expressions only.

*Base spans* are the leftmost non-overlapping matches of four fixed patterns (email, ip,
card, phone) that pass their check (parts up to 255, Luhn, number of digits). They always
stay. Around them, *generators* with looser patterns (spelled-out ``at`` and ``dot``,
bracketed dots, other separators, numbers without a plus) propose overlapping candidate
spans. A generator's own filters drop what its kind rules out: failed checks (Luhn, octets,
number of digits), dates, prose with an ``at``, and numbers after a word of ``_AGAINST``.
Boosted trees score the others by their format (digits, groups and their sizes,
separators, first character, variety) and their context (neighbouring characters, other
numbers around, key words before them), and a threshold calibrated for precision on a
held-out part selects those that are added. Of overlapping candidates the best stays;
none may touch a base span.

Training needs no outside labels. Positive are the base spans of the corpus, rewritten to
loose forms of their kind (``_forms``) in their own contexts. Negative is *background*: number
lists, tables, scores, years and ids (``_background``), one for each text, among words of that
text and through the same generators, with the weight of all positive ones together. The corpus'
own candidates are unlabelled: they may be either, so each counts as background with the small
weight ``UNLABELLED``. What fails a filter is no example, so no rule is among the features.
Features are small whole numbers; the ``FIT_CELLS`` most frequent rows of features of each
class and part are all that the driver sees. Trees are fitted there and become CASE
expressions. Kinds share trees and threshold, so a kind with few base spans leans on the others.

How it runs. Matches come from ``regexp_extract_all`` and the text between them from
``split``, both built in; adding up their lengths, block by block, gives the places in code
points. Spans of one kind are in order and apart, so overlaps are found by halving. Time is
near linear in the matches of a text. A cheap test for an ``@`` or a run of digits spares most texts the patterns. All of it is a
map: no shuffle but the cell counts. Patterns begin at the start of a run of their first
character class and use possessive repeats, so time is linear in the text and no stack
grows with it.

Null texts count as empty: no spans. Rows are independent: repeated rows and null ids are
answered each. Redaction keeps all columns and null texts as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial, reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The base patterns, each anchored where a leftmost match can begin.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole run of digits with single separators, if it has 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT = r"(?: ?@ ?| ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?| (?:at|AT) )"
_DOT = r"(?:\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) )"
_NUMBER_DOT = r" ?(?:\.|[\[({] ?(?:\.|dot|DOT) ?[\])}]) ?"
LOOSE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9.])[0-9]{{1,3}}(?:{_NUMBER_DOT}[0-9]{{1,3}}){{3}}(?![0-9])(?!\.[0-9])",
    "card": r"(?<![0-9])(?<![0-9][ ./-])[0-9](?:[ ./-]{0,2}[0-9]){12,18}+(?![ ./-]?[0-9])",
    "phone": r"(?<![0-9+.])(?:(?:\+|00) ?[0-9]{1,3}[ ./-]{0,2})?\(?[0-9]{2,4}(?:(?:\)[ ./-]{0,2}|[ ./-]{1,2})\(?[0-9]{2,4}){1,4}\)?(?![0-9])",
}
# Texts that can hold any match.
_NUMBERS = r"[0-9][0-9 ().\[\]{}dotDOT/-]{5,}"
_MAIL = r"@|[\[({<] ?(?:at|AT) ?[\])}>]| (?:at|AT) [A-Za-z0-9-]+(?: (?:dot|DOT) |\.)"
# A plain "at" with written dots is prose ("look at example.com") unless a key word precedes it.
_PROSE_AT = r"^[^@\[({<]* (?:at|AT) [A-Za-z0-9.-]+$"
_TLD = r"[A-Za-z]{2,}$"
_YEAR, _MONTH, _DAY = "(?:19|20)[0-9]{2}", "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
_SEP = "[ ./-]{1,2}"
# Dates, spans of years and dotted quads are no phone numbers.
_NO_PHONE = rf"^(?:{_YEAR}{_SEP}{_MONTH}{_SEP}{_DAY}(?![0-9]).*|(?:{_DAY}{_SEP}{_MONTH}|{_MONTH}{_SEP}{_DAY}){_SEP}{_YEAR}(?![0-9]).*|{_YEAR}{_SEP}{_YEAR}|[0-9]{{1,3}}(?: ?\. ?[0-9]{{1,3}}){{3}})$"
_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"

# Key words that speak for a kind when they stand before a candidate, and against any.
_FOR = {
    "email": r"(?i)mail|contact|write to|address",
    "ip": r"(?i)\bip\b|host|server|addr|ping|login",
    "card": r"(?i)card|visa|master|amex|credit|payment|\bcc\b",
    "phone": r"(?i)phone|tel|call|mobile|cell|fax|whatsapp|sms",
}
_AGAINST = r"(?i)version|order|\bid\b|\bno\b|\bnr\b|ref|isbn|issn|token|licen|page|section|key|hash|serial"

#: Features with the number of values each can take.
FEATURES = {
    "kind": 4, "digits": 7, "groups": 6, "shape": 4, "first": 4, "last": 4, "seps": 4, "lead": 5,
    "left": 4, "right": 4, "near": 2, "numbers": 2, "variety": 3,
}
# Rows of features that are fitted, at most: the most frequent ones.
FIT_CELLS = 100_000
# Weight of one of the corpus' own candidates as background.
UNLABELLED = 0.2
CONTEXT = 24
ROUNDS, DEPTH, RATE, RIDGE = 40, 3, 0.3, 2.0
# Wanted precision on the calibration part, where positive ones and background weigh the same.
PRECISION = 0.95
# One in so many documents calibrates.
PARTS = 4
# Code points in a piece of a text that is being rebuilt, and elements that are added up together.
PIECE = 4096
BLOCK = 128

_EMPTY = "cast(array() as array<struct<s:int,e:int,t:string,l:string,r:string>>)"


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _luhn(t: Column) -> Column:
    d = _digits(t)

    def step(total: Column, i: Column) -> Column:
        x = F.substring(d, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), step) % 10 == 0


def _valid(kind: str, t: Column) -> Column:
    """The check of a base match."""
    if kind == "ip":
        return t.rlike(_OCTETS)
    if kind == "card":
        return _luhn(t)
    if kind == "phone":
        return F.length(_digits(t)).between(8, 15)
    return F.lit(True)


def _running(df: DataFrame, given: dict[str, Column], zero: int, op: Callable[[Column, Column], Column]) -> DataFrame:
    """Add columns with the running ``op`` of arrays of whole numbers (null stays null).

    Runs inside blocks of ``BLOCK`` elements, then over the blocks, so time grows with the
    elements and not with their square.
    """
    none = F.expr("cast(array() as array<int>)")

    def run(x: Column, before: bool) -> Column:
        def step(acc: Column, v: Column) -> Column:
            at = op(acc["at"], v)
            return F.struct(at.alias("at"), F.concat(acc["out"], F.array(acc["at"] if before else at)).alias("out"))

        return F.aggregate(x, F.struct(F.lit(zero).alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    df = df.withColumns({f"x_{n}": c for n, c in given.items()})
    inside = {}
    for n in given:
        x = F.col(f"x_{n}")
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), partial(lambda x, i: run(F.slice(x, i * BLOCK + 1, F.lit(BLOCK)), False), x))
        inside[f"y_{n}"] = F.when(F.size(x) > 0, cut).when(F.size(x) == 0, F.expr("cast(array() as array<array<int>>)"))
    df = df.withColumns(inside)
    df = df.withColumns({f"z_{n}": run(F.transform(f"y_{n}", lambda y: F.element_at(y, -1)), True) for n in given})
    both = lambda y, c: F.transform(y, lambda v: op(c, v))
    df = df.withColumns({n: F.flatten(F.zip_with(f"y_{n}", f"z_{n}", both)) for n in given})
    return df.drop(*(f"{c}_{n}" for n in given for c in "xyz"))


def _with_matches(df: DataFrame) -> DataFrame:
    """Add ``base_<kind>`` and ``loose_<kind>``: arrays of matches with place and context."""
    mail, numbers = F.col("text").rlike(_MAIL), F.col("text").rlike(_NUMBERS)
    patterns = {f"{how}_{k}": p for how, table in (("base", BASE), ("loose", LOOSE)) for k, p in table.items()}
    df = df.withColumns({"has_mail": mail, "has_numbers": numbers})
    on = {n: F.col("has_mail" if n.endswith("email") else "has_numbers") for n in patterns}
    none = F.expr("cast(array() as array<string>)")
    df = df.withColumns({f"m_{n}": F.when(on[n], F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none) for n, p in patterns.items()})
    df = df.withColumns({f"g_{n}": F.when(F.size(f"m_{n}") > 0, F.split("text", p, -1)).otherwise(none) for n, p in patterns.items()})
    steps = {f"e_{n}": F.when(F.size(f"m_{n}") > 0, F.zip_with(F.slice(f"g_{n}", F.lit(1), F.size(f"m_{n}")), f"m_{n}", lambda g, m: F.length(g) + F.length(m))) for n in patterns}
    df = _running(df, steps, 0, lambda a, b: a + b)

    def placed(n: str) -> Column:
        m, g, e = F.col(f"m_{n}"), F.col(f"g_{n}"), F.col(f"e_{n}")

        def one(i: Column) -> Column:
            left, right = F.substring(g[i], -CONTEXT, CONTEXT), F.substring(g[i + 1], 1, CONTEXT)
            return F.struct((e[i] - F.length(m[i])).alias("s"), e[i].alias("e"), m[i].alias("t"), left.alias("l"), right.alias("r"))

        return F.when(F.size(m) > 0, F.transform(F.sequence(F.lit(0), F.size(m) - 1), one)).otherwise(F.expr(_EMPTY))

    df = df.withColumns({n: placed(n) for n in patterns})
    df = df.withColumns({f"base_{k}": F.filter(f"base_{k}", partial(lambda k, x: _valid(k, x["t"]), k)) for k in KINDS})
    span = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    df = _with_reach(df.withColumn("bases", F.array_sort(F.concat(*(F.transform(f"base_{k}", span) for k in KINDS)))), "bases")
    return df.drop(*(f"{x}_{n}" for n in patterns for x in "mge"), "has_mail", "has_numbers")


def _search(spans: Column, beyond: Callable[[Column], Column]) -> Column:
    """Number of spans, which are in order, before the first that is ``beyond``: by halving."""
    rounds = F.ceil(F.log2(F.size(spans) + 1)).cast("int") + 1

    def halve(acc: Column, _: Column) -> Column:
        mid = ((acc["lo"] + acc["hi"]) / 2).cast("int")
        yes = F.coalesce(beyond(F.get(spans, mid)), F.lit(True))
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & ~yes, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(open_ & yes, mid).otherwise(acc["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    return F.when(F.size(spans) == 0, 0).otherwise(F.aggregate(F.sequence(F.lit(1), rounds), start, halve, lambda acc: acc["lo"]))


def _with_reach(df: DataFrame, spans: str) -> DataFrame:
    """Add ``reach_<spans>``: how far the spans up to each one reach, for spans in order of their starts."""
    return _running(df, {f"reach_{spans}": F.when(F.size(spans) > 0, F.transform(spans, lambda x: x["e"]))}, 0, F.greatest)


def _overlapping(spans: str, c: Column) -> tuple[Column, Column]:
    """Numbers of the first span that can overlap a candidate and of the first one after it."""
    reach = F.when(F.size(spans) == 0, F.expr("cast(array() as array<int>)")).otherwise(F.col(f"reach_{spans}"))
    return _search(reach, lambda x: x > c["s"]), _search(F.col(spans), lambda x: x["s"] >= c["e"])


def _touches(spans: str, c: Column) -> Column:
    """Whether a candidate overlaps one of some spans."""
    before = _search(F.col(spans), lambda x: x["s"] >= c["e"])
    return F.when(F.size(spans) == 0, False).otherwise(F.coalesce(F.get(f"reach_{spans}", before - 1) > c["s"], F.lit(False)))


def _bin(x: Column, *bounds: int) -> Column:
    """How many of the rising bounds ``x`` reaches."""
    return reduce(lambda a, b: a + b, (F.when(x >= b, 1).otherwise(0) for b in bounds))


def _fails(kind: str, c: Column) -> Column:
    """Whether the check of its kind speaks against a candidate."""
    t = c["t"]
    if kind == "email":
        return ~t.rlike(_TLD) | (t.rlike(_PROSE_AT) & ~c["l"].rlike(_FOR[kind]))
    if kind == "ip":
        return ~F.regexp_replace(F.regexp_replace(t, "dot|DOT", "."), "[^0-9.]", "").rlike(_OCTETS)
    if kind == "phone":
        return ~_valid(kind, t) | t.rlike(_NO_PHONE)
    return ~_valid(kind, t)


def _forms(kind: str, t: Column) -> list[Column]:
    """A base match as it reads without its plus, ``@``, dots or usual separators."""
    if kind == "email":
        local, host = F.substring_index(t, "@", 1), F.substring_index(t, "@", -1)
        ways = ((" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "(dot)"), (" [at] ", "."), ("(at)", "."))
        return [F.concat(local, F.lit(at), F.replace(host, F.lit("."), F.lit(dot))) for at, dot in ways]
    if kind == "ip":
        return [F.replace(t, F.lit("."), F.lit(dot)) for dot in ("[.]", "[dot]", " . ")]
    if kind == "card":
        return [F.regexp_replace(_digits(t), "([0-9]{4})(?=[0-9])", "$1" + sep) for sep in (".", "/", "  ")]
    bare = F.regexp_replace(t, r"^\+[0-9]{1,3}[ .-]*", "")
    groups = F.regexp_extract_all(bare, F.lit("[0-9]+"), F.lit(0))
    mixed = F.concat(F.element_at(groups, 1), F.lit("/"), F.array_join(F.slice(groups, F.lit(2), F.size(groups)), "-"))
    return [bare, *(F.array_join(groups, sep) for sep in ("-", ".", " ")), F.when(F.size(groups) > 1, mixed), F.concat(F.lit("00"), F.substring(t, F.lit(2), F.length(t)))]


FORMS = {"email": 5, "ip": 3, "card": 3, "phone": 6}


def _features(kind: str, c: Column) -> dict[str, Column]:
    t, d = c["t"], _digits(c["t"])
    before, after = F.substring(c["l"], -1, 1), F.substring(c["r"], 1, 1)
    first = F.substring(t, 1, 1)

    def beside(x: Column) -> Column:
        return F.when((x == "") | x.rlike(r"\s"), 0).when(x.rlike(r"[\p{L}0-9_]"), 1).when(x.rlike(r"[.,;:!?()'-]"), 2).otherwise(3)

    found = F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))
    sizes = F.transform(found, lambda g: F.length(g))
    kinds = F.size(F.array_distinct(sizes))
    seps = F.regexp_replace(t, r"[^ ./()\[\]{}-]", "")
    shape = F.when(F.size(sizes) < 2, 0).otherwise(_bin(kinds, 1, 2, 3))
    separated = F.when(seps == "", 0).when(seps.rlike(r"^(?: +|-+|\.+)$"), 1).when(seps.rlike(r"^[ ()-]+$"), 2).otherwise(3)
    if kind == "email":
        # how the at and the dots are written
        shape = F.when(t.contains("@"), 0).when(t.rlike(r"[\[({<] ?(?:at|AT)"), 1).otherwise(2)
        separated = F.when(t.rlike(r"[\[({<] ?(?:dot|DOT|\.)"), 1).when(t.rlike(" (?:dot|DOT) "), 2).otherwise(0)
    return {
        "kind": F.lit(KINDS.index(kind)),
        "digits": _bin(F.length(d), 1, 8, 10, 12, 14, 16),
        "groups": _bin(F.size(sizes), 2, 3, 4, 5, 6),
        "shape": shape,
        "first": _bin(F.coalesce(F.try_element_at(sizes, F.lit(1)), F.lit(0)), 2, 3, 4),
        "last": _bin(F.coalesce(F.try_element_at(sizes, F.lit(-1)), F.lit(0)), 3, 4, 5),
        "seps": separated,
        "lead": F.when(first == "+", 0).when(t.startswith("00"), 4).when(first == "(", 1).when(first == "0", 2).otherwise(3),
        "left": beside(before),
        "right": beside(after),
        "near": F.when(c["l"].rlike(_FOR[kind]), 1).otherwise(0),
        "numbers": F.when(c["l"].rlike("[0-9]") | c["r"].rlike("[0-9]"), 1).otherwise(0),
        "variety": _bin(F.size(F.array_distinct(F.split(d, ""))), 3, 5),
    }


def _as_struct(features: dict[str, Column]) -> Column:
    return F.struct(*(v.alias(n) for n, v in features.items()))


def _candidates(kind: str) -> Column:
    """A kind's candidates as ``struct<s, e, f>``: in order, past the generator's filters and apart from all base spans."""

    def passes(c: Column) -> Column:
        return ~(_fails(kind, c) | c["l"].rlike(_AGAINST) | _touches("bases", c))

    return F.transform(F.filter(f"loose_{kind}", passes), lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), _as_struct(_features(kind, c)).alias("f")))


def _own(kind: str) -> Column:
    """Features of a text's candidates."""
    return F.transform(_candidates(kind), lambda c: c["f"])


def _positives(kind: str) -> Column:
    """Features of the loose forms of the base spans that pass the generator's filters."""

    def rewritten(c: Column) -> Column:
        forms = F.transform(F.array(*_forms(kind, c["t"])), lambda t: F.struct(t.alias("t"), c["l"].alias("l"), c["r"].alias("r")))
        return F.filter(forms, lambda x: x["t"].rlike("^(?:" + LOOSE[kind] + ")$") & ~_fails(kind, x))

    every = F.flatten(F.transform(F.filter(f"base_{kind}", lambda c: ~c["l"].rlike(_AGAINST)), rewritten))
    return F.transform(every, lambda x: _as_struct(_features(kind, x)))


def _background(df: DataFrame) -> DataFrame:
    """For every text a short one with numbers that are nobody's: ``part, text``.

    The numbers come from hashes of the text, their kind and separators too, and the words
    around them from two of its places.
    """
    h = lambda k: F.xxhash64("text", F.lit(k))
    pick = lambda k, n: F.pmod(h(k), F.lit(n)).cast("int")
    df = df.select("part", "text", *(F.lpad(F.pmod(h(k), F.lit(10**16)).cast("string"), 16, "7").alias(f"d{k}") for k in (1, 2)), pick(3, 8).alias("how"), pick(4, 3).alias("u"), pick(5, 3).alias("v"), pick(6, 5).alias("w"), pick(7, 6).alias("z"))
    d = F.concat("d1", "d2")
    sep = F.array(*map(F.lit, (" ", "-", "/", ".", "  ")))[F.col("w")]
    count = F.col("u") + 3
    every = F.sequence(F.lit(0), count - 1)
    step = F.array(*map(F.lit, (10, 25, 50, 100, 250, 1024)))[F.col("z")]
    equal = F.transform(every, lambda i: F.substring(d, i * 4 + 1, F.col("v") + 2))
    mixed = F.transform(every, lambda i: F.substring(d, i * 4 + 1, F.substring(d, i * 4 + 2, F.lit(1)).cast("int") % 4 + 1))
    pairs = F.transform(every, lambda i: F.concat_ws("-", F.substring(d, i * 5 + 1, F.col("u") % 2 + 1), F.substring(d, i * 5 + 3, F.col("v") % 2 + 1)))
    multiples = F.transform(every, lambda i: ((i + 1 + F.col("v")) * step).cast("string"))
    years = F.transform(every, lambda i: F.concat(F.when(i % 2 == 0, "19").otherwise("20"), F.substring(d, i * 2 + 1, F.lit(2))))
    quad = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.substring(d, i * 3 + 1, F.col("u") % 2 + 1))
    powers = F.transform(every, lambda i: F.pow(F.lit(2), i + F.col("v") + 6).cast("long").cast("string"))
    number = (
        F.when(F.col("how") == 0, F.array_join(equal, " "))
        .when(F.col("how") == 1, F.concat_ws("", F.transform(equal, lambda g: F.concat(g, sep))))
        .when(F.col("how") == 2, F.concat_ws("", F.transform(mixed, lambda g: F.concat(g, sep))))
        .when(F.col("how") == 3, F.array_join(pairs, " "))
        .when(F.col("how") == 4, F.array_join(multiples, " "))
        .when(F.col("how") == 5, F.array_join(F.when(F.col("w") % 2 == 0, years).otherwise(powers), " "))
        .when(F.col("how") == 6, F.substring(d, F.lit(1), F.col("w") + 12))
        .otherwise(F.array_join(quad, " . "))
    )
    words = lambda k: F.trim(F.regexp_replace(F.substring(F.col("text"), F.pmod(h(k), F.greatest(F.length("text"), F.lit(1))).cast("int"), F.lit(CONTEXT)), r"[^\p{L} ,.:;]", " "))
    return df.select("part", F.concat(words(8), F.lit(" "), F.rtrim(F.regexp_replace(number, r"[-/.]+$", "")), F.lit(" "), words(9)).alias("text"))


class Boosted:
    """Boosted trees over cells of features, with a threshold."""

    def __init__(self, cells: list[dict]):
        """``cells``: features, ``label`` (2 positive, 1 unlabelled, 0 background), ``part`` and count ``n`` of each cell."""
        self.trees: list[tuple] = []
        self.start = 0.0
        self.threshold: float | None = None
        if not cells:
            return
        x = np.array([[c[f] for f in FEATURES] for c in cells])
        label = np.array([c["label"] for c in cells])
        y = (label == 2).astype(float)
        # the forms of one base span count as one; background weighs as much as they do
        w = np.array([c["n"] / (FORMS[KINDS[c["kind"]]] if c["label"] == 2 else 1) for c in cells])
        fit = np.array([c["part"] != 0 for c in cells])
        for part in (fit, ~fit):
            made = part & (label == 0)
            w[made] *= w[part & (label == 2)].sum() / max(w[made].sum(), 1e-9)
        w[label == 1] *= UNLABELLED
        if not (w[fit] * y[fit]).sum():
            return
        total = np.zeros(len(y))
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-total))
            g, h = np.where(fit, w * (y - p), 0), np.where(fit, w * p * (1 - p), 0)
            tree = self._grow(x, g, h, np.ones(len(y), bool), DEPTH)
            if tree[0] == "leaf":
                break
            self.trees.append(tree)
            total += self._value(tree, x)
        held = ~fit & (label != 1)
        self.threshold = self._threshold(total[held], y[held], w[held])

    def features_used(self) -> set[str]:
        """Names of the features that the trees split on."""
        names = list(FEATURES)

        def walk(tree: tuple) -> set[str]:
            return set() if tree[0] == "leaf" else {names[tree[1]]} | walk(tree[3]) | walk(tree[4])

        return set().union(*map(walk, self.trees))

    @staticmethod
    def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, here: np.ndarray, depth: int) -> tuple:
        leaf = ("leaf", RATE * float(g[here].sum() / (h[here].sum() + RIDGE)))
        best, gain = None, 1e-6
        if depth:
            worth = lambda m: g[m].sum() ** 2 / (h[m].sum() + RIDGE)
            for f, values in enumerate(FEATURES.values()):
                for v in range(values):
                    for test in ("le", "eq"):
                        yes = here & ((x[:, f] <= v) if test == "le" else (x[:, f] == v))
                        no = here & ~yes
                        if yes.any() and no.any() and (more := worth(yes) + worth(no) - worth(here)) > gain:
                            best, gain = (test, f, v, yes, no), more
        if best is None:
            return leaf
        test, f, v, yes, no = best
        return (test, f, v, Boosted._grow(x, g, h, yes, depth - 1), Boosted._grow(x, g, h, no, depth - 1))

    @staticmethod
    def _value(tree: tuple, x: np.ndarray) -> np.ndarray:
        if tree[0] == "leaf":
            return np.full(len(x), tree[1])
        yes = x[:, tree[1]] <= tree[2] if tree[0] == "le" else x[:, tree[1]] == tree[2]
        return np.where(yes, Boosted._value(tree[3], x), Boosted._value(tree[4], x))

    @staticmethod
    def _threshold(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> float | None:
        """The lowest score from which on the precision is as wanted, or none.

        Half an example of background is always taken to be there, so that precision on few
        examples is no claim.
        """
        found = None
        for s in sorted(set(score.tolist()), reverse=True):
            at = score >= s
            right = (w[at] * y[at]).sum()
            if right / (w[at].sum() + 0.5) >= PRECISION:
                found = s
        return None if found is None else max(found, 0.0)

    def score(self, f: Column) -> Column:
        """Log odds of a candidate from its struct of features."""
        names = list(FEATURES)

        def case(tree: tuple) -> Column:
            if tree[0] == "leaf":
                return F.lit(tree[1])
            at = f[names[tree[1]]]
            return F.when(at <= tree[2] if tree[0] == "le" else at == tree[2], case(tree[3])).otherwise(case(tree[4]))

        return reduce(lambda a, b: a + b, (case(t) for t in self.trees), F.lit(self.start))

    def selects(self, c: Column) -> Column:
        """Whether a scored candidate reaches the threshold."""
        return F.lit(False) if self.threshold is None else c["score"] >= self.threshold - 1e-9


def _rows(docs: DataFrame, text_col: str, **keep: Column) -> DataFrame:
    return docs.select(*(v.alias(n) for n, v in keep.items()), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fit(docs: DataFrame, text_col: str = "text") -> Boosted:
    """Learn from all texts of ``docs``."""
    rows = _rows(docs, text_col, part=F.when(F.pmod(F.xxhash64(text_col), F.lit(PARTS)) == 0, 0).otherwise(1))

    def examples(df: DataFrame, *of: tuple[Callable[[str], Column], int]) -> DataFrame:
        every = [F.transform(f(k), partial(lambda n, x: F.struct(x.alias("f"), F.lit(n).alias("label")), n)) for f, n in of for k in KINDS]
        return _with_matches(df).select("part", F.explode(F.concat(*every)).alias("c")).select("part", "c.f.*", "c.label")

    found = examples(rows, (_positives, 2), (_own, 1)).union(examples(_background(rows), (_own, 0)))
    cells = found.groupBy("part", *FEATURES, "label").agg(F.count("*").alias("n"))
    return Boosted([r.asDict() for r in cells.orderBy(F.desc("n"), "part", *FEATURES, "label").limit(FIT_CELLS).collect()])


def _with_spans(df: DataFrame, model: Boosted) -> DataFrame:
    """Add ``span_<kind>``: base and added spans by start, next to ``base_<kind>``."""
    df = _with_matches(df)
    span = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    plain = {k: F.transform(f"base_{k}", span) for k in KINDS}
    if model.threshold is None:
        return df.withColumns({f"span_{k}": plain[k] for k in KINDS})
    df = df.withColumn("proposed", F.concat(*(_candidates(k) for k in KINDS)))
    scored = lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["f"]["kind"].alias("kind"), model.score(c["f"]).alias("score"))
    df = df.withColumn("chosen", F.array_sort(F.filter(F.transform("proposed", scored), model.selects)))
    df = _with_reach(df, "chosen")
    rank = lambda c: F.struct(-c["score"], c["s"], c["e"], c["kind"])

    def best(c: Column) -> Column:
        """Whether no better candidate overlaps: those that can are next to each other."""
        a, b = _overlapping("chosen", c)
        near = F.slice("chosen", a + 1, F.greatest(b - a, F.lit(0)))
        return ~F.exists(near, lambda o: (o["s"] < c["e"]) & (o["e"] > c["s"]) & (rank(o) < rank(c)))

    df = df.withColumn("added", F.when(F.size("chosen") > 1, F.filter("chosen", best)).otherwise(F.col("chosen")))
    own = {k: F.transform(F.filter("added", partial(lambda i, c: c["kind"] == i, i)), span) for i, k in enumerate(KINDS)}
    return df.withColumns({f"span_{k}": F.array_sort(F.concat(plain[k], own[k])) for k in KINDS})


def _listed(prefix: str) -> Column:
    """``kind:start:end`` of all spans, by kind and start, joined by commas."""
    parts = [F.transform(f"{prefix}_{k}", partial(lambda k, x: F.concat_ws(":", F.lit(k), x["s"].cast("string"), x["e"].cast("string")), k)) for k in KINDS]
    return F.concat_ws(",", F.concat(*parts))


def find(docs: DataFrame, model: Boosted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every text: ``doc_id, n_<kind> (base), base_sha256, spans, n_added``."""
    df = _with_spans(_rows(docs, text_col, doc_id=F.col(id_col)), model)
    count = lambda p: reduce(lambda a, b: a + b, (F.size(f"{p}_{k}") for k in KINDS))
    return df.select(
        "doc_id",
        *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("span").alias("spans"),
        (count("span") - count("base")).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, model: Boosted, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>``; overlapping spans become one."""
    columns = docs.columns
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = _with_spans(df, model)
    every = F.concat(*(F.transform(f"span_{k}", partial(lambda k, x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(k.upper()).alias("k")), k)) for k in KINDS))
    df = df.withColumn("every", F.array_sort(every))

    # spans that overlap become one: it begins where no earlier span reaches, and ends at the farthest reach
    df = _with_reach(df, "every")
    free = F.filter(F.sequence(F.lit(0), F.size("every") - 1), lambda i: (i == 0) | (F.get("reach_every", i - 1) <= F.col("every")[i]["s"]))
    df = df.withColumn("begins", F.when(F.size("every") > 0, free))
    n = F.size("begins")

    def merged(x: Column, j: Column) -> Column:
        until = F.when(j + 1 < n, F.get("begins", j + 1)).otherwise(F.size("every"))
        one = F.col("every")[x]
        return F.struct(one["s"].alias("s"), F.col("reach_every")[until - 1].alias("e"), one["k"].alias("k"))

    df = df.withColumn("spans", F.transform("begins", merged))
    # pieces of equal length make a place in a long text cheap to reach
    df = df.withColumn("pieces", F.when(F.size("every") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))
    df = df.withColumn("size", F.length("text"))

    def cut(a: Column, b: Column) -> Column:
        """Code points a to b of the text."""
        p = F.col("pieces")
        i, j = (a / PIECE).cast("int"), (b / PIECE).cast("int")
        tail = F.when(b % PIECE > 0, F.substring(p[j], F.lit(1), b % PIECE)).otherwise("")
        apart = F.concat(F.substring(p[i], a % PIECE + 1, F.lit(PIECE)), F.array_join(F.slice(p, i + 2, j - i - 1), ""), tail)
        return F.when(a >= b, "").when(i == j, F.substring(p[i], a % PIECE + 1, b - a)).otherwise(apart)

    def tagged(x: Column, i: Column) -> Column:
        before = F.when(i == 0, 0).otherwise(F.col("spans")[F.greatest(i - 1, F.lit(0))]["e"])
        return F.concat(cut(before, x["s"]), F.lit("<"), x["k"], F.lit(">"))

    rebuilt = F.concat(F.array_join(F.transform("spans", tagged), ""), cut(F.element_at("spans", -1)["e"], F.col("size")))
    df = df.withColumn("clean", F.when(F.size("every") > 0, rebuilt).otherwise(F.col(f"row.`{text_col}`")))
    return df.select(*(F.col("clean").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns))
