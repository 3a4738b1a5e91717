"""Personal data in texts, with DataFrame and SQL functions only.

Strict patterns find the base spans, which always stay. Wide generators propose more spans, which may
overlap; each gets a set of yes-or-no features of its format and its context. Boosted trees, learned
on the counts of feature sets, tell how likely a proposal is to be personal data, and a threshold
calibrated on proposals that were not learned from selects the ones that are added.

There are no labels, so examples are made. Personal data are the base spans, the same values written
in ways that the base patterns miss (``DISGUISES``), and proposals of a valid format after a word that
announces their kind. Look-alikes are all other proposals, and base values spoilt so that their check
digit or number range is wrong (``SPOILT``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Repeats that can give nothing back are possessive, and a match begins at the
#: first place of a run that it could begin in, so each text is read once; neither changes a match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which there is no match: texts that lack it are not searched.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: What proposes further spans of each kind.
PROPOSALS = {
    "email": r"(?:\G|(?<![^\s@<>()\[\],;:\"|]))[^\s@<>()\[\],;:\"|]++(?:@| ?[(\[]at[)\]] ?)[^\s@<>()\[\],;:\"|]++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:(?:[.,:]|\[\.\])[0-9]++){3}",
    "card": r"[0-9](?:[\x20./_-]?[0-9])++",
    "phone": r"[+(]?[0-9](?:[\x20()./-]{0,3}[0-9])++",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Words that announce each kind, shortly before it.
CONTEXT = {
    "email": r"(?i)\b(?:e-?mails?|mail me|contact|write to|reach me)\b[^\n]{0,8}$",
    "ip": r"(?i)\b(?:ip|ip address|host|server|ping|ssh)\b[^\n]{0,8}$",
    "card": r"(?i)\b(?:card|credit|debit|visa|mastercard|amex)\b[^\n]{0,10}$",
    "phone": r"(?i)\b(?:call|tel|phone|fax|mobile|cell|whatsapp)\b[^\n]{0,8}$",
}
#: Other ways to write a value of each kind: (pattern, what takes its place).
DISGUISES = {
    "email": [("@", " (at) "), ("@", "[at]")],
    "ip": [(r"\.", "[.]")],
    "card": [("[ -]", ""), ("[ -]?([0-9]{4})(?=[ -]?[0-9])", "$1."), ("[ -]?([0-9]{4})(?=[ -]?[0-9])", "$1_")],
    "phone": [(r"^\+", ""), (r"^\+", "00"), (r"^\+|[()]", ""), (r"\+?([0-9]+)[ ().-]+(?=[0-9])", "$1/")],
}
#: What makes a look-alike of a value: a wrong check digit or range, a version number, plain digits.
SPOILT = {
    "email": [(r"\.[A-Za-z]+$", ".9"), (r"@.*", "@1x2.3")],
    "ip": [(r"^[0-9]+", "999"), (r"^[0-9]+\.[0-9]+", "1.0"), (r"\.", ","), (r"\.", ":")],
    "card": [("0$", "7"), ("[1-9]$", "0"), ("[0-9]{4}$", "")],
    "phone": [(r"^\+|[^0-9]", ""), (r"^\+([0-9]+).*", "$1 12 1999"), ("[0-9]{4}$", "")],
}
FEATURES = 16


@dataclass(frozen=True)
class Boosting:
    trees: int = 80
    rate: float = 0.3
    ridge: float = 1.0
    precision: float = 0.98  # of the examples at or above the threshold that are neither base spans nor learned from
    least: int = 20  # of these there must be at least so many
    weakest: float = 0.9  # precision of a feature set by itself, where the threshold may not go below it


_NONE = "array<struct<start:int,end:int,value:string>>"


def marked(text: Column, pattern: str) -> Column:
    """The text before the first match, and from there on each match, a mark and what follows it."""
    return F.split(F.regexp_replace(text, f"(?:{pattern})", "\x01$0\x02"), "\x01")


def matches(pieces: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points, end exclusive."""

    def add(done: Column, piece: Column) -> Column:
        value = F.substring_index(piece, "\x02", 1)
        end = done["at"] + F.length(value)
        return F.struct((end + F.length(piece) - F.length(value) - 1).alias("at"), F.concat(done["spans"], F.array(F.struct(done["at"].alias("start"), end.alias("end"), value.alias("value")))).alias("spans"))

    start = F.struct(F.length(F.element_at(pieces, 1)).alias("at"), F.array().cast(_NONE).alias("spans"))
    return F.when(F.size(pieces) > 1, F.aggregate(F.slice(pieces, 2, F.size(pieces)), start, add)["spans"]).otherwise(F.array().cast(_NONE))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    return F.call_function("luhn_check", _digits(value))


def _octets(value: Column) -> Column:
    return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


def valid(kind: str, value: Column) -> Column:
    """What a match of the base pattern must be besides."""
    n = F.length(_digits(value))
    return {"email": F.lit(True), "ip": _octets(value), "card": n.between(13, 19) & _luhn(value), "phone": n.between(9, 15)}[kind]


def _valid(kind: str):
    return lambda x: valid(kind, x["value"])


def _before(text: Column, x: Column) -> Column:
    return F.substring(text, F.greatest(F.lit(1), x["start"] - 23), F.least(F.lit(24), x["start"]))


def _features(text: Column, kind: str, x: Column) -> Column:
    """A whole number with a bit for each feature."""
    value, n = x["value"], F.length(_digits(x["value"]))
    before, after = _before(text, x), F.substring(text, x["end"] + 1, F.lit(1))
    dotted, numeric = F.replace(value, F.lit("[.]"), F.lit(".")), F.lit(kind != "email")
    tests = [
        F.lit(KINDS.index(kind) % 2 == 1), F.lit(KINDS.index(kind) >= 2), value.rlike(r"^(?:[0-9]{4}[^0-9]?){3}[0-9]+$"), numeric & n.between(9, 15), numeric & n.between(13, 19), numeric & _luhn(value), _octets(dotted), value.rlike(r"^(?:\+|00)"),
        value.rlike(r"(?:@| ?[(\[]at[)\]] ?)[A-Za-z0-9.-]*[A-Za-z0-9-]\.[A-Za-z]{2,}$"), dotted.rlike(r"^(?:0|1)\."), value.rlike(r"[,:]"), numeric & value.rlike(r"[0-9][^0-9]+[0-9]"), numeric & value.rlike(r"^\+?[0-9]*[^0-9]*\(|[0-9]{3}[^0-9]+[0-9]{3}[^0-9]+[0-9]{4}$"), before.rlike(CONTEXT[kind]), before.rlike(r"[\w=#/.]$"), after.rlike(r"^[\w=#/]"),
    ]
    return sum((F.when(F.coalesce(t, F.lit(False)), 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0)).cast("int")


def _announced(text: Column, kind: str, x: Column) -> Column:
    """Whether a word before the span announces its kind, and it could be of it."""
    return _before(text, x).rlike(CONTEXT[kind]) & F.coalesce({"email": x["value"].rlike(r"[A-Za-z0-9-]\.[A-Za-z]{2,}$"), "ip": _octets(F.replace(x["value"], F.lit("[.]"), F.lit(".")))}.get(kind, valid(kind, x["value"])), F.lit(False))


def _half(x: Column) -> Column:
    return F.pmod(F.xxhash64(x["value"]), F.lit(2)).cast("int")


def _proposed(text: Column, kind: str) -> Column:
    """The proposals of a kind."""
    plausible = lambda x: F.length(_digits(x["value"])).between(7, 24)
    found = matches(f"pii_wide_{kind}")
    found = F.filter(found, plausible) if kind in ("card", "phone") else found
    place = lambda x: F.shiftleft(x["start"].cast("long"), 32) + x["end"]
    same = lambda x: F.array_contains(F.col(f"pii_places_{kind}"), place(x))
    return F.transform(found, lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), _features(text, kind, x).alias("features"), same(x).alias("known"), _announced(text, kind, x).alias("announced"), _half(x).alias("half")))


def _made(text: Column, kind: str) -> Column:
    """Examples made of the base spans of a kind: struct<features, good, half>; those that change nothing are left out."""

    def made(x: Column) -> Column:
        ways = [(w, good) for good, all_ways in ((True, DISGUISES), (False, SPOILT)) for w in all_ways[kind]]
        changed = F.array(*[F.struct(x["start"].alias("start"), x["end"].alias("end"), F.regexp_replace(x["value"], pattern, to).alias("value"), F.lit(good).alias("good")) for (pattern, to), good in ways])
        changed = F.filter(changed, lambda y: y["value"] != x["value"])
        return F.transform(changed, lambda y: F.struct(_features(text, kind, y).alias("features"), y["good"].alias("good"), _half(x).alias("half")))

    return F.flatten(F.transform(f"pii_{kind}", made))


def _of_kind(array: str, number: int) -> Column:
    return F.transform(array, lambda x: F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def count(array: str, kind: str) -> Column:
    return F.size(F.filter(array, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with pii_base, pii_proposed (features, known, announced and half of each proposal) and pii_made (examples made of base spans).

    known tells that a proposal is one of the base spans, announced that a word before it names its
    kind and its format is valid; half is 0 or 1 by a hash of its text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marks = text.contains("\x01") | text.contains("\x02")
    rows = docs.withColumn("pii_text", F.when(marks, F.translate(text, "\x01\x02", "\x03\x03")).otherwise(text))
    text, none = F.col("pii_text"), F.array(F.lit(""))
    # Marked texts are columns of their own, so that each pattern runs once over a text, and only
    # where there is a character without which there is no match.
    for kind in KINDS:
        needed = text.contains(NEEDS[kind]) if NEEDS[kind] else text.rlike("[0-9]")
        rows = rows.withColumn(f"pii_strict_{kind}", F.when(needed, marked(text, BASE[kind])).otherwise(none))
        rows = rows.withColumn(f"pii_wide_{kind}", F.when(text.rlike(r"@|[(\[]at[)\]]") if kind == "email" else text.rlike("[0-9]"), marked(text, PROPOSALS[kind])).otherwise(none))
    for kind in KINDS:
        rows = rows.withColumn(f"pii_{kind}", F.filter(matches(f"pii_strict_{kind}"), _valid(kind)))
    for kind in KINDS:
        rows = rows.withColumn(f"pii_places_{kind}", F.transform(f"pii_{kind}", lambda x: F.shiftleft(x["start"].cast("long"), 32) + x["end"]))
        rows = rows.withColumn(f"pii_more_{kind}", _proposed(text, kind)).withColumn(f"pii_made_{kind}", _made(text, kind))
    base = F.concat(*[_of_kind(f"pii_{k}", i) for i, k in enumerate(KINDS)])
    return rows.withColumn("pii_base", base).withColumn("pii_proposed", F.concat(*[F.col(f"pii_more_{k}") for k in KINDS])).withColumn("pii_made", F.concat(*[F.col(f"pii_made_{k}") for k in KINDS])).drop("pii_text", *[f"pii_{x}{k}" for x in ("", "more_", "made_", "places_", "strict_", "wide_") for k in KINDS])


@dataclass
class Trees:
    """Each tree looks at one or two features: (first, second, value for each of the four answers)."""

    trees: list[tuple[int, int, tuple[float, float, float, float]]]
    start: float
    threshold: float

    def score(self, features: int) -> float:
        return self.start + sum(v[(features >> a & 1) * 2 + (features >> b & 1)] for a, b, v in self.trees)

    def column(self, features: Column) -> Column:
        bit = lambda i: features.bitwiseAND(1 << i) != 0
        leaf = lambda a, b, v: F.when(bit(a), F.when(bit(b), v[3]).otherwise(v[2])).otherwise(F.when(bit(b), v[1]).otherwise(v[0]))
        return sum((leaf(a, b, v) for a, b, v in self.trees), F.lit(self.start))


def fit(found: DataFrame, boosting: Boosting | None = None) -> Trees:
    """Trees learned on the examples of ``found``, by half of their values; the other half sets the threshold.

    Examples are counted by their feature set, of which there are at most 2^16 however many
    documents there are; only these counts come to the driver. Base spans are learned from, but do
    not count for the threshold, which is for what they leave out.
    """
    boosting = boosting or Boosting()
    proposed = F.transform("pii_proposed", lambda x: F.struct(x["features"].alias("features"), (x["known"] | x["announced"]).alias("good"), x["half"].alias("half"), x["known"].alias("known")))
    made = F.transform("pii_made", lambda x: F.struct(x["features"].alias("features"), x["good"].alias("good"), x["half"].alias("half"), F.lit(False).alias("known")))
    each = found.select(F.explode(F.concat(proposed, made)).alias("x")).select("x.*").where((F.col("half") == 0) | ~F.col("known"))
    counted = each.groupBy("features").agg(*[F.count_if((F.col("half") == h) & (F.col("good") == bool(g))).alias(f"n{h}{g}") for h in (0, 1) for g in (0, 1)])
    rows = [(r["features"], r["n00"], r["n01"], r["n10"], r["n11"]) for r in counted.orderBy("features").collect()]
    positive, total = sum(r[2] for r in rows), sum(r[1] + r[2] for r in rows)
    start = math.log((positive + 1) / (total - positive + 1))
    score, trees = {r[0]: start for r in rows}, []
    for _ in range(boosting.trees if rows else 0):
        best = (1e-6, None)
        chance = {f: 1 / (1 + math.exp(-score[f])) for f in score}
        slope = [(f, n1 * (1 - chance[f]) - n0 * chance[f], (n0 + n1) * chance[f] * (1 - chance[f])) for f, n0, n1, _, _ in rows]
        # Sums over the rows that have both features of a pair; those of the other three answers follow from totals.
        both = {(a, b): [0.0, 0.0] for a in range(FEATURES) for b in range(a + 1)}
        all_up, all_weight = sum(x[1] for x in slope), sum(x[2] for x in slope)
        for f, up, weight in slope:
            bits = [i for i in range(FEATURES) if f >> i & 1]
            for i, a in enumerate(bits):
                for b in bits[: i + 1]:
                    sums = both[a, b]
                    sums[0] += up
                    sums[1] += weight
        for (a, b), (up, weight) in both.items():
            (up_a, weight_a), (up_b, weight_b) = both[a, a], both[b, b]
            g = [all_up - up_a - up_b + up, up_b - up, up_a - up, up]
            h = [x + boosting.ridge for x in (all_weight - weight_a - weight_b + weight, weight_b - weight, weight_a - weight, weight)]
            gain = sum(x * x / y for x, y in zip(g, h, strict=True))
            if gain > best[0] + 1e-9:
                best = (gain, (a, b, tuple(boosting.rate * x / y for x, y in zip(g, h, strict=True))))
        if best[1] is None:
            break
        a, b, v = best[1]
        trees.append(best[1])
        score = {f: s + v[(f >> a & 1) * 2 + (f >> b & 1)] for f, s in score.items()}
    # The lowest score down to which the examples not learned from are personal data often enough, all together and each set by itself.
    threshold, good, seen = math.inf, 0, 0
    for s, n0, n1 in sorted(((score[r[0]], r[3], r[4]) for r in rows if r[3] + r[4]), reverse=True):
        good, seen = good + n1, seen + n0 + n1
        if n1 < boosting.weakest * (n0 + n1) or good < boosting.precision * seen:
            break
        if seen >= boosting.least:
            threshold = s
    return Trees(trees, start, threshold)


def spans(found: DataFrame, trees: Trees) -> DataFrame:
    """found with pii_spans, array<struct<kind, start, end>> in order: base spans, and the selected proposals that touch none.

    Of selected proposals that overlap the likeliest stays, of equally likely ones the first kind's.
    """
    meet = lambda x, y: (y["start"] < x["end"]) & (x["start"] < y["end"])
    picked = F.array().cast("array<struct<kind:int,start:int,end:int,score:double>>")
    if not math.isinf(trees.threshold):
        free = F.filter("pii_proposed", lambda x: ~x["known"] & ~F.exists("pii_base", lambda y: meet(x, y)))
        picked = F.filter(F.transform(free, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), trees.column(x["features"]).alias("score"))), lambda x: x["score"] >= F.lit(trees.threshold - 1e-9))
    found = found.withColumn("pii_picked", picked)
    better = lambda x, y: (y["score"] > x["score"]) | ((y["score"] == x["score"]) & (F.struct(y["kind"], y["start"]) < F.struct(x["kind"], x["start"])))
    best = F.filter("pii_picked", lambda x: ~F.exists("pii_picked", lambda y: meet(x, y) & better(x, y)))
    plain = F.transform(best, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.withColumn("pii_spans", F.array_sort(F.concat("pii_base", plain))).drop("pii_picked")


def digest(array: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _found(docs: DataFrame, keep: list[str], boosting: Boosting | None, text_col: str) -> DataFrame:
    """(pii_row, pii_base, pii_spans): the columns ``keep`` of docs as structs, so that they meet no others."""
    row = F.struct(*([F.col(f"`{c}`") for c in keep] or [F.lit(True).alias("nothing")]))
    rows = docs.select(row.alias("pii_row"), F.col(text_col).cast("string").alias("pii_read"))
    found = common.written(candidates(rows, "pii_read").drop("pii_read"), "pii")
    return spans(found, fit(found, boosting)).select("pii_row", "pii_base", "pii_spans")


def find(docs: DataFrame, boosting: Boosting | None = None, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of docs, all if none are named, with pii_base and pii_spans: the personal data of each whole text.

    Null texts count as empty and have none. Every row is searched on its own, so repeated and
    null ids stay; an empty table gives no rows. The trees are learned on the same documents. A
    column of docs called pii_base or pii_spans is not kept, any other name is free.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in ("pii_base", "pii_spans")]
    found = _found(docs, keep, boosting, text_col)
    return found.select(*[F.col(f"pii_row.`{c}`") for c in keep], "pii_base", "pii_spans")


def clean(docs: DataFrame, boosting: Boosting | None = None, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with each text's personal data replaced by its kind in brackets, and ``length_col``, if named, the new length.

    All columns stay under their names, whatever these are; null texts stay null, as do all else as in ``find``.
    """
    found = _found(docs, docs.columns, boosting, text_col)
    text = redacted(found, f"pii_row.`{text_col}`")
    changed = {text_col: text.alias(text_col)} | ({length_col: F.length(text).cast(docs.schema[length_col].dataType).alias(length_col)} if length_col else {})
    return found.select(*[changed.get(c, F.col(f"pii_row.`{c}`")) for c in docs.columns])


def redacted(found: DataFrame, text_col: str = "text") -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced together."""
    by_place = F.array_sort(F.transform("pii_spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    name = lambda x: F.concat(F.lit("["), F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), F.lit("]"))
    text = F.col(text_col)

    def add(done: Column, x: Column) -> Column:
        new = F.concat(done["out"], F.substring(text, done["at"] + 1, x["start"] - done["at"]), name(x))
        return F.struct(F.greatest(done["at"], x["end"]).alias("at"), F.when(x["start"] >= done["at"], new).otherwise(done["out"]).alias("out"))

    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size("pii_spans") > 0, F.aggregate(by_place, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add, rest)).otherwise(text)
