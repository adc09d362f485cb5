r"""Personal data by weak supervision: labelers vote on candidate spans.

Candidates are the base kinds (email, ip, card, phone) and two looser ones
(phone numbers without a plus sign, national ids). Four labelers vote on each: its shape, a gazetteer
(top-level domains, calling codes, issuer prefixes, reserved ranges), words
before it, and its make-up. Expectation-maximisation over the counts of vote
patterns of all documents estimates the labelers' reliability per kind; its
posteriors are the soft labels of a logistic span classifier over all kinds,
which decides on looser candidates. Base spans always stay.

Only DataFrame functions touch the texts. Spans come from two calls per
pattern: the matches, and the pieces between them, whose lengths in code points
add up to the positions. The patterns are written so that Java's matcher needs
no recursion and no second look at a run: possessive groups, and a look-behind
that starts a match only where a run starts (or the previous match ended).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.weak import estimate, logistic

KINDS = ("email", "ip", "card", "phone", "local_phone", "national_id")
BASE = 4  # the first kinds are base kinds
CONTEXT = 40  # code points before a span that the context labeler reads

_LOCAL = "A-Za-z0-9._%+-"
_PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9+])(?<![0-9+][ ().-])(?:\([0-9]{3}\) |[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])(?![ .-][0-9])",
    "national_id": r"(?<![0-9])(?<![0-9][ .-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])(?![ .-][0-9])",
}
# A text without these has no match: a cheap test before the pattern.
_NEEDS = {"email": "@", "phone": "+"}

# Fixed values of the gazetteer labeler.
_DOMAINS = "com org net edu gov io info biz co de fr es uk us eu ca au jp cn in it nl ch at be se".split()
_CALLING = "1 7 20 27 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 55 61 64 65 81 82 86 90 91".split()
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
# Fixed values of the context labeler: words before a span, lower case.
_FOR = {
    "email": "mail|contact|write|reach",
    "ip": "ip|host|server|address|addr",
    "card": "card|visa|credit|debit|payment",
    "phone": "call|phone|tel|mobile|cell|fax|contact",
    "local_phone": "call|phone|tel|mobile|cell|fax|contact",
    "national_id": "ssn|social|security|insurance|identity",
}
_AGAINST = "version|release|section|chapter|isbn|issn|doi|figure|table|part no|serial"


def _matches(text: Column, kind: str) -> Column:
    """array<struct<start, kind, end, match, before>> of one pattern, in order."""
    pattern = F.lit(_PATTERNS[kind])
    found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, _PATTERNS[kind], -1)
    number = F.lit(KINDS.index(kind))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")

    def place(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(state["gaps"], i))
        match = F.get(state["found"], i)
        end = start + F.length(match)
        row = F.struct(start.alias("start"), number.alias("kind"), end.alias("end"), match.alias("match"))
        return F.struct(
            end.alias("at"), state["gaps"].alias("gaps"), state["found"].alias("found"),
            F.concat(state["rows"], F.array(row)).alias("rows"),
        )

    start = F.struct(
        F.lit(0).alias("at"), between.alias("gaps"), found.alias("found"), empty.alias("rows")
    )
    placed = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, place, lambda s: s["rows"])
    likely = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else F.rlike(text, pattern)
    return F.when(likely & F.rlike(text, pattern), placed).otherwise(empty)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    reversed_ = F.reverse(_digits(match))
    at = F.sequence(F.lit(1), F.length(reversed_))

    def value(i: Column) -> Column:
        d = reversed_.substr(i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(at, F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _valid(span: Column) -> Column:
    """The checks a match must pass to be a candidate of its kind."""
    match, kind = span["match"], span["kind"]
    digits = F.length(_digits(match))
    low = F.rlike(match, F.lit(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"))
    return (
        F.when(kind == 1, low)
        .when(kind == 2, _luhn(match))
        .when(kind == 3, (digits >= 10) & (digits <= 15))
        .otherwise(True)
    )


def candidates(text: Column) -> Column:
    """All candidate spans of a text by start, then kind; looser ones only where no base span lies."""
    arrays = [F.filter(_matches(text, k), _valid) for k in KINDS]
    return F.array_sort(F.concat(*arrays))


def _without_overlap(spans: Column) -> Column:
    base = F.filter(spans, lambda s: s["kind"] < BASE)
    free = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return F.filter(spans, lambda s: (s["kind"] < BASE) | free(s))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(text: Column, span: Column) -> list[Column]:
    """The four labelers' votes on a span."""
    match, kind = span["match"], span["kind"]
    digits = _digits(match)
    same = F.rlike(digits, F.lit(r"^([0-9])\1*$"))
    tail = F.lower(F.element_at(F.split(match, "\\."), -1))
    shape = (
        F.when(kind == 0, _vote(F.rlike(match, F.lit(r"^[A-Za-z0-9].*@.*\.[A-Za-z]{2,}$")), F.lit(True)))
        .when(kind == 1, _vote(~F.rlike(match, F.lit(r"(^|\.)0[0-9]")), F.lit(True)))
        .when(kind == 2, _vote(F.rlike(match, F.lit(r"^([0-9]{4}[ -]?){3}[0-9]{1,7}$")), F.lit(False)))
        .when(kind == 3, _vote(F.rlike(match, F.lit(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]")), F.lit(True)))
        .otherwise(1)
    )
    gazetteer = (
        F.when(kind == 0, _vote(tail.isin(*_DOMAINS), F.rlike(tail, F.lit("^[0-9]+$"))))
        .when(kind == 1, _vote(~F.rlike(match, F.lit(r"^(0|10|127|22[4-9]|2[3-5][0-9])\.|^192\.168\.")), F.lit(True)))
        .when(kind == 2, _vote(F.rlike(digits, F.lit(_ISSUERS)), F.lit(False)))
        .when(kind == 3, _vote(F.rlike(digits, F.lit(f"^(?:{'|'.join(_CALLING)})")), F.lit(False)))
        .when(kind == 4, _vote(F.rlike(digits, F.lit("^[2-9][0-9]{2}[2-9]")), F.lit(True)))
        .otherwise(_vote(~F.rlike(digits, F.lit("^(000|666|9)")), F.lit(True)))
    )
    before = F.lower(text.substr(F.greatest(span["start"] - CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT))))
    for_ = F.lit(False)
    for i, k in enumerate(KINDS):
        for_ = F.when(kind == i, F.rlike(before, F.lit(rf"\b(?:{_FOR[k]})"))).otherwise(for_)
    context = _vote(for_, F.rlike(before, F.lit(rf"\b(?:{_AGAINST})")))
    makeup = F.when(kind == 0, _vote(F.length(match) <= 64, F.lit(True))).otherwise(_vote(~same, F.lit(True)))
    return [v.cast("int") for v in (shape, gazetteer, context, makeup)]


@dataclass(frozen=True)
class Classifier:
    """Weights: one bias per kind, then one weight per labeler."""

    weights: tuple[float, ...]

    def accepts(self, kind: Column, votes_: list[Column]) -> Column:
        if not self.weights:
            return F.lit(False)
        z = F.lit(self.weights[-1])
        for i in range(len(KINDS)):
            z = z + F.when(kind == i, self.weights[i]).otherwise(0.0)
        for w, v in zip(self.weights[len(KINDS) : -1], votes_):
            z = z + F.lit(w) * v
        return z >= 0


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    """Reliabilities and classifier from the vote patterns of all documents' candidates.

    At most 6 x 81 pattern counts come to the driver. Documents without
    candidates add nothing; without any candidate every looser span is refused.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = docs.select(text.alias("_text"), candidates(text).alias("_spans"))
    spans = spans.where(F.size("_spans") > 0).select("_text", F.explode("_spans").alias("_span"))
    named = [v.alias(f"v{i}") for i, v in enumerate(votes(F.col("_text"), F.col("_span")))]
    rows = spans.select(F.col("_span.kind").alias("kind"), *named)
    counted = rows.groupBy("kind", *[f"v{i}" for i in range(4)]).agg(F.count(F.lit(1)).alias("n")).collect()
    by_kind: dict[int, dict[tuple[int, ...], int]] = {}
    for row in counted:
        by_kind.setdefault(row.kind, {})[(row.v0, row.v1, row.v2, row.v3)] = row.n
    soft = []
    for kind, counts in by_kind.items():
        model = estimate(counts)
        one_hot = tuple(float(i == kind) for i in range(len(KINDS)))
        soft += [((*one_hot, *map(float, v)), model.posterior(v), float(n)) for v, n in counts.items()]
    return Classifier(tuple(logistic(soft)))


def find(docs: DataFrame, classifier: Classifier, text_col: str = "text", name: str = "pii") -> DataFrame:
    """Every row of ``docs`` with ``pii``: its accepted spans by start, then kind.

    A null or empty text has none. Base spans always count; looser ones must be
    accepted by the classifier and not overlap a base span. Every row is judged
    by itself, so repeated rows and keys do not matter; a column named like the
    new one is replaced; an empty table stays empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def judged(s: Column) -> Column:
        return (s["kind"] < BASE) | classifier.accepts(s["kind"], votes(text, s))

    return docs.withColumn(name, F.filter(_without_overlap(candidates(text)), judged))


def of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping ones become one."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(state: Column, s: Column) -> Column:
        gap = text.substr(state["at"] + 1, s["start"] - state["at"])
        fresh = s["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], gap, F.get(names, s["kind"]))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], text.substr(s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
