"""Native search for personal data by weak supervision.

Candidates are the matches of one pattern per kind: ``email``, ``ip``, ``card``, ``phone``, and ``secret`` (keys and
passwords). Four labelers vote on each candidate, 1 for, -1 against, 0 without an opinion:

* *regex*: the kind's strict rule (parts at most 255, Luhn, number of digits, length of a key);
* *gazetteer*: known top-level domains, card issuers, calling codes, key prefixes and reserved networks;
* *context*: telling words in the characters before the candidate, for and against;
* *shape*: real values vary; a repeated or counting pattern of digits does not.

Candidates are counted per pattern of votes and traits over all documents. Expectation-maximisation (a latent true
label; every labeler has its own reliability, every kind its own share of true spans) runs on those counts, and its
posteriors train the final span classifier, a naive Bayes model over kind, votes and traits. All tables involved have
at most ``len(KINDS) * 3 ** 4 * 3 ** 2`` rows, however large the corpus. Spans that the classifier accepts are added;
those that pass the strict rules of the base kinds stay in any case.

Everything runs in built-in column functions. The patterns start only where a match can start, so they are linear in
the length of a text, and use possessive groups, so that no length of text exhausts the stack. Places are running sums
taken block by block, so a text's work grows with its spans, not with their square.

Defined cases: null and empty texts have no span. Repeated rows get a result each. Empty tables give empty results and
the prior model. Other columns are kept; one with the name of an output is replaced by it. Places count code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import free_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
_MAIL = "A-Za-z0-9._%+-"
# A match begins where the one before has ended, or where no character of its first run stands before it.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{12,}+|gh[pousr]_[A-Za-z0-9]{16,}+|(?i:password|passwd|pwd|token|secret|api_?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9_/+-]{8,}+[\"']?)",
}
# A quick look whether a text can hold the kind at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": r"AKIA|gh[pousr]_|[=:]"}
DOMAINS = ("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "io", "info", "eu", "it", "nl", "ch", "at")
CONTEXT_FOR = {
    "email": "mail|contact|write|e-?mail|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|client|adresse",
    "card": "card|visa|master|credit|pay|karte|tarjeta|carte",
    "phone": "call|phone|tel|mobile|fax|contact|anruf|llam|appel",
    "secret": "key|secret|token|credential|login|password",
}
CONTEXT_AGAINST = r"version|\bv$|release|isbn|issn|order|serial|section|figure|chapter|article|example of"
SURROUNDING = 24  # characters of context
THRESHOLD = 0.5
BLOCK = 128  # spans of a text that are placed together
_SPAN = "struct<kind:string,start:int,end:int,value:string,before:string>"
_VOTES = ("regex", "gazetteer", "context", "shape")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _blocks(values: Column) -> Column:
    """The array cut into arrays of ``BLOCK`` entries."""
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK)), lambda at: at <= F.size(values))
    return F.transform(starts, lambda at: F.slice(values, at, BLOCK))


def _running(values: Column, merge: Callable[[Column, Column], Column], start: Column) -> Column:
    """``start``, then what has been merged after each entry. Copies the array once an entry: for short ones."""
    return F.aggregate(values, F.array(start), lambda done, v: F.concat(done, F.array(merge(F.element_at(done, -1), v))))


def _before(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each of many whole numbers what the ones before it merge to, from 0: block by block, so that the work grows
    with the entries and not with their square."""

    def within(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), merge))
        return F.flatten(F.zip_with(blocks, F.slice(_running(totals, merge, F.lit(0)), 1, F.size(blocks)), lambda b, at: F.slice(_running(b, merge, at), 1, F.size(b))))

    return _let(values, lambda v: _let(_blocks(v), within))


def _found(text: Column, kind: str) -> Column:
    """All matches of a kind with their places, from the matches and the pieces of text between them."""
    pattern = PATTERNS[kind]
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.filter(F.arrays_zip(pieces.alias("p"), values.alias("v")), lambda x: x["v"].isNotNull())

    def span(pair: Column, at: Column) -> Column:
        start = at + F.length(pair["p"])
        return F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            (start + F.length(pair["v"])).alias("end"),
            pair["v"].alias("value"),
            F.substring(pair["p"], F.lit(-SURROUNDING), F.lit(SURROUNDING)).alias("before"),
        )

    def placed(found: Column) -> Column:
        lengths = F.transform(found, lambda x: F.length(x["p"]) + F.length(x["v"]))
        return F.zip_with(found, _before(lengths, lambda a, b: a + b), span).cast(f"array<{_SPAN}>")

    return F.when(text.rlike(NEEDS[kind]), _let(pairs, placed)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def strict(kind: Column, value: Column) -> Column:
    """Whether a candidate passes its kind's rule."""
    digits = F.length(_digits(value))
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.try_cast("int") <= 255).otherwise(False))
    card = F.when((digits >= 13) & (digits <= 19), _luhn(_digits(value))).otherwise(False)
    secret = F.length(F.regexp_extract(value, r"[A-Za-z0-9_/+-]+[\"']?$", 0)) >= 16
    return (
        F.when(kind == "email", True).when(kind == "ip", small).when(kind == "card", card).when(kind == "phone", (digits >= 9) & (digits <= 15)).otherwise(secret)
    )


def _votes(span: Column) -> Column:
    kind, value, before = span["kind"], span["value"], F.lower(span["before"])
    digits = _digits(value)
    vote = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    tail = F.lower(F.regexp_extract(value, r"\.([A-Za-z0-9-]+)$", 1))
    reserved = value.rlike(r"^(?:0|127|255)\.")
    gazetteer = (
        F.when(kind == "email", vote(tail.isin(*DOMAINS), tail.rlike("^[0-9]+$")))
        .when(kind == "ip", vote(F.lit(False), reserved))
        .when(kind == "card", vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"), digits.rlike("^0")))
        .when(kind == "phone", vote(value.rlike(r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"), value.rlike(r"^\+0")))
        .otherwise(vote(value.rlike("^(?:AKIA|gh[pousr]_)")))
    )
    cues = F.lit(False)
    for name, cue in CONTEXT_FOR.items():
        cues = cues | ((kind == name) & before.rlike(cue))
    context = vote(cues | ((kind == "secret") & F.lower(value).rlike("^(?:pass|pwd|token|secret|api)")), before.rlike(CONTEXT_AGAINST))
    alike = F.size(F.array_distinct(F.split(digits, "")))
    dull = ((F.length(digits) >= 7) & (alike <= 2)) | digits.rlike("^(?:0?1234567|0?9876543)")
    own = F.size(F.array_distinct(F.split(value, "")))
    shape = F.when(kind.isin("email", "secret"), vote(own >= 8, own <= 4)).when(kind == "ip", vote(alike >= 3, alike <= 1)).otherwise(vote(alike >= 4, dull))
    size = F.length(value)
    return F.struct(
        kind.alias("kind"),
        vote(strict(kind, value), F.lit(True)).alias("regex"),
        gazetteer.alias("gazetteer"),
        context.alias("context"),
        shape.alias("shape"),
        F.when(size <= 12, 0).when(size <= 24, 1).otherwise(2).alias("length"),
        F.when(F.length(digits) * 2 < size, 0).when(F.length(digits) * 10 < size * 9, 1).otherwise(2).alias("digits"),
    )


def with_candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with all candidates in the order of ``KINDS``, then of their places, each with its votes and traits."""
    whole = F.coalesce(F.col(text), F.lit(""))
    each = F.concat(*[_found(whole, kind) for kind in KINDS])
    spans = F.when(whole.rlike("[0-9@=:]|AKIA|gh[pousr]_"), each).otherwise(F.array().cast(f"array<{_SPAN}>"))
    judged = F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _votes(s).alias("votes")))
    return docs.withColumn(out, judged)


_TRAITS = ("kind", *_VOTES, "length", "digits")


@dataclass(frozen=True)
class Model:
    prior: float  # log odds
    weights: dict[str, float]  # log odds of "trait=value", and of "kind=value" for the kind
    reliability: dict[str, float]

    def probability(self, votes: Column) -> Column:
        total = F.lit(self.prior)
        for trait in _TRAITS:
            chosen = F.lit(0.0)
            for name, weight in self.weights.items():
                if name.startswith(f"{trait}="):
                    chosen = F.when(votes[trait].cast("string") == name.split("=", 1)[1], weight).otherwise(chosen)
            total = total + chosen
        return 1 / (1 + F.exp(-total))


def vote_counts(found: DataFrame, candidates: str) -> DataFrame:
    """How often each pattern of kind, votes and traits occurs."""
    return found.select(F.explode(candidates).alias("c")).select("c.votes.*").groupBy(*_TRAITS).agg(F.count("*").alias("n"))


def fit(counts: DataFrame, rounds: int = 50) -> Model:
    """Expectation-maximisation on the counts, then the classifier from its posteriors."""
    rows = [r.asDict() for r in counts.orderBy(*_TRAITS).collect()]  # bounded by the number of patterns
    right = dict.fromkeys(_VOTES, 0.8)
    share = dict.fromkeys(KINDS, 0.5)
    posterior = [0.5] * len(rows)
    for _ in range(rounds):
        for k, r in enumerate(rows):
            odds = math.log(share[r["kind"]] / (1 - share[r["kind"]]))
            odds += sum(r[v] * math.log(right[v] / (1 - right[v])) for v in _VOTES)
            posterior[k] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
        for v in _VOTES:
            told = [(r["n"], p if r[v] > 0 else 1 - p) for r, p in zip(rows, posterior, strict=True) if r[v]]
            # Labelers are better than chance: that tells true from false spans.
            right[v] = min(0.98, max(0.55, (sum(n * p for n, p in told) + 8) / (sum(n for n, _ in told) + 10)))
        for kind in KINDS:
            own = [(r["n"], p) for r, p in zip(rows, posterior, strict=True) if r["kind"] == kind]
            share[kind] = (sum(n * p for n, p in own) + 1) / (sum(n for n, _ in own) + 2)
    true = sum(r["n"] * p for r, p in zip(rows, posterior, strict=True))
    false = sum(r["n"] for r in rows) - true
    weights = {}
    for trait in _TRAITS:
        for value in sorted({str(r[trait]) for r in rows}):
            yes = sum(r["n"] * p for r, p in zip(rows, posterior, strict=True) if str(r[trait]) == value)
            no = sum(r["n"] * (1 - p) for r, p in zip(rows, posterior, strict=True) if str(r[trait]) == value)
            weights[f"{trait}={value}"] = math.log((yes + 1) / (true + 2)) - math.log((no + 1) / (false + 2))
    return Model(math.log((true + 1) / (false + 1)), weights, right)


def with_spans(found: DataFrame, candidates: str, model: Model, out: str) -> DataFrame:
    """Keeps of the candidates those of the base rules and those that the classifier accepts, each with its probability."""
    scored = F.transform(
        candidates,
        lambda c: F.struct(
            c["kind"].alias("kind"),
            c["start"].alias("start"),
            c["end"].alias("end"),
            c["value"].alias("value"),
            (c["kind"].isin(*BASE) & (c["votes"]["regex"] == 1)).alias("base"),
            model.probability(c["votes"]).alias("probability"),
        ),
    )
    return found.withColumn(out, F.filter(scored, lambda c: c["base"] | (c["probability"] >= THRESHOLD)))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def part(block: Column) -> Column:
        """What comes of a block of spans and the text before each; a span that begins before ``at`` is part of one before."""
        first = block[0]["at"]
        own = F.substring(text, first + 1, F.greatest(F.element_at(block, -1)["s"]["start"] - first, F.lit(0)))
        shown = lambda t, x: F.concat(F.substring(t, x["at"] - first + 1, x["s"]["start"] - x["at"]), F.lit("<"), F.upper(x["s"]["kind"]), F.lit(">"))
        return _let(own, lambda t: F.array_join(F.transform(block, lambda x: F.when(x["s"]["start"] >= x["at"], shown(t, x)).otherwise("")), ""))

    def whole(sorted_spans: Column) -> Column:
        ends = _before(F.transform(sorted_spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        placed = F.zip_with(sorted_spans, ends, lambda s, at: F.struct(s.alias("s"), at.alias("at")))
        last = F.array_max(F.transform(sorted_spans, lambda s: s["end"]))
        parts = _let(placed, lambda p: F.array_join(F.transform(_blocks(p), part), ""))
        return F.concat(parts, F.substring(text, last + 1, F.length(text)))

    return F.when(F.size(spans) > 0, _let(order, whole)).otherwise(text)


def detect(docs: DataFrame, text: str = "text", out: str = "spans", model: Model | None = None) -> DataFrame:
    """``docs`` with an array of spans (kind, start, end, value, base, probability); fits on ``docs`` without a model."""
    docs = free_of(docs, out, "__candidates")
    found = with_candidates(docs, text, "__candidates")
    if model is None:
        model = fit(vote_counts(with_candidates(docs.select(text), text, "__candidates"), "__candidates"))
    return with_spans(found, "__candidates", model, out).drop("__candidates")
