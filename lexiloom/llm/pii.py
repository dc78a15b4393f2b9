"""Personal data by weak supervision, in DataFrame expressions only.

Base spans are matches of fixed patterns that pass fixed checks; they are always reported. Wider patterns propose further
candidates. Four labelers vote (1, 0 or -1) on every candidate, the base matches among them: a regex labeler (does a strict
pattern fit), a gazetteer labeler (words in front of the span), a context labeler (what touches the span) and a form
labeler (top-level domains, issuer digits, address ranges and the like). Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is for each kind, without any labelled row. The posteriors train the final
classifier: naive Bayes over surface features of spans (length, shape, neighbours, votes). Candidates it is sure of are
added to the base spans where they overlap none.

Counting of votes and features is an aggregation over all documents; only the counts, whose number is bounded by the
kinds, the vote patterns and the feature buckets, reach the driver.

Null texts count as empty; an empty table gives no row. Repeated rows are handled one by one. Other columns are passed
through or not read. Texts are read whole. Of spans of one kind that overlap the leftmost counts, of added ones that begin
together the shorter.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain, product

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lexiloom.llm.common import stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
LABELERS = ("regex", "gazetteer", "context", "form")
SHAPE_BUCKETS = 64
#: Least probability of an added span.
SURE = 0.9
#: Share of true spans among the candidates of a kind that the documents have none of.
START_SHARE = 0.6

# The first pattern of an email is tried where a run of its characters begins, or where the last match ended: a match can
# begin nowhere else, and long runs are read once. Repeated groups are possessive where nothing follows them: they give
# the same matches, and the regex engine reads them in a loop instead of by recursion.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that a text must pass before the pattern of the kind is tried.
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}

_AT, _DOT = r"\x20?[(\[]at[)\]]\x20?", r"\x20?[(\[]dot[)\]]\x20?"
WIDE_PATTERNS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./_])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9./_])",
    "phone": r"(?<![0-9A-Za-z+.])(?:00[1-9][0-9]|\(0[0-9]{1,4}\)|0[0-9]{2,4}[\x20/-])[\x20()0-9/-]{4,20}[0-9](?![0-9A-Za-z.])",
    "secret": r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key)\x20?[=:]\x20?\"?[A-Za-z0-9+/_.-]{8,}+\"?",
}
WIDE_GATES = {
    "email": r"[(\[]at[)\]]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", "card": r"[0-9]{4}[./_][0-9]{4}",
    "phone": r"00[1-9]|\(0[0-9]|0[0-9]{2,4}[\x20/-]", "secret": r"(?i)password|passwd|pwd|token|secret|api[_-]?key",
}

#: Words in front of a span that speak for its kind, and words that speak against any.
GAZETTEER = {
    "email": "mail|e-mail|email|contact|write|correo|courriel|kontakt|from|to",
    "ip": "ip|host|server|address|addr|client|login|from|adresse",
    "card": "card|visa|mastercard|amex|credit|debit|carte|karte|tarjeta|paid",
    "phone": "tel|phone|call|mobile|cell|fax|telefon|teléfono|téléphone|whatsapp|sms",
    "secret": "api|admin|user|login|root|auth|key",
}
AGAINST = "version|release|chapter|section|figure|table|page|isbn|issn|doi|order|invoice|build|rev|model"
TOP_LEVELS = "com|org|net|edu|gov|info|biz|io|co|uk|de|fr|es|it|nl|ch|at|eu|us|ca|au|jp|br|in|mx|se|no|dk|pl|pt|be"


def _spans(text: Column, kind: str, pattern: str, gate: str) -> Column:
    """Matches of ``pattern`` in order, as structs of kind, start, end (code points, end exclusive) and value."""
    empty = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,value:string>>)")
    lit = F.lit(pattern)
    pairs = F.arrays_zip(F.split(text, lit, -1).alias("gap"), F.regexp_extract_all(text, lit, F.lit(0)).alias("hit"))

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        one = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["hit"].alias("value")
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(one)).alias("spans"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    # After the last match there is a gap without a match.
    matched = F.filter(pairs, lambda pair: pair["hit"].isNotNull())
    found = F.aggregate(matched, begin, add)["spans"]
    return F.when(text.rlike(gate), found).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))
    backwards = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.ascii(F.substr(backwards, place, F.lit(1))) - 48
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


_BYTE = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


def passes(span: Column) -> Column:
    """Whether a base match passes the check of its kind."""
    kind, value = span["kind"], span["value"]
    digits = _digits(value)
    size = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == "card", F.when((size >= 13) & (size <= 19), _luhn(digits)).otherwise(False))
        .otherwise((size >= 9) & (size <= 15))
    )


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with _text (null: empty), _base (base spans) and _more (other candidates with their votes)."""
    docs = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    text = F.col("_text")
    for kind in BASE_KINDS:
        docs = docs.withColumn(f"_{kind}", _spans(text, kind, BASE_PATTERNS[kind], GATES[kind]))
    matched = F.concat(*[F.col(f"_{kind}") for kind in BASE_KINDS])
    docs = docs.withColumn("_matched", matched).withColumn("_base", F.filter("_matched", passes))
    # Cards and phones with a wrong check digit or length stay candidates; short numbers and other addresses do not.
    def near(s: Column) -> Column:
        return (s["kind"] == "phone") | (s["kind"] == "card") & (F.length(_digits(s["value"])) >= 13)

    failed = F.filter("_matched", lambda s: ~passes(s) & near(s))
    wide = F.concat(*[_spans(text, kind, WIDE_PATTERNS[kind], WIDE_GATES[kind]) for kind in KINDS])
    docs = docs.withColumn("_failed", failed).withColumn("_wide", wide)
    return docs.drop("_matched", *[f"_{kind}" for kind in BASE_KINDS])


def _by_kind(kind: Column, values: dict[str, str]) -> Column:
    found = F.lit("")
    for name, value in values.items():
        found = F.when(kind == name, F.lit(value)).otherwise(found)
    return found


def _flag(test: Column, yes: int, no: int) -> Column:
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def _judged(text: Column, span: Column, regex: int) -> Column:
    """A span with the votes of the labelers and its surface features."""
    kind, value, start, end = span["kind"], span["value"], span["start"], span["end"]
    front = F.lower(F.substr(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24))))
    before = F.when(start > 0, F.substr(text, start, F.lit(1))).otherwise(F.lit(" "))
    after = F.coalesce(F.nullif(F.substr(text, end + 1, F.lit(1)), F.lit("")), F.lit(" "))
    digits = F.length(_digits(value))

    def named(words: dict[str, str] | str) -> Column:
        if isinstance(words, str):
            return front.rlike(rf"\b(?:{words})\b[^\p{{L}}]{{0,4}}$")
        found = F.lit(False)
        for name, some in words.items():
            found = found | ((kind == name) & front.rlike(rf"\b(?:{some})\b[^\p{{L}}]{{0,4}}$"))
        return found

    gazetteer = F.when(named(AGAINST), F.lit(-1)).when(named(GAZETTEER), F.lit(1)).otherwise(F.lit(0))
    glued = before.rlike(r"[\p{L}0-9_/=@#]") | after.rlike(r"[\p{L}0-9_/=@#]")
    form = (
        F.when(kind == "email", _flag(F.lower(value).rlike(rf"[.)\]]\x20?(?:{TOP_LEVELS})$"), 1, 0))
        .when(kind == "ip", _flag(value.rlike(r"^(?:0+|127|255)\."), -1, 1))
        .when(kind == "card", _flag((digits >= 13) & (digits <= 19) & value.rlike("^[3-6]"), 1, -1))
        .when(kind == "phone", _flag((digits >= 9) & (digits <= 15), 1, -1))
        .otherwise(_flag(value.rlike("[0-9]") & value.rlike("[A-Za-z]{2}"), 1, -1))
    )
    shape = F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), r"\p{L}+", "a")
    side = lambda c: F.when(c.rlike(r"\p{L}"), F.lit("a")).when(c.rlike("[0-9]"), F.lit("9")).when(c.rlike(r"\s"), F.lit("_")).otherwise(F.lit("."))
    return F.struct(
        kind.alias("kind"), start.alias("start"), end.alias("end"),
        F.concat_ws(",", F.lit(regex), gazetteer, _flag(glued, -1, 1), form).alias("votes"),
        F.array(
            F.concat(F.lit("length "), F.floor(F.log2(end - start)).cast("string")),
            F.concat(F.lit("digits "), F.least(digits, F.lit(20)).cast("string")),
            F.concat(F.lit("shape "), F.pmod(F.xxhash64(shape), F.lit(SHAPE_BUCKETS)).cast("string")),
            F.concat(F.lit("before "), side(before)),
            F.concat(F.lit("after "), side(after)),
        ).alias("features"),
    )


def with_judged(docs: DataFrame, with_base: bool) -> DataFrame:
    """Adds _judged: the candidates that are no base spans (and base spans, if wanted) with votes and features."""
    docs = with_candidates(docs)
    text = F.col("_text")
    groups = [F.transform("_wide", lambda s: _judged(text, s, 0)), F.transform("_failed", lambda s: _judged(text, s, -1))]
    if with_base:
        groups.append(F.transform("_base", lambda s: _judged(text, s, 1)))
    return docs.withColumn("_judged", F.concat(*groups))


@dataclass(frozen=True)
class Model:
    """Log odds: of each kind (prior), and of each feature or vote pattern of a kind."""

    prior: dict[str, float]
    odds: dict[str, float]
    reliability: dict[str, dict[str, tuple[float, float]]]


def starting_table(labelers: int) -> np.ndarray:
    """P(vote | truth) by labeler, truth and vote, before anything is seen."""
    table = np.tile(np.array([[0.5, 0.3, 0.2], [0.15, 0.3, 0.55]]), (labelers, 1, 1))
    table[0] = [[0.8, 0.15, 0.05], [0.04, 0.16, 0.8]]
    return table


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation for one kind.

    ``votes``: patterns by labelers, in -1, 0, 1. Returns the posterior of each pattern, P(vote | truth) by labeler, truth
    and vote, and the share of true spans. The regex labeler's start is stronger, so that truth means what it means.
    """
    n, labelers = votes.shape
    table = starting_table(labelers)
    share = 0.5
    at = votes + 1
    for _ in range(rounds):
        like = np.array([[np.prod([table[j, y, at[i, j]] for j in range(labelers)]) for y in (0, 1)] for i in range(n)])
        like *= [1 - share, share]
        posterior = like[:, 1] / like.sum(axis=1)
        for y, weight in ((0, (1 - posterior) * counts), (1, posterior * counts)):
            for j in range(labelers):
                # The starting values act as a few observations.
                table[j, y] = [weight[at[:, j] == v].sum() for v in range(3)] + 2.0 * np.array(
                    [[0.5, 0.3, 0.2], [0.15, 0.3, 0.55]][1 - y] if y == 0 else [0.15, 0.3, 0.55]
                )
                table[j, y] /= table[j, y].sum()
        share = float(np.clip((posterior * counts).sum() / counts.sum(), 0.01, 0.99))
    return posterior, table, share


def _odds_of_votes(kind: str, table: np.ndarray) -> dict[str, float]:
    """Log odds of every pattern of votes, from the reliabilities of the labelers."""
    found = {}
    for votes in product((-1, 0, 1), repeat=len(table)):
        ratio = [np.log(table[j, 1, vote + 1] / table[j, 0, vote + 1]) for j, vote in enumerate(votes)]
        found[f"{kind} votes {','.join(map(str, votes))}"] = float(sum(ratio))
    return found


def fit(docs: DataFrame) -> Model:
    """Learn from the candidates of all documents."""
    found = stored(
        with_judged(docs.select("text"), True).select(F.explode("_judged").alias("s")).select("s.kind", "s.votes", "s.features"),
        "candidates",
    )
    by_votes = found.groupBy("kind", "votes").count().collect()  # at most kinds x 3^4 rows
    by_feature = (
        found.select("kind", "votes", F.explode("features").alias("feature")).groupBy("kind", "votes", "feature").count()
    ).collect()  # at most that times the buckets of a feature
    prior, odds, reliability, posterior_of = {}, {}, {}, {}
    for kind in KINDS:
        rows = sorted((r["votes"], r["count"]) for r in by_votes if r["kind"] == kind)
        if not rows:
            # Nothing to learn from: the starting beliefs decide.
            prior[kind] = float(np.log(START_SHARE / (1 - START_SHARE)))
            odds |= _odds_of_votes(kind, starting_table(len(LABELERS)))
            continue
        votes = np.array([[int(v) for v in text.split(",")] for text, _ in rows])
        counts = np.array([n for _, n in rows], dtype=float)
        posterior, table, share = reliabilities(votes, counts)
        posterior_of |= {(kind, text): p for (text, _), p in zip(rows, posterior, strict=True)}
        prior[kind] = float(np.log(share / (1 - share)))
        # Patterns that were not seen are judged by the labelers' reliabilities; the others follow below.
        odds |= _odds_of_votes(kind, table)
        reliability[kind] = {
            name: (float(table[j, 1, 2]), float(table[j, 0, 0])) for j, name in enumerate(LABELERS)
        }
        for (text, _), p in zip(rows, posterior, strict=True):
            odds[f"{kind} votes {text}"] = float(np.log(p / (1 - p))) - prior[kind]
        names = {r["feature"].split(" ")[0] for r in by_feature if r["kind"] == kind}
        for name in sorted(names):
            sums: dict[str, np.ndarray] = {}
            for r in by_feature:
                if r["kind"] == kind and r["feature"].startswith(f"{name} "):
                    p = posterior_of[kind, r["votes"]]
                    sums[r["feature"]] = sums.get(r["feature"], np.zeros(2)) + np.array([1 - p, p]) * r["count"]
            total = sum(sums.values()) + len(sums)
            for feature, both in sums.items():
                share_of = (both + 1) / total
                odds[f"{kind} {feature}"] = float(np.log(share_of[1] / share_of[0])) / len(names)
    return Model(prior, odds, reliability)


def _score(model: Model, span: Column) -> Column:
    """Log odds of the final classifier; kinds, votes and features that were never seen count nothing."""
    if not model.odds:
        return F.lit(-1e9)
    odds = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(model.odds.items()))])
    prior = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(model.prior.items()))])
    of = lambda name: F.coalesce(F.try_element_at(odds, F.concat(span["kind"], F.lit(" "), name)), F.lit(0.0))
    return F.aggregate(
        span["features"],
        F.coalesce(F.try_element_at(prior, span["kind"]), F.lit(-1e9)) + of(F.concat(F.lit("votes "), span["votes"])),
        lambda total, feature: total + of(feature),
    )


def with_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with _base and _all: base spans, and these with the added ones, by kind and start."""
    docs = with_judged(docs, False)
    sure = float(np.log(SURE / (1 - SURE)))
    plain = lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    base = F.transform("_base", plain)
    chosen = F.filter("_judged", lambda s: _score(model, s) >= sure)
    chosen = F.filter(chosen, lambda s: ~F.exists("_base", lambda b: _overlaps(s, b)))
    by_start = F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint,kind:string>>)")
    # Of added spans that overlap, the first stays.
    apart = F.aggregate(
        by_start,
        empty,
        lambda kept, s: F.when((F.size(kept) == 0) | (F.try_element_at(kept, F.lit(-1))["end"] <= s["start"]), F.concat(kept, F.array(s))).otherwise(kept),
    )
    docs = docs.withColumn("_base", F.array_sort(base)).withColumn("_apart", F.when(F.size("_judged") > 0, apart).otherwise(empty))
    return docs.withColumn("_all", F.array_sort(F.concat("_base", F.transform("_apart", plain)))).drop("_judged", "_apart", "_wide", "_failed")


def _digest(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, base counts, digest of the base spans and all spans of every row."""
    found = with_spans(docs.select("doc_id", "text"), model)

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(_digest("_base"), 256).alias("base_sha256"), _digest("_all").alias("spans"))


def mask(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span in text replaced by its kind in brackets; n_chars, if there, follows the new text."""
    # All columns travel in one, so that none can meet a column that is made on the way.
    found = with_spans(docs.select("text", F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row")), model)
    by_start = F.array_sort(F.transform("_all", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint,kind:string>>)")

    def merge(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        head = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when((F.size(done) > 0) & (last["end"] > s["start"]), F.concat(head, F.array(longer))).otherwise(F.concat(done, F.array(s)))

    text, merged = F.col("_text"), F.col("_merged")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(merged, lambda s: s["end"]))
    pieces = F.transform(
        merged,
        lambda s, i: F.concat(
            F.substr(text, F.element_at(ends, i + 1) + 1, s["start"] - F.element_at(ends, i + 1)),
            F.lit("["), F.upper(s["kind"]), F.lit("]"),
        ),
    )
    masked = F.concat(F.array_join(pieces, ""), F.substr(text, F.element_at(ends, -1) + 1, F.length(text)))
    found = found.withColumn("_merged", F.aggregate(by_start, empty, merge))
    found = found.withColumn("_new", F.when(F.size("_merged") > 0, masked).otherwise(F.col("text")))
    replaced = {"text": F.col("_new")} | ({"n_chars": F.when(F.size("_merged") > 0, F.length("_new").cast("long")).otherwise(F.col("_row")["n_chars"])} if "n_chars" in docs.columns else {})
    return found.select(*[replaced[c].alias(c) if c in replaced else F.col("_row")[c].alias(c) for c in docs.columns])
