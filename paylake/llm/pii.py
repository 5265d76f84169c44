"""Personal data: candidate gradient boosting, in DataFrame and SQL functions only.

Strict patterns with checks give the base spans. Wider generators propose further, overlapping spans; boosted trees over
format and context features score them, and a threshold per kind, calibrated on documents the trees have not seen, selects
what else to redact. The trees learn from the corpus: base spans as they stand and in the disguises of `_disguised` are
positives, other proposals negatives. So a look that the corpus has for other things as well stays, while an address with
its marks spelt out, a number with other separators or a digit off, or two numbers run together are found by their look.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.llm.common import staged, table, unused

KINDS = ("email", "ip", "card", "phone")

# Strict patterns. A run that fails is left as a whole (possessive, and no start inside it), so time is linear in the text.
_LOCAL = "[A-Za-z0-9._%+-]"
_STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Generators of candidates: kind and pattern. Repetition is bounded or possessive.
GENERATORS = (
    ("email", rf"(?<!{_LOCAL}){_LOCAL}++(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9.])[0-9]{1,4}(?:[.,:_-][0-9]{1,4}){3,7}(?![0-9])"),
    ("card", r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}(?:[\x20./_-][0-9]{4}){2,3}(?:[\x20./_-][0-9]{1,3})?)(?![0-9])"),
    ("phone", r"(?<![0-9A-Za-z])\+?\(?[0-9]{1,4}(?:[\x20().-]{1,3}[0-9]{1,5}){2,5}(?![0-9A-Za-z])"),
)
_CONTEXT = r"(?i)(?:tel|phone|call|fax|mail|contact|write|card|visa|pay|account|host|server|addr|\bip\b)"
CONTEXT_CHARS = 24

TREES = 16
RATE = 0.5
RIDGE = 1.0
#: A kind's threshold is the lowest score at which most calibration candidates, and this share of all from there on up, are
#: positives.
PRECISION = 0.9
#: Weight of a proposal. The disguises of a base span weigh a quarter together, as what strict patterns miss is taken to be
#: rarer than what they find; for calibration, so does the span itself. A whole number of each kind's disguises fits.
UNIT, DISGUISED = 48, 12

_SPAN = "struct<start: int, kind: int, end: int>"
_CANDIDATE = "struct<start: int, kind: int, end: int, features: array<int>, disguised: array<array<int>>>"
_FEATURES = (
    "kind", "digits", "letters", "groups", "plus", "at", "paren", "dots", "spaces", "hyphens", "longest_run", "luhn", "octets", "before", "after", "context",
)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _octets_fit(s: Column) -> Column:
    return s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


_CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda s: F.lit(True),
    "ip": _octets_fit,
    "card": lambda s: F.length(_digits(s)).between(12, 19) & F.call_function("luhn_check", _digits(s)),
    "phone": lambda s: F.length(_digits(s)).between(9, 15),
}


def occurrences(text: Column, pattern: str, kind: int, check: Callable[[Column], Column], described: bool = False) -> Column:
    """Spans of the leftmost non-overlapping matches that pass the check, in code points, described by features if asked.

    The text between matches and the matches themselves alternate, so a running length gives the places, and the last
    characters are carried along: no match is looked up by its place in the text.
    """
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ahead = [F.slice(a, F.lit(2), F.size(a)) for a in (pieces, hits)] if described else []
    state = F.expr(f"named_struct('at', 0, 'tail', '', 'out', cast(array() AS array<{_CANDIDATE if described else _SPAN}>))")

    def step(s: Column, part: Column) -> Column:
        hit = part["1"]
        start = s["at"] + F.length(part["0"])
        end = start + F.coalesce(F.length(hit), F.lit(0))
        values = [start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")]
        tail = s["tail"]
        if described:
            tail = F.right(F.concat(s["tail"], part["0"]), F.lit(CONTEXT_CHARS))
            after = F.left(F.concat(F.coalesce(part["2"], F.lit("")), F.coalesce(part["3"], F.lit(""))), F.lit(1))
            around = [_class(F.right(tail, F.lit(1))), _class(after), F.coalesce(tail.rlike(_CONTEXT), F.lit(False))]
            look = lambda v: _features(v, kind, around)
            other = F.when(_CHECKS[KINDS[kind]](hit), F.transform(F.array(*_disguised(hit, KINDS[kind])), look))
            values += [look(hit).alias("features"), F.coalesce(other, F.expr("cast(array() AS array<array<int>>)")).alias("disguised")]
            tail = F.right(F.concat(tail, F.coalesce(hit, F.lit(""))), F.lit(CONTEXT_CHARS))
        out = F.when(hit.isNotNull() & check(hit), F.concat(s["out"], F.array(F.struct(*values)))).otherwise(s["out"])
        return F.struct(end.alias("at"), tail.alias("tail"), out.alias("out"))

    return F.aggregate(F.arrays_zip(pieces, hits, *ahead), state, step, lambda s: s["out"])


def _class(c: Column) -> Column:
    """0 white space or none, 1 letter, 2 digit, 3 other."""
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2).otherwise(3)


def _features(s: Column, kind: int, around: list[Column]) -> Column:
    """Features of a proposal's text; around: the classes of the characters beside it, and whether context words precede."""
    count = lambda p, most: F.least(F.regexp_count(s, F.lit(p)), F.lit(most))
    runs = F.transform(F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0)), F.length)
    values = [
        F.lit(kind), count("[0-9]", 24), count("[A-Za-z]", 8), count("[0-9A-Za-z]+", 8), count(r"\+", 1), count("@", 1), count(r"[(\[]", 1),
        count(r"\.", 4), count(r"\x20", 4), count("-", 4), F.least(F.coalesce(F.array_max(runs), F.lit(0)), F.lit(20)),
        F.coalesce(F.call_function("luhn_check", _digits(s)), F.lit(False)), _octets_fit(F.translate(s, ",:_-", "....")), *around,
    ]
    return F.array(*[v.cast("int") for v in values])


def _disguised(s: Column, kind: str) -> list[Column]:
    """A base span's text as it may be written to escape, or slip past, its strict pattern."""
    if kind == "email":
        name, host = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)
        marks = ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "."))
        return [F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot))) for at, dot in marks]
    if kind == "ip":
        return [F.translate(s, ".", mark) for mark in "-,_:"]
    if kind == "card":
        last = F.translate(F.right(s, F.lit(1)), "0123456789", "1234567890")
        return [F.concat(F.left(s, F.length(s) - 1), last), F.translate(s, " -", ".."), F.translate(s, " -", "//")]
    # Without the plus, and without the country's number.
    return [F.substring(s, 2, 64), F.regexp_replace(s, r"^\+[0-9]{1,3}[\x20.-]+", "")]


def with_candidates(docs: DataFrame, text: str = "text", base: str = "pii_base", candidates: str = "pii_candidates") -> DataFrame:
    """Add the base spans, in order of start and kind, and the described candidates of each whole text; null is empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.expr(f"cast(array() AS array<{_SPAN}>)")
    sign = {"email": F.contains(whole, F.lit("@")), "phone": F.contains(whole, F.lit("+"))}
    digit = whole.rlike("[0-9]")
    strict = [F.when(sign.get(k, digit), occurrences(whole, _STRICT[k], i, _CHECKS[k])).otherwise(none) for i, k in enumerate(KINDS)]
    loose = []
    for kind, pattern in GENERATORS:
        worth = whole.rlike(r"@|[(\[]at[)\]]|\x20at\x20.{0,64}(?:\.[A-Za-z0-9]|dot)") if kind == "email" else digit
        loose.append(F.when(worth, occurrences(whole, pattern, KINDS.index(kind), lambda s: F.lit(True), True)))
    loose = [F.coalesce(c, F.expr(f"cast(array() AS array<{_CANDIDATE}>)")) for c in loose]
    return docs.withColumns({base: F.array_sort(F.concat(*strict)), candidates: F.concat(*loose)})


@dataclass
class PiiModel:
    """Trees as (feature, bin, (feature, bin, leaf, leaf) twice): low side first; and a threshold per kind."""

    bias: float = 0.0
    trees: list[tuple] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, f: str) -> str:
        """The probability that an array of features is personal data, as SQL: a model is one expression to build."""
        total = [f"{self.bias!r}D"]
        for feature, cut, *sides in self.trees:
            low, high = (f"if({f}[{a}] <= {c}, {left!r}D, {right!r}D)" for a, c, left, right in sides)
            total.append(f"if({f}[{feature}] <= {cut}, {low}, {high})")
        return f"1D / (1D + exp(-({' + '.join(total)})))"


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _key(span: Column) -> Column:
    """Start, end and kind as one number: membership in an array of numbers is a plain scan."""
    return (span["start"].cast("bigint") * F.lit(1 << 31) + span["end"]) * 4 + span["kind"]


def _split(rows: DataFrame) -> dict[int, tuple]:
    """Of each node: the best (feature, bin) and the leaf values on both sides, from sums of gradients per bin."""
    bins = rows.select("node", "g", "h", F.posexplode("features").alias("feature", "bin")).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    # A few hundred rows, as features have few bins: one task takes them all, and nothing is shuffled again.
    bins = bins.coalesce(1)
    by = W.partitionBy("node", "feature")
    upto = by.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    bins = bins.select("node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"), F.sum("g").over(by).alias("g"), F.sum("h").over(by).alias("h"))
    gain = F.expr(f"gl * gl / (hl + {RIDGE}) + (g - gl) * (g - gl) / (h - hl + {RIDGE})")
    order = F.struct(F.round(gain, 9), -F.col("feature"), -F.col("bin"))
    leaf = lambda g, h: F.expr(f"{-RATE} * ({g}) / ({h} + {RIDGE})")
    best = bins.groupBy("node").agg(F.max_by(F.struct("feature", "bin", leaf("gl", "hl").alias("low"), leaf("g - gl", "h - hl").alias("high")), order).alias("b"))
    return {r["node"]: tuple(r["b"]) for r in best.collect()}


def fit(found: DataFrame, trees: int = TREES, base: str = "pii_base", candidates: str = "pii_candidates", doc_id: str = "doc_id") -> PiiModel:
    """Learn from documents with candidates. A candidate that equals a base span of its kind is a positive, and so are its
    disguises; one that overlaps none, or equals one of another kind, is a negative; others are left out. Half of the
    documents grow the trees, the rest calibrate. All candidates count: they are summed per distinct features first, whose
    number the bins bound, so a round of boosting reads that table alone, and one row per node reaches the driver. Without
    positives nothing is added. Disguised data in the corpus count as negatives, as nothing marks them: a look is learnt
    while base spans outweigh what else has it.
    """
    one = found.select(
        (F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0).alias("grow"), F.col(base).alias("b"), F.transform(base, _key).alias("k"), F.explode(candidates).alias("c")
    )
    equal = F.array_contains("k", _key(F.col("c")))
    other = F.exists("b", lambda b: (b["start"] == F.col("c.start")) & (b["end"] == F.col("c.end")))
    clear = ~F.exists("b", lambda b: _overlaps(b, F.col("c")))
    example = lambda f, y, n: F.struct(f.alias("features"), F.lit(y).alias("y"), F.expr(n).cast("bigint").alias("n"))
    itself = F.array(example(F.col("c.features"), 1.0, f"if(grow, {UNIT}, {DISGUISED})"))
    disguises = F.transform("c.disguised", lambda d: example(d, 1.0, f"{DISGUISED} div size(c.disguised)"))
    examples = F.when(equal, F.concat(itself, disguises)).when(other | clear, F.array(example(F.col("c.features"), 0.0, f"{UNIT}")))
    one = one.select("grow", F.explode(examples).alias("e")).select("grow", "e.*")
    rows = staged(one.groupBy("grow", "features", "y").agg(F.sum("n").alias("n")), "pii-features")
    grow = rows.filter("grow")
    sums = grow.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("y")).first()
    if not sums["y"]:
        return PiiModel()
    rate = min(sums["y"] / sums["n"], 0.999)
    model = PiiModel(bias=log(rate / (1 - rate)))
    for _ in range(trees):
        p = F.expr(model.score("features"))
        grad = grow.select("features", (F.col("n") / UNIT * (p - F.col("y"))).alias("g"), (F.col("n") / UNIT * p * (1 - p)).alias("h"))
        feature, cut, *_ = _split(grad.withColumn("node", F.lit(0)))[0]
        sides = _split(grad.withColumn("node", (F.col("features")[feature] > cut).cast("int")))
        model.trees.append((feature, cut, sides[0], sides.get(1, sides[0])))
    seen = rows.filter("NOT grow").select(F.col("features")[0].alias("kind"), F.round(F.expr(model.score("features")), 9).alias("p"), "y", "n")
    seen = seen.groupBy("kind", "p").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("y"))
    above = W.partitionBy("kind").orderBy(F.desc("p"))
    good = seen.withColumn("share", F.sum("y").over(above) / F.sum("n").over(above)).filter((F.col("share") >= PRECISION) & (F.col("y") / F.col("n") > 0.5))
    model.thresholds = {r["kind"]: r["p"] for r in good.groupBy("kind").agg(F.min("p").alias("p")).collect()}
    return model


def with_spans(found: DataFrame, model: PiiModel, base: str = "pii_base", candidates: str = "pii_candidates", spans: str = "pii_spans") -> DataFrame:
    """Add all spans: the base ones, and of the other candidates, best first, those above the threshold that overlap none."""
    def limit(kind: Column) -> Column:
        out = F.lit(2.0)
        for k, p in model.thresholds.items():
            out = F.when(kind == k, F.lit(p)).otherwise(out)
        return out

    scored = F.expr(
        f"transform(`{candidates}`, c -> named_struct('worse', -round({model.score('c.features')}, 9), 'shorter', c.start - c.end, 'start', c.start, 'kind', c.kind, 'end', c.end))"
    )
    keys = unused(found, "_keys")
    beyond = F.filter(scored, lambda c: (-c["worse"] >= limit(c["kind"])) & ~F.array_contains(keys, _key(c)))
    found = found.withColumn(keys, F.transform(base, _key)).withColumn("_scored", F.array_sort(beyond)).drop(keys)

    def step(kept: Column, c: Column) -> Column:
        free = ~F.exists(kept, lambda k: _overlaps(k, c))
        return F.when(free, F.concat(kept, F.array(F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))).otherwise(kept)

    return found.withColumn(spans, F.array_sort(F.aggregate("_scored", F.col(base), step))).drop("_scored")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the later ones start where the last ended."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, F.greatest(span["start"] - s["at"], F.lit(0)))
        mark = F.when(span["end"] > s["at"], F.element_at(names, span["kind"] + 1)).otherwise(F.lit(""))
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.concat(s["out"], gap, mark).alias("out"))

    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.aggregate(spans, state, step, rest)


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: int) -> Callable[[Column], Column]:
    return lambda k: k == kind


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_candidates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = staged(docs.drop("text"), "pii")
    found = with_spans(found, fit(found))
    kinds = F.col("pii_base.kind")
    counts = [F.size(F.filter(kinds, _is(i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    counts.append(F.size("pii_spans").cast("bigint").alias("n_spans"))
    return found.select("doc_id", *counts, F.sha2(listed(F.col("pii_base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("pii_spans")).alias("spans"))
