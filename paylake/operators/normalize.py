"""Raw payloads to typed transaction tables, one operator per source.

Each source declares which rows it wants, the fields a wanted row must have, and the columns it takes. Rows a
source does not want are dropped; malformed rows go to `rejected_payloads`, or stop the job when `strict`.

Reasons: `not_json`, `too_large` (unreadable, with a number beyond the parser's limit of 1,000 characters), `not_object`, `missing_field`, `not_text`, `bad_amount`, `bad_received_at`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paylake.functions.iso_time import utc_clock
from paylake.functions.json_values import Document, as_array, beyond_limits, computed_once, opens_object
from paylake.schemas import processed_schema


@dataclass(frozen=True)
class Rules:
    """What a source takes from a payload.

    `wanted` selects rows; `unreadable` gives a reason when that cannot even be decided. The payload of a wanted row spells
    all `words`, in any case and maybe escaped; `decided_by` are the paths that `wanted` looks at. A wanted row must
    have all named fields: `texts` are text, `optional_texts` text or null, and `amount_ok` holds for `amount`.
    """

    wanted: Callable[[Document], Column]
    words: Sequence[str]
    decided_by: Sequence[str]
    unreadable: Callable[[Document], Column]
    texts: Sequence[str]
    optional_texts: Sequence[str]
    amount: str
    amount_ok: Callable[[Document, str], Column]
    columns: Callable[[Document], Sequence[Column]]


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _converts(doc: Document, path: str) -> Column:
    return doc.number(path).isNotNull()


# Generated card transactions: words are stored in lower case, the status is compared without case.
FAKER = Rules(
    wanted=lambda doc: F.lower(doc.text(".status")) == "completed",
    words=("completed",),
    decided_by=(".status",),
    unreadable=lambda doc: (
        F.when(doc.missing(".status"), "missing_field").when(~doc.is_text(".status"), "not_text")
    ),
    texts=(".currency", ".transaction_type"),
    optional_texts=(".transaction_id", ".user_id"),
    amount=".amount",
    amount_ok=lambda doc, path: doc.is_number_or_null(path),
    columns=lambda doc: [
        doc.text(".transaction_id"),
        doc.text(".user_id"),
        F.try_variant_get(doc.column, "$[0].amount", "double"),
        F.lower(doc.text(".currency")),
        F.lower(doc.text(".transaction_type")),
    ],
)


def _undecided_intent(doc: Document) -> Column:
    kind, status = ".data.object.object", ".data.object.status"
    is_intent = F.coalesce(doc.text(kind) == "payment_intent", F.lit(False))
    return F.when(doc.missing(kind) | (is_intent & doc.missing(status)), "missing_field")


# Payment intents: amounts come in minor units.
STRIPE = Rules(
    wanted=lambda doc: (
        (doc.text(".data.object.status") == "succeeded") & (doc.text(".data.object.object") == "payment_intent")
    ),
    words=("succeeded", "payment_intent"),
    decided_by=(".data.object.status", ".data.object.object"),
    unreadable=_undecided_intent,
    texts=(),
    optional_texts=tuple(f".data.object.{name}" for name in ("id", "customer", "currency", "payment_method")),
    amount=".data.object.amount",
    amount_ok=_converts,
    columns=lambda doc: [
        doc.text(".data.object.id"),
        doc.text(".data.object.customer"),
        doc.number(".data.object.amount") / 100.0,
        doc.text(".data.object.currency"),
        doc.text(".data.object.payment_method"),
    ],
)


# Account transfers: account and currency are those of the first leg, the amount that of the second.
REVOLUT = Rules(
    wanted=lambda doc: doc.text(".data.state") == "completed",
    words=("completed",),
    decided_by=(".data.state",),
    # Data with a state is an object, so most rows need no look at the whole of it.
    unreadable=lambda doc: F.when(
        doc.missing(".data.state"),
        F.when(doc.missing(".data"), "missing_field").when(~doc.is_object(".data"), "not_object"),
    ),
    texts=(),
    optional_texts=(".data.id", ".data.legs[0].account_id", ".data.legs[0].currency", ".data.type"),
    amount=".data.legs[1].amount",
    amount_ok=_converts,
    columns=lambda doc: [
        doc.text(".data.id"),
        doc.text(".data.legs[0].account_id"),
        doc.number(".data.legs[1].amount"),
        doc.text(".data.legs[0].currency"),
        doc.text(".data.type"),
    ],
)

RULES = {"faker": FAKER, "stripe": STRIPE, "revolut": REVOLUT}


def _rules(source: str) -> Rules:
    if source not in RULES:
        raise ValueError(f"unknown source: {source}")
    return RULES[source]


def _opened(raw: DataFrame, rules: Rules, wanted_only: bool = False) -> tuple[DataFrame, Document]:
    """Parse, and take what the rules look at: first what decides whether a row is wanted, the rest for wanted rows."""
    kept = [name for name in raw.columns if name != "source"]
    columns = {"doc": F.try_parse_json(as_array(F.col("payload"))), "instant": utc_clock(F.col("received_at"))}
    parsed, whole = computed_once(raw, columns, *kept), Document(F.col("doc"))
    deciding = {path: F.col(f"_decides{i}") for i, path in enumerate(rules.decided_by)}
    first = {f"_decides{i}": whole.text(path) for i, path in enumerate(rules.decided_by)}
    parsed = computed_once(parsed, first | {"_alone": F.coalesce(whole.is_alone(), F.lit(False))}, *parsed.columns)
    doc = Document(F.col("doc"), deciding, alone=F.col("_alone"))
    wanted = _wanted(rules, doc)
    if wanted_only:
        parsed = parsed.filter(wanted)
    texts = [*rules.texts, *rules.optional_texts]
    rest = {f"_text{i}": F.when(wanted, whole.text(path)) for i, path in enumerate(texts)}
    parsed = computed_once(parsed, rest | {"_kind": F.when(wanted, whole.kind(rules.amount))}, *parsed.columns)
    known = deciding | {path: F.col(f"_text{i}") for i, path in enumerate(texts)}
    return parsed, Document(F.col("doc"), known, {rules.amount: F.col("_kind")}, F.col("_alone"))


def _wanted(rules: Rules, doc: Document) -> Column:
    return F.coalesce(rules.wanted(doc), F.lit(False))


def _may_be_wanted(rules: Rules) -> Column:
    """False only for payloads that cannot be of a wanted row, so that those need not be parsed. An escape may spell anything."""
    text = F.lower("payload")
    return _all([F.contains(text, F.lit(word)) for word in rules.words]) | F.contains("payload", F.lit("\\"))


def _texts_ok(rules: Rules, doc: Document) -> Column:
    return _all([doc.is_text(path) for path in rules.texts] + [doc.is_text_or_null(path) for path in rules.optional_texts])


def _sound(rules: Rules, doc: Document) -> Column:
    """A wanted row that is not malformed. A missing field has no type, so it fails the type checks."""
    fields_ok = _texts_ok(rules, doc) & rules.amount_ok(doc, rules.amount)
    return doc.is_alone() & fields_ok & F.col("instant").isNotNull()


def _fault(rules: Rules, doc: Document) -> Column:
    """The reason a row is malformed; NULL for good rows and for rows the source does not want."""
    named = [*rules.texts, *rules.optional_texts, rules.amount]
    of_wanted = (
        F.when(~_all([~doc.missing(path) for path in named]), "missing_field")
        .when(~_texts_ok(rules, doc), "not_text")
        .when(~rules.amount_ok(doc, rules.amount), "bad_amount")
        .when(F.col("instant").isNull(), "bad_received_at")
    )
    unreadable = rules.unreadable(doc)
    return (
        F.when(~F.coalesce(doc.is_alone(), F.lit(False)), F.when(beyond_limits(F.col("payload")), "too_large").otherwise("not_json"))
        .when(_wanted(rules, doc), of_wanted)
        # The type of a whole document costs a walk through it; its first character tells as much.
        .when(unreadable.isNotNull(), F.when(opens_object(F.col("payload")), unreadable).otherwise("not_object"))
    )


def _malformed(rules: Rules, doc: Document) -> Column:
    """The cheap test; the search for the reason is for malformed rows only."""
    single = F.coalesce(doc.is_alone(), F.lit(False))
    return ~single | F.when(_wanted(rules, doc), ~_sound(rules, doc)).otherwise(rules.unreadable(doc).isNotNull())


def normalize(
    raw: DataFrame, source: str, strict: bool = False, keep: Sequence[str] = (), counts: Observation | None = None
) -> DataFrame:
    """Typed rows of one source. `raw` holds that source only; `keep` carries extra columns along.

    `counts` is told how many rows were `read` and how many of them were `rejected` as malformed.
    """
    rules, schema = _rules(source), processed_schema(source)
    wanted_only = counts is None and not strict  # nobody asks for the faults of other rows
    parsed, doc = _opened(raw.filter(_may_be_wanted(rules)) if wanted_only else raw, rules, wanted_only)
    if counts is not None:
        # The filter below asks again, so the answer is kept.
        parsed = computed_once(parsed, {"malformed": _malformed(rules, doc)}, *parsed.columns)
        malformed = F.col("malformed")
        parsed = parsed.observe(counts, F.count(F.lit(1)).alias("read"), F.count_if(malformed).alias("rejected"))
    wanted = _wanted(rules, doc)
    if strict:
        fault = _fault(rules, doc)
        failed = F.raise_error(F.concat(F.lit("malformed payload: "), fault)).cast("boolean")
        rows = parsed.filter(F.when(fault.isNotNull(), failed).otherwise(wanted))
    elif counts is not None:
        rows = parsed.filter(wanted & ~malformed)
    else:
        rows = parsed.filter(wanted & _sound(rules, doc))
    values = [F.lit(source), F.col("instant"), *rules.columns(doc)]
    typed = [value.cast(field.dataType).alias(field.name) for value, field in zip(values, schema.fields)]
    return rows.select(*typed, *keep)


def rejected_payloads(raw: DataFrame, source: str, keep: Sequence[str] = ()) -> DataFrame:
    """Malformed rows of one source: `source, received_at, payload, reason`, and the columns to keep."""
    rules = _rules(source)
    parsed, doc = _opened(raw, rules)
    return parsed.filter(_malformed(rules, doc)).select(
        F.lit(source).alias("source"), "received_at", "payload", _fault(rules, doc).alias("reason"), *keep
    )


def normalize_each(raw: DataFrame, sources: Sequence[str], strict: bool = False) -> dict[str, DataFrame]:
    return {source: normalize(raw.filter(F.col("source") == source), source, strict) for source in sources}


def union_sources(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of tables with the same columns; a table with other columns is an error."""
    return reduce(lambda a, b: a.unionByName(b), tables)
