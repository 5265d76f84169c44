"""Typed access to JSON documents.

A document is parsed once, as the first of two elements of an array, the other being a null. Text after the
document then breaks the array, or the null is not where it should be, and the document is refused as a
strict JSON reader would. `computed_once` puts the parse below an explode, because
a filter on a parsed field would otherwise be pushed through the projection and parse every row again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_array(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit(",null]"))


def computed_once(df: DataFrame, columns: dict[str, Column], *keep: str) -> DataFrame:
    """Add columns that later filters refer to without computing them again."""
    named = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*keep, F.inline(F.array(named)))


def _could_be_other(text: Column) -> Column:
    """Whether the text of a value could come from a number (one too large reads Infinity), a container or a boolean."""
    return F.left(text, F.lit(1)).isin(list("-0123456789{[IN")) | text.isin("true", "false")


class Document:
    """Paths into one JSON document held as `[document, null]` in a VARIANT column.

    What has been computed before, by `computed_once`, can be given by path: `texts`, `kinds`, and whether the document is
    `alone`. The type of a value costs several times its text, as the value is copied first; a type is asked for only where
    a given text leaves it open.
    """

    def __init__(
        self, column: Column, texts: Mapping[str, Column] | None = None, kinds: Mapping[str, Column] | None = None,
        alone: Column | None = None,
    ):
        self.column, self.texts, self.kinds, self.alone = column, texts or {}, kinds or {}, alone

    def value(self, path: str = "") -> Column:
        """The value as VARIANT: SQL NULL when missing, a variant null when JSON null."""
        return F.try_variant_get(self.column, f"$[0]{path}", "variant")

    def text(self, path: str) -> Column:
        return self.texts[path] if path in self.texts else F.try_variant_get(self.column, f"$[0]{path}", "string")

    def kind(self, path: str = "") -> Column:
        return self.kinds[path] if path in self.kinds else F.schema_of_variant(self.value(path))

    def _known(self, path: str, of_text: Column, otherwise: Column) -> Column:
        """`of_text` where a given text can be nothing but a text."""
        if path not in self.texts:
            return otherwise
        text = self.texts[path]
        return F.when(text.isNotNull() & ~_could_be_other(text), of_text).otherwise(otherwise)

    def missing(self, path: str) -> Column:
        return self._known(path, F.lit(False), self.value(path).isNull())

    def is_text(self, path: str) -> Column:
        return self._known(path, F.lit(True), F.coalesce(self.kind(path) == "STRING", F.lit(False)))

    def is_text_or_null(self, path: str) -> Column:
        return self._known(path, F.lit(True), F.coalesce(self.kind(path).isin("STRING", "VOID"), F.lit(False)))

    def is_number_or_null(self, path: str) -> Column:
        kind = self.kind(path)
        return F.coalesce(kind.isin("BIGINT", "DOUBLE", "FLOAT", "VOID") | F.startswith(kind, F.lit("DECIMAL")), F.lit(False))

    def is_object(self, path: str = "") -> Column:
        return F.coalesce(F.startswith(self.kind(path), F.lit("OBJECT")), F.lit(False))

    def is_alone(self) -> Column:
        """True when the text holds one document and nothing more."""
        if self.alone is not None:
            return self.alone
        second, third = (F.try_variant_get(self.column, path, "variant") for path in ("$[1]", "$[2]"))
        return F.is_variant_null(second) & third.isNull()

    def number(self, path: str) -> Column:
        """A number from a JSON number, boolean or numeric text; NULL when it is none of these."""
        text = F.trim(self.text(path), F.lit(" \t\n\r\f\u000b"))
        spelled = text.rlike(NUMBER_TEXT)
        from_text = F.when(spelled, F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        direct = F.try_variant_get(self.column, f"$[0]{path}", "double")
        return F.when(self.is_text(path), from_text).otherwise(direct)


# Fixed form: number texts that convert to a float (single underscores between digits allowed).
NUMBER_TEXT = (
    r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf|infinity|nan)\z"
)


def beyond_limits(text: Column) -> Column:
    """Whether a text that could not be read has a number longer than the parser's limit of 1,000 characters."""
    return text.rlike("[-+.0-9eE]{1001}")


def opens_object(text: Column) -> Column:
    """Whether a text known to be JSON is an object."""
    return F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{"))


def is_container(text: Column) -> Column:
    return F.startswith(text, F.lit("{")) | F.startswith(text, F.lit("["))


def canonical_field(value: Column, field: str, extracted: Column) -> Column:
    """JSON text of one field of a message, given the text a schema-driven parse extracted for it.

    Extraction drops the quotes of strings, so a string that looks like an object is ambiguous. Such a string
    opens with `"{`, `"[` or an escape in the message; and if it holds quotes, they are escaped there. Most
    messages are cleared by one search for a backslash. The others are searched for the opening, and only
    what is left, and scalars, are parsed again to learn the type.
    """
    opens = F.contains(value, F.lit('"{')) | F.contains(value, F.lit('"[')) | F.contains(value, F.lit('"\\'))
    suspicious = (F.contains(value, F.lit("\\")) | ~F.contains(extracted, F.lit('"'))) & opens
    doc = Document(F.try_parse_json(as_array(value)))
    nested = F.startswith(doc.kind(f".{field}"), F.lit("OBJECT")) | F.startswith(doc.kind(f".{field}"), F.lit("ARRAY"))
    exact = F.when(nested, extracted).otherwise(F.to_json(doc.value(f".{field}")))
    return F.when(is_container(extracted) & ~suspicious, extracted).otherwise(F.coalesce(exact, extracted))
