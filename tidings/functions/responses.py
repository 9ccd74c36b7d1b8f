"""Checking model responses: JSON text to a typed record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"
_WHOLE = r"^\s*[+-]?\d+(\.0*)?\s*$"
_NUMERIC = ("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN")


def json_block(text: Column) -> Column:
    """Text from the first ``{`` to the last ``}``; NULL when there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def _child(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _kind(value: Column) -> Column:
    """JSON type of a variant: ``STRING``, ``VOID`` for null, ...; NULL when absent."""
    return F.schema_of_variant(value)


def _is_number(kind: Column) -> Column:
    return kind.isin(*_NUMERIC) | kind.startswith("DECIMAL")


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _as_float(value: Column, kind: Column) -> Column:
    """Float of a number, boolean or numeric string."""
    text = _text(value)
    return F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("float")).when(
        _is_number(kind) | ((kind == "STRING") & text.rlike(_NUMBER)),
        F.trim(text).try_cast("double").cast("float"),
    )


def _as_whole(value: Column) -> Column:
    """Whole number of a number without fraction, boolean or numeric string."""
    kind, text = _kind(value), _text(value)
    number = F.trim(text).try_cast("double")
    return F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("long")).when(
        (_is_number(kind) & (number == F.floor(number)))
        | ((kind == "STRING") & text.rlike(_WHOLE)),
        number.cast("long"),
    )


def _is_text_list(value: Column) -> Column:
    items = _elements(value)
    all_text = F.forall(items, lambda item: F.coalesce(_kind(item) == "STRING", F.lit(False)))
    return items.isNotNull() & F.coalesce(all_text, F.lit(False))


def _text_list(value: Column) -> Column:
    texts = F.try_variant_get(value, "$", "array<string>")
    return F.coalesce(texts, F.array().cast("array<string>"))


def _ok_if_present(value: Column, test: Column) -> Column:
    return value.isNull() | F.coalesce(test, F.lit(False))


def _perspective_ok(item: Column) -> Column:
    return F.coalesce(
        _kind(item).startswith("OBJECT")
        & _as_whole(_child(item, "index")).isNotNull()
        & (_kind(_child(item, "focus")) == "STRING"),
        F.lit(False),
    )


_REQUIRED = ("summary", "topic", "sentiment")
_LISTS = ("keywords", "consensus_points", "disagreement_points")
_FACTS = ("organizations", "locations", "people")
_STATES = ("before_state", "after_state")
_FIELDS = (*_REQUIRED, *_LISTS, *_STATES, "key_facts", "why_it_matters", "sentiment_score",
           "source_perspectives")


def with_answer(df: DataFrame, raw: str, name: str = "answer") -> DataFrame:
    """Add the struct of a parsed response: ``valid`` and its fields with defaults.

    Three texts are required. Lists must hold texts only, an explicit null is allowed for the
    score and the two states only, a number is not a text, and unknown keys are ignored.

    Each step is a projection of its own, so that a text is parsed once and not once for every
    field that is looked at.
    """
    parsed = df.withColumn("_doc", F.try_parse_json(json_block(F.col(raw))))
    fields = parsed.withColumns({f"_{field}": _child(F.col("_doc"), field) for field in _FIELDS})
    facts = fields.withColumns({f"_{n}": _child(F.col("_key_facts"), n) for n in _FACTS})
    items = facts.withColumn("_items", _elements(F.col("_source_perspectives")))
    typed = (*_REQUIRED, *_STATES, "doc", "key_facts", "why_it_matters", "sentiment_score")
    kinds = items.withColumns({f"_kind_{n}": _kind(F.col(f"_{n}")) for n in typed})
    score = _as_float(F.col("_sentiment_score"), F.col("_kind_sentiment_score"))
    values = kinds.withColumn("_score", score)

    def kind(field):
        return F.col(f"_kind_{field}")

    checks = [kind("doc").startswith("OBJECT")]
    checks += [kind(n) == "STRING" for n in _REQUIRED]
    checks += [_ok_if_present(F.col(f"_{n}"), _is_text_list(F.col(f"_{n}")))
               for n in (*_LISTS, *_FACTS)]
    checks += [kind(n).isNull() | kind(n).isin("STRING", "VOID") for n in _STATES]
    checks += [
        kind("key_facts").isNull() | kind("key_facts").startswith("OBJECT"),
        kind("why_it_matters").isNull() | (kind("why_it_matters") == "STRING"),
        kind("sentiment_score").isNull() | (kind("sentiment_score") == "VOID")
        | F.col("_score").isNotNull(),
        _ok_if_present(
            F.col("_source_perspectives"),
            F.col("_items").isNotNull() & F.forall("_items", _perspective_ok),
        ),
    ]
    valid = F.lit(True)
    for check in checks:
        valid = valid & F.coalesce(check, F.lit(False))
    focus = F.transform(
        "_items",
        lambda item: F.struct(
            _as_whole(_child(item, "index")).alias("index"),
            _text(_child(item, "focus")).alias("focus"),
        ),
    )
    no_focus = F.array().cast("array<struct<index:bigint,focus:string>>")
    answer = F.struct(
        valid.alias("valid"),
        *[_text(F.col(f"_{n}")).alias(n) for n in _REQUIRED],
        F.col("_score").alias("sentiment_score"),
        *[_text_list(F.col(f"_{n}")).alias(n) for n in _LISTS],
        *[_text_list(F.col(f"_{n}")).alias(f"key_facts_{n}") for n in _FACTS],
        F.coalesce(_text(F.col("_why_it_matters")), F.lit("")).alias("why_it_matters"),
        *[_text(F.col(f"_{n}")).alias(n) for n in _STATES],
        F.coalesce(focus, no_focus).alias("perspectives"),
    )
    return values.select(*df.columns, answer.alias(name))
