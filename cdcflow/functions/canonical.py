"""Canonical JSON of a record and its SHA-256.

Canonical form: keys in code-point order, no spaces, explicit nulls, UTF-8
without ``\\u`` escapes. Sealing builds it from columns, verifying rebuilds it
from message text; both stay inside the JVM.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH = "hash"
# Only JSON itself counts: the JSON reader is lenient by default.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def canonical_json(columns: dict[str, Column]) -> Column:
    ordered = [columns[name].alias(name) for name in sorted(columns)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def with_fields(df: DataFrame, text: Column, names, into: str) -> DataFrame:
    """Adds the named top-level fields of a JSON object as a struct of variants.

    The struct is NULL unless ``text`` is one JSON object and nothing else; ``_keys``
    lists the names of all its members as they come, repeated ones too. The reader
    stops at the end of the first value, so the record is read as a member of an outer
    object with one more member behind it, whose name is the SHA-256 of the text. No
    text holds its own digest, so none can close the record, add members or end the
    outer object itself and still leave exactly these two names.
    """
    end = sha256(text)
    outer = F.concat(F.lit('{"record":'), text, F.lit(',"'), end, F.lit('":{}}'))
    read = F.from_json(outer, "map<string,map<string,variant>>", _STRICT)
    parsed = computed_once(df, "_outer", read)
    two = F.map_keys("_outer") == F.array(F.lit("record"), end)
    record = F.col("_outer")["record"]
    fields = F.struct(
        *[record[name].alias(name) for name in names], F.map_keys(record).alias("_keys")
    )
    whole = F.when(two & record.isNotNull(), fields)
    return parsed.select(*df.columns, whole.alias(into))


def in_canonical_order(keys: Column) -> Column:
    """Whether members are sorted, each once, with the hash as the last."""
    ahead = F.slice(keys, 1, F.greatest(F.size(keys) - 1, F.lit(0)))
    ordered = F.array_sort(F.array_distinct(ahead)) == ahead
    return ordered & (F.element_at(keys, -1) == HASH) & ~F.array_contains(ahead, HASH)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is evaluated once per row, however often it is used.

    A plain projection is inlined wherever it is referenced, filters above it
    included; the optimizer does not move expressions through a generator.
    """
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


def covered_sha256(text: Column) -> Column:
    """SHA-256 of a sealed message's text up to the hash that closes it."""
    cut = F.char_length(text) - _SEAL_LENGTH
    return sha256(F.concat(text.substr(F.lit(1), cut), F.lit("}")))


def is_sealed_by(text: Column, digest: Column) -> Column:
    return text.endswith(seal_text(digest))


def rewritten_sha256(text: Column) -> Column:
    """SHA-256 of a record after parsing it and bringing it to canonical form."""
    fields = F.from_json(text, "map<string,variant>", _STRICT)
    # bound by the lambda, the record is parsed once
    return F.transform(F.array(fields), lambda f: sha256(record_json(f)))[0]


def seal_text(digest: Column) -> Column:
    """How the hash closes a sealed message."""
    return F.concat(F.lit(f',"{HASH}":"'), digest, F.lit('"}'))


_SEAL_LENGTH = len(f',"{HASH}":"') + 64 + len('"}')


def record_json(fields: Column) -> Column:
    """Canonical JSON of a map of variants, its hash left out.

    NULL if a key occurs twice: such a record has no canonical form.
    """
    keys = F.sort_array(F.filter(F.map_keys(fields), lambda k: k != HASH))
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    ordered = F.map_from_arrays(keys, F.transform(keys, lambda k: fields[k]))
    return F.when(unique, F.to_json(ordered, {"ignoreNullFields": "false"}))


def field_json(field: Column) -> Column:
    """JSON text of a variant; a missing field and JSON null both read null."""
    return F.coalesce(F.to_json(field), F.lit("null"))


def field_text(field: Column) -> Column:
    """Scalar variant as text, NULL if it is missing, null or not a scalar."""
    return F.try_variant_get(field, "$", "string")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def spaced_json_sha256(text: Column) -> Column:
    """SHA-256 of a record as Python's ``json.dumps(..., sort_keys=True)`` writes it.

    Needed only to exchange records with producers that hash that form: its
    ``\\u`` escapes and number texts have no built-in expression.
    """
    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        import hashlib
        import json

        def one(value):
            try:
                record = json.loads(value)
                record.pop("hash", None)
            except (TypeError, ValueError, AttributeError):
                return None
            written = json.dumps(record, sort_keys=True)
            return hashlib.sha256(written.encode()).hexdigest()

        return texts.map(one)

    return digest(text)
