"""JSON held in string columns."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Bytes of the longest document that the JVM's variant parser takes.
PARSER_LIMIT = 128 * 1024 * 1024


def parsed(text: Column) -> Column:
    return F.try_parse_json(text)


def is_string_property(text: Column, name: str) -> Column:
    """Does the document have a top-level property of this name that is a JSON string?"""
    kind = F.schema_of_variant(F.try_variant_get(parsed(text), f"$.{name}", "variant"))
    return F.coalesce(kind, F.lit("")) == "STRING"


def _unless_container(found: Column, text: Column, path: str) -> Column:
    """``found``, but null where the value at ``path`` is an object or array."""
    kind = F.schema_of_variant(F.try_variant_get(parsed(text), path, "variant"))
    # Only texts that look like a container need the costlier look at the value's type. It stands in
    # a branch, not in a condition, so that Spark does not evaluate it for every row.
    looks = F.substring(found, 1, 1).isin("{", "[")
    return F.when(looks, F.when(kind == "STRING", found)).otherwise(found)


def scalar(text: Column, path: str) -> Column:
    """Text of the scalar at ``path``; null for absent values, JSON null, objects and arrays."""
    return _unless_container(F.get_json_object(text, path), text, path)


def with_scalars(frame: DataFrame, text: str, names: Sequence[str], target: str) -> DataFrame:
    """A struct column ``target`` of top-level scalars, as ``scalar`` gives them; each text is parsed once.

    The values come from a generator, below which no filter on them is pushed, so none makes Spark parse again.
    """
    found = [f"__{name}" for name in names]
    raw = frame.select("*", F.json_tuple(F.col(text), *names).alias(*found))
    fields = [_unless_container(F.col(f"__{name}"), F.col(text), f"$.{name}").alias(name) for name in names]
    return raw.withColumn(target, F.struct(*fields)).drop(*found)


def has_key(text: Column, name: str) -> Column:
    """Is ``name`` a top-level key?"""
    return F.coalesce(F.array_contains(F.json_object_keys(text), name), F.lit(False))


def canonical(text: Column) -> Column:
    """A form that is equal for documents equal up to key order and number spelling.

    Texts that are not JSON stand for themselves. Beyond the size that the parser takes the form is not
    known, so such a document fails the job rather than being compared as raw text.
    """
    oversize = F.raise_error(F.concat(F.lit("document too large to compare: bytes "), F.octet_length(text))).cast("string")
    raw = F.when(F.octet_length(text) > PARSER_LIMIT, oversize).otherwise(text)
    return F.coalesce(F.to_json(parsed(text)), raw)


def fingerprint(text: Column) -> Column:
    """Digest of the canonical form; stands in for the document in shuffles."""
    return F.sha2(canonical(text), 256)


def same_json(left: Column, right: Column) -> Column:
    return canonical(left) == canonical(right)


def _no_constant(name: str) -> object:
    raise ValueError(f"{name} is not JSON")


def _finite(digits: str) -> float:
    number = float(digits)
    if math.isinf(number):
        raise ValueError(f"{digits} is out of range")
    return number


def read_document(raw: str) -> object:
    """The document in a text; NaN, infinities and numbers out of range are refused like other text that is not JSON."""
    try:
        return json.loads(raw, parse_constant=_no_constant, parse_float=_finite)
    except RecursionError as error:
        raise ValueError("nested too deeply") from error


def compact_text(document: object) -> str:
    """Compact encoding; refuses text that has no UTF-8 form (half of a surrogate pair)."""
    text = json.dumps(document, separators=(",", ":"), ensure_ascii=False)
    text.encode("utf-8")
    return text


def compact(text: Column) -> Column:
    """Compact encoding that keeps key order; null when the text is not JSON."""

    @F.pandas_udf("string")
    def encode(texts: pd.Series) -> pd.Series:
        def one(raw):
            try:
                return None if raw is None else compact_text(read_document(raw))
            except ValueError:
                return None

        return texts.map(one, na_action="ignore")

    return encode(text)


def _canonical_parts(value: object) -> Iterator[str]:
    """The canonical form of a document, piece by piece: sorted keys, and whole numbers without a fraction."""
    if isinstance(value, dict):
        for n, key in enumerate(sorted(value)):
            yield ("," if n else "{") + json.dumps(key) + ":"
            yield from _canonical_parts(value[key])
        yield "}" if value else "{}"
    elif isinstance(value, list):
        for n, item in enumerate(value):
            yield "," if n else "["
            yield from _canonical_parts(item)
        yield "]" if value else "[]"
    else:
        yield json.dumps(int(value) if isinstance(value, float) and value.is_integer() else value)


def digest_of(document: object) -> str:
    """Digest of a document that is equal for documents equal up to key order and number spelling, of any size."""
    digest = hashlib.sha256()
    for part in _canonical_parts(document):
        digest.update(part.encode())
    return digest.hexdigest()


# Up to this many characters, and brackets, which bound its depth, a document's canonical form is made in one piece.
SHORT, SHALLOW = 1 << 20, 300


def _whole(digits: str) -> int | float:
    number = _finite(digits)
    return int(number) if number.is_integer() else number


# made once, as each takes longer to make than a short document to read
_READER = json.JSONDecoder(parse_constant=_no_constant, parse_float=_whole)
_WRITER = json.JSONEncoder(sort_keys=True, separators=(",", ":"))


def text_digest(raw: str | None) -> str | None:
    """``digest_of`` the document in a text; texts that are not JSON stand for themselves."""
    if raw is None:
        return None
    try:
        if len(raw) <= SHORT and raw.count("[") + raw.count("{") <= SHALLOW:
            return hashlib.sha256(_WRITER.encode(_READER.decode(raw)).encode()).hexdigest()
        return digest_of(read_document(raw))
    except (RecursionError, ValueError):
        return "text:" + hashlib.sha256(raw.encode("utf-8", "surrogatepass")).hexdigest()


def content_digest(text: Column) -> Column:
    """``text_digest`` as a column; unlike ``fingerprint``, without a bound on the size."""

    @F.pandas_udf("string")
    def digests(texts: pd.Series) -> pd.Series:
        # copies in a batch are read once
        known = {raw: text_digest(raw) for raw in set(texts) if isinstance(raw, str)}
        return pd.Series([known[raw] if isinstance(raw, str) else None for raw in texts], dtype=object)

    return digests(text)
