"""A small checker for the JSON-schema keywords in use; runs inside tasks on one document at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

# Type names and message texts of the violation report.
TYPE_NAMES = {
    "object": "JSONObject", "array": "JSONArray", "string": "String", "integer": "Integer",
    "number": "Number", "boolean": "Boolean", "null": "Null",
}
WRONG_TYPE = "expected type: {want}, found: {got}"
MISSING_KEY = "required key [{key}] not found"
EXTRA_KEY = "extraneous key [{key}] is not permitted"
BAD_PATTERN = "string [{value}] does not match pattern {pattern}"
BAD_ENUM = "{value} is not a valid enum value"
UNSUPPORTED = "constraint [{key}] is not supported"
FORBIDDEN = "no value is permitted"
# Constraints of JSON schemas that are not checked; keywords outside the standard constrain nothing.
UNCHECKED = {
    "$ref", "additionalItems", "allOf", "anyOf", "const", "contains", "dependencies", "dependentRequired", "dependentSchemas", "else",
    "exclusiveMaximum", "exclusiveMinimum", "format", "if", "maxItems", "maxLength", "maxProperties", "maximum", "minItems", "minLength", "minProperties",
    "minimum", "multipleOf", "not", "oneOf", "patternProperties", "prefixItems", "propertyNames", "then", "unevaluatedItems",
    "unevaluatedProperties", "uniqueItems",
}


class BadSchema(Exception):
    """A schema that cannot be applied."""


def type_of(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    if isinstance(value, float):
        return "number"
    if isinstance(value, str):
        return "string"
    return "array" if isinstance(value, list) else "object"


def _fits(value: object, wanted: str) -> bool:
    actual = type_of(value)
    return actual == wanted or (wanted == "number" and actual == "integer")


def _same(value: object, allowed: object) -> bool:
    return type_of(value) == type_of(allowed) and value == allowed


def _found(pattern: str, value: str) -> bool:
    try:
        return re.search(pattern, value) is not None
    except (re.error, TypeError) as error:
        raise BadSchema(str(error)) from error


def violations(value: object, schema: object, where: str = "#") -> Iterator[str]:
    """One message per violation of ``type, required, properties, items, enum, pattern, additionalProperties``.

    A constraint of another kind is named in a message of its own, so that nothing
    passes unseen. A pattern that cannot be read makes the schema a bad one.
    """
    if schema is False:
        yield f"{where}: {FORBIDDEN}"
    if not isinstance(schema, dict):
        return
    for key in schema:
        if key in UNCHECKED:
            yield f"{where}: {UNSUPPORTED.format(key=key)}"
    wanted = schema.get("type")
    if wanted is not None:
        options = wanted if isinstance(wanted, list) else [wanted]
        if not any(_fits(value, option) for option in options):
            want = " or ".join(TYPE_NAMES.get(o, o) for o in options)
            yield f"{where}: {WRONG_TYPE.format(want=want, got=TYPE_NAMES[type_of(value)])}"
            return
    allowed = schema.get("enum")
    if allowed is not None and not any(_same(value, option) for option in allowed):
        yield f"{where}: {BAD_ENUM.format(value=value)}"
    if isinstance(value, str) and "pattern" in schema and not _found(schema["pattern"], value):
        yield f"{where}: {BAD_PATTERN.format(value=value, pattern=schema['pattern'])}"
    if isinstance(value, list) and "items" in schema:
        for index, item in enumerate(value):
            yield from violations(item, schema["items"], f"{where}/{index}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for key in schema.get("required", []):
            if key not in value:
                yield f"{where}: {MISSING_KEY.format(key=key)}"
        extra = schema.get("additionalProperties", True)
        for key in value:
            if key in known:
                yield from violations(value[key], known[key], f"{where}/{key}")
            elif extra is False:
                yield f"{where}: {EXTRA_KEY.format(key=key)}"
            else:
                yield from violations(value[key], extra, f"{where}/{key}")
