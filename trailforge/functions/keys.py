"""Content keys: SHA-256 of the canonical JSON of a fingerprint."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import StoreError
from ..schemas import STORE_VERSION
from .text import canonical

# The fields of a fingerprint.
FIELDS = ("task_id", "sample_index", "stage", "model_id", "model_revision", "format_version", "template_sha", "harness_version", "dataset_version", "seed", "decode_params", "tool_catalog_sha", "image_digest")


def sha256_text(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def attempt_key(**fields) -> str:
    """The key of one attempt; a missing or unknown field is an error."""
    wrong = sorted(set(FIELDS) ^ set(fields))
    if wrong:
        raise StoreError(f"fingerprint fields missing or unknown: {wrong}")
    return sha256_text(canonical({"store_version": STORE_VERSION, **fields}))


def attempt_keys(rows) -> list[str]:
    """The keys of attempts given as mappings, each with all fields; for lists on the driver. Tables take key_column()."""
    return [attempt_key(**row) for row in rows]


def json_text(x: Column) -> Column:
    """A string column as JSON text in Python's way: quotes, backslashes and control characters escaped, the rest raw."""
    x = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        x = F.replace(x, F.lit(raw), F.lit(shown))
    for i in [*range(8), 11, *range(14, 32)]:
        x = F.replace(x, F.lit(chr(i)), F.lit(f"\\u{i:04x}"))
    return F.concat(F.lit('"'), x, F.lit('"'))


def key_column(config: dict, task_id: Column, sample: Column, stage: Column, turn: Column | None = None, call_index: Column | None = None, tool_name: Column | None = None) -> Column:
    """attempt_key() as an expression: what is constant is written once, on the driver; a row's fields are spliced in.

    A turn becomes part of the stage ("generate:t2"); a call adds call_index and tool_name."""
    rest = set(FIELDS) - {"task_id", "sample_index", "stage"}
    if set(config) != rest:
        raise StoreError(f"fingerprint fields missing or unknown: {sorted(set(config) ^ rest)}")
    if turn is not None:
        stage = F.concat(stage, F.lit(":t"), turn.cast("string"))
    parts: dict[str, Column | None] = dict.fromkeys([*config, "store_version"])
    parts |= {"task_id": json_text(task_id.cast("string")), "sample_index": sample.cast("string"), "stage": json_text(stage)}
    if call_index is not None:
        parts |= {"call_index": call_index.cast("string"), "tool_name": json_text(tool_name)}
    constant = {**config, "store_version": STORE_VERSION}
    pieces: list[Column] = []
    for i, name in enumerate(sorted(parts)):
        pieces.append(F.lit(("{" if not i else ",") + json.dumps(name) + ":"))
        pieces.append(parts[name] if parts[name] is not None else F.lit(canonical(constant[name])))
    return F.sha2(F.concat(*pieces, F.lit("}")), 256)
