"""Validation of conversations: set-wise rules over long tables, and whole nested records.

Nothing is dropped silently: each operator gives the rows kept and the rows rejected, with the first reason."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..errors import ValidationError
from ..functions.text import blank, coerce_object, spaced
from ..schemas import MAX_IMAGES, RESERVED_TAGS, ROLES

REASONS = ("no_messages", "unknown_role", "late_system", "reserved_tag", "empty_turn", "no_user", "no_assistant")


def long_rejects(messages: DataFrame) -> DataFrame:
    """conv_id, turn, reason: the first broken rule of each conversation, in order of turns, then of rules.

    messages: conv_id, turn, role, text; tool-free. A rule over a whole conversation counts after all turns. The minimum of
    (turn, rule) is a partial aggregation: no conversation is gathered."""
    role = F.lower(F.col("role"))
    first = F.min("turn").over(Window.partitionBy("conv_id"))
    tagged = F.lit(False)
    for tag in RESERVED_TAGS:
        tagged = tagged | F.contains(F.coalesce("text", F.lit("")), F.lit(tag))
    known = role.isin(*ROLES)
    rule = F.when(~F.coalesce(known, F.lit(False)), 1).when(role.isin("system", "developer") & (F.col("turn") != F.col("first")), 2)
    rule = rule.when(~role.isin("assistant") & tagged, 3).when(role.isin("assistant") & blank(F.col("text")), 4)
    marked = messages.withColumn("first", first).select("conv_id", "turn", role.alias("role"), rule.alias("rule"))
    found = marked.groupBy("conv_id").agg(
        F.min(F.when(F.col("rule").isNotNull(), F.col("turn").cast("long") * 8 + F.col("rule"))).alias("broken"),
        F.sum((F.col("role") == "user").cast("long")).alias("users"), F.sum((F.col("role") == "assistant").cast("long")).alias("assistants"),
    )
    whole = F.when(F.coalesce("users", F.lit(0)) == 0, 5).when(F.coalesce("assistants", F.lit(0)) == 0, 6)
    number = F.coalesce(F.pmod("broken", F.lit(8)).cast("int"), whole)
    reason = F.coalesce(*[F.when(number == i, name) for i, name in enumerate(REASONS)])
    return found.select("conv_id", F.floor(F.col("broken") / 8).alias("turn"), reason.alias("reason"))


def validated(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages of conversations without a fault, and (conv_id, turn, reason) of the others."""
    rejected = long_rejects(messages).where("reason is not null")
    return messages.join(rejected, "conv_id", "left_anti"), rejected


def islands(messages: DataFrame) -> DataFrame:
    """Adjacent tool messages become one turn: `island` numbers the turns that remain."""
    own = Window.partitionBy("conv_id").orderBy("turn")
    tool = F.col("role") == "tool"
    starts = (~(tool & F.coalesce(F.lag("role").over(own) == "tool", F.lit(False)))).cast("int")
    return messages.withColumn("starts", starts).withColumn("island", F.sum("starts").over(own.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("starts")


# Whole nested records.


class _Fault(ValidationError):
    def __init__(self, reason: str, where: str):
        super().__init__(f"{reason} at {where}")
        self.reason, self.where = reason, where


def _text(value, where: str, sanitize: bool) -> str:
    value = value or ""
    if not isinstance(value, str):
        raise _Fault("not_text", where)
    for tag in RESERVED_TAGS:
        if tag in value:
            if not sanitize:
                raise _Fault("reserved_tag", where)
            value = value.replace(tag, "‹" + tag[1:])
    return value


def normal_tools(tools, sanitize: bool = False) -> list[dict]:
    """Tools by name, each once, with an object of parameters."""
    found = {}
    for i, entry in enumerate(tools or []):
        where = f"tools[{i}]"
        if not isinstance(entry, dict) or not isinstance(entry.get("function", entry), dict):
            raise _Fault("bad_tool", where)
        f = entry.get("function", entry)
        name, about = f.get("name"), f.get("description") or ""
        if not isinstance(name, str) or not name or name in found or not isinstance(about, str):
            raise _Fault("bad_tool", where)
        raw = f.get("parameters", f.get("input_schema"))
        try:
            schema = {"type": "object", "properties": {}} if raw is None else coerce_object(raw)
        except ValidationError as e:
            raise _Fault("bad_tool", where) from e
        found[name] = {"name": name, "description": _text(about, where, sanitize), "input_schema": schema}
    return [found[n] for n in sorted(found)]


def _calls(message: dict, where: str) -> list[dict]:
    raw = message.get("tool_calls") or []
    if not isinstance(raw, list):
        raise _Fault("bad_tool_call", where)
    found = []
    for j, call in enumerate(raw):
        at = f"{where}.tool_calls[{j}]"
        f = call.get("function", call) if isinstance(call, dict) else None
        if not isinstance(f, dict) or not isinstance(f.get("name"), str) or not f["name"]:
            raise _Fault("bad_tool_call", at + ".function.name")
        ident = call.get("id") or f.get("id")
        if not isinstance(ident, str) or not ident:
            raise _Fault("missing_call_id", at + ".id")
        try:
            arguments = coerce_object(f.get("arguments") or f.get("input") or {})
        except ValidationError as e:
            raise _Fault("bad_arguments", at + ".function.arguments") from e
        found.append({"id": ident, "name": f["name"], "arguments": arguments})
    return found


def _results(message: dict, where: str, sanitize: bool) -> list[dict]:
    raw = message.get("results")
    if not raw and message.get("tool_call_id"):
        raw = [{"tool_use_id": message["tool_call_id"], "content": message.get("content"), "is_error": message.get("is_error", False)}]
    if raw is not None and not isinstance(raw, list):
        raise _Fault("bad_result", where)
    found = []
    for j, r in enumerate(raw or []):
        at = f"{where}.results[{j}]"
        ident = (r.get("tool_use_id") or r.get("tool_call_id")) if isinstance(r, dict) else None
        if not isinstance(ident, str) or not ident:
            raise _Fault("bad_result", at)
        found.append({"tool_use_id": ident, "content": _text(r.get("content"), at, sanitize), "is_error": bool(r.get("is_error", False))})
    if not found:
        raise _Fault("no_results", where)
    return found


def image_ref_problem(ref) -> str | None:
    """Why a path is no relative path below the images' root."""
    if not isinstance(ref, str) or not ref.strip():
        return "empty"
    if "\\" in ref:
        return "backslash"
    if ref.startswith("/"):
        return "absolute"
    if re.match(r"[A-Za-z]:", ref):
        return "drive"
    parts = ref.split("/")
    return "parent" if ".." in parts else "empty" if parts[0] in ("", ".") else None


def _images(raw, where: str) -> list[dict]:
    if not isinstance(raw, list) or len(raw) > MAX_IMAGES:
        raise _Fault("bad_images", where)
    whole = lambda v: isinstance(v, int) and not isinstance(v, bool) and v >= 1
    found = []
    for j, x in enumerate(raw):
        at = f"{where}.images[{j}]"
        if not isinstance(x, dict) or image_ref_problem(x.get("ref")):
            raise _Fault("bad_image_ref", at)
        grid, merge = x.get("grid_thw"), x.get("merge_size", 2)
        if not isinstance(grid, list) or len(grid) != 3 or not all(map(whole, grid)) or not whole(merge) or grid[1] % merge or grid[2] % merge:
            raise _Fault("bad_image_grid", at)
        found.append({"ref": x["ref"], "grid_thw": grid, "merge_size": merge})
    return found


def split_thinking(message: dict) -> tuple[str, str]:
    said = message.get("reasoning_content") or message.get("thinking") or ""
    content = message.get("content") or ""
    content = content if isinstance(content, str) else str(content)
    if isinstance(said, str) and said.strip():
        return said.strip(), content
    if "</think>" not in content:
        return "", content
    before, after = content.split("</think>", 1)
    return before.split("<think>")[-1].strip(), after.strip()


def normalize(record: dict, sanitize: bool = False) -> dict:
    """The canonical conversation {messages, tools} of a raw record; the first broken rule is raised with its place."""
    messages = record.get("messages")
    if not isinstance(messages, list) or not messages:
        raise _Fault("no_messages", "messages")
    for i, m in enumerate(messages):
        if not isinstance(m, dict):
            raise _Fault("bad_message", f"messages[{i}]")
        if m.get("images") and m.get("role") != "user":
            raise _Fault("images_off_user", f"messages[{i}].images")
    tools = normal_tools(record.get("tools"), sanitize)
    known = {t["name"] for t in tools}
    asked: dict[str, str] = {}
    answered: set[str] = set()
    out: list[dict] = []
    users = assistants = 0
    for i, m in enumerate(messages):
        where, role = f"messages[{i}]", m.get("role")
        turn = {"role": role, "content": "", "reasoning_content": "", "tool_calls": [], "results": [], "images": []}
        if role not in ROLES:
            raise _Fault("unknown_role", where)
        if role in ("system", "developer"):
            if i:
                raise _Fault("late_system", where)
            turn |= {"role": "system", "content": _text(m.get("content"), where, sanitize)}
        elif role == "user":
            users += 1
            turn["content"] = _text(m.get("content"), where, sanitize)
            turn["images"] = _images(m["images"], where) if m.get("images") else []
        elif role == "assistant":
            assistants += 1
            turn["tool_calls"] = _calls(m, where)
            turn["reasoning_content"], turn["content"] = split_thinking(m)
            if not turn["tool_calls"] and not turn["content"].strip() and not turn["reasoning_content"].strip():
                raise _Fault("empty_turn", where)
            for j, call in enumerate(turn["tool_calls"]):
                if known and call["name"] not in known:
                    raise _Fault("unlisted_tool", f"{where}.tool_calls[{j}]")
                if call["id"] in asked:
                    raise _Fault("duplicate_call_id", f"{where}.tool_calls[{j}]")
                asked[call["id"]] = where
        else:
            for j, r in enumerate(got := _results(m, where, sanitize)):
                if r["tool_use_id"] not in asked:
                    raise _Fault("dangling_result", f"{where}.results[{j}]")
                if r["tool_use_id"] in answered:
                    raise _Fault("second_result", f"{where}.results[{j}]")
                answered.add(r["tool_use_id"])
            if out and out[-1]["role"] == "tool":
                out[-1]["results"] += got
                continue
            turn["results"] = got
        out.append(turn)
    for reason, wrong in (("no_user", not users), ("no_assistant", not assistants), ("unanswered_call", bool(asked.keys() - answered))):
        if wrong:
            raise _Fault(reason, "messages")
    return {"messages": out, "tools": tools}


def normalize_records(raw: DataFrame, column: str = "value", sanitize: bool = False) -> DataFrame:
    """raw with conversation (JSON text, null if rejected), reason and place (null if kept); one Arrow pass."""

    @pandas_udf("struct<conversation:string,reason:string,place:string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            try:
                record = json.loads(t) if t is not None else None
                if not isinstance(record, dict):
                    raise _Fault("not_an_object", "record")
                rows.append((spaced(normalize(record, sanitize)), None, None))
            except _Fault as e:
                rows.append((None, e.reason, e.where))
            except ValueError:
                rows.append((None, "bad_json", "record"))
        return pd.DataFrame(rows, columns=["conversation", "reason", "place"])

    return raw.withColumn("x", run(F.col(column))).select("*", "x.conversation", "x.reason", "x.place").drop("x")


def kept_and_rejected(normalized: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two relations of normalize_records(); strict raises on the first reject that is met."""
    if strict:
        fail = F.raise_error(F.concat_ws(" at ", "reason", "place")).cast("boolean")
        return normalized.where(F.when(F.col("reason").isNull(), True).otherwise(fail)).drop("reason", "place"), normalized.where(F.lit(False)).drop("conversation")
    return normalized.where("reason is null").drop("reason", "place"), normalized.where("reason is not null").drop("conversation")
