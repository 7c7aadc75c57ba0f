"""Conversations as exact text, with the spans that are training targets."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..errors import TemplateError
from ..functions.text import spaced, strip
from ..schemas import FORMAT_VERSION, IGNORED_LABEL, VISION_PAD

# The marks of the format.
START, END = "<|im_start|>", "<|im_end|>\n"
VISION = ("<|vision_start|>", "<|vision_end|>")
EMPTY_THINKING = "<think>\n\n</think>\n\n"


def segments(conversation: dict, add_generation_prompt: bool = False, enable_thinking: bool = True) -> list[tuple[str, bool]]:
    """(text, supervised) in order. What an assistant writes is supervised; its header and end mark are not."""
    messages, tools = conversation["messages"], conversation.get("tools") or []
    out: list[tuple[str, bool]] = []
    head = messages[0] if messages and messages[0]["role"] == "system" else None
    if head or tools:
        about = (head["content"] or "").strip() if head else ""
        body = about + "\n" if about else ""
        if tools:
            body += "\n" * bool(about) + "<available_tools>\n" + "".join(spaced({k: t[k] for k in ("name", "description", "input_schema")}) + "\n" for t in tools) + "</available_tools>"
        out.append((f"{START}system\n{body}{END}", False))
    for m in messages[1:] if head else messages:
        if m["role"] == "user":
            pads = "".join("\n" + VISION[0] + VISION_PAD * (x["grid_thw"][0] * x["grid_thw"][1] * x["grid_thw"][2] // x["merge_size"] ** 2) + VISION[1] for x in m.get("images") or [])
            out.append((f"{START}user\n{(m['content'] or '').strip()}{pads}{END}", False))
        elif m["role"] == "tool":
            shown = "".join(f"<tool_result>{spaced({k: r[k] for k in ('tool_use_id', 'content', 'is_error')})}</tool_result>\n" for r in m["results"])
            out.append((f"{START}user\n{shown}{END}", False))
        elif m["role"] == "assistant":
            thinking, text = ((m.get(k) or "").strip() for k in ("reasoning_content", "content"))
            written = (thinking + "\n\n" if thinking else "") + (text + "\n" if text else "")
            written += "".join(f"<tool_use>{spaced({'id': c['id'], 'name': c['name'], 'input': c['arguments']})}</tool_use>\n" for c in m.get("tool_calls") or [])
            out += [(f"{START}assistant\n", False), (written, True), (END, False)]
        else:
            raise TemplateError(f"no such role in a rendered conversation: {m['role']}")
    if add_generation_prompt:
        out.append((f"{START}assistant\n" + ("" if enable_thinking else EMPTY_THINKING), False))
    return [x for x in out if x[0]]


def render_text(conversation: dict, **options) -> str:
    return "".join(t for t, _ in segments(conversation, **options))


def rendered(x: Column) -> Column:
    """Rendered text of canonical conversations in JSON."""

    @pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: render_text(json.loads(t)), na_action="ignore")

    return run(x)


def render_long(messages: DataFrame) -> DataFrame:
    """conv_id, rendered: tool-free conversations from a long table (conv_id, turn, role, text), in expressions only."""
    body = strip(F.coalesce("text", F.lit("")))
    system = F.col("role").isin("system", "developer")
    role = F.when(system, "system").otherwise(F.col("role"))
    tail = F.when((system | (role == "assistant")) & (body != ""), F.lit("\n")).otherwise(F.lit(""))
    turn = F.concat(F.lit(START), role, F.lit("\n"), body, tail, F.lit(END))
    own = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("t")))).alias("x"))
    return own.select("conv_id", F.array_join(F.transform("x", lambda x: x["t"]), "").alias("rendered"))


# Fixed value: where a template file names its format.
VERSION_MARK = r"\{#-\s*\n\s*format:\s*([a-z0-9.\-]+)\s*\n"


def template_version(source: str) -> str:
    """The format that a template file declares; one without is refused."""
    found = re.search(VERSION_MARK, source)
    if found is None:
        raise TemplateError("the template names no format")
    return found[1]


def check_token_format(source: str, pad_id: int | None, vision_pad_id: int | None = None, version: str = FORMAT_VERSION) -> None:
    """What must hold before tokens are made of a template: its format, the marks of what is supervised, a pad of its own."""
    if template_version(source) != version:
        raise TemplateError(f"the template's format is {template_version(source)}, not {version}")
    if "{% generation" not in source and "{%- generation" not in source:
        raise TemplateError("the template marks nothing as supervised")
    if pad_id is None or pad_id == vision_pad_id:
        raise TemplateError("the pad is missing, or is the pad of images")


def byte_tokenizer() -> Callable[[str], list[int]]:
    """A tokenizer that needs no model: the UTF-8 bytes."""
    return lambda text: list(text.encode())


def examples(conversations: DataFrame, tokenizer: Callable[[], Callable[[str], list[int]]] = byte_tokenizer, max_length: int | None = None, on_empty: str = "error") -> DataFrame:
    """conv_id, input_ids, attention_mask, labels, assistant_mask, truncated. conversations: conv_id, conversation (JSON).

    tokenizer() is called once per partition. on_empty: an example without a supervised token is an error, or skipped."""
    if on_empty not in ("error", "skip"):
        raise ValueError("on_empty is error or skip")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens_of = tokenizer()
        for batch in batches:
            rows = []
            for ident, text in zip(batch["conv_id"], batch["conversation"], strict=True):
                ids, mask = [], []
                for part, supervised in segments(json.loads(text)):
                    new = tokens_of(part)
                    ids += new
                    mask += [int(supervised)] * len(new)
                cut = max_length is not None and len(ids) > max_length
                ids, mask = ids[:max_length], mask[:max_length]
                if not any(mask):
                    if on_empty == "error":
                        raise TemplateError(f"conversation {ident}: nothing is supervised")
                    continue
                rows.append((ident, ids, [1] * len(ids), [i if m else IGNORED_LABEL for i, m in zip(ids, mask, strict=True)], mask, cut))
            yield pd.DataFrame(rows, columns=["conv_id", "input_ids", "attention_mask", "labels", "assistant_mask", "truncated"])

    return conversations.select(F.col("conv_id").cast("string").alias("conv_id"), "conversation").mapInPandas(run, "conv_id string, input_ids array<int>, attention_mask array<int>, labels array<int>, assistant_mask array<int>, truncated boolean")


def mask_problem(x: DataFrame) -> Column:
    """Why an example is not sane, or null: lengths, no supervision, labels that disagree with the mask."""
    size = F.size("input_ids")
    same = (F.size("labels") == size) & (F.size("assistant_mask") == size) & (F.size("attention_mask") == size)
    agree = F.forall(F.zip_with("labels", "assistant_mask", lambda a, b: (a != IGNORED_LABEL) == (b == 1)), lambda v: v)
    return F.when(~same, "lengths").when(~F.exists("assistant_mask", lambda v: v == 1), "no_supervision").when(~agree, "labels")


def export_lines(rows: DataFrame) -> DataFrame:
    """One compact JSON line per example, with the format's version."""
    return rows.select(F.to_json(F.struct(F.lit(FORMAT_VERSION).alias("format_version"), "input_ids", "attention_mask", "labels", "assistant_mask")).alias("value"))


def token_totals(rows: DataFrame) -> DataFrame:
    """records, total, supervised, longest, average (floored), share (of all tokens; 1.0 without any)."""
    n, s = F.size("input_ids"), F.aggregate("assistant_mask", F.lit(0), lambda a, v: a + v)
    found = rows.agg(F.count("*").alias("records"), F.sum(n).alias("total"), F.sum(s).alias("supervised"), F.max(n).alias("longest"))
    return found.select("*", F.floor(F.col("total") / F.col("records")).alias("average"), F.when(F.col("total") > 0, F.least(F.lit(1.0), F.col("supervised") / F.col("total"))).otherwise(1.0).alias("share"))


def measure_dataset(conversations: DataFrame, max_records: int | None = None, max_tokens: int | None = None, tokenizer: Callable[[], Callable[[str], list[int]]] = byte_tokenizer) -> tuple[DataFrame, DataFrame]:
    """The examples of the first max_records conversations (by conv_id) that stay below max_tokens, and the others'
    conv_id with the reason: truncated or nothing_supervised."""
    rows = conversations
    if max_records is not None:
        rows = rows.orderBy("conv_id").limit(max_records)
    made = examples(rows, tokenizer, on_empty="skip")
    long = F.size("input_ids") >= max_tokens if max_tokens is not None else F.lit(False)
    named = rows.select(F.col("conv_id").cast("string").alias("conv_id")).join(made.select("conv_id", long.alias("long")), "conv_id", "left")
    refused = named.select("conv_id", F.when(F.col("long").isNull(), "nothing_supervised").when(F.col("long"), "truncated").alias("reason")).where("reason is not null")
    return made.where(~long), refused


def pair_examples(pairs: DataFrame, tokenizer: Callable[[], Callable[[str], list[int]]] = byte_tokenizer, max_length: int | None = None) -> DataFrame:
    """task_id, chosen and rejected (input_ids, assistant_mask) of preference pairs whose sides are conversations in JSON."""
    side = lambda name: examples(pairs.select(F.col("task_id").alias("conv_id"), F.col(name).alias("conversation")), tokenizer, max_length).select(F.col("conv_id").alias("task_id"), F.struct("input_ids", "assistant_mask").alias(name))
    return side("chosen").join(side("rejected"), "task_id")


def measured_rows(conversations: DataFrame, tokenizer: Callable[[], Callable[[str], list[int]]] = byte_tokenizer) -> DataFrame:
    """conv_id, supervised_tokens, total_tokens by a real rendering: what a mined record is measured by."""
    made = examples(conversations, tokenizer, on_empty="skip")
    return made.select("conv_id", F.aggregate("assistant_mask", F.lit(0), lambda a, v: a + v).cast("long").alias("supervised_tokens"), F.size("input_ids").cast("long").alias("total_tokens"))


def sequence_logprob(logprobs: Column, mask: Column) -> Column:
    """The sum of log-probabilities at supervised positions."""
    return F.aggregate(F.zip_with(logprobs, mask, lambda p, m: F.when(m == 1, p).otherwise(0.0)), F.lit(0.0), lambda a, v: a + v)
