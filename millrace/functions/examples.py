"""Rows of any of the known shapes as one normal example, in JSON."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.messages import ROLES, _decoded, _flatten, _text

# Keys by which rows of different sources name the same thing, in order of preference.
MESSAGE_KEYS = ("messages", "conversations", "conversation", "trajectory")
PROMPT_KEYS, ANSWER_KEYS, CONTEXT_KEYS = ("question", "instruction", "prompt", "problem", "task"), ("answer", "response", "completion", "output", "solution"), ("input", "context")
REASONING_KEYS, CALL_KEYS = ("reasoning_content", "reasoning", "thinking", "thought"), ("tool_calls", "function_calls", "function_call")
KEPT_KEYS = (
    "passed", "pass", "resolved", "source_outcome", "metadata", "uuid", "task_id", "teacher", "language", "difficulty", "source", "source_note", "model_patch", "model_patch_bytes", "patch_bytes",
    "original_model_patch_bytes",
)
# Where a row keeps a fact that it does not have itself, in order.
NESTED_KEYS = ("source_outcome", "metadata")
# Facts that a published row carries from its source; uuid becomes source_uuid.
PUBLISHED_KEYS = (
    "reward", "source", "source_note", "uuid", "task_id", "source_shard", "source_row_index", "row_source", "source_group", "language", "teacher", "difficulty", "agent_exit_status", "model_patch_bytes",
    "percent_messages_with_reasoning", "api_calls", "assistant_message_count", "trajectory_bytes", "trajectory_chars", "recommended_for_compaction_training", "quality_rule_version", "quality_flags",
    "failure_class", "compaction_original_row_id", "compaction_original_row_path", "prompt_repair_source_raw_compacted_uuid", "prompt_repair_source_firstturn_uuid", "prompt_repair_v4_uuid",
    "verification_modification_family", "verification_source_uuid", "verification_original_row_uuid",
)


def _think(reasoning, content) -> str:
    body = _text(content)
    if reasoning is None and body.lstrip().startswith("<think>"):
        return body
    head = f"<think>\n{_text(reasoning).strip()}\n</think>\n"
    return head + body if body else head.rstrip("\n")


def _calls(value) -> list:
    value = _decoded(value)
    out = []
    for call in value if isinstance(value, list) else [value] if isinstance(value, dict) else []:
        call = _decoded(call)
        if not isinstance(call, dict):
            continue
        inner = call["function"] if isinstance(call.get("function"), dict) else call
        name = inner.get("name", call.get("name", ""))
        if name:
            out.append({"function": {"name": str(name), "arguments": _decoded(inner.get("arguments", {}))}})
    return out


def message(m) -> dict | None:
    """A raw message as a normal one, or None where it is no part of a chat."""
    if not isinstance(m, dict):
        return None
    role = ROLES.get(str(m.get("role", m.get("from", m.get("speaker")))).strip().lower())
    content = next((m[k] for k in ("content", "value", "text", "system_prompt") if k in m), "")
    if role != "assistant":
        return {"role": role, "content": _text(content)} if role else None
    _, thought, inside = _flatten(_decoded(content))
    reasoning = next((m[k] for k in REASONING_KEYS if m.get(k) not in (None, "")), thought or None)
    out = {"role": role, "content": _think(reasoning, content)} | {k: False for k in ("trainable", "loss") if m.get(k) is False}
    calls = next((c for k in CALL_KEYS if (c := _calls(m.get(k)))), _calls(inside))
    return out | ({"tool_calls": calls} if calls else {})


def _target(m: dict) -> bool:
    said = m["content"].strip()
    return m["role"] == "assistant" and bool(m.get("tool_calls") or (said and said != "<think>\n\n</think>"))


def example(row) -> dict | None:
    """A raw row as a normal example, or None where it has nothing to learn."""
    if not isinstance(row, dict):
        return None
    raw = next((v for k in MESSAGE_KEYS if isinstance(v := _decoded(row.get(k)), list)), None)
    out: dict = {}
    if raw is None:
        first = lambda keys: next((row[k] for k in keys if row.get(k) not in (None, "")), None)
        asked, answer, context = first(PROMPT_KEYS), first(ANSWER_KEYS), first(CONTEXT_KEYS)
        if asked is None or answer is None:
            return None
        chat = [{"role": "user", "content": _text(asked) + (f"\n\n{_text(context)}" if context else "")}, {"role": "assistant", "content": _think(None, answer)}]
    else:
        chat = [m for m in map(message, raw) if m]
        while chat and chat[0]["role"] == "system" and not chat[0]["content"].strip():
            chat = chat[1:]
        tools = _decoded(row.get("tools"))
        out = {"tools": tools} if tools not in (None, "", [], {}) else {}
    if not any(map(_target, chat)):
        return None
    return {"messages": chat} | out | {k: row[k] for k in KEPT_KEYS if k in row}


def normalized(row: Column) -> Column:
    """`example` of a row given as JSON text, as JSON text; null for bad JSON and rows without anything to learn."""

    def one(x: str | None) -> str | None:
        try:
            made = example(json.loads(x))
        except (TypeError, ValueError):
            return None
        return None if made is None else json.dumps(made, ensure_ascii=False)

    def run(batch: pd.Series) -> pd.Series:
        return batch.map(one)

    return F.pandas_udf(run, "string")(row)


def source_fact(row: Column, key: str) -> Column:
    """A fact of a row given as a variant: its own key, else one in its outcome, else one in its metadata; null if none has it.

    The first that has the key decides, even with a JSON null.
    """
    return F.coalesce(*(F.try_variant_get(row, f"$.{p}", "variant") for p in (key, *(f"{n}.{key}" for n in NESTED_KEYS))))


def published_row(row: Column, keys: tuple[str, ...] | list[str] = PUBLISHED_KEYS) -> list[Column]:
    """Flat columns of a published row, from an example as JSON text: passed as a truth value, messages and tools as
    JSON, the other facts as text, uuid as source_uuid. Empty facts are null: JSON nulls, "", [] and {}. Where the
    text is null or no JSON all columns are. Dataset, view, shard and numbers are the caller's columns."""
    v = F.try_parse_json(row)

    def kept(value: Column, out: Column) -> Column:
        return F.when(~F.to_json(value).isin("null", '""', "[]", "{}"), out)

    passed = F.to_json(source_fact(v, "passed"))
    truth = passed.isNotNull() & ~passed.isin("null", "false", '""', "[]", "{}") & F.coalesce(passed.try_cast("double") != 0, F.lit(True))
    tools = F.try_variant_get(v, "$.tools", "variant")
    facts = {("source_uuid" if k == "uuid" else k): source_fact(v, k) for k in keys}
    return [
        F.get_json_object(row, "$.messages").alias("messages"), F.when(v.isNotNull(), truth).alias("passed"), kept(tools, F.get_json_object(row, "$.tools")).alias("tools"),
        *(kept(f, F.try_variant_get(f, "$", "string")).alias(k) for k, f in facts.items()),
    ]
