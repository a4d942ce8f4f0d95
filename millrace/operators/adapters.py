"""Traces of other agents as traces that use one shell tool."""

from __future__ import annotations

import json
import re
import shlex
from collections.abc import Iterator
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

SHELL_NAMES = ("bash", "execute_bash", "shell", "terminal", "run_command")
SUBMIT_NAMES = ("submit", "finish", "complete", "task_complete")
#: Languages of a fence that may hold a command; none counts as well.
FENCED = ("", "bash", "sh", "shell", "console")


@dataclass(frozen=True)
class Adaptation:
    """How a trace is adapted; all flags off keeps visible content beside the calls."""

    reasoning: bool = False  # the text before a call becomes its reasoning
    toolonly: bool = False  # no content beside calls
    strict: bool = False  # one instruction to use the shell tool heads the task; think tags go
    submit: bool = False  # traces without a submit are dropped
    first: bool = False  # only the first user and assistant turns
    recovery: bool = False  # the same with a format error between them
    toolobs: bool = False  # observations told by the user become tool turns
    single: bool = False  # one call a turn; turns are split with their observations
    emptythink: bool = False  # an empty reasoning before calls


FLAGS = tuple(f.name for f in fields(Adaptation))
#: Fixed texts that adapted traces carry.
SYSTEM = "You solve tasks in a repository by running shell commands with the bash tool."
STRICT = "Use the bash tool for every step and submit when the task is done.\n\n"
FORMAT_ERROR = "Your last reply held no valid tool call. Call the bash tool."
SUBMIT = "echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT && cat patch.txt"
THINK_TAGS = re.compile(r"</?think>")


def parse(transform: str) -> Adaptation | None:
    """The adaptation that a name spells: bash_tool and flags joined by underscores; `none` adapts nothing.

    `visible` says that content stays, which is the default. Anything else is an error.
    """
    if transform == "none":
        return None
    head, words = transform[:9], [w for w in transform[9:].split("_") if w]
    if head != "bash_tool" or set(words) - {*FLAGS, "visible"} or len(set(words)) < len(words):
        raise ValueError(f"unknown transform {transform}")
    return Adaptation(**{w: True for w in words if w != "visible"})


def json_objects(text: str) -> list:
    """All JSON objects that start at some brace of a text, outermost ones only."""
    out, at, decoder = [], 0, json.JSONDecoder()
    while (at := text.find("{", at)) >= 0:
        try:
            value, end = decoder.raw_decode(text, at)
            out.append(value)
            at = end
        except ValueError:
            at += 1
    return out


def edit_command(a: dict) -> str | None:
    """A file editor's call as a shell command."""
    path, kind = shlex.quote(str(a.get("path", ""))), a.get("command")
    if kind == "view":
        span = a.get("view_range")
        return f"sed -n '{span[0]},{span[1]}p' {path}" if span else f"cat {path}"
    if kind == "create":
        return f"cat > {path} <<'EOF'\n{a.get('file_text', '')}\nEOF"
    if kind in ("str_replace", "insert"):
        keys = {"str_replace": ("old_str", "new_str"), "insert": ("insert_line", "new_str")}[kind]
        values = ", ".join(repr(a.get(k, "")) for k in keys)
        step = "t = t.replace(a, b, 1)" if kind == "str_replace" else "n = t.split('\\n'); n.insert(int(a), b); t = '\\n'.join(n)"
        return f"python3 - <<'EOF'\np = {a.get('path', '')!r}\na, b = {values}\nt = open(p).read()\n{step}\nopen(p, 'w').write(t)\nEOF"
    return None


def native_command(name: str, arguments, submit: str) -> str | None:
    """The shell command that stands for a native tool call, or None."""
    try:
        a = json.loads(arguments) if isinstance(arguments, str) else arguments or {}
    except ValueError:
        return None
    if not isinstance(a, dict):
        return None
    if name in SHELL_NAMES:
        return a.get("command") or a.get("cmd")
    if name in SUBMIT_NAMES:
        return submit
    return edit_command(a) if name == "str_replace_editor" else None


def fenced_command(text: str) -> str | None:
    """The command in a text's first fence, if that is of a shell or of nothing and holds one line."""
    blocks = text.split("```")
    if len(blocks) < 3:
        return None
    language, line_end, body = blocks[1].partition("\n")
    body = (body if line_end else language).strip()
    allowed = not line_end or language.strip().lower() in FENCED
    return body if allowed and body and "\n" not in body else None


def turn_commands(m: dict) -> tuple[str, str, list[str]]:
    """(kind, text left beside the commands, commands) of an assistant message: native calls, else the last JSON object with
    commands, which submits only if it has none and says that the task is complete, else the first fence's line."""
    text = m.get("content") or ""
    found = [c for c in (native_command(x["function"]["name"], x["function"]["arguments"], SUBMIT) for x in m.get("tool_calls") or []) if c]
    if found:
        return "native", text, found
    value = next((v for v in reversed(json_objects(text)) if isinstance(v, dict) and isinstance(v.get("commands"), list)), None)
    if value is not None:
        found = [c for x in value["commands"] if isinstance(x, dict) and (c := str(x.get("keystrokes") or "").rstrip())]
        found = found or ([SUBMIT] if value.get("task_complete") is True else [])
        if found:
            return "json", "\n\n".join(x for k in ("analysis", "plan") if (x := str(value.get(k) or "").strip())), found
    command = fenced_command(text)
    return ("fenced", text, [command]) if command else ("none", text, [])


def split_calls(messages: list[dict]) -> list[dict] | None:
    """One call a turn: the observation after a turn of several is cut at the prompt lines of its commands; None if it can't be."""
    out, skip = [], False
    for i, m in enumerate(messages):
        if skip:
            skip = False
            continue
        calls = m.get("tool_calls") or []
        if len(calls) < 2:
            out.append(m)
            continue
        after = messages[i + 1]["content"] or "" if i + 1 < len(messages) else ""
        commands = [json.loads(c["function"]["arguments"])["command"] for c in calls]
        pieces = re.split("|".join(re.escape(f"$ {c}\n") for c in commands), after)
        if len(pieces) != len(commands) + 1:
            return None
        for k, c in enumerate(calls):
            out += [{**m, "content": m["content"] if k == 0 else "", "tool_calls": [c]}, {"role": "tool", "content": pieces[k + 1].rstrip("\n")}]
        skip = True
    return out


COUNTERS = ("assistant_turns", "native_turns", "json_turns", "fenced_turns", "observations_moved", "commands", "split_turns", "dropped_no_command", "dropped_no_submit", "dropped_no_split", "dropped_no_first_turn")


def adapt(messages: list[dict], how: Adaptation) -> tuple[list[dict] | None, dict]:
    """(the adapted trace or None, counters)."""
    n, out, asked = dict.fromkeys(COUNTERS, 0), [], False
    if not messages or messages[0]["role"] != "system":
        messages = [{"role": "system", "content": SYSTEM}, *messages]
    for m in messages:
        role, text = m["role"], m.get("content") or ""
        if role != "assistant":
            told = role == "user" and out and out[-1]["role"] == "assistant"
            if how.toolobs and told:
                role = "tool"
                n["observations_moved"] += 1
            elif role == "user" and not asked:
                asked, text = True, STRICT + text if how.strict else text
            out.append({"role": role, "content": text})
            continue
        n["assistant_turns"] += 1
        kind, text, commands = turn_commands(m)
        if not commands:
            return None, n | {"dropped_no_command": 1}
        n[f"{kind}_turns"] += 1
        n["commands"] += len(commands)
        calls = [{"function": {"name": "bash", "arguments": json.dumps({"command": c})}} for c in commands]
        said = THINK_TAGS.sub("", text).strip() if how.strict or how.reasoning else text
        turn = {"role": "assistant", "content": "" if how.toolonly or how.reasoning else said, "tool_calls": calls}
        if how.emptythink:
            turn["reasoning_content"] = "\n"
        elif how.reasoning and said:
            turn["reasoning_content"] = said
        out.append(turn)
    told = [c["function"]["arguments"] for m in out for c in m.get("tool_calls") or []]
    if how.submit and not any("complete_task_and_submit_final_output" in a.lower() for a in told):
        return None, n | {"dropped_no_submit": 1}
    if how.single:
        n["split_turns"] = sum(len(m.get("tool_calls") or []) > 1 for m in out)
        out = split_calls(out)
        if out is None or sum(m["role"] == "user" for m in out) > 1:
            return None, n | {"dropped_no_split": 1}
    if how.first or how.recovery:
        user, reply = (next((m for m in out if m["role"] == r), None) for r in ("user", "assistant"))
        if user is None or reply is None:
            return None, n | {"dropped_no_first_turn": 1}
        out = [out[0], user, *([{"role": "user", "content": FORMAT_ERROR}] if how.recovery else []), reply]
    return out, n


def adapt_to_shell(df: DataFrame, transform: str, messages: str = "messages") -> DataFrame:
    """df with adapted messages and a struct of counters; rows that cannot be adapted have null messages.

    One row is one trace, so every trace is adapted where it lies.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    how = parse(transform)
    counters = T.StructType([T.StructField(k, T.LongType()) for k in COUNTERS])
    if how is None:
        return df.withColumn("counters", F.lit(None).cast(counters))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema] + [T.StructField("counters", counters)])

    def run(stream: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in stream:
            rows = []
            for row in batch.to_pylist():
                row[messages], row["counters"] = adapt(row[messages] or [], how)
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return df.mapInArrow(run, schema)
