import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import coerce, diffs, examples, messages, submissions, texts
from millrace.operators import adapters

PATCH = "diff --git a/src/a.py b/src/a.py\n--- a/src/a.py\n+++ b/src/a.py\n@@ -1,2 +1,3 @@ def f\n-old\n+new\n+more\n same\ndiff --git a/tests/test_a.py b/tests/test_a.py\n--- a/tests/test_a.py\n+++ b/tests/test_a.py\n@@ -1 +1 @@\n-x\n+y"


def one(spark, *cols, text=PATCH):
    return spark.createDataFrame([(text,)], "t string").select(*cols).first()


def test_truth_differs_by_rule(spark):
    rows = spark.createDataFrame([(" Yes ",), ("y",), ("submitted",), ("false",), ("",), (None,)], "v string")
    got = rows.select(*(coerce.truthy(F.col("v"), r).alias(r) for r in ("signal", "record", "selection")), coerce.python_truth(F.col("v")).alias("raw")).collect()
    assert [tuple(r) for r in got] == [(True, False, True, True), (True, False, False, True), (False, False, True, True), (False, False, False, True), (False, False, False, False), (False, False, False, False)]


def test_strip_takes_unicode_spaces_and_rounding_is_half_even(spark):
    r = spark.createDataFrame([("  a b　\n",)], "v string").select(coerce.strip(F.col("v")).alias("s"), coerce.half_even(F.lit(2.5)).alias("a"), coerce.half_even(F.lit(3.5)).alias("b"), coerce.number(F.lit(" x "), 7.0).alias("n")).first()
    assert tuple(r) == ("a b", 2.0, 4.0, 7.0)


def test_diffs(spark):
    c = F.col("t")
    r = one(spark, diffs.paths(c).alias("p"), diffs.net_delta(c).alias("n"), diffs.changed_lines(c).alias("k"), diffs.source_paths(c).alias("s"), diffs.languages(c).alias("l"), diffs.without_paths(c, F.array(F.lit("src/a.py"))).alias("w"), diffs.quality_reasons(c, 1).alias("q"))
    assert r.p == ["src/a.py", "tests/test_a.py"] and r.n == 1 and r.k == 5 and r.s == ["src/a.py"] and r.l == ["python"]
    assert r.w == PATCH[PATCH.index("diff --git a/tests") :] and r.q == ["too_many_files"]
    plain = "--- a/x.c\n+++ b/x.c\n-a\n+b"
    assert one(spark, diffs.paths(c).alias("p"), text=plain).p == ["x.c"]


def test_reversing_twice_gives_the_diff_back(spark):
    twice = one(spark, diffs.reverse(diffs.reverse(F.col("t"))).alias("r")).r
    assert twice == PATCH
    once = one(spark, diffs.reverse(F.col("t")).alias("r")).r
    assert "@@ -1,3 +1,2 @@ def f\n-new\n-more\n+old" in once


def test_texts(spark):
    c = F.col("t")
    t = "See https://a.b/c (https://x.y).\n- [ ] todo\n+added\n```python\nx = 1\n```\n```python\ny = 2\n```"
    r = one(spark, texts.counts(c)["n_urls"].alias("u"), texts.last_fence(c).alias("f"), texts.tidy_prompt(c).alias("p"), text=t)
    assert r.u == 2 and r.f == "y = 2\n" and "todo" not in r.p and "()" not in r.p and "\nadded" in r.p
    assert one(spark, texts.task_text(c).alias("x"), text="a <issue> it fails </issue> b").x == "it fails"
    assert one(spark, texts.problem_key(c).alias("x"), text=" Ａ  b\n").x == "a b"


def test_model_answers(spark):
    keys = {k: "x" for k in submissions.REQUIRED_KEYS}
    prompt = "Fix the lexer so that nested quotes are handled. " * 6
    error = lambda text: one(spark, submissions.answer_error(F.col("t")).alias("x"), text=text).x
    assert error(json.dumps(keys | {"mini_swe_task_prompt": prompt})) is None
    assert error("```json\n" + json.dumps(keys | {"mini_swe_task_prompt": prompt}) + "\n```") is None
    assert error("Here it is: " + json.dumps(keys | {"mini_swe_task_prompt": prompt}) + " done") is None
    assert error(" ") == "empty_response" and error("no json") == "no_json_object_found" and error("a {b} c") == "json_decode_error" and error("[1]") == "json_root_not_object"
    assert error('{"original_goal": 1, "mini_swe_task_prompt": "x", "current_repo_state": 1}') == "missing_required_keys:actions_already_taken,compaction_model_reasoning,uncertainty_notes"
    said = lambda p, **more: error(json.dumps(keys | {"mini_swe_task_prompt": p} | more))
    assert said(" ") == "empty_mini_swe_task_prompt" and said(3) == "empty_mini_swe_task_prompt" and said("short") == "mini_swe_task_prompt_too_short"
    assert said(prompt + "See the retained suffix.") == "mini_swe_task_prompt_contains_compaction_process_marker"
    assert said("Read the page. " * 30) == "mini_swe_task_prompt_missing_task_intent"
    assert said(prompt + "Continue.") == "mini_swe_task_prompt_contains_continuation_marker"
    assert said(prompt + "Write new tests.") == "mini_swe_task_prompt_requests_test_edits"
    assert said(prompt, compaction_model_reasoning="") == "empty_compaction_model_reasoning"


def test_faithful_prompts(spark):
    anchors = one(spark, submissions.anchor_terms(F.col("t"), F.lit("org/some-repo")).alias("x"), text="use `Foo.bar` and foo.bar in src/a_b.py, then tokenizer Tokenizer").x
    assert anchors == ["some-repo", "Foo.bar", "src/a_b.py", "tokenizer"]
    error = lambda p, c: spark.range(1).select(submissions.faithfulness_error(F.lit(p), F.lit(c)).alias("x")).first().x
    assert error("", "x") == "faithfulness_empty_prompt" and error("do it", "the tokenizer fails") == "faithfulness_no_context_anchor_in_prompt"
    assert error("fix the Tokenizer", "the tokenizer fails") is None
    assert error("fix the tokenizer in src/main.c", "the tokenizer fails") == "faithfulness_generic_build_hallucination"


def test_messages(spark):
    parts = '[{"type":"reasoning","text":"why"},{"type":"text","text":"hi"},{"type":"tool_call","name":"bash","arguments":{"command":"ls"}}]'
    r = one(spark, messages.content_parts(F.col("t")).alias("c"), text=parts).c
    assert r.text == "hi" and r.reasoning == "why" and r.tool_calls[0].function.name == "bash"
    assert one(spark, messages.merge_thinking(F.lit("r"), F.lit("")).alias("m")).m == "<think>\nr\n</think>"
    assert one(spark, messages.merge_thinking(F.lit(None).cast("string"), F.lit("<think>x")).alias("m")).m == "<think>x"
    assert one(spark, messages.merge_thinking(F.lit(None).cast("string"), F.lit("\n<think>a</think>x")).alias("m")).m == "\n<think>a</think>x"
    assert one(spark, messages.content_parts(F.col("t")).alias("c"), text='[{"type":"image","url":"u"},{"type":"text","text":"hi"}]').c.text == "hi"
    assert one(spark, messages.content_parts(F.col("t")).alias("c"), text='{"content":"c","value":"v"}').c.text == "c"
    calls = one(spark, messages.normalize_calls(F.lit('{"name":"f","arguments":"{}"}')).alias("m"), messages.normalize_calls(F.lit('[{"function":{"name":"","arguments":"{}"}}]')).alias("n"))
    assert calls.m[0].function.name == "f" and calls.n == []


def test_raw_messages_normalize(spark):
    rows = spark.createDataFrame([([{"from": "human", "value": "q"}, {"role": "exit", "content": "bye"}, {"role": "gpt", "text": "a"}],), ([{"role": "user", "content": "only"}],)], "messages array<struct<role:string,`from`:string,speaker:string,content:string,value:string,text:string,system_prompt:string,reasoning_content:string,reasoning:string,thinking:string,thought:string,tool_calls:string,function_calls:string,function_call:string,loss:boolean,trainable:boolean>>")
    got = messages.normalized_rows(rows).collect()
    assert len(got) == 1 and [(m.role, m.content) for m in got[0].messages] == [("user", "q"), ("assistant", "a")]


def test_adapter_kinds():
    call = {"function": {"name": "str_replace_editor", "arguments": '{"command":"view","path":"a.py","view_range":[1,3]}'}}
    assert adapters.turn_commands({"tool_calls": [call]})[2] == ["sed -n '1,3p' a.py"]
    assert adapters.turn_commands({"content": 'x {"plan":"p","commands":[{"keystrokes":"ls\\n"}],"task_complete":true}'}) == ("json", "p", ["ls"])
    assert adapters.turn_commands({"content": '{"commands":[],"task_complete":true}'})[2] == [adapters.SUBMIT]
    assert adapters.turn_commands({"content": "so ```bash\nls\n```"})[2] == ["ls"] and adapters.turn_commands({"content": "```\nls\n``` or ```\npwd\n```"})[2] == ["ls"]
    assert adapters.turn_commands({"content": "```python\nls\n```"})[0] == "none"


def test_adapter_flags():
    a = adapters
    assert a.parse("none") is None and a.parse("bash_tool_submit_strict_toolobs_single_visible").single
    with pytest.raises(ValueError, match="unknown"):
        a.parse("bash_tool_other")
    assert a.adapt([{"role": "assistant", "content": "no"}], a.parse("bash_tool"))[0] is None
    trace = [{"role": "user", "content": "do"}, {"role": "assistant", "content": '{"plan":"p","commands":[{"keystrokes":"a"},{"keystrokes":"b"}]}'}, {"role": "user", "content": "$ a\none\n$ b\ntwo"}]
    out, n = a.adapt(trace, a.parse("bash_tool_toolobs_single"))
    assert [m["role"] for m in out] == ["system", "user", "assistant", "tool", "assistant", "tool"] and n["split_turns"] == 1 and out[3]["content"] == "one"
    assert a.adapt(trace, a.parse("bash_tool_submit"))[1]["dropped_no_submit"] == 1
    first = a.adapt(trace, a.parse("bash_tool_recovery_strict_toolobs_toolonly_emptythink"))[0]
    assert [m["role"] for m in first] == ["system", "user", "user", "assistant"] and first[3]["content"] == "" and first[3]["reasoning_content"] == "\n" and first[1]["content"].startswith(a.STRICT)
    assert a.adapt(trace, a.parse("bash_tool_reasoning"))[0][2]["reasoning_content"] == "p"


def test_published_rows_look_in_the_outcome_and_the_metadata(spark):
    rows = [
        '{"messages":[{"role":"user"}],"passed":true,"uuid":"u","reward":1.5,"language":"","metadata":{"language":"go"}}',
        '{"source_outcome":{"passed":1,"language":"c"},"metadata":{"passed":false,"language":"d"},"tools":[]}',
        '{"passed":null,"source_outcome":{"passed":true},"metadata":"text","reward":0}', '{"passed":"false"}', '{"passed":0.0}', "bad", None,
    ]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r string").select("i", *examples.published_row(F.col("r"), ["uuid", "reward", "language"])).orderBy("i").drop("i")
    assert [tuple(r) for r in got.collect()] == [
        ('[{"role":"user"}]', True, None, "u", "1.5", None), (None, True, None, None, None, "c"), (None, False, None, None, "0", None),
        (None, True, None, None, None, None), (None, False, None, None, None, None), (None,) * 6, (None,) * 6,
    ]
