import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import commands
from millrace.operators import dedup, joins, ranking, stateful, stats
from millrace.sources import readers, writers


@pytest.mark.parametrize("rounds", [1, 6])
def test_conflict_free_equals_the_sequential_loop(spark, rounds):
    r = random.Random(4)
    rows = [(i, [f"k{r.randrange(60)}" for _ in range(r.randrange(0, 4))]) for i in range(300)]
    used, kept = set(), set()
    for i, keys in rows:
        if not used & set(keys):
            kept.add(i)
            used |= set(keys)
    df = spark.createDataFrame(rows, "i long, keys array<string>")
    assert {x.i for x in dedup.conflict_free(df, "i", "keys", rounds).collect()} == kept


def test_a_long_chain_settles(spark):
    df = spark.range(10_000).selectExpr("id as i", "array(cast(id as string), cast(id + 1 as string)) as keys")
    assert [x.i for x in dedup.conflict_free(df, "i", "keys", 1).orderBy("i").collect()] == list(range(0, 10_000, 2))
    chain = df.where("i < 24")  # too large to fold: rounds alone
    assert [x.i for x in dedup.conflict_free(chain, "i", "keys", 3, fold=5).orderBy("i").collect()] == list(range(0, 24, 2))


def test_capped_selection_equals_the_sequential_loop(spark):
    r = random.Random(5)
    rows = [(f"t{r.randrange(25)}", f"u{i:03}", float(r.randrange(9)), sorted({f"l{r.randrange(80)}" for _ in range(2)})) for i in range(150)]
    by: dict = {}
    for x in rows:
        by.setdefault(x[0], []).append(x)
    for v in by.values():
        v.sort(key=lambda x: (-x[2], x[1]))
    order, used, picked = sorted(by, key=lambda t: (-by[t][0][2], t)), set(), []
    for k in range(3):
        for t in order:
            if k < len(by[t]) and not used & set(by[t][k][3]):
                picked.append(by[t][k][1])
                used |= set(by[t][k][3])
    df = spark.createDataFrame(rows, "task string, uuid string, score double, lineage array<string>")
    got = dedup.capped_selection(df, "task", "score", "uuid", "lineage", 3, 20).collect()
    assert {x.uuid for x in got} == set(picked[:20])


def test_canonical_digest_ignores_key_order(spark):
    rows = spark.createDataFrame([('{"a":1,"b":[2]}',), ('{ "b": [2], "a": 1 }',), ("no",), (None,)], "j string").select(dedup.canonical_digest(F.col("j")).alias("d")).collect()
    assert rows[0].d == rows[1].d and rows[2].d is None and rows[3].d is None


def test_numbering_is_gapless(spark):
    df = spark.createDataFrame([(float(i % 50), i) for i in range(500)], "k double, i long")
    got = ranking.numbered(df, "k", "i").orderBy("position").collect()
    assert [x.position for x in got] == list(range(500)) and [(x.k, x.i) for x in got] == sorted((float(i % 50), i) for i in range(500))


def test_packing_rules(spark):
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate([4, 6, 5, 5, 1, 10])], "shard int, i int, n int")
    packed = stateful.pack_next_fit(df, "shard", ["i"], "n", 10)
    assert [(x.pack, x.doc, x.offset) for x in packed.orderBy("i").collect()] == [(0, 0, 0), (0, 1, 4), (1, 0, 0), (1, 1, 5), (2, 0, 0), (3, 0, 0)]
    lengths = {x.pack: x.seq_lens for x in stateful.pack_lengths(packed, "shard", "n", 10).collect()}
    assert lengths[2] == [1, 9] and lengths[0] == [4, 6]
    packs = stateful.pack_lengths(packed, "shard", "n", 10)
    assert stateful.padded_packs(packs, "shard", 6, 10).count() == 6
    with pytest.raises(Exception, match="more packs"):
        stateful.padded_packs(packs, "shard", 2, 10).collect()
    with pytest.raises(Exception, match="split before packing"):
        stateful.pack_next_fit(df, "shard", ["i"], "n", 5).collect()


def trace(*turns):
    out = []
    for role, content, command in turns:
        calls = [{"function": {"name": "bash", "arguments": json.dumps({"command": command})}}] if command else None
        out.append({"role": role, "content": content, "reasoning_content": None, "tool_calls": calls, "loss": None, "loss_weight": None})
    return out


SCHEMA = "uuid string, messages array<struct<role:string,content:string,reasoning_content:string,tool_calls:array<struct<function:struct<name:string,arguments:string>>>,loss:boolean,loss_weight:double>>"


def losses(spark, turns, **flags):
    df = spark.createDataFrame([("a", trace(*turns))], SCHEMA)
    return [m.loss for m in stateful.loss_policy(df, **flags).first().messages if m.role == "assistant"]


MARKER = "echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT && cat patch.txt"
DIFF = "diff --git a/x b/x\n--- a/x\n+++ b/x\n@@ -1 +1 @@\n-a\n+b"


def test_loss_policy_states(spark):
    # only the marker ends a task, and without flags nothing changes
    assert losses(spark, [("assistant", "", "ls"), ("assistant", "", MARKER), ("assistant", "", "ls")], need_calls=True) == [None, None, False]
    assert losses(spark, [("assistant", "", MARKER), ("assistant", "", "ls")]) == [None, None]
    assert losses(spark, [("assistant", "", "submit"), ("assistant", "", "ls")], need_calls=True) == [None, None]
    assert losses(spark, [("assistant", "x", None), ("assistant", "x", "ls")], need_calls=True) == [False, None]
    assert losses(spark, [("assistant", "<think>r</think>", "ls"), ("assistant", "x", "ls")], need_reasoning=True) == [None, False]
    assert losses(spark, [("tool", "Tool call error", None), ("assistant", "", "ls"), ("assistant", "", "ls")], mask_error_recovery=True) == [False, None]
    assert losses(spark, [("assistant", "", "echo x > patch.txt"), ("assistant", "", "ls")], reject_manual_patch=True) == [False, False]
    assert losses(spark, [("assistant", "", "echo x > patch.txt"), ("assistant", "", "ls")], reject_manual_patch=True, allow_manual_patch=F.lit(True)) == [None, None]


def test_loss_policy_verified_submits(spark):
    made = [("assistant", "", "git diff > patch.txt"), ("tool", "done", None)]
    shown = [("assistant", "", "cat patch.txt"), ("tool", f"<returncode>0</returncode>\n<output>\n{DIFF}\n</output>", None)]
    submit, flags = [("assistant", "", MARKER)], {"reject_unverified_submit": True, "reject_manual_patch": True}
    assert losses(spark, made + shown + submit, **flags) == [None, None, None]
    assert losses(spark, made + submit, **flags) == [None, False]  # nobody looked
    assert losses(spark, made + shown + made + submit, **flags) == [None, None, None, False]  # written again since
    assert losses(spark, made + [shown[0], ("tool", "no diff", None)] + submit, **flags) == [None, None, False]
    hand = [("assistant", "", "cat > patch.txt <<'E'\ndiff --git a/x b/x\nE")]
    assert losses(spark, hand + shown + submit, reject_unverified_submit=True) == [None, None, False]
    assert losses(spark, made + shown + submit, reject_nonpassing_submit=True, nonpassing=F.lit(True)) == [None, None, False]
    split = [shown[0], ("tool", "diff --git a/x b/x", None), ("tool", "--- a/x\n+++ b/x", None)]
    assert losses(spark, made + split + submit, **flags) == [None, None, None]


def test_loss_policy_weights_and_content(spark):
    turns = [("user", "q", None), ("assistant", "<think>look</think>so", "cat patch.txt"), ("tool", DIFF, None), ("assistant", "<think>done</think>", "submit")]
    rows = spark.createDataFrame([("a", trace(*turns)), ("b", [])], SCHEMA)
    out = {r.uuid: r.messages for r in stateful.loss_policy(rows, passed=F.lit(False), weights=stateful.WEIGHTS, nonpassing_factor=0.75, mask_empty_submit=True, empty_patch=F.lit(True), drop_content=True).collect()}
    assert [(m.loss, m.loss_weight, m.content, m.reasoning_content) for m in out["a"] if m.role == "assistant"] == [(None, 1.125, "", "look"), (False, 1.5, "", "done")]
    assert out["b"] == []


def test_example_outcomes(spark):
    def outcome(x):
        cols = stateful.example_outcome(F.lit(json.dumps(x)))
        return tuple(spark.range(1).select(*(c.alias(n) for n, c in cols.items())).first())

    assert outcome({"passed": True, "source_outcome": {"model_patch_bytes": 128}}) == (True, False, False, False)
    assert outcome({"source_outcome": {"passed": False, "model_patch_bytes": 0}}) == (False, True, False, False)
    assert outcome({"metadata": {"passed": "no", "empty_patch": True, "allow_manual_patch_context": True}}) == (True, True, True, True)
    assert outcome({"model_patch": ""}) == (False, True, False, False) and outcome({}) == (False, False, False, False)
    assert outcome({"metadata": {"source_outcome": {"passed": "pass"}, "passed": False, "source": "current_empty_diff_recovery"}}) == (False, False, False, True)


def test_where_a_patch_file_comes_from(spark):
    cases = {
        "git diff > patch.txt": (False, False, True),
        "git diff | tee patch.txt": (False, True, True),
        "git diff > a.diff && cat a.diff > patch.txt": (False, True, True),
        "git diff > a.diff; cp a.diff patch.txt": (False, False, False),
        "cp other.diff patch.txt": (True, False, False),
        "cat > /tmp/patch.txt <<'EOF'\ndiff --git a/x b/x\nEOF": (True, True, True),
        "echo x >> patch.txt": (True, False, True),
        "git diff >> patch.txt": (False, False, True),
        "touch patch.txt": (True, False, False),
        ": > patch.txt": (True, False, True),
        "cp /dev/null ./patch.txt": (True, False, False),
        "diff -u /dev/null new.py > patch.txt": (True, False, True),
        "python3 -c \"open('patch.txt','w').write('x')\"": (True, False, True),
        "head -3 patch.txt": (False, True, False),
        "ls && cat my-patch.txt": (False, False, False),
        MARKER: (False, False, False),
        "": (False, False, False),
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, c string").select("i", commands.patch_facts(F.col("c")).alias("f")).orderBy("i").collect()
    assert {c: tuple(r.f) for c, r in zip(cases, rows, strict=True)} == cases


def test_tokenizer_spans(spark):
    df = spark.createDataFrame([("a", trace(("user", "q", None), ("assistant", "yes", None)))], SCHEMA)
    row = stateful.tokenize_chat(df, stateful.characters).first()
    assert "".join(chr(x) for x in row.labels if x != -100) == "yes<|im_end|>\n"
    assert stateful.tokenize_chat(df, stateful.characters, most=5).count() == 0
    plain = stateful.tokenize_chat(df, lambda text: [ord(c) for c in text]).first()
    assert plain.labels == row.labels and row.position_ids == list(range(len(row.input_ids))) and set(row.attention_mask) == {1}
    calls = spark.createDataFrame([("a", trace(("user", "q", None), ("assistant", "why", "ls")))], SCHEMA)
    label = lambda target: "".join(chr(x) for x in stateful.tokenize_chat(calls, stateful.characters, target=target).first().labels if x != -100)
    assert label("tool_calls") == '<tool_call>\n{"name": "bash", "arguments": {"command": "ls"}}\n</tool_call><|im_end|>\n' and label("assistant") == "why\n" + label("tool_calls")
    parts = stateful.tokenize_chat(df, stateful.characters, most=20, overlong="split", least_labels=0).collect()
    assert len(parts) > 1 and sum(len(p.input_ids) for p in parts) == len(row.input_ids)


def test_percentiles_of_arrays(spark):
    r = spark.range(1).select(stats.percentile_nearest(F.array(*map(F.lit, [4, 1, 3, 2])), 0.5).alias("n"), stats.percentile_floor(F.array(*map(F.lit, [4, 1, 3, 2])), 0.5).alias("f")).first()
    assert (r.n, r.f) == (3, 2)


def test_subset_search_finds_a_close_subset():
    import numpy as np

    m = np.random.default_rng(1).integers(0, 2, (6, 60)).astype(float)
    cols, loss = stats.subset_search(m, {0: 6, 1: 6}, [i % 2 for i in range(60)], 12)
    assert len(set(cols)) == 12 and sum(c % 2 for c in cols) == 6 and loss < 0.1


def test_required_keys_stop_the_query(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no row for k 2"):
        joins.require(a, b, "k").collect()


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"uuid":"u1","task_id":"t"}\n\nnot json\n[1]\n{"uuid":"u2"}\n')
    rows = readers.jsonl(spark, str(tmp_path / "a.jsonl"), "uuid string, task_id string")
    assert sorted(r.uuid for r in rows.collect()) == ["u1", "u2"]
    with pytest.raises(Exception, match="bad JSON"):
        readers.jsonl(spark, str(tmp_path / "a.jsonl"), "uuid string", strict=True).collect()
    (tmp_path / "ids.txt").write_text('# no\n\n{"uuid":"u9"}\nu3 note\n')
    assert {r.uuid for r in readers.id_list(spark, str(tmp_path / "ids.txt")).collect()} == {"u9", "u3"}
    (tmp_path / "bad.txt").write_text("-1\n")
    with pytest.raises(Exception, match="integer from 0"):
        readers.line_list(spark, str(tmp_path / "bad.txt")).collect()
    (tmp_path / "t.csv").write_text("id,v\n1,a\n2,b\n1,c\n")
    assert {(r.id, r.v) for r in readers.csv_by_id(spark, str(tmp_path / "t.csv"), "id").collect()} == {("1", "c"), ("2", "b")}
    (tmp_path / "m.tsv").write_text("index\ta\tb\tc\td\n0\t1\tx\ty\tz\n1\t1\tx\tq\tz\nshort\n")
    assert [(r.roll, r.inst) for r in readers.manifest_tsv(spark, str(tmp_path / "m.tsv"), {"roll": 1, "inst": 2}).collect()] == [("1", "x")]
    log = tmp_path / "logs"
    log.mkdir()
    (log / "e.jsonl").write_text('{"type":"session"}\n{"type":"message","message":{"role":"user","content":"hi"}}\nbroken\n{"type":"message","message":{"role":"ai","content":[{"type":"text","text":"yo"}]}}\n')
    (log / "o.jsonl").write_text('{"uuid":"x"}\n')
    logs = readers.event_logs(spark, str(log)).collect()
    assert len(logs) == 1 and logs[0].bad_json == 1 and [(m.role, m.content) for m in logs[0].messages] == [("user", "hi"), ("assistant", "yo")]
    df = spark.range(10).withColumnRenamed("id", "k")
    writers.write_shards(writers.with_shard(df, "k", 3), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 3
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_shards(writers.with_shard(df, "k", 3), str(tmp_path / "out"))
    names = spark.createDataFrame([("p-00003.zst",), ("other",)], "f string")
    assert writers.next_name(names, "f", "p", "zst").first().name == "p-00004.zst"


def test_zstd_lines_and_examples(spark, tmp_path):
    import zstandard

    raw = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": [{"type": "reasoning", "text": "why"}, {"type": "tool_call", "name": "bash", "arguments": {"command": "ls"}}]}, {"role": "exit", "content": "bye"}], "passed": True},
           {"question": "2+2?", "context": "sums", "answer": "4"}, {"messages": [{"role": "user", "content": "only"}]}, {"messages": "not a list"}]
    body = "\n".join([*map(json.dumps, raw), "broken", "", ""])
    (tmp_path / "a.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(body.encode()))
    (tmp_path / "log.jsonl").write_text('{"type":"session"}\n{"type":"message","message":{"role":"user","content":"hi"}}\n')
    assert [(r.line, r.value) for r in readers.numbered_lines(spark, str(tmp_path)).where("file like '%zst'").orderBy("line").collect()] == list(enumerate(body.split("\n")[:-1]))
    got = [(r.line, json.loads(r.example)) for r in readers.normalized_examples(spark, str(tmp_path)).orderBy("line").collect()]
    assert [line for line, _ in got] == [0, 1] and got[0][1]["passed"] is True
    assert got[0][1]["messages"] == [{"role": "user", "content": "q"}, {"role": "assistant", "content": "<think>\nwhy\n</think>", "tool_calls": [{"function": {"name": "bash", "arguments": {"command": "ls"}}}]}]
    assert got[1][1]["messages"] == [{"role": "user", "content": "2+2?\n\nsums"}, {"role": "assistant", "content": "<think>\n\n</think>\n4"}]
    assert readers.normalized_examples(spark, str(tmp_path), per_file=1).count() == 1
    assert readers.text_set(spark, str(tmp_path / "missing.txt")).count() == 0


def test_sqlite_source(spark, tmp_path):
    import sqlite3

    with sqlite3.connect(tmp_path / "i.db") as db:
        db.execute("create table traces (task_id text)")
        db.executemany("insert into traces values (?)", [("a",), ("a",), ("",), ("b",)])
    assert {r.value for r in readers.sqlite_distinct(spark, str(tmp_path / "i.db"), "traces", "task_id").collect()} == {"a", "b"}


def test_stream_equals_batch(spark, data, tmp_path):
    from millrace.streaming import events as E

    src = tmp_path / "events"
    spark.read.parquet(f"{data}/events.parquet").repartition(2).write.parquet(str(src))
    q = E.tumbling(E.stream(spark, str(src))).writeStream.format("memory").queryName("tumbling").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    streamed = {(r.start, r.event_type): r.n for r in spark.table("tumbling").collect()}
    batch = {(r.start, r.event_type): r.n for r in E.tumbling(spark.read.parquet(str(src)).withColumn("ts", F.col("ts").cast("timestamp"))).collect()}
    assert streamed == batch


def test_outcome_vectors_fill_full_runs_only(spark):
    tasks = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    runs = spark.createDataFrame([("a", "x", True), ("b", "x", None), ("a", "y", True), ("z", "y", True), ("a", "other", True)], "t string, r string, ok boolean")
    v = stats.outcome_vectors(tasks, runs, "t", "r", "ok", ["x"], ["y", "none"])
    assert sorted(map(tuple, v.collect()), key=repr) == sorted([("x", "a", 1.0), ("x", "b", 0.0), ("x", "c", 0.0), ("y", "a", 1.0), ("y", "b", None), ("y", "c", None), *(("none", t, None) for t in "abc")], key=repr)
    assert sorted(map(tuple, stats.run_coverage(v, runs, "t", "r", "ok").collect()), key=repr) == [("none", 0, None), ("x", 2, 1 / 3), ("y", 1, 1.0)]
