"""Learned and aligned operators, the pipeline, and components."""

import random

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import decontaminate, registry, toxicity
from millrace.llm.common import components


def test_components_equal_a_union_find(spark):
    r = random.Random(1)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(400, i) for i in range(401, 500)]
    root = list(range(500))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in components(spark.createDataFrame([*pairs, (None, 3), (7, 7)], "a long, b long")).collect()}
    assert got == {n: find(n) for p in pairs if p[0] != p[1] for n in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_label_model_finds_accuracies_and_echoes():
    r = np.random.default_rng(0)
    y = r.random(6000) < 0.2
    right = lambda p: np.where(r.random(6000) < p, np.where(y, 1, -1), np.where(y, -1, 1))
    good, poor, echo = right(0.95), right(0.6), right(0.6)
    votes = np.column_stack([good, right(0.85), poor, echo, echo, echo])
    q, table, weight = toxicity.label_model(votes)
    assert ((q > 0.5) == y).mean() > 0.93
    assert table[1, 0, 2] > 0.85 and weight[3] < weight[0]


def test_unlabelled_documents_are_voted_on():
    r = np.random.default_rng(4)
    y = r.random(3000) < 0.2
    right = lambda p: np.where(r.random(3000) < p, np.where(y, 1, -1), np.where(y, -1, 1))
    gold = np.where(np.arange(3000) < 600, np.where(y, 1, -1), 0)
    votes = np.column_stack([right(0.9), right(0.85), right(0.8), gold])
    q, table, _ = toxicity.label_model(votes, known=3)
    silent = gold == 0
    assert ((q > 0.5) == y)[silent].mean() > 0.9 and table[1, 3, 2] / (table[1, 3, 0] + table[1, 3, 2]) > 0.9
    wrong = gold.copy()
    wrong[:600] *= np.where(r.random(600) < 0.3, -1, 1)  # labels that err are not believed as before
    _, table2, _ = toxicity.label_model(np.column_stack([votes[:, :3], wrong]), known=3)
    assert table2[1, 3, 2] / (table2[1, 3, 0] + table2[1, 3, 2]) < table[1, 3, 2] / (table[1, 3, 0] + table[1, 3, 2])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.toxic).mean() >= 0.93 and got[got.predicted == 1].toxic.mean() >= 0.9


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.1), (3, "you stupid idiot, pathetic clown", 0.0), (3, "you stupid idiot, pathetic clown", 0.0), (None, "fine words", 0.2)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, none).collect()
    assert len(got) == 5 and {r.predicted for r in got if r.doc_id == 3} == {1} and {r.predicted for r in got if r.doc_id != 3} == {0}
    assert {r.score for r in got if r.doc_id in (1, 2)} == {[r.score for r in got if r.doc_id == 2][0]}
    assert toxicity.toxicity(docs.where("false"), none).count() == 0
    long = spark.createDataFrame([(1, "calm words " * 500_000), (2, "idiot moron " * 300_000)], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.toxicity(long, none).collect()} == {1: 0, 2: 1}


def brute_align(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_plain_recurrence():
    r = random.Random(3)
    for _ in range(200):
        a, b = ([r.randrange(5) for _ in range(r.randrange(1, 25))] for _ in range(2))
        score, first, end, equal = decontaminate.align(np.array(a), np.array(b))
        assert score == brute_align(a, b) and 0 <= first <= end <= len(b) and equal <= len(a)


def test_alignment_in_pieces_finds_what_the_whole_does(monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 1)
    r = random.Random(8)
    for _ in range(100):
        item = np.array([r.randrange(40) for _ in range(r.randrange(1, 9))])
        words = [r.randrange(40) for _ in range(r.randrange(1, 400))]
        at = r.randrange(len(words))
        words[at : at + len(item)] = [x for x in item.tolist() if r.random() < 0.8]
        words = np.array(words or [1])
        score, first, end, equal = decontaminate.best_alignment(item, words)
        assert score == decontaminate.align(item, words)[0] == brute_align(item.tolist(), words[first:end].tolist())
        assert equal <= end - first


def test_a_long_text_costs_memory_by_the_item(spark):
    import tracemalloc

    r = np.random.default_rng(1)
    item, words = r.integers(0, 3000, 150), r.integers(0, 3000, 400_000)
    words[300_000:300_150] = item
    tracemalloc.start()
    assert decontaminate.best_alignment(item, words) == (300, 300_000, 300_150, 150)
    assert tracemalloc.get_traced_memory()[1] < 40e6
    tracemalloc.stop()


def test_leaks_equal_an_alignment_of_every_pair(spark):
    r = random.Random(12)
    words = [f"w{i}" for i in range(150)]
    some = lambda n: [r.choice(words) for _ in range(n)]
    items = [some(r.choice([1, 2, 12, 25, 40])) for _ in range(25)]
    texts = []
    for i in range(60):
        body = some(r.randrange(0, 120))
        for _ in range(r.randrange(3)):
            copy = [w if r.random() > 0.12 else r.choice(words) for w in r.choice(items)]
            body[(at := r.randrange(len(body) + 1)) : at] = copy
        texts.append(" ".join(body))
    texts += [texts[0], "", " ".join(items[2] + items[2])]
    docs, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x for x in decontaminate.leaks(docs, bench).collect()}
    grams = lambda x: list(zip(x, x[1:], strict=False)) or [tuple(x)]
    held = [{*grams(t.split()), *((w,) for w in t.split())} for t in texts]
    counts = {g: sum(g in h for h in held) for x in items for g in grams(x)}
    rare = [{g for g in grams(x) if counts[g] <= sorted(counts[y] for y in grams(x))[(len(grams(x)) - 1) // 2]} for x in items]
    want = {(d, i): brute_align(x, t.split()) / (2 * len(x)) for d, t in enumerate(texts) for i, x in enumerate(items) if rare[i] & held[d]}
    want = {k: v for k, v in want.items() if v >= decontaminate.LEAST}
    assert want == {k: x.score for k, x in got.items()}
    every = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if len(x) >= 12 and brute_align(x, t.split()) >= decontaminate.LEAST * 2 * len(x)}
    found = {k for k in got if len(items[k[1]]) >= 12}  # edits may leave a short copy without a rare pair of words
    assert found <= every and len(every - found) <= len(every) // 20
    tie = got[len(texts) - 1, 2]  # two equal copies: the first counts
    assert tie.start == 0 and len(got) > 30


def test_leaks_find_copies_edits_and_nothing_else(spark, monkeypatch):
    r = random.Random(9)
    words = [f"x{i}" for i in range(500)]
    item = [r.choice(words) for _ in range(30)]
    edited = [w if i % 5 else "changed" for i, w in enumerate(item)]
    noise = lambda n: [r.choice(words) for _ in range(n)]
    texts = [" ".join(noise(40) + item + noise(40)), " ".join(noise(10) + edited + noise(300)), " ".join(noise(200)), None, "", " ".join(item[:8])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (None, "x1 x2"), (4, "x499 x498"), (1, " ".join(item))], "item_id long, text string")
    want = {(0, 1), (1, 1), (6, 1)}
    got = decontaminate.leaks(docs, bench).where("item_id = 1").collect()
    assert {(x.doc_id, x.item_id) for x in got} == want
    first = next(x for x in got if x.doc_id == 0)
    assert texts[0][first.start : first.end] == " ".join(item) and first.score == 1.0
    monkeypatch.setattr(decontaminate, "CHUNK", 8)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)  # several passes
    assert {(x.doc_id, x.item_id) for x in decontaminate.leaks(docs, bench).where("item_id = 1").collect()} == want
    assert decontaminate.leaks(docs.where("false"), bench).count() == 0 and decontaminate.leaks(docs, bench.where("false")).count() == 0


def test_an_item_in_a_third_of_all_documents_keeps_its_seeds(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(i, f"doc {i} {item}" if i % 3 == 0 else f"doc {i} of other words {i + 1}") for i in range(90)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {x.doc_id for x in decontaminate.leaks(docs, bench).collect()} == set(range(0, 90, 3))


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").selectExpr("*", "1 as score", "'x' as fp", "2 as k", "3 as h")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
        assert 0.5 * docs.count() < out.count() <= docs.count()
    final = corpus_pipeline.run(spark, data)
    assert final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < final.count() < docs.count()


def test_near_copies_stage_keeps_one_of_each_group(spark, data):
    docs = spark.createDataFrame([(3, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words entirely here now"), (None, "x")], "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "5L as n_chars")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.drop_near_copies(spark, docs, data).collect()) == ["1", "2", "None"]


CLASHES = ("_k", "_v", "_gone", "_kept", "_n_lines", "_n_removed", "_toxicity", "_again", "_nul", "_row", "_lines", "k", "v", "nul", "id", "item_id")


def test_pipeline_stages_leave_clashing_columns_alone(spark, data):
    line = "a line that is long enough to be a passage " * 2
    texts = [(1, line + "\n" + line[::-1] + "\nown one"), (2, line + "\n" + line[::-1] + "\nown two and more words here"), (None, None), (3, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "7L as n_chars", *(f"'{c}!' as `{c}`" for c in CLASHES))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == c + "!" for r in rows for c in CLASHES), name
        assert stage(spark, docs.where("false"), data).count() == 0, name
    cut = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_lines(spark, docs, data).collect()}
    assert cut[2] == ("own two and more words here", 27) and cut[1] == (texts[0][1], 7) and cut[None] == (None, 7)


def test_texts_that_share_an_id_are_documents_of_their_own(spark, data):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine ten", "red orange yellow green blue indigo violet black")
    docs = spark.createDataFrame([(1, a), (1, b), (2, c), (2, a), (None, b), (None, "quite another text of seven or eight words"), (1, a)], "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "5L as n_chars")
    got = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, data).collect())
    assert got == sorted([("1", a), ("1", b), ("2", c), ("None", "quite another text of seven or eight words")])
    bench = spark.read.parquet(f"{data}/benchmark.parquet").orderBy("item_id").first().text
    docs = spark.createDataFrame([(1, a), (1, f"{a} {bench} {b}"), (None, bench), (None, c)], "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "5L as n_chars")
    assert sorted((str(r.doc_id), r.text) for r in corpus_pipeline.drop_leaks(spark, docs, data).collect()) == sorted([("1", a), ("None", c)])


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_agrees(spark, data, name):
    import duckdb

    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    result = db.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    df = registry.queries()[name](spark, data).select(*columns)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, result.fetchall()))


def test_features_of_the_classifier_are_held_in_few_bytes():
    kinds = list(toxicity.traits([["idiot", "words", "wordsmith"], ["words", "other"]]))
    assert [k[0] for k in kinds] == ["#", "=", "", "", "", ""]
    assert all(sum(x.itemsize for x in k[2:]) <= 9 for k in kinds)
    heads = {(kinds[2][1][f], t): c for t, f, c in zip(*(x.tolist() for x in kinds[2][2:]), strict=True)}
    assert heads == {("idio", 0): 1, ("word", 0): 2, ("word", 1): 1, ("othe", 1): 1}
