"""Operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash

from millrace.llm import lines, packing, perspectives, pieces, pii, runindex, simhash, spotsigs

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sample_texts(seed: int = 3) -> list:
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "und", "é", "日本"]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = "\n".join(line(14) for _ in range(6))
    texts = [line(r.randrange(1, 60)) for _ in range(20)]
    texts += [f"{line(9)}\n{passage}\n{line(9)}" for _ in range(4)]
    texts += [texts[3], texts[3], None, None, "", "", " \n\t ", "a" * 3000, "ab " * 2000, passage, "one"]
    texts += [re.sub("w1 ", "w2 ", texts[21], count=1), line(3000)]
    return texts


@pytest.fixture(scope="module")
def rows():
    return [(i * 3 + 1, t) for i, t in enumerate(sample_texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = [(i, t, "x", "y", len(t or ""), "z") for i, t in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, score string").repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_pieces_equal_the_library(docs, rows, empty):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in pieces.piece_digests(docs, MODEL).collect()}
    for i, t in rows:
        ids = lib.encode(t or "", add_bos=True, add_eos=True)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert pieces.piece_digests(empty, MODEL).count() == 0


def test_pieces_on_awkward_texts():
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    with open(MODEL, "rb") as f:
        model = pieces.PieceModel(f.read())
    r = random.Random(8)
    texts = ["", " ", "\n", "a\x00b", "▁▁ ▁", "🙂", "=" * 1500, "ab" * 700 + " " * 90, "<s></s><0x0A>", "�"]
    texts += ["".join(r.choice(["=", "-", " ", "a", "b", "the", "\n", "é", "▁", "#", '"', "0", "🙂"]) for _ in range(r.randrange(300))) for _ in range(200)]
    ids, counts = model.encode(texts)
    ends = np.cumsum(counts)
    for t, end, n in zip(texts, ends, counts, strict=True):
        own = [model.bos, *ids[end - n : end].tolist(), model.eos]
        assert own == lib.encode(t, add_bos=True, add_eos=True)
        assert model.decode(np.array(own)).decode() == lib.decode(own)


def brute_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_equals_brute_force(docs, rows, empty):
    fps = [brute_fingerprint(t, 3) for _, t in rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    comp = roots(len(fps), near)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fp:016x}", rows[c][0]) for (i, _), fp, c in zip(rows, fps, comp, strict=True)}
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_links_in_large_and_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 40)
    monkeypatch.setattr(simhash, "TILE", 16)
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(6)]
    fps = sorted({b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(3))) for b in base for _ in range(60)})
    near = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    nodes = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x, []) for i, x in enumerate(fps)], "id long, fp long, meet array<long>")
    found = [(x.a, x.b) for x in simhash.links(nodes, 3).collect()]
    assert {frozenset(p) for p in found} <= {frozenset(p) for p in near}
    assert roots(len(fps), found) == roots(len(fps), near)


def test_wide_radius_keeps_near_copies_together(spark):
    r = random.Random(6)
    words = [f"v{i}" for i in range(4000)]
    a = [r.choice(words) for _ in range(400)]
    b = [*a[:200], "new", *a[201:]]
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(r.choice(words) for _ in range(400)))], "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(df, 5, 12, meetings=6).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def similar_texts(seed: int = 12) -> list:
    """Texts of few and many words, edited so that similarities lie on both sides of 0.8, and one text of many repeats."""
    r = random.Random(seed)
    line = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    texts = []
    for n in (8, 9, 24, 60, 200, 500):
        for edits in range(1, 8):
            a = line(n)
            b = list(a)
            for _ in range(max(1, edits * n // 140)):
                b[r.randrange(n)] = f"x{r.randrange(99)}"
            texts += [a, b, a[: n - edits * n // 30]]
    loop = line(8)
    texts += [line(30) + loop, texts[-1][:20] + loop * 3, loop * 40 + line(6), loop + line(6), loop, loop * 2, loop * 50]
    base = line(120)  # a large group: nearly all pairs of it are below 0.8, and some are not
    texts += [[w if r.random() > 0.01 * (i % 9) else f"y{r.randrange(99)}" for w in base] for i in range(70)]
    return [*map(" ".join, texts), None, "", " ", "one"]


def jaccard_links(texts, width=5):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({" ".join(w[i : i + width]) for i in range(len(w) - width + 1)} or ({" ".join(w)} if w else set()))
    return [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]


@pytest.mark.parametrize("split", [4096, 20])
def test_near_copies_are_those_of_similarity_0_8(spark, monkeypatch, split):
    monkeypatch.setattr(simhash, "SPLIT_SETS", split)
    texts = similar_texts()
    comp = roots(len(texts), jaccard_links(texts))
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int").repartition(5)
    got = {x.doc_id for x in corpus_pipeline.drop_near_copies(spark, df, "").collect()}
    assert got == {i for i, c in enumerate(comp) if i == c}
    assert 20 < len(got) < len(texts) - 20
    assert corpus_pipeline.drop_near_copies(spark, df.where("false"), "").count() == 0


def test_buckets_of_the_same_nodes_are_compared_once(spark, monkeypatch):
    held = {}

    def keep(df, name):
        held[name] = df.localCheckpoint()
        return held[name]

    monkeypatch.setattr(simhash, "materialize", keep)
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (2, text + " x"), (3, "y " + text), (4, "alone")], "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.similar(df, 5, 28, 10, (4, 5)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}
    # ten minhashes, nearly all of them shared: the same two or three nodes meet in one bucket, not in ten
    buckets = [sorted(x.id for x in held["units"].where((held["units"].block == b) & (held["units"].value == v)).collect()) for b, v in held["units"].select("block", "value").distinct().collect()]
    assert len(buckets) == len(set(map(tuple, buckets))) <= 4


def brute_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~gone])).hexdigest()))
    return out


def test_byte_repeats_equal_brute_force(spark, docs, rows, empty):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in runindex.dedup_bytes(docs).collect()}
    assert got == dict(zip((i for i, _ in rows), brute_removal([t for _, t in rows], 400), strict=True))
    assert any(x[1] for x in got.values())
    assert all(r.repeats == (r.n_removed > 0) and r.removed_share == r.n_removed / max(1, r.n_bytes) for r in runindex.dedup_bytes(docs).collect())
    assert runindex.dedup_bytes(empty).count() == 0
    twice = spark.createDataFrame([(5, "q" + "xyz" * 200), (5, "q" + "xyz" * 200), (None, "short")], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed) for r in runindex.dedup_bytes(twice).collect()) == [(5, 0), (601, 601), (601, 601)]


def test_a_passage_goes_from_the_length_on_whatever_its_words(spark):
    r = random.Random(6)
    words = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7))) for _ in range(n))
    passages = [words(100)[: n - 2] + "xy" for n in (300, 399, 400)]
    assert [len(p) for p in passages] == [300, 399, 400] and all(len(p.split()) > 50 for p in passages)
    # The bytes beside the two copies differ, so that the repeat is the passage alone.
    texts = [words(30) + side + p + side + words(30) for p in passages for side in "<>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for length, gone in ((400, [0, 0, 0, 0, 400, 400]), (256, [300, 300, 399, 399, 400, 400])):
        got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in runindex.dedup_bytes(df, length=length).collect()}
        assert got == dict(enumerate(brute_removal(texts, length))) and [got[i][1] for i in range(6)] == gone


def test_run_index_marks_like_brute_force():
    r = random.Random(3)
    for _ in range(300):
        letters = r.choice([b"a", b"ab", b"abcd"])
        pool = [bytes(r.choice(letters) for _ in range(r.randrange(1, 40))) for _ in range(4)]
        n = r.choice([3, 5, 8, 20])
        texts = list(dict.fromkeys(t for t in (b"".join(r.choice(pool) for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 7))) if len(t) >= n))
        if texts:
            seen = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
            want = [[seen[t[i : i + n]] > 1 for i in range(len(t) - n + 1)] for t in texts]
            assert [h.tolist() for h in runindex.marked(texts, n)] == want
            assert [h.tolist() for h in runindex.by_hash(texts, n)] == want


@pytest.mark.parametrize("block", [3000, 40_000])
def test_hot_groups_of_bytes_go_through_the_index(spark, monkeypatch, block):
    monkeypatch.setattr(runindex, "BLOCK", block)
    made, split = [], runindex.split_groups
    monkeypatch.setattr(runindex, "split_groups", lambda *args: made.append(split(*args)) or made[-1])
    monkeypatch.setattr(runindex, "release", lambda *frames: None)
    r = random.Random(9)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    hot = text(500)
    texts = [text(r.randrange(60, 900)) + hot[: r.choice([300, 420, 500])] + text(r.randrange(60, 900)) for _ in range(60)]
    texts += ["ab" * 900 + hot, "ab" * 700, "a" * 2500, hot + hot, hot, None, *texts[:2]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in runindex.dedup_bytes(df).collect()}
    assert got == dict(enumerate(brute_removal(texts, 400)))
    groups = {}
    for x in made[-1][0].where("text is not null").collect():
        groups.setdefault(x.m, set()).add(bytes(x.text))
    assert all(len(g) == 1 or sum(map(len, g)) <= block for g in groups.values())


def test_personal_data_trains_on_every_document(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["lo", "mip", "sat"]) for _ in range(9)) for _ in range(4300)]
    found = pii.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).localCheckpoint()
    made = np.zeros((1, len(pii.bounds())), np.uint8), np.zeros(1, np.uint8), np.zeros(1, bool)
    n = pii.summed(found, lambda b, y, apart: np.array([float(len(y))]), made)[0] - 1
    assert n == sum(len(pii.planted_rows(t, random.Random(hashlib.sha256(t.encode()).digest()))) for t in texts) > 4000


def test_splitting_a_hot_group_does_not_follow_its_copies(spark, monkeypatch):
    monkeypatch.setattr(runindex, "BLOCK", 3000)
    made, keep = {}, runindex.materialize

    def counted(df, name):
        out = keep(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(runindex, "materialize", counted)
    r = random.Random(4)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    hot = text(440)
    texts = [text(r.randrange(60, 300)) + hot + text(r.randrange(60, 300)) for _ in range(12)]
    counts = []
    for copies in (2, 6):
        made.clear()
        rows = list(enumerate(texts * copies))
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert {x.n_removed for x in runindex.dedup_bytes(df.where("doc_id < 12").unionByName(df.where("doc_id >= 12"))).collect()} == {len(t) for t in texts}
        counts.append({k: n for k, n in made.items() if k not in ("spans", "cuts", "hits")})
    assert counts[0]["parts"] > 0 and counts[0] == counts[1]


def test_a_block_goes_through_the_index_whatever_its_size(monkeypatch):
    monkeypatch.setattr(runindex, "BLOCK", 10)
    monkeypatch.setattr(runindex, "by_hash", None)
    assert [h.tolist() for h in runindex.marked([b"abcdefgh", b"xxabcdexx"], 4)] == [[True, True, False, False, False], [False, False, True, True, False, False]]


def test_halves_keep_equal_windows_together_and_end_in_single_ones():
    r = random.Random(4)
    length, k, powers = 40, 8, runindex.Powers()
    shared = b"shared!!"
    whole = [bytes(r.choice(b"ab") for _ in range(32)) + shared + bytes(r.choice(b"ab") for _ in range(32)) for _ in range(50)]
    whole += [b"ab" * 16 + shared + b"ab" * 16] * 2
    value = int(runindex.rolling(np.frombuffer(shared, np.uint8), k, powers).view(np.int64)[0])
    for level in range(1, (length - k).bit_length() + 1):
        groups = {}
        for t in whole:
            parts = list(runindex.halves(t, 7, value, -1, level, length, k, powers))
            assert sum(n for _, _, n, _ in parts) == len(t) - length + 1
            for m, s, n, _ in parts:
                for w in range(s, s + n):
                    groups.setdefault(t[w : w + length], set()).add(m)
        assert all(len(x) == 1 for x in groups.values())
    by_group = {}
    for window, (m,) in groups.items():
        by_group.setdefault(m, set()).add(window)
    assert all(len(x) == 1 for x in by_group.values())


def test_packing_keeps_its_law(docs, rows, empty):
    got = packing.pack(docs, 4).toPandas()
    assert len(got) == len(rows) and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    for i, t in rows:
        x = got[got.doc_id == i].iloc[0]
        assert x["size"] == len((t or "").encode()) + 8 and x.text_crc32 == zlib.crc32((t or "").encode())
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= got["size"].max()
    assert packing.pack(empty, 4).count() == 0


def test_placing_equals_the_plain_loop():
    r = np.random.default_rng(2)
    for _ in range(30):
        demand = r.random((r.integers(0, 40), 3)) * 0.1
        shards = int(r.integers(1, 6))
        left = [[1 / shards] * 3 for _ in range(shards)]
        want = [0] * len(demand)
        for i in sorted(range(len(demand)), key=lambda i: (-max(demand[i]), i)):
            dots = [sum(w * a * b for w, a, b in zip(packing.WEIGHT, demand[i], row, strict=True)) for row in left]
            want[i] = k = dots.index(max(dots))
            left[k] = [a - b for a, b in zip(left[k], demand[i], strict=True)]
        assert packing.place(demand, np.full((shards, 3), 1 / shards)).tolist() == want


@pytest.mark.parametrize("bundle", [20_000, 40])
def test_packing_balances_all_dimensions_over_many_bundles(spark, monkeypatch, bundle):
    monkeypatch.setattr(packing, "BUNDLE", bundle)
    monkeypatch.setattr(packing, "CHUNK", 50)
    r = random.Random(6)
    texts = ["x" * r.randrange(1, 400) if r.random() < 0.2 else " ".join(["w"] * r.randrange(1, 150)) + str(i) for i in range(2000)]
    texts += texts[:300]
    df = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = packing.pack(df, 8).toPandas()
    per = got.groupby("shard").agg(b=("size", "sum"), r=("size", "count"), top=("slot", "max"))
    assert len(got) == len(texts) and (per.top + 1 == per.r).all() and got.groupby(["shard", "slot"]).size().max() == 1
    loose = 1.0 if bundle > len(texts) else 1.1  # 40 groups over 8 shards leave more over
    assert per.b.max() < 1.01 * loose * per.b.min() and per.r.max() < 1.1 * loose * per.r.min()
    assert got.groupby("text_crc32").shard.nunique().max() == 1  # groups stay whole


def test_a_hot_group_is_dealt_to_all_shards(spark):
    df = spark.createDataFrame([(i, "same text" if i % 3 == 0 else f"text number {i}") for i in range(900)], "doc_id long, text string")
    sums = packing.pack(df, 6).groupBy("shard").sum("size").toPandas()["sum(size)"]
    assert len(sums) == 6 and sums.max() < 1.05 * sums.min()


def test_perspectives_join_to_whole_renderings(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 600, "bot", "yo"), (1, 600, "bot", "yo"), (1, None, None, None), (None, 1, "user", "q"), (2, 1, "system", "only")]
    turns = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, start int")
    got = perspectives.rotate(turns, block=2).collect()
    assert {(r.conv_id, r.perspective) for r in got} == {(1, "user"), (1, "bot"), (1, "unknown"), (None, "user")}
    for view in ("user", "bot", "unknown"):
        own = sorted((r for r in got if r.conv_id == 1 and r.perspective == view), key=lambda r: r.start)
        text = "".join(r.segment for r in own)
        assert [r.start for r in own] == [0, *np.cumsum([len(r.segment) for r in own])[:-1].tolist()] and own[-1].end == len(text)
        for r in own:
            assert (r.role == "assistant") == (r.mask_start is not None)
            if r.mask_start is not None:
                assert text[r.mask_start : r.mask_end] == {"user": "hi", "bot": "yo", "unknown": ""}[view] + "<|im_end|>\n"
    assert perspectives.rotate(turns.where("false")).count() == 0
    whole = {(r.conv_id, r.perspective): r for r in perspectives.renderings(perspectives.rotate(turns)).collect()}
    bot = whole[1, "bot"]
    assert bot.rendering == "<|im_start|>user name=unknown\n<|im_end|>\n<|im_start|>system\ns<|im_end|>\n<|im_start|>user name=user\nhi<|im_end|>\n" + "<|im_start|>assistant\nyo<|im_end|>\n" * 2
    assert [bot.rendering[m.start : m.end] for m in bot.masks] == ["yo<|im_end|>\n"] * 2 and len(whole) == 4


def test_line_dedup_keeps_the_first_of_each_passage(spark, empty):
    r = random.Random(1)
    line = lambda: " ".join(r.choice("abcdefghij") * r.randrange(2, 9) for _ in range(12))
    passage = [line() for _ in range(12)]
    texts = ["\n".join([line() for _ in range(r.randrange(3))] + passage + [line() for _ in range(r.randrange(3))]) for _ in range(6)]
    rows = [*enumerate(texts, 1), (7, None), (8, ""), (9, "no feed"), (None, texts[0]), (2, texts[1])]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars int")
    got = lines.dedup_lines(df).collect()
    assert len(got) == len(rows)
    by = {x.doc_id: x for x in got}
    assert by[1].text == texts[0] and by[7].text is None and by[8].text == "" and by[9].text == "no feed" and by[None].text == texts[0]
    for i in range(2, 7):
        left = set(by[i].text.split("\n"))
        assert len(left & set(passage)) <= 6 and by[i]._n_removed >= 6
        assert set(texts[i - 1].split("\n")) - set(passage) <= left
    assert lines.dedup_lines(empty).count() == 0


def test_repeated_runs_of_lines_go_whole(spark):
    r = random.Random(5)
    line = lambda n=9: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    passages = [[line() for _ in range(n)] for n in (2, 2, 2, 3, 3, 4, 7)] + [["}", "", "}"], [line(2) for _ in range(9)]]
    texts = ["\n".join([*(line() for _ in range(r.randrange(4))), *r.choice(passages), *(line() for _ in range(r.randrange(4)))]) for _ in range(150)] + ["\n".join([line(20)] * 5), "\n\n\n", "one"]
    seen, want = set(), []
    for t in texts:
        rows, gone = t.split("\n"), set()
        hits = []
        for i in range(len(rows) - 1):
            hits.append((rows[i], rows[i + 1]) in seen)
            seen.add((rows[i], rows[i + 1]))
        i = 0
        while i < len(hits):
            j = i
            while j < len(hits) and hits[j]:
                j += 1
            if j > i and len("\n".join(rows[i : j + 1])) >= 80:
                gone |= set(range(i, j + 1))
            i = j + 1
        want.append("\n".join(x for i, x in enumerate(rows) if i not in gone))
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long").repartition(5)
    got = {x.doc_id: (x.text, x.n_chars) for x in corpus_pipeline.drop_repeated_lines(spark, df, "").collect()}
    assert got == {i: (t, len(t)) for i, t in enumerate(want)}
    assert sum(map(len, want)) < 0.8 * sum(map(len, texts))


def test_spotsigs_equal_brute_force(docs, rows, empty):
    order = sorted(rows, reverse=True)
    want = {}
    for at, (i, t) in enumerate(order):
        t, after = t or "", order[(at + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = map(spotsigs.signatures, (t, edited, after))
        want[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.spell(a), spotsigs.spell(b), spotsigs.likeness(a, b), spotsigs.likeness(a, c))
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in spotsigs.compare_documents(docs).collect()}
    assert got == want
    assert spotsigs.compare_documents(empty).count() == 0


def test_spotsigs_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 7)
    df = spark.createDataFrame([(i, f"the w{i} x{i}") for i in range(100)], "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in spotsigs.compare_documents(df).collect()}
    t = lambda i: f"the w{i} x{i}"
    assert got == {i: hashlib.sha256((t(i)[: len(t(i)) - len(t(i)) // 2] + t((i - 1) % 100)[: len(t(i)) // 2]).encode()).hexdigest() for i in range(100)}


def test_spotsigs_of_repeated_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 5)
    r = random.Random(3)
    rows = [(r.choice([7, 7, 7, None, None, i]), f"the w{r.randrange(40)} x{i % 60} of y{i % 9}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hashes = {x.text: x.h for x in df.selectExpr("text", "xxhash64(text) as h").collect()}
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), hashes[x[1]]))
    want = []
    for at, (i, t) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        want.append((i, hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()))
    got = [(x.doc_id, x.edited_sha256) for x in spotsigs.compare_documents(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    buckets = spotsigs.neighbours(df, "doc_id", "text").where("halo = 0 and doc_id = 7").select("bucket").distinct().count()
    assert buckets > 2  # a hot key is spread


@pytest.mark.parametrize("split", [2_000, 6])
def test_spotsigs_groups_equal_brute_force(spark, docs, rows, empty, monkeypatch, split):
    monkeypatch.setattr(spotsigs, "SPLIT", split)
    r = random.Random(4)
    words = ["the", "of", "a", "is", *(f"w{i}" for i in range(300))]
    long = [[r.choice(words) for _ in range(300)] for _ in range(4)]
    texts = [t for _, t in rows] + [" ".join([*x[:k], "q", *x[k + 1 :]]) for x in long for k in range(0, 120, 12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sigs = [spotsigs.signatures(t or "") for t in texts]
    near = [(i, j) for i in range(len(sigs)) for j in range(i) if spotsigs.likeness(sigs[i], sigs[j]) >= 0.8]
    assert {x.doc_id: x.group_id for x in spotsigs.near_groups(df).collect()} == dict(enumerate(roots(len(texts), near)))
    assert len(near) > 100 and spotsigs.near_groups(empty).count() == 0


def base_rules(t):
    luhn = lambda d: sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_rules_equal_the_plain_patterns():
    r = random.Random(2)
    for _ in range(4000):
        t = "".join(r.choice("@@..a1-+0 5(4)é%_") for _ in range(r.randrange(60)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == base_rules(t)


def test_personal_data(spark, empty):
    texts = ["mail a.b@c.org or +1 (555) 010-2030", "card 4111 1111 1111 1111 ip 10.0.0.256 10.0.0.1", 'token = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"', "clean text of 1999", None, "", "1" * 5000]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_rules(t or ""))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[i].spans.split(","))
    assert (got[0].n_email, got[0].n_phone, got[1].n_card, got[1].n_ip) == (1, 1, 1, 1)
    assert "secret:" in got[2].spans and got[3].spans == "" and got[4].spans == ""
    assert (got[2].n_secret, got[2].n_spans, got[2].has_personal, got[3].has_personal) == (1, 1, True, False)
    assert pii.personal_data(empty).count() == 0


def test_proposals_have_no_length_bound():
    def secrets(t):
        return [t[a:b] for k, a, b in pii.proposals(t) if k == 4]

    assert "sk-" + "aB3" * 200 in secrets("x sk-" + "aB3" * 200 + " y")
    assert "0f" * 300 in secrets("x " + "0f" * 300 + " y")
    assert "p1" * 400 in secrets('password = "' + "p1" * 400 + '" z')
    assert "eyJhbGci.eyJzdWIi.c2ln" in secrets("Bearer eyJhbGci.eyJzdWIi.c2ln")
    key = "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----"
    assert key in secrets("a " + key + " b") and "-----BEGIN PRIVATE KEY-----" in secrets("-----BEGIN PRIVATE KEY----- cut")
    spoken = "m" * 300 + " (at) host (dot) org"
    assert [spoken[a:b] for k, a, b in pii.proposals(spoken) if k == 0] == [spoken]
    assert [x for x in pii.proposals("x" * 500 + " (at) host dot") if x[0] == 0] == []


def test_selection_equals_the_plain_greedy_choice(monkeypatch):
    r = random.Random(7)
    trees = type("T", (), {"score": lambda self, x: np.array([(v[1] * 37 % 11) / 11 for v in x])})()
    monkeypatch.setattr(pii, "features", lambda t, k, a, b: [k, a * 3 + b])
    for _ in range(300):
        starts = [r.randrange(60) for _ in range(r.randrange(25))]
        spans = sorted({(r.randrange(5), a, a + r.randrange(1, 9)) for a in starts})
        base = [(0, 10, 14), (1, 12, 20), (2, 40, 44)] if r.random() < 0.5 else []
        monkeypatch.setattr(pii, "proposals", lambda t, s=spans: s)
        monkeypatch.setattr(pii, "base_spans", lambda t, b=base: list(b))
        taken = list(base)
        extra = [c for c in spans if not any(a < c[2] and c[1] < b for _, a, b in base)]
        scores = trees.score([[k, a * 3 + b] for k, a, b in extra])
        for s, c in sorted(zip(scores, extra, strict=True), key=lambda z: (-z[0], z[1])):
            if s >= 0.5 and not any(a < c[2] and c[1] < b for _, a, b in taken):
                taken.append(c)
        assert pii.select("x", trees, [0.5] * 5)[1] == (sorted(taken) if extra else base)


def test_planted_data_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trees, limits = pii.train(docs)
    texts = [r.text or "" for r in docs.collect()]
    for kind, (n, found, alike, wrong) in pii.measure(texts, trees, limits).items():
        assert found >= 0.9 * n and wrong <= 0.05 * alike, kind


def test_trees_learn_an_interaction():
    x = np.random.default_rng(0).random((3000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    t = pii.Trees(x[:2000], y[:2000])
    assert ((t.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
