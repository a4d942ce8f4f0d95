"""Toxicity by weak supervision: many weak voters, a generative label model, a linear classifier on its posterior.

Voters are fixed lexicons, fixed patterns, and lexicons mined from the labelled rows; each votes toxic, clean
or not at all, on labelled and unlabelled documents alike. The label model is learned by expectation
maximisation: it estimates, for the hidden label, each voter's chance of each vote (its accuracy), and from the
votes' covariance given that label which voters repeat one another, so that correlated voters share one weight.
Known labels are one more voter, silent where there is none; its accuracy is estimated like the rest, from a
prior belief of TRUST rows. A logistic regression over words and word beginnings is then fitted to the posterior
of all sampled documents and scores every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches

#: English insults and threats, in groups of one voter each.
LEXICONS = (
    ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "imbecile", "fool", "dimwit", "dunce"),
    ("loser", "losers", "pathetic", "worthless", "useless", "coward", "failure", "clown", "clowns", "joke"),
    ("scum", "trash", "garbage", "filth", "filthy", "vermin", "disgusting", "vile", "rubbish", "pig"),
    ("hate", "hateful", "despise", "loathe", "detest"),
    ("kill", "murder", "die", "hang", "destroy", "strangle"),
    ("bastard", "bitch", "crap", "damn", "hell", "jerk", "creep", "freak", "psycho", "lunatic"),
)
#: Patterns, one voter each.
PATTERNS = (
    r"(?i)\byou(?:'re| are)? (?:an? |such an? |all )?(?:\w+ )?(?:idiot|moron|loser|clown|fool|scum|trash)",
    r"(?i)\bshut up\b|\bgo to hell\b|\bdrop dead\b|\bget lost\b",
    r"(?i)\b[a-z]\*{2,}[a-z]?\b|\b[a-z]+[@$!][a-z]+[!]{2,}",
    r"!{3,}|\?!\?!",
)
WORDS = re.compile(r"\w+")
#: The classifier also counts a text's distinct words of the first lexicons; the later ones hold words of other languages.
COUNTED = frozenset(w for lex in LEXICONS[:3] for w in lex)
#: Labelled rows, and documents without a label, used to fit the models, at most; taken in the order of a hash of their id.
SAMPLE, UNLABELLED = 5_000, 3_000
#: Rows' worth of belief that a known label is right 19 times in 20, before any row is seen.
TRUST = 400
#: Word beginnings of these lengths are features beside whole words.
PREFIXES = (4, 5, 6, 7)
#: Features of the classifier, at most, and the least number of training rows that hold one.
FEATURES, SUPPORT = 4_000, 3
#: Mined lexicons: voters dealt from the terms most bound to the toxic class.
MINED_VOTERS, MINED_TERMS = 8, 160
FOLDS = 5


def label_model(votes, known=None, rounds: int = 60):
    """(posterior of the toxic class, accuracy table, voter weights) from an (items x voters) array of -1, 0, 1.

    0 is no vote. Starts from the votes' majority, or near the votes of the voter at index `known` where it has
    one; that voter is never taken for an echo of the others and starts from a belief of TRUST rows.
    """
    import numpy as np

    n, m = votes.shape
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # items, voters, vote
    # Voters that repeat one another share a vote from the start, else three echoes would outvote two witnesses.
    centred = votes - votes.mean(0)
    spread = np.sqrt((centred**2).sum(0)) + 1e-9
    raw = (centred.T @ centred) / np.outer(spread, spread)
    np.fill_diagonal(raw, 0)
    weight = 1 / (1 + (raw**2).sum(1))
    for_, against = (votes == 1) @ weight, (votes == -1) @ weight
    q = (for_ + 0.02) / (for_ + against + 0.1)
    belief = np.full((2, m, 3), 0.5)
    if known is not None:
        told = votes[:, known] != 0
        q = np.where(told, np.where(votes[:, known] > 0, 0.95, 0.05), q)
        share = max(float(told.mean()), 1e-3)  # how often it votes says nothing about the class
        belief[0, known], belief[1, known] = (np.array([a * share, 1 - share, b * share]) * TRUST + 0.5 for a, b in ((0.95, 0.05), (0.05, 0.95)))
        weight[known] = 1.0
    for step in range(rounds):
        prior = np.clip(q.mean(), 1e-3, 0.5)
        table = np.stack([np.einsum("n,nmv->mv", p, hot) for p in (1 - q, q)]) + belief
        table /= table.sum(axis=2, keepdims=True)
        if step % 5 == 4:  # correlations of the votes that the hidden label does not explain
            mean = np.einsum("nc,cmv->nmv", np.stack([1 - q, q], 1), table)
            left = votes - (mean[:, :, 2] - mean[:, :, 0])
            scale = np.sqrt((left**2).mean(0)) + 1e-6
            r = (left.T @ left) / max(n, 1) / np.outer(scale, scale)
            np.fill_diagonal(r, 0)
            weight = 1 / (1 + np.maximum(r, 0).sum(1))
            if known is not None:
                weight[known] = 1.0
        ratio = np.log(table[1]) - np.log(table[0])
        odds = np.log(prior / (1 - prior)) + np.einsum("nmv,mv,m->n", hot, ratio, weight)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - q).max(initial=0) < 1e-6:
            q = new
            break
        q = new
    return q, table, weight


def logistic(rows, cols, values, n: int, m: int, target, l2: float = 0.5, newton: int = 12, inner: int = 40):
    """(weights, bias) of a ridge logistic regression on a sparse matrix: Newton steps solved by conjugate gradients."""
    import numpy as np

    forward = lambda v: np.bincount(rows, weights=v[:-1][cols] * values, minlength=n) + v[-1]
    back = lambda u: np.append(np.bincount(cols, weights=u[rows] * values, minlength=m), u.sum())
    ridge = np.append(np.full(m, l2), 1e-4)
    w = np.zeros(m + 1)
    for _ in range(newton):
        p = 1 / (1 + np.exp(-np.clip(forward(w), -30, 30)))
        g, h = back(p - target) + ridge * w, np.maximum(p * (1 - p), 1e-4)
        x, r = np.zeros(m + 1), -g
        d, rr = r.copy(), r @ r
        for _ in range(inner):
            if rr < 1e-9:
                break
            ad = back(h * forward(d)) + ridge * d
            step = rr / (d @ ad)
            x, r = x + step * d, r - step * ad
            d, rr = r + (r @ r) / rr * d, r @ r
        w += x * min(1.0, 5.0 / max(np.abs(x).max(), 1e-9))
        if np.abs(x).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def traits(bags: list) -> Iterator[tuple[str, list, object, object, object]]:
    """(mark, names, text, feature, count) of each kind of feature, whose full name is mark + name.

    How many of a text's words stand in the counted lexicons, then its whole words, then how many of them share a
    beginning; 8 at most each. bags holds each text's distinct words; one kind at a time is in memory.
    """
    import numpy as np

    vocabulary: dict = {}
    word = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for bag in bags for w in bag), np.int32)
    text = np.repeat(np.arange(len(bags), dtype=np.int32), [len(bag) for bag in bags])
    names = list(vocabulary)
    hits = np.bincount(text[np.fromiter((w in COUNTED for w in names), bool, len(names))[word]], minlength=len(bags))
    some = np.flatnonzero(hits)
    yield "#", ["lexicons"], some.astype(np.int32), np.zeros(len(some), np.int32), np.minimum(hits[some], 8).astype(np.int8)
    del vocabulary
    yield "=", names, text, word, np.ones(len(word), np.int8)
    for n in PREFIXES:
        heads: dict = {}
        head = np.fromiter((heads.setdefault(w[:n], len(heads)) if len(w) >= n else -1 for w in names), np.int64, len(names))[word]
        has, size = head >= 0, max(1, len(heads))
        pair, count = np.unique(text[has] * size + head[has], return_counts=True)
        del head, has
        yield "", list(heads), (pair // size).astype(np.int32), (pair % size).astype(np.int32), np.minimum(count, 8).astype(np.int8)


def fit(sample: list) -> tuple[dict, float]:
    """({feature: weight}, bias) from rows (distinct words, pattern hits, label 0, 1 or None)."""
    import numpy as np

    bags = [words for words, _, _ in sample]
    told = np.array([y is not None for _, _, y in sample], float)
    labels = np.array([y or 0 for _, _, y in sample], float)
    n, n1, n0 = len(sample), labels.sum(), told.sum() - labels.sum()
    found, cells = [], []
    for mark, names, text, feature, count in traits(bags):
        c1 = np.bincount(feature, weights=labels[text], minlength=len(names))
        c0 = np.bincount(feature, weights=told[text], minlength=len(names)) - c1
        odds = np.log((c1 + 0.3) / (n1 - c1 + 0.6)) - np.log((c0 + 0.3) / (n0 - c0 + 0.6))
        gain = np.where(c0 + c1 >= SUPPORT, np.abs(odds) * np.sqrt(c1 + 0.02 * c0), 0)
        top = np.argsort(-gain, kind="stable")[:FEATURES]
        top = top[gain[top] > 0]
        at = np.full(len(names), -1, np.int32)
        at[top] = np.arange(len(found), len(found) + len(top))
        found += [(float(gain[i]), mark + names[i], float(odds[i]), float(c1[i])) for i in top.tolist()]
        own = at[feature] >= 0
        cells.append((text[own], at[feature[own]], count[own]))
        del text, feature, count, own
    rows, cols, values = (np.concatenate([c[i] for c in cells]) for i in range(3))
    del cells
    order = sorted(range(len(found)), key=lambda i: (-found[i][0], found[i][1]))
    chosen, mined = order[:FEATURES], [i for i in order if found[i][2] > 2.5 and found[i][3] >= SUPPORT][:MINED_TERMS]
    # Mined lexicons, dealt out so that every voter has frequent and rare terms.
    columns = [np.array([not lex.isdisjoint(bag) for bag in bags], int) for lex in map(frozenset, LEXICONS)]
    for i in range(MINED_VOTERS):
        hit = np.zeros(n, int)
        hit[rows[np.isin(cols, mined[i::MINED_VOTERS])]] = 1
        columns.append(hit)
    lexical = np.array(columns).T.reshape(n, -1)
    shown = np.array([[int(h > 0) for h in hits] for _, hits, _ in sample]).reshape(n, -1)
    none, two = np.where(lexical.sum(1) == 0, -1, 0), np.where(lexical.sum(1) >= 2, 1, 0)
    votes = np.column_stack([lexical, shown, none, two, np.where(told > 0, np.where(labels > 0.5, 1, -1), 0)])
    target, _, _ = label_model(votes, known=votes.shape[1] - 1)
    at = np.full(len(found) + 1, -1, np.int32)
    at[chosen] = np.arange(len(chosen))
    own = at[cols] >= 0
    rows, cols, values = rows[own], at[cols[own]], values[own]
    w, b = logistic(rows, cols, values, n, len(chosen), target)
    return {found[i][1]: float(x) for i, x in zip(chosen, w, strict=True) if x}, float(b)


def fallback() -> tuple[dict, float]:
    """Weights where no row is labelled: any two terms of the fixed lexicons make a text toxic."""
    return {"=" + w: 2.0 for lex in LEXICONS for w in lex}, -3.0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> tuple[dict, float]:
    """Fit on at most `sample` labelled rows outside the held-out fold, and as many documents without a label, but
    `unlabelled` of these at most: more than that would let the voters drown the labels.

    Runs jobs when called. Only the sampled documents' distinct words reach the driver. A document of the held-out
    fold is never sampled, labelled or not.
    """
    given = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(F.avg(F.col("toxic").cast("double")).alias("y"))
    known = given.where(~held_out(key)).orderBy(F.xxhash64(key), key).limit(sample)
    free = docs.select(F.col(key).cast("long").alias(key)).where(F.col(key).isNotNull()).where(~held_out(key)).distinct().join(given.select(key), key, "left_anti")
    free = free.orderBy(F.xxhash64(key), key).limit(min(unlabelled, known.count())).withColumn("y", F.lit(None).cast("double"))

    def run(stream) -> Iterator:
        import pyarrow as pa

        patterns = [re.compile(p) for p in PATTERNS]
        for batch in batches(stream, 512, 4_000_000, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            words = [" ".join(sorted(set(WORDS.findall(t.lower())))) for t in texts]
            hits = [[sum(1 for _ in p.finditer(t)) for p in patterns] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(words), pa.array(hits, pa.list_(pa.int32())), batch.column("y")], [key, "words", "hits", "y"])

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).join(F.broadcast(known.unionByName(free)), key).mapInArrow(run, f"{key} long, words string, hits array<int>, y double")
    rows = sorted({(x[key], x["words"], tuple(x["hits"]), -1 if x["y"] is None else int(x["y"] >= 0.5)) for x in rows.collect()})
    if len({y for *_, y in rows} - {-1}) < 2:
        return fallback()
    one: dict = {}  # each distinct word is held once
    bags: list = []
    rows.reverse()
    while rows:  # a row's text goes when it is split
        _, words, hits, y = rows.pop()
        bags.append(([one.setdefault(w, w) for w in words.split()], hits, None if y < 0 else y))
    return fit(bags)


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string")) % FOLDS == 0


def score(docs: DataFrame, weights: dict, bias: float, text: str = "text", name: str = "score") -> DataFrame:
    """docs with a column `name`, the classifier's chance that the text is toxic. Null texts score as empty ones."""
    import copy

    from pyspark.sql import types as T

    schema = copy.deepcopy(docs.schema).add(name, T.DoubleType())

    def run(stream) -> Iterator:
        import math

        import pyarrow as pa

        whole = {f[1:]: w for f, w in weights.items() if f[0] == "="}
        heads = [(n, {f: w for f, w in weights.items() if f[0] not in "=#" and len(f) == n}) for n in PREFIXES]
        counted = weights.get("#lexicons", 0.0)

        def one(t: str) -> float:
            words, x = set(WORDS.findall(t.lower())), bias
            x += sum(map(whole.__getitem__, words & whole.keys())) + counted * min(8, len(words & COUNTED))
            for n, table in heads:
                if hits := [h for w in words if (h := w[:n]) in table]:
                    x += sum(table[h] * min(8, hits.count(h)) for h in set(hits))
            return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))

        for batch in batches(stream, 1024, 4_000_000, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([one(t or "") for t in batch.column(text).to_pylist()], pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score and predicted for every row.

    held_out: crc32 of the key as text leaves no remainder by 5; such rows are never trained on. predicted is
    1 where score >= 0.5. A null key is not held out; null and empty texts get the score of an empty text;
    several labels for one key count by their mean (a tie is toxic); without both classes among the labels a
    fixed classifier over the lexicons takes over; repeated rows score alike and an empty table gives no rows.
    Training runs Spark jobs when this is called. A text's distinct words are all that a score needs, so a long
    text costs memory for these alone.
    """
    weights, bias = train(docs, labels, key, text)
    out = score(docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)), weights, bias, text)
    return out.select(key, F.coalesce(held_out(key), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
