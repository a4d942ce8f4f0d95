"""Benchmark decontamination: rare n-gram seeds find candidates, Smith-Waterman alignment scores them.

Each test item is cut into word n-grams. One pass over all documents counts how many hold each of them; the
rarer half of an item's n-grams are its seeds, whatever their count, so that an item that leaked into a
third of all documents keeps its seeds. A second pass joins the seeds with every whole text and aligns the
item with the passage around each group of seeds. Items come in blocks of bounded size: a block's words and
n-grams are numbers in sorted arrays that travel with the tasks, and texts are looked up in them a batch at a
time. Nothing but counts is shuffled. An alignment's memory follows the item, not the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches

WORDS = re.compile(r"\w+")
#: Words in a seed.
SEED = 2
#: Bytes of item texts in one block; each block is two passes over the documents.
BLOCK_BYTES = 24 << 20
#: Fixed scores of the alignment: equal words, different words, a gap.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Alignment score over the best possible one, from which a passage counts as a copy.
LEAST = 0.45
#: Words of a passage that are aligned in one go, at least; longer passages are cut with an overlap.
CHUNK = 4096


def _rows(item, passage, h):
    """The alignment's rows for the words of item, one after the other, from the row h before them."""
    import numpy as np

    slope = np.arange(len(passage) + 1) * -GAP
    for word in item:
        row = np.maximum(0, h + GAP)
        np.maximum(row[1:], h[:-1] + np.where(passage == word, MATCH, MISMATCH), out=row[1:])
        h = np.maximum.accumulate(row + slope) - slope
        yield h


def align(item, passage):
    """(score, first word, end word, equal words) of the best local alignment of two arrays of word numbers.

    Of equal scores the one that ends first in the item, then in the passage. Every k-th row is kept, k the root of
    the item's length, and those between are made again on the way back.
    """
    import numpy as np

    n = len(item)
    k = max(1, int(n**0.5))
    h = np.zeros(len(passage) + 1, np.int32)
    kept, best, i, j = [h], 0, 0, 0
    for at, h in enumerate(_rows(item, passage, h), 1):
        if at % k == 0:
            kept.append(h)
        if (top := int(h.max())) > best:
            best, i, j = top, at, int(h.argmax())
    end, equal, low, table = j, 0, i + 1, []
    while i > 0:
        if i - 1 < low:  # rows low to i, from the last one kept before them
            low = (i - 1) // k * k
            table = [kept[low // k], *_rows(item[low:i], passage[:j], kept[low // k][: j + 1])]
        now, up = table[i - low], table[i - low - 1]
        if now[j] <= 0:
            break
        hit = j > 0 and passage[j - 1] == item[i - 1]
        if j > 0 and now[j] == up[j - 1] + (MATCH if hit else MISMATCH):
            i, j, equal = i - 1, j - 1, equal + int(hit)
        elif now[j] == up[j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, j, end, equal


def best_alignment(item, passage):
    """`align` over pieces of a long passage: no alignment with a positive score is longer than three items, so pieces that overlap by as much miss none."""
    reach = (MATCH // -GAP + 1) * len(item)
    step = max(CHUNK, 5 * reach)
    found = None
    for a in range(0, max(1, len(passage) - reach), step):
        score, first, end, equal = align(item, passage[a : a + step + reach])
        if found is None or score > found[0]:
            found = (score, first + a, end + a, equal)
    return found


def spans(hits: list, length: int, n_words: int) -> list:
    """Windows of a text, an item's length and a half around each seed, overlapping ones joined."""
    out: list = []
    for at, place in sorted(hits, key=lambda x: x[0] - x[1]):
        low, high = max(0, at - place - length // 2), min(n_words, at - place + length + length // 2 + 1)
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


class Block:
    """A block of items as numbers: their words, their n-grams (all words of an item with fewer), and where these stand."""

    def __init__(self, ids: list, items: list):
        import numpy as np

        self.ids = ids
        self.numbers = {w: i for i, w in enumerate(sorted({w for words in items for w in words}))}
        self.base = len(self.numbers) + 1
        self.coded = [np.array([self.numbers[w] for w in words], np.int64) for words in items]
        keys = [self.keys(c) if len(c) >= SEED else c[:1] - self.base for c in self.coded]
        owner = np.repeat(np.arange(len(items)), [len(k) for k in keys])
        place = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.zeros(0, np.int64)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.grams, back = np.unique(flat, return_inverse=True)
        order = np.argsort(back, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.first = np.searchsorted(back[order], np.arange(len(self.grams) + 1))

    def keys(self, code):
        """A number for each n-gram of an array of word numbers."""
        key = code[: len(code) - SEED + 1]
        for i in range(1, SEED):
            key = key * self.base + code[i : len(code) - SEED + 1 + i]
        return key

    def look_up(self, texts: list[str]):
        """(word numbers of all texts, each text's first, its end, places with an item's n-gram, that n-gram)."""
        import numpy as np

        words, ends = [], []
        for t in texts:
            words += WORDS.findall(t)
            ends.append(len(words))
            words.append("")  # no n-gram goes over it
        code = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        ends = np.array(ends, np.int64)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        known = code >= 0
        both = known[: len(code) - SEED + 1].copy()
        for i in range(1, SEED):
            both &= known[i : len(code) - SEED + 1 + i]
        pairs, ones = np.flatnonzero(both), np.flatnonzero(known) if len(self.grams) and self.grams[0] < 0 else np.zeros(0, np.int64)
        at = np.concatenate([pairs, ones])
        key = np.concatenate([self.keys(code)[pairs] if len(pairs) else pairs, code[ones] - self.base])
        gram = np.minimum(np.searchsorted(self.grams, key), max(0, len(self.grams) - 1))
        hit = self.grams[gram] == key if len(self.grams) else np.zeros(len(key), bool)
        return code, starts, ends, at[hit], gram[hit]

    def seeds(self, counts):
        """Which n-grams are seeds: one flag per place in an item, in the order of owner and place. counts: documents that hold each n-gram."""
        import numpy as np

        gram = np.repeat(np.arange(len(self.grams)), np.diff(self.first))
        own = counts[gram]
        order = np.lexsort((own, self.owner))
        size = np.bincount(self.owner, minlength=len(self.ids))
        middle = np.concatenate([[0], np.cumsum(size)[:-1]]) + np.maximum(size - 1, 0) // 2
        median = own[order][np.minimum(middle, max(0, len(own) - 1))] if len(own) else own
        return own <= median[self.owner]


def matches(block: Block, seeds, texts: list[str], least: float) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(text, item number, score, start, end, equal words) of each item's best passage, if good enough; places are code points."""
    import numpy as np

    low = [t.lower() for t in texts]
    code, starts, ends, at, gram = block.look_up(low)
    of = np.searchsorted(ends, at)
    found: dict = {}
    for text, place, g in zip(of.tolist(), (at - starts[of]).tolist(), gram.tolist(), strict=True):
        for x in range(block.first[g], block.first[g + 1]):
            if seeds[x]:
                found.setdefault((text, int(block.owner[x])), []).append((place, int(block.place[x])))
    for (text, k), hits in sorted(found.items()):
        words, item = code[starts[text] : ends[text]], block.coded[k]
        tries = [(*best_alignment(item, words[a:b]), a) for a, b in spans(hits, len(item), len(words))]
        score, first, end, equal, a = max(tries, key=lambda x: (x[0], -x[4]))
        score /= MATCH * len(item)
        if score >= least:
            t = texts[text]
            where = [m.span() for m in WORDS.finditer(low[text] if len(low[text]) == len(t) else t)]
            yield text, k, score, where[a + first][0], where[a + end - 1][1], equal


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", least: float = LEAST) -> DataFrame:
    """(key, item, score, start, end, n_equal): every document's best passage for each item, where score >= least.

    score is the local alignment's over that of the whole item with itself; start and end are code points. Of
    passages with one score the first counts. Null, empty and wordless texts or items match nothing; items with a
    null id are left out; items that repeat an id with other texts count by their best passage; rows with a null
    key report a null key. Repeated documents give equal rows; empty tables give none; other columns are left out.
    Counts the n-grams in Spark jobs when called. A long text is aligned in pieces, so memory follows the items.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    tests = benchmark.select(F.col(item).cast("long").alias("i"), F.col("text").alias("t")).where("i is not null and t is not null").distinct()
    size = tests.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = spark.createDataFrame([], SCHEMA)
    for block in range(blocks):
        rows = sorted(tuple(x) for x in tests.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block).collect())
        rows = [(i, words) for i, t in rows if (words := WORDS.findall(t.lower()))]
        if rows:
            out = out.unionByName(_block(own, Block([i for i, _ in rows], [w for _, w in rows]), least))
    best = F.max_by(F.struct("score", "start", "end", "n_equal"), F.struct("score", -F.col("start")))
    return out.groupBy("doc", "item").agg(best.alias("b")).select(F.col("doc").alias(key), F.col("item").alias(item), "b.*")


SCHEMA = "doc long, item long, score double, start long, end long, n_equal long"


def _block(docs: DataFrame, block: Block, least: float) -> DataFrame:
    import numpy as np

    def count(stream) -> Iterator:
        import pyarrow as pa

        totals = np.zeros(len(block.grams), np.int64)
        for batch in batches(stream, 256, 1_000_000):
            _, _, ends, at, gram = block.look_up([(t or "").lower() for t in batch.column("text").to_pylist()])
            once = np.unique(np.searchsorted(ends, at) * max(1, len(totals)) + gram)
            totals += np.bincount(once % max(1, len(totals)), minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(totals[some])], ["g", "n"])

    # One row at most per n-gram of the block, whatever the number of documents.
    counted = docs.select("text").mapInArrow(count, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(block.grams), np.int64)
    counts[counted["g"].to_numpy()] = counted["n"].to_numpy()
    seeds = block.seeds(counts)

    def run(stream) -> Iterator:
        import pyarrow as pa

        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches(stream, 256, 1_000_000):
            ids = batch.column("doc").to_pylist()
            out = [(ids[d], block.ids[k], *rest) for d, k, *rest in matches(block, seeds, [t or "" for t in batch.column("text").to_pylist()], least)]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.mapInArrow(run, SCHEMA)
