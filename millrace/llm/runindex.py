"""Removal of long repeated byte strings with a run-length compressed Burrows-Wheeler index.

Every window of LENGTH bytes belongs to the least hash among its K-byte strings; the windows that share it
side by side form a region. Equal windows have equal least hashes, so only regions whose hash occurs again
anywhere can hold a repeat, and all of a window's copies meet in one group of regions. A group larger than
a block is split: its windows are parted by where in them the shared string lies, in halves, and by the bytes
that all windows of such a class have in common. Equal windows stay together, and after at most 9
halvings a class has one window. Groups are packed into blocks of bounded size. For each block the distinct regions are joined, their Burrows-Wheeler transform
is built and run-length compressed, and suffix-array samples are kept at the runs' ends only. The samples
give, streamed in text order, every position's matching statistic: the longest string there that also
starts elsewhere. Windows whose statistic reaches LENGTH are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches, materialize, release

LENGTH = 400
#: Bytes hashed to choose a window's group.
K = 32
#: Symbols in one index; a larger group is split.
BLOCK = 2_000_000
BASE, MASK = 0x9E3779B97F4A7C15, 2**64 - 1


class Powers:
    """Powers of the hash base and of its inverse modulo 2 ** 64, as far as needed."""

    def __init__(self):
        self.n = 0

    def upto(self, n: int):
        import numpy as np

        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.full(self.n - 1, b, np.uint64)]).cumprod(dtype=np.uint64) for b in (BASE, pow(BASE, -1, 2**64)))
        return self.up[:n], self.down[:n]


def rolling(data, k: int, powers: Powers):
    """A 64-bit hash of every k-byte string of a byte array."""
    import numpy as np

    up, down = powers.upto(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    h = (sums[k:] - sums[:-k]) * down[: len(data) - k + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def regions(data, length: int, k: int, powers: Powers):
    """(hash, start, windows, repeats) of the maximal runs of windows with one least hash.

    repeats: 2 if the hash occurs twice in the region, else 1.
    """
    import numpy as np

    h = rolling(data, k, powers)
    w = length - k + 1
    n = len(h) - w + 1
    pad = -len(h) % w
    grid = np.append(h, np.full(pad, MASK, np.uint64)).reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    size = np.diff(np.append(start, n))
    value = low[start]
    twice = [2 if np.count_nonzero(h[s : s + c + w - 1] == v) > 1 else 1 for s, c, v in zip(start.tolist(), size.tolist(), value, strict=True)]
    return value.view(np.int64), start, size, twice


def suffix_array(sym, longest: int):
    """(suffix array, 7-symbol keys) of symbols 0..256, 0 parting texts of at most `longest` symbols; ties by position."""
    import numpy as np

    n = len(sym)
    key = np.zeros(n, np.int64)
    for i in range(7):
        key <<= 9
        key[: max(0, n - i)] |= sym[i:]
    sa = np.argsort(key, kind="stable")
    head = np.concatenate([[True], key[sa[1:]] != key[sa[:-1]]])
    place = np.arange(n)
    first = np.maximum.accumulate(np.where(head, place, 0))
    rank = np.empty(n, np.int64)
    rank[sa] = first
    h = 7
    tied = np.flatnonzero(~head | np.append(~head[1:], False))
    while h <= longest and len(tied):
        at = sa[tied]
        group = rank[at]
        after = at + h
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(group * (n + 2) + second, kind="stable")
        at, group, second = at[order], group[order], second[order]
        sa[tied] = at
        head = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        rank[at] = tied[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        tied = tied[~head | np.append(~head[1:], False)]
        h *= 2
    return sa, key


class RunIndex:
    """Run-length BWT of texts, with suffix-array samples at both ends of every run."""

    def __init__(self, texts: list[bytes]):
        import numpy as np

        lens = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
        sym = np.zeros(int((lens + 1).sum()), np.int64)
        owner = np.repeat(np.arange(len(texts)), lens + 1)
        inside = np.ones(len(sym), bool)
        inside[self.starts + lens] = False
        sym[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        self.left = self.starts[owner] + lens[owner] - np.arange(len(sym))  # symbols to the end of the text
        sa, self.key = suffix_array(sym, int(lens.max(initial=0)) + 1)
        self.sym = sym
        bwt = sym[sa - 1]
        # A run never joins two texts' ends: parting symbols are all different.
        head = np.flatnonzero(np.concatenate([[True], (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)]))
        self.run_symbol, self.run_length = bwt[head], np.diff(np.append(head, len(sa)))
        self.first, self.last = sa[head], sa[np.append(head[1:] - 1, len(sa) - 1)]
        self.n = len(sa)

    def extension(self, a, b):
        """The longest common string of pairs of positions, inside their texts."""
        import numpy as np

        most = np.minimum(self.left[a], self.left[b])
        got, on = np.zeros(len(a), np.int64), np.arange(len(a))
        while len(on):
            x, y = a[on] + got[on], b[on] + got[on]
            same = (self.key[np.minimum(x, self.n - 1)] == self.key[np.minimum(y, self.n - 1)]) & (got[on] + 7 <= most[on])
            got[on[same]] += 7
            on = on[same]
        on = np.arange(len(a))
        for _ in range(7):
            on = on[got[on] < most[on]]
            on = on[self.sym[a[on] + got[on]] == self.sym[b[on] + got[on]]]
            got[on] += 1
        return got

    def matching_statistics(self):
        """For each position, the longest string there that also starts elsewhere.

        Neighbours in suffix order change only at run ends: between samples a match moves along and shortens
        by one, so one pass over the positions from sample to sample gives all lengths.
        """
        import numpy as np

        length = self.extension(self.first[1:], self.last[:-1])
        best, place = np.zeros(self.n, np.int64), np.arange(self.n)
        # Samples of the neighbour before and after; the very first and the very last suffix lack one.
        for samples, none in ((self.first[1:], self.first[0]), (self.last[:-1], self.last[-1])):
            reach, known = np.zeros(self.n, np.int64), np.zeros(self.n, bool)
            reach[samples], known[samples], known[none] = samples + length, True, True
            nearest = np.maximum.accumulate(np.where(known, place, 0))
            np.maximum(best, reach[nearest] - place, out=best)
        return np.minimum(best, self.left)


def marked(texts: list[bytes], length: int):
    """For each text a boolean array over its windows: whether the window also starts elsewhere in the texts."""
    import numpy as np

    index = RunIndex(texts)
    hit = index.matching_statistics() >= length
    return [hit[s : s + len(t) - length + 1] for s, t in zip(index.starts.tolist(), texts, strict=True)] if len(hit) else [np.zeros(0, bool)]


def by_hash(texts: list[bytes], length: int):
    """The same by the windows' 64-bit hashes alone, for tests."""
    import numpy as np

    powers = Powers()
    rows = [rolling(np.frombuffer(t, np.uint8), length, powers) for t in texts]
    _, back, count = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    hit, ends = count[back] > 1, np.cumsum([len(r) for r in rows])
    return [hit[e - len(r) : e] for e, r in zip(ends.tolist(), rows, strict=True)]


def halves(data: bytes, m: int, shared: int, at: int, level: int, length: int, k: int, powers: Powers):
    """(group, start, windows, at) of the parts of a region's windows, at a level from 1 on.

    m: the region's group; shared: the hash of the string that its windows share. at: how far behind the first
    window's start its first such string starts, which falls by one from window to window; -1: to be found, and
    then a window belongs to the first in it.
    """
    import numpy as np
    import xxhash

    n = len(data) - length + 1
    if at < 0:
        where = np.flatnonzero(rolling(np.frombuffer(data, np.uint8), k, powers).view(np.int64) == shared)
        behind = where[np.searchsorted(where, np.arange(n))] - np.arange(n)
    else:
        behind = at - np.arange(n)
    width = 1 << max(0, (length - k).bit_length() - level)
    part = behind // width
    first = np.flatnonzero(np.concatenate([[True], (np.diff(part) != 0) | (np.diff(behind) != -1)]))
    for s, e in zip(first.tolist(), [*first[1:].tolist(), n], strict=True):
        low = int(part[s]) * width
        high = min(low + width - 1, length - k)
        anchor = s + int(behind[s])
        yield xxhash.xxh64_intdigest(b"%d %d %d " % (m, level, low) + data[anchor - low : anchor - high + length]) - 2**63, s, e - s, int(behind[s])


def covered(hit, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the windows that hit."""
    import numpy as np

    at = np.flatnonzero(hit)
    if not len(at):
        return []
    new = np.flatnonzero(np.concatenate([[True], np.diff(at) > length]))
    return [(int(at[a]), int(at[b - 1]) + length) for a, b in zip(new, np.append(new[1:], len(at)), strict=True)]


def repeated_ranges(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """(k1, k2, a, b): byte ranges [a, b) of the rows (k1, k2, text) whose every byte lies in a repeated string.

    Ranges of one row may overlap.
    """

    def find(stream) -> Iterator:
        import numpy as np
        import pyarrow as pa

        powers = Powers()
        for batch in batches(stream, 512, 4_000_000):
            out: list = [[], [], [], [], [], []]
            for k1, k2, t in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text")), strict=True):
                data = np.frombuffer((t or "").encode(), np.uint8)
                if len(data) >= length:
                    value, start, size, twice = regions(data, length, k, powers)
                    for column, x in zip(out, (np.full(len(start), k1), np.full(len(start), k2), value, start, size, twice), strict=True):
                        column.append(x)
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, kinds, strict=True)], ["k1", "k2", "m", "s", "n", "c"])

    spans = materialize(docs.select("k1", "k2", "text").mapInArrow(find, "k1 long, k2 long, m long, s int, n int, c int"), "spans")
    # Written, so that the join has an exchange of its own, which AQE can split where a hash is hot.
    again = materialize(spans.groupBy("m").agg(F.sum("c").alias("c")).where("c > 1").select("m"), "again")
    wanted = spans.join(again.hint("merge"), "m", "left_semi").groupBy("k1", "k2").agg(F.collect_set(F.struct("m", "s", "n")).alias("want"))

    def cut(stream) -> Iterator:
        """A region's bytes come with its first occurrence in the task, its second only says so."""
        import pyarrow as pa
        import xxhash

        seen: dict = {}
        names = ["k1", "k2", "m", "r1", "r2", "s", "twice", "text"]
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.bool_(), pa.binary()]
        for batch in batches(stream, 512, 4_000_000):
            out = []
            for k1, k2, t, want in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text", "want")), strict=True):
                data = t.encode()
                for x in want:
                    m, part = x["m"], data[x["s"] : x["s"] + x["n"] + length - 1]
                    digest = xxhash.xxh3_128_intdigest(part)
                    r1, r2 = (digest >> 64) - 2**63, (digest & MASK) - 2**63
                    times = seen[m, digest] = seen.get((m, digest), 0) + 1
                    out.append((k1, k2, m, r1, r2, x["s"], times == 2, part if times == 1 else None))
            if len(seen) > 500_000:
                seen.clear()  # what is met again is sent again
            columns = list(zip(*out, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    kinds = "k1 long, k2 long, m long, r1 long, r2 long, s int, twice boolean, text binary"
    cuts = materialize(docs.join(wanted.hint("merge"), ["k1", "k2"]).mapInArrow(cut, kinds), "cuts")
    release(spans, again)
    texts, levels, written = split_groups(cuts, length, k)

    def mark(stream) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names, hold = ["m", "r1", "r2", "ranges"], {}
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        size, last = 0, None

        def settle():
            ready = [(key, t, many) for key, (t, many) in hold.items() if t is not None]
            hits = marked([t for _, t, _ in ready], length) if ready else []
            rows = [(key, covered(np.ones_like(hit) if many > 1 else hit, length)) for (key, _, many), hit in zip(ready, hits, strict=True)]
            rows = [x for x in rows if x[1]]
            return pa.RecordBatch.from_arrays([*(pa.array([x[0][i] for x in rows], pa.int64()) for i in range(3)), pa.array([[{"a": a, "b": b} for a, b in x[1]] for x in rows], kind)], names)

        for batch in stream:
            for m, r1, r2, twice, t in zip(*(batch.column(c).to_pylist() for c in ("m", "r1", "r2", "twice", "text")), strict=True):
                if m != last and size > BLOCK // 2:
                    yield settle()
                    hold.clear()
                    size = 0
                last = m
                held, many = hold.get((m, r1, r2), (None, 0))
                if held is None and t is not None:
                    size += len(t)
                hold[m, r1, r2] = (held if held is not None else t, many + 1 + twice)
        if hold:
            yield settle()

    ranges = texts.select("m", "r1", "r2", "twice", "text").repartition("m").sortWithinPartitions("m").mapInArrow(mark, "m long, r1 long, r2 long, ranges array<struct<a:int,b:int>>")
    ranges = materialize(ranges, "ranges")
    whole = raised(ranges, levels) if levels else ranges
    places = cuts.select("k1", "k2", "m", "r1", "r2", "s")
    hits = places.join(whole.hint("merge"), ["m", "r1", "r2"]).select("k1", "k2", "s", F.explode("ranges").alias("x"))
    hits = materialize(hits.select("k1", "k2", (F.col("s") + F.col("x.a")).alias("a"), (F.col("s") + F.col("x.b")).alias("b")), "hits")
    release(cuts, ranges, *written)
    return hits


#: Groups that are named to every task when they are split; more are joined by a shuffle.
NAMED = 100_000


def raised(ranges: DataFrame, levels: list) -> DataFrame:
    """(m, r1, r2, ranges) of whole regions: the ranges found in parts, moved to the regions that were cut.

    One row for each distinct region, from its distinct parts: how often a region stands in documents plays no role.
    """
    for parts in reversed(levels):
        found = ranges.select(F.col("m").alias("m2"), F.col("r1").alias("q1"), F.col("r2").alias("q2"), "ranges")
        moved = F.transform("ranges", lambda x: F.struct((x["a"] + F.col("off")).alias("a"), (x["b"] + F.col("off")).alias("b")))
        ranges = ranges.unionByName(parts.select("m", "r1", "r2", "off", "m2", "q1", "q2").join(found.hint("merge"), ["m2", "q1", "q2"]).select("m", "r1", "r2", moved.alias("ranges")))
    return ranges.groupBy("m", "r1", "r2").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def split_groups(cuts: DataFrame, length: int, k: int) -> tuple[DataFrame, list, list]:
    """(texts, levels, tables to release): cuts with the groups larger than a block split.

    texts: (m, r1, r2, twice, text, at, shared), the distinct regions of each group; levels: tables with
    (m, r1, r2, off, m2, q1, q2), which part of a region went to which group. A split works on the distinct texts of
    the groups concerned alone: neither the documents nor the places of the regions in them are read again.
    """
    texts = cuts.where("text is not null or twice").select("m", "r1", "r2", "twice", "text", F.lit(-1).alias("at"), F.col("m").alias("shared"))
    levels, written, done = [], [], []
    once = [F.max("text").alias("text"), ((F.count(F.lit(1)) > 1) | F.bool_or("twice")).alias("twice"), F.max("at").alias("at"), F.max("shared").alias("shared")]
    for level in range(1, (length - k).bit_length() + 1):
        # Only several texts make a group hot: one text needs no splitting, however long.
        sizes = texts.groupBy("m", "r1", "r2").agg(F.max(F.octet_length("text")).cast("long").alias("n")).groupBy("m")
        hot = materialize(sizes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).where((F.col("n") > BLOCK) & (F.col("texts") > 1)).select("m"), "hot")
        written.append(hot)
        many = hot.count()
        if not many:
            break
        named = F.broadcast(hot) if many <= NAMED else hot.hint("merge")
        done.append(texts.join(named, "m", "left_anti"))

        def cut(stream, level=level) -> Iterator:
            import pyarrow as pa
            import xxhash

            powers = Powers()
            names = ["m", "r1", "r2", "off", "m2", "q1", "q2", "at", "shared", "twice", "text"]
            kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 3 + [pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
            for batch in batches(stream, 512, 4_000_000):
                out = []
                for m, r1, r2, whole, twice, at, shared in zip(*(batch.column(c).to_pylist() for c in ("m", "r1", "r2", "text", "twice", "at", "shared")), strict=True):
                    for m2, off, n, at2 in halves(whole, m, shared, at, level, length, k, powers):
                        part = whole[off : off + n + length - 1]
                        digest = xxhash.xxh3_128_intdigest(part)
                        out.append((m, r1, r2, off, m2, (digest >> 64) - 2**63, (digest & MASK) - 2**63, at2, shared, twice, part))
                columns = list(zip(*out, strict=True)) or [[]] * 11
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        whole = texts.join(named, "m", "left_semi").groupBy("m", "r1", "r2").agg(*once)
        parts = materialize(whole.mapInArrow(cut, "m long, r1 long, r2 long, off int, m2 long, q1 long, q2 long, at int, shared long, twice boolean, text binary"), "parts")
        # Regions that differ have equal parts where they do not: each is one row from here on.
        texts = parts.select(F.col("m2").alias("m"), F.col("q1").alias("r1"), F.col("q2").alias("r2"), "twice", "text", "at", "shared")
        texts = materialize(texts.groupBy("m", "r1", "r2").agg(*once).select("m", "r1", "r2", "twice", "text", "at", "shared"), "texts")
        levels.append(parts)
        written += [parts, texts]
    for t in done:
        texts = texts.unionByName(t)
    return texts, levels, written


def dedup_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256, repeats, removed_share and kept (the remaining bytes) of every row.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same text or
    another; all is judged on the input. Matches lie within one text. Null texts count as empty; shorter texts
    keep all; rows that repeat are texts of their own, so long ones lose all their bytes; a null key stays
    null; an empty table gives no rows; other columns are left out. repeats says whether any byte goes,
    removed_share which part of the bytes (an empty text: none). Runs Spark jobs when called: the index is built
    in steps, each a table in the shared folder, deleted when the next is written.
    """
    own = docs.select(F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    own = own.select("_id", F.coalesce("_id", F.lit(0)).alias("k1"), F.xxhash64("_id", "text", F.lit(13)).alias("k2"), "text")
    found = repeated_ranges(own, length).groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("gone"))

    def remove(stream) -> Iterator:
        import pyarrow as pa

        for batch in batches(stream, 512, 4_000_000):
            out = []
            for doc, t, gone in zip(*(batch.column(c).to_pylist() for c in ("_id", "text", "gone")), strict=True):
                data, spans = t.encode(), []
                for a, b in sorted((x["a"], x["b"]) for x in gone or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                lost = len(data) - len(kept)
                out.append((doc, len(data), lost, len(spans), hashlib.sha256(kept).hexdigest(), lost > 0, lost / max(1, len(data)), kept))
            columns = list(zip(*out, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.bool_(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "repeats", "removed_share", "kept"])

    return own.join(found.hint("merge"), ["k1", "k2"], "left").mapInArrow(remove, f"{key} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, repeats boolean, removed_share double, kept binary")
