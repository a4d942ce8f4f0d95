"""SimHash near-duplicate detection by tiled exact comparison of 64-bit fingerprints.

Fingerprints within the radius agree in one of radius + 1 blocks of bits, so equal blocks bring together all
that can link. Within such a bucket numpy compares tiles of fingerprints, sorted by population count, by
exclusive-or and bit counts; tile pairs whose counts differ beyond the radius are skipped. A bucket above
SPLIT fingerprints is dealt to several tasks as pairs of parts. Each task returns a spanning forest of its
links, never all pairs, so that nothing grows with the square of a group.

`similar` links by Jaccard similarity instead: there fingerprints and shared minhashes only propose pairs, and
each pair is recounted on its shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches, components, materialize

BITS = 64
#: Fingerprints compared in one numpy operation, each side.
TILE = 1024
#: Fingerprints of one bucket in a single task; above it the bucket is split into parts of this size.
SPLIT = 16_384
#: The same where shingle sets are recounted: rows, and shingles of all rows together.
SPLIT_SETS, SPLIT_SHINGLES = 4096, 4_000_000


def shingle_hashes(text: str, width: int):
    """XXH64, seed 42, of each word shingle, repeats included; the whole sequence where there are fewer words."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return np.empty(0, np.uint64)
    flat, h = b" ".join(words), xxhash.xxh64_intdigest
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lens)
    first, last = (ends - lens).tolist(), (ends - 1).tolist()
    return np.array([h(flat[a:b], 42) for a, b in zip(first, last[width - 1 :], strict=False)] or [h(flat, 42)], np.uint64)


def fingerprint(hashes) -> int:
    """A bit is set if it is set in over half the hashes; no hashes: 0."""
    import numpy as np

    bits = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        bits += np.unpackbits(hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def rarest(hashes, n: int):
    """The least hash under each of n permutations: two texts share one with a chance of their Jaccard similarity."""
    import numpy as np

    odd = np.random.default_rng(23).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = hashes ^ (hashes >> np.uint64(31))
    return [int((mixed * k).min()) if len(hashes) else 0 for k in odd]


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text", meetings: int = 0) -> DataFrame:
    """(key, fp, meet): fp is the fingerprint's 64 bits as a signed long, meet the text's rarest shingles' hashes.

    Null and wordless texts: 0.
    """

    def run(stream) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches(stream, 2048, 8_000_000, text):
            fps, meet = [], []
            for t in batch.column(text).to_pylist():
                hashes = shingle_hashes(t or "", width)
                fps.append(fingerprint(hashes))
                meet.append(np.array(rarest(hashes, meetings), np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(meet, pa.list_(pa.int64()))], [key, "fp", "meet"])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(run, f"{key} long, fp long, meet array<long>")


def shingle_sets(docs: DataFrame, width: int, meetings: int, text: str = "text") -> DataFrame:
    """docs without text, plus d1 and d2 (a digest of the set of shingles), fp, meet, size and shingles.

    fp and meet are those of the distinct shingles. meetings 0: shingles is the sorted set, 8 bytes each; else it
    is null, for the sets are as large as the texts.
    """
    kept = [f for f in docs.schema.fields if f.name != text]
    names = [*(f.name for f in kept), "d1", "d2", "fp", "meet", "size", "shingles"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def run(stream) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches(stream, 2048, 8_000_000, text):
            out = []
            for t in batch.column(text).to_pylist():
                hashes = np.unique(shingle_hashes(t or "", width))
                raw = hashes.tobytes()
                digest = xxhash.xxh3_128_intdigest(raw)
                meet = np.array(rarest(hashes, meetings), np.uint64).view(np.int64)
                fp = fingerprint(hashes)
                out.append(((digest >> 64) - 2**63, (digest & (2**64 - 1)) - 2**63, fp - (fp >> 63 << 64), meet, len(hashes), None if meetings else raw))
            made = list(zip(*out, strict=True)) or [[]] * 6
            types = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(pa.array(c, t) for c, t in zip(made, types, strict=True))], names)

    return docs.mapInArrow(run, f"{kinds}, d1 long, d2 long, fp long, meet array<long>, size long, shingles binary")


class Recount:
    """Which rows are similar, by recounting their sets of shingles: |A and B| of |A or B| at least num / den."""

    def __init__(self, sets: list, num: int, den: int):
        import numpy as np

        sets = [np.frombuffer(x, np.uint64) for x in sets]
        self.num, self.den = num, den
        self.size = np.array([len(x) for x in sets], np.int64)
        _, back = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(back, np.cumsum(self.size)[:-1])
        self.mark = np.zeros(len(back) + 1, bool)

    def __call__(self, p: int, others):
        """Which of the other rows are similar to row p."""
        import numpy as np

        a, b = self.size[p], self.size[others]
        out = self.den * np.minimum(a, b) >= self.num * np.maximum(a, b)
        out &= b > 0
        at = np.flatnonzero(out)
        if len(at):
            self.mark[self.sets[p]] = True
            shared = np.add.reduceat(self.mark[np.concatenate([self.sets[i] for i in others[at]])].astype(np.int64), np.append(0, np.cumsum(b[at])[:-1]))
            self.mark[self.sets[p]] = False
            out[at] = self.den * shared >= self.num * (a + b[at] - shared)
        return out


def forest(fps, ids, radius: int, cut: int = 0, recount=None):
    """Pairs (id, id) that join exactly what the links of these fingerprints join.

    cut: if not 0, only rows before it are compared with rows from it on. recount: tells, for a row and the rows
    within the radius of it, which are links; without it all are.
    """
    import numpy as np

    pops = np.bitwise_count(fps).astype(np.int64)
    sides = [np.arange(len(fps))] * 2 if not cut else [np.arange(cut), np.arange(cut, len(fps))]
    sides = [x[np.argsort(pops[x], kind="stable")] for x in sides]
    label, out = np.arange(len(fps)), []
    tiles = [[x[i : i + TILE] for i in range(0, len(x), TILE)] for x in sides]
    for i, a in enumerate(tiles[0]):
        low, high = pops[a[0]] - radius, pops[a[-1]] + radius
        for j, b in enumerate(tiles[1]):
            if (not cut and j < i) or pops[b[-1]] < low or pops[b[0]] > high:
                continue
            hit = np.bitwise_count(fps[a][:, None] ^ fps[b][None, :]) <= radius
            hit &= label[a][:, None] != label[b][None, :]
            for row in np.flatnonzero(hit.any(axis=1)).tolist():
                p, near = a[row], b[hit[row]]
                if recount is not None:
                    near = near[label[near] != label[p]]
                    near = near[recount(p, near)]
                # one link to each component that is near; what is joined already needs none
                for other in np.unique(label[near]).tolist():
                    if other != label[p]:
                        out.append((int(ids[p]), int(ids[near[(label[near] == other).argmax()]])))
                        label[label == other] = label[p]
    return out


def links(nodes: DataFrame, radius: int = 3, meetings: int = 0, least: tuple[int, int] | None = None, sets=None) -> DataFrame:
    """A spanning forest (a, b) of the links between the nodes (id, fp, meet): fingerprints within the radius.

    Without meetings, all links: nodes meet where a block of bits is equal, fp must be distinct. With them, the
    links of nodes that share one of their rarest shingles: blocks of bits no longer part anything at a wide
    radius. Edges join what links join; they are links themselves.

    least: a fraction (num, den); links must also have that Jaccard similarity, recounted on sets. Nodes then have
    a size, and sets makes a table (id, shingles) for a table of ids: only nodes that meet another need them. Of
    buckets that hold the same nodes one is compared, for the sets are carried to every bucket.
    """
    blocks = radius + 1
    width = -(-BITS // blocks)
    bits = F.array(*(F.expr(f"shiftrightunsigned(fp, {i * width})").bitwiseAND((1 << width) - 1 if width < 63 else -1) for i in range(blocks)))
    keyed = nodes.select("id", "fp", *(["size"] if least else []), F.posexplode(F.col("meet") if meetings else bits).alias("block", "value"))
    # Parts: 1 for nearly every bucket. Their number comes from a count per bucket, combined before the shuffle.
    rows = F.count(F.lit(1))
    parts = F.greatest(F.ceil(rows / SPLIT_SETS), F.ceil(F.sum("size") / SPLIT_SHINGLES)) if least else F.ceil(rows / SPLIT)
    alike = [F.bit_xor(F.xxhash64("id", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)] if least else []
    counts = keyed.groupBy("block", "value").agg(rows.alias("n"), parts.cast("int").alias("parts"), *alike).where("n > 1")
    if least:
        # Buckets of the same nodes (as many, with the same 128 bits of hashes) would only be compared again: one stays.
        counts = counts.groupBy("n", "parts", "x1", "x2").agg(F.min(F.struct("block", "value")).alias("b")).select("b.*", "parts")
    keyed = keyed.join(counts, ["block", "value"]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int"))
    # A part meets every part of its bucket: the task (low, high) holds the rows of both.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    units = keyed.withColumn("with", other).select("block", "value", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "part", "id", "fp")
    unit = ["block", "value", "low", "high"]
    carried = [*unit, "part", "id", "fp"]
    if least:
        units = materialize(units, "units")
        units = units.join(sets(units.select("id").distinct()).hint("merge"), "id").select(*carried, "shingles")
        carried = [*carried, "shingles"]

    def run(stream) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held = None

        def compare(rows):
            """All complete units of the rows; small ones by shifted comparison of the whole array at once."""
            keys = np.stack([rows[c] for c in unit])
            start = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            size = np.diff(np.append(start, keys.shape[1]))
            of = np.repeat(np.arange(len(start)), size)
            fps, ids, out, root = rows["fp"].view(np.uint64), rows["id"], [], {}

            def find(x: int) -> int:
                while x in root:
                    x = root[x]
                return x

            small = np.repeat(size <= 32, size)
            for shift in range(1, int(size[size <= 32].max(initial=1))):
                same = (of[shift:] == of[:-shift]) & small[shift:]
                hit = np.flatnonzero(same & (np.bitwise_count(fps[shift:] ^ fps[:-shift]) <= radius))
                for p, q in zip(hit.tolist(), (hit + shift).tolist(), strict=True):
                    p0, q0 = find(p), find(q)
                    if p0 != q0 and (not least or Recount([rows["shingles"][p], rows["shingles"][q]], *least)(0, np.array([1]))[0]):
                        root[max(p0, q0)] = min(p0, q0)
                        out.append((int(ids[p]), int(ids[q])))
            for u in np.flatnonzero(size > 32).tolist():
                s = slice(start[u], start[u] + size[u])
                two = rows["low"][s.start] != rows["high"][s.start]
                cut = int((rows["part"][s] == rows["low"][s.start]).sum()) if two else 0
                if not two or 0 < cut < size[u]:
                    out += forest(fps[s], ids[s], radius, cut, Recount(rows["shingles"][s], *least) if least else None)
            return out

        for batch in stream:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in carried}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            n = len(rows["fp"])
            if not n:
                continue
            keys = np.stack([rows[c] for c in unit])
            cut = int((keys == keys[:, -1:]).all(axis=0).argmax())
            held = {c: v[cut:] for c, v in rows.items()}
            if cut:
                out = compare({c: v[:cut] for c, v in rows.items()})
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])
        if held is not None:
            out = compare(held)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return units.repartition(*unit).sortWithinPartitions(*unit, "part").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text", meetings: int = 0) -> DataFrame:
    """(key, fingerprint, component_id) of every document.

    meetings: 0 for all links within the radius; for wide radii the number of rarest shingles, of which linked
    texts must share one (texts of Jaccard similarity J miss each other with a chance of (1 - J) ** meetings).

    fingerprint: 16 hexadecimal digits; component_id: the smallest key reachable by links, its own included.
    Null, empty and wordless texts have fingerprint zero and link like any other. Equal texts share a
    fingerprint; each distinct fingerprint is compared once. A null key stays null and is never a component's
    id unless all keys with that fingerprint are null, and then it has no links. Rows that repeat give equal
    rows; an empty table gives none; other columns are left out.
    """
    prints = materialize(fingerprints(docs, width, key, text, meetings), "prints")
    nodes = materialize(prints.groupBy("fp", "meet").agg(F.min(key).alias("id")), "nodes")
    found = components(links(nodes.where("id is not null"), radius, meetings))
    named = nodes.join(found.withColumnRenamed("node", "id"), "id", "left").select("fp", "meet", F.coalesce("component", "id").alias("component_id"))
    return prints.join(named, ["fp", "meet"]).select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _similar(docs: DataFrame, width: int, radius: int, meetings: int, least: tuple[int, int], key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the digest of their shingle set, sets with their least row and component)."""
    own = docs.select(*row_keys(key, text), F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    prints = materialize(shingle_sets(own, width, meetings).drop("shingles"), "prints")
    lo = F.struct("nul", "k", "v")
    nodes = materialize(prints.groupBy("d1", "d2").agg(F.min(lo).alias("lo"), F.first("fp").alias("fp"), F.first("meet").alias("meet"), F.first("size").alias("size")), "nodes")
    # A node's number is its digest: two sets may have one key.
    nodes = nodes.select(F.col("d1").alias("id"), "d2", "lo", "fp", "meet", "size")

    def sets(ids: DataFrame) -> DataFrame:
        wanted = nodes.join(ids, "id", "left_semi").select(F.col("id").alias("node"), "lo.*")
        texts = own.dropDuplicates(["nul", "k", "v"]).join(wanted.hint("merge"), ["nul", "k", "v"]).select("node", "text")
        return shingle_sets(texts, width, 0).select(F.col("node").alias("id"), "shingles")

    found = components(links(nodes, radius, meetings, least, sets))
    named = nodes.join(found.withColumnRenamed("node", "id"), "id", "left").select("d2", F.col("id").alias("d1"), "lo", F.coalesce("component", "id").alias("c"))
    return prints, named


def row_keys(key: str, text: str) -> list:
    """nul, k and v: whether the key is null, the key, and the hash of the text; they sort null keys last and tell rows of one key apart."""
    return [F.col(key).isNull().alias("nul"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("k"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("v")]


def similar(docs: DataFrame, width: int, radius: int, meetings: int, least: tuple[int, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id) of every document whose set of word shingles is as similar as least to another's.

    Links are pairs of Jaccard similarity num / den or more, recounted on the sets' 64-bit shingle hashes.
    Proposed are the pairs that share one of `meetings` minhashes and whose fingerprints differ in at most
    radius bits; equal sets always link. component_id: the smallest key reachable by links, null if all keys of
    the group are. Texts without words have equal sets. Repeated rows give equal rows, an empty table none.
    Runs Spark jobs when called.
    """
    prints, named = _similar(docs, width, radius, meetings, least, key, text)
    heads = named.groupBy("c").agg(F.min("lo").alias("head"))
    named = named.join(heads, "c").select("d1", "d2", F.when(~F.col("head.nul"), F.col("head.k")).alias("component_id"))
    return prints.join(named, ["d1", "d2"]).select(F.col("id").alias(key), "component_id")


def representatives(docs: DataFrame, width: int, radius: int, meetings: int, least: tuple[int, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(nul, k, v), as `row_keys` makes them, of one row of each group that `similar` finds: the least key's, null keys last."""
    _, named = _similar(docs, width, radius, meetings, least, key, text)
    return named.groupBy("c").agg(F.min("lo").alias("head")).select("head.*")
