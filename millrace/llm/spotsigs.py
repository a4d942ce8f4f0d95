"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

A text's signatures are the chains "anchor, next content word, next but one". The set of their hashes is the
fingerprint; two fingerprints are compared by Jaccard similarity, cut short when their lengths, or what is
left of them, can no longer reach what is asked for. `compare_documents` holds each text against its edited text
and its next document; `near_groups` joins all fingerprints, parted by the lengths of their sets.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batches

#: Common function words of English, French, German and Spanish.
ANCHORS = frozenset(
    "the of and to in is it that was for on are as with his they at be this have from or by not but what all were we when your can said there an a he "
    "le la les de des du et un une en que qui dans pour par sur au aux avec est il elle ne pas plus son sa ses "
    "der die das den dem ein eine und zu von mit sich auf für ist im nicht als auch es an er sie "
    "el los las del y unos una no se por con para su al lo como más o pero sus".split()
)
WORDS = re.compile(r"\w+")
#: Content words in a chain.
CHAIN = 2
#: Rows of one bucket of neighbouring keys, about, and buckets at most: a bucket is streamed, so beyond that many rows
#: buckets only take longer.
BUCKET_ROWS, BUCKETS = 2_000, 10_000
#: Sets of one (length partition, signature) that a single task compares; above it they are dealt out as pairs of parts.
SPLIT = 2_000

SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures long"


def signatures(text: str, chain: int = CHAIN) -> frozenset:
    """The 32-bit hashes of a text's chains. A text without any has its words instead, or else itself."""
    import xxhash

    anchors, content, words = [], [], WORDS.findall(text.lower())
    for w in words:
        if w in ANCHORS:
            anchors.append((w, len(content)))
        else:
            content.append(w)
    h, last = xxhash.xxh32_intdigest, len(content) - chain
    found = frozenset([h(" ".join((a, *content[k : k + chain]))) for a, k in anchors if k <= last])
    return found or frozenset(map(h, words or ([text] if text else ())))


def spell(found: frozenset) -> str:
    """A fingerprint as text: the sorted hashes, eight hexadecimal digits each."""
    return "".join(f"{x:08x}" for x in sorted(found))


def likeness(a: frozenset, b: frozenset, least: float = 0.0) -> float:
    """Jaccard similarity; 0.0 as soon as the lengths show that it is below `least`. Two empty sets are alike."""
    a, b = sorted((a, b), key=len)
    if not b:
        return 1.0
    if len(a) < least * len(b):
        return 0.0
    if not least:
        both = len(a & b)
    else:
        need, both = least / (1 + least) * (len(a) + len(b)) - 1e-9, 0
        for seen, x in enumerate(a):
            if both + len(a) - seen < need:
                return 0.0
            both += x in b
    return both / (len(a) + len(b) - both)


def _search(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are <= value, in two steps over literal arrays."""
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not bounds:
        return F.lit(0)
    heads = F.array(*(F.lit(b[0]) for b in blocks))
    block = F.size(F.filter(heads, lambda x: x <= value))
    inner = F.get(F.array(*(F.array(*(F.lit(x) for x in b)) for b in blocks)), block - 1)
    return F.when(block == 0, 0).otherwise((block - 1) * step + F.size(F.filter(inner, lambda x: x <= value))).cast("int")


def neighbours(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(bucket, halo, k, h, doc_id, text) so that sorted by bucket, halo, k descending and h each row precedes its next document.

    Buckets are ranges of keys from approximate quantiles over all rows; a key that fills several of them is parted
    by its texts' hashes, so that rows of one key, or null keys, spread out too. The first row of each bucket is
    also sent, as halo, to the bucket before it; the very first to the last one.
    """
    spark = docs.sparkSession
    low = -(2**63)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(F.col(key).cast("long"), F.lit(low)).alias("k"), F.xxhash64(F.col(text).cast("string")).alias("h"))
    n = rows.count()
    parts = max(1, min(BUCKETS, n // BUCKET_ROWS))
    found = Counter(int(x) for x in rows.approxQuantile("k", [i / parts for i in range(1, parts)], 0.2 / parts)) if parts > 1 else {}
    hot = {k: times for k, times in found.items() if times > 1}
    piece = F.lit(0)
    if hot:
        times = F.element_at(F.create_map(*(F.lit(x) for pair in sorted(hot.items()) for x in pair)), F.col("k"))
        piece = F.coalesce(F.least(F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * times), times - 1) + 1, F.lit(0)).cast("int")
    # Buckets count up along the order: descending keys, and within a hot key its pieces.
    placed = rows.withColumn("bucket", F.struct((-_search(F.col("k"), sorted(found))).alias("range"), piece.alias("piece")))
    # One row per bucket: 10,000 at most.
    tops = _tops(placed)
    halo = [(k, h, *tops[i - 1][0]) for i, (_, k, h) in enumerate(tops)]
    halo = F.broadcast(spark.createDataFrame(halo, "k long, h long, range int, piece int"))
    first = placed.drop("bucket").join(halo, ["k", "h"]).withColumn("bucket", F.struct("range", "piece")).dropDuplicates(["bucket"])
    columns = ["bucket", "halo", "k", "h", "doc_id", "text"]
    return placed.withColumn("halo", F.lit(0)).select(columns).unionByName(first.withColumn("halo", F.lit(1)).select(columns))


def _tops(placed: DataFrame) -> list:
    """(bucket, k, h) of every bucket's first row, in the order of the buckets."""
    first = F.max(F.struct("k", (-F.col("h").cast("decimal(20,0)")).alias("h"))).alias("top")
    return sorted((tuple(x["bucket"]), x["top"]["k"], int(-x["top"]["h"])) for x in placed.groupBy("bucket").agg(first).collect())


def compare_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its length, its fingerprint and those of its edited text and its next document, compared.

    The next document has the next smaller key, after the last comes the first; rows with one key follow each
    other in the order of their texts' hashes; null keys come last. Counts keys in Spark jobs when called. The edited text has its last half's code points
    replaced by the first as many of the next document's. Null texts count as empty; an empty text has an
    empty fingerprint, and two empty ones have a likeness of 1. A single document is its own next. An empty
    table gives no rows.
    """
    rows = neighbours(docs, key, text)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "halo", F.desc("k"), "h")
    rows = rows.select(F.concat_ws(":", "bucket.range", "bucket.piece").alias("bucket"), "halo", "doc_id", "text")

    def run(stream) -> Iterator:
        import pyarrow as pa

        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_signatures"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        held = None
        for batch in batches(stream, 512, 4_000_000):
            out = []
            for bucket, halo, doc_id, t in zip(*(batch.column(c).to_pylist() for c in ("bucket", "halo", "doc_id", "text")), strict=True):
                t = t or ""
                own = signatures(t)
                if held is not None and held[0] == bucket and not held[1]:
                    before, mine = held[3], held[4]
                    half = len(before) // 2
                    edited = before[: len(before) - half] + t[:half]
                    new = signatures(edited)
                    out.append((held[2], len(before), hashlib.sha256(edited.encode()).hexdigest(), spell(mine), spell(new), likeness(mine, new), likeness(mine, own), len(mine)))
                held = (bucket, halo, doc_id, t, own)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True) if out else [[]] * 8, types, strict=True)], names)

    return rows.mapInArrow(run, SCHEMA)


def near_groups(docs: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, group_id): group_id is the smallest key reachable over pairs of fingerprints with a Jaccard similarity of `least`.

    Exact. Equal fingerprints count once. Sets meet if their length partitions touch and they share one of their
    rarest signatures, of which each set has so many that similar sets must share one (prefix filtering). Where
    sets meet, they are compared in the order of their lengths: the scan stops at the first that is too long, and
    sets that are joined already are left out. A signature that many sets share is dealt to several tasks as pairs
    of parts. Only a spanning forest of the links is returned, so a group's pairs are never written out. Null keys
    get no group; empty texts form one group. Runs Spark jobs when called.
    """
    from millrace.llm.common import components, materialize
    from millrace.llm.simhash import Recount

    def sets(stream) -> Iterator:
        import pyarrow as pa

        for batch in batches(stream, 1024, 4_000_000, text):
            found = [sorted(signatures(t or "")) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.list_(pa.int64()))], [key, "sigs"])

    own = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).where(F.col(key).isNotNull())
    every = materialize(own.mapInArrow(sets, f"{key} long, sigs array<long>"), "sets")
    nodes = materialize(every.groupBy("sigs").agg(F.min(key).alias("id")), "nodes")
    flat = nodes.select("id", F.explode("sigs").alias("sig"))
    rarity = materialize(flat.groupBy("sig").agg(F.count(F.lit(1)).alias("df")), "rarity")
    ranked = flat.join(rarity.hint("merge"), "sig").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("ranked"))
    n = F.size("ranked")
    kept = F.slice("ranked", F.lit(1), (n - F.ceil(F.round(n * F.lit(least), 6)) + 1).cast("int"))
    met = ranked.select("id", F.explode(F.transform(F.filter(kept, lambda x: x["df"] > 1), lambda x: x["sig"])).alias("sig"))
    part = F.floor(F.log(F.size("sigs")) / F.lit(-math.log(least)))
    sizes = nodes.select("id", F.explode(F.array(part, part + 1)).alias("part"), F.size("sigs").alias("n"))
    keyed = met.join(sizes.hint("merge"), "id")
    # Parts: 1 for nearly every (length partition, signature); pairs of parts share the work of the others.
    counts = keyed.groupBy("part", "sig").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("part", "sig", F.ceil(F.col("rows") / SPLIT).cast("int").alias("pieces"))
    keyed = keyed.join(counts, ["part", "sig"]).withColumn("piece", F.pmod(F.xxhash64("id", F.lit(7)), F.col("pieces")).cast("int"))
    keyed = keyed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    unit = ["part", "sig", "low", "high"]
    keyed = keyed.select("part", "sig", F.least("piece", "with").alias("low"), F.greatest("piece", "with").alias("high"), "piece", "id", "n")
    units = materialize(keyed, "units").join(nodes.hint("merge"), "id").select(*unit, "piece", "id", "n", "sigs")
    share = Fraction(least).limit_denominator(1000)

    def link(stream) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: list = []

        def compare(rows: list) -> list:
            """Links that join what the pairs of a unit join; of two different parts only across them. Rows come by length."""
            two, out = rows[0][2] != rows[0][3], []
            sides = np.array([r[4] for r in rows])
            lens = np.array([r[6] for r in rows], np.int64)
            label = np.arange(len(rows))
            alike = Recount([np.array(r[7], np.uint64).tobytes() for r in rows], share.numerator, share.denominator)
            for i in range(len(rows) - 1):
                # lengths only grow: the scan ends where a set is too long for this one
                to = int(np.searchsorted(lens, lens[i] * share.denominator // share.numerator, side="right"))
                near = np.arange(i + 1, to)
                near = near[(label[near] != label[i]) & ((sides[near] != sides[i]) if two else True)]
                near = near[alike(i, near)] if len(near) else near
                for other in np.unique(label[near]).tolist():
                    out.append((rows[i][5], rows[int(near[(label[near] == other).argmax()])][5]))
                    label[label == other] = label[i]
            return out

        for batch in stream:
            out: list = []
            for row in zip(*(batch.column(c).to_pylist() for c in (*unit, "piece", "id", "n", "sigs")), strict=True):
                if held and row[:4] != held[-1][:4]:
                    out += compare(held)
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["a", "b"])
        if held:
            out = compare(held)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["a", "b"])

    found = components(units.repartition(*unit).sortWithinPartitions(*unit, "n", "id").mapInArrow(link, "a long, b long"))
    named = nodes.join(found.withColumnRenamed("node", "id"), "id", "left").select("sigs", F.coalesce("component", "id").alias("group_id"))
    return every.join(named, "sigs").select(key, "group_id")
