"""Line dedup by content-defined chunks: multi-line passages that repeat anywhere are kept once.

Only DataFrame functions run here. A rolling hash over the hashes of neighbouring lines decides, from these
lines alone, where a chunk ends, so chunks fall alike wherever a passage is moved. Divisors nest: coarser
chunks are unions of finer ones and cover what the finest leaves as single lines. Chunks meet by hash; the
texts of those that do are compared byte by byte. With `runs`, every two neighbouring lines are a chunk as well,
so a repeated run of lines goes whole wherever the cuts fall. Joins are sort-merge joins at every size: either side may be large, and AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, materialize, release

#: A chunk ends after a line whose rolling hash is a multiple of the divisor.
DIVISORS = (2, 4, 8)
#: Chunks of fewer characters than this are too common to be passages.
LEAST_CHARS = 80


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _cuts(divisor: int) -> Column:
    """Indexes of the lines that start a chunk, and the number of lines."""
    n = F.size("_lines")
    return F.filter(F.sequence(F.lit(0), n), lambda i: (i == 0) | (i == n) | (F.pmod(F.get("_r", i - 1), F.lit(divisor)) == 0))


def _spans(cuts: str) -> Column:
    """(s, n) of the chunks between cuts that have two lines or more."""
    spans = F.transform(F.slice(cuts, F.lit(1), F.size(cuts) - 1), lambda s, j: F.struct(s.alias("s"), (F.get(cuts, j + 1) - s).alias("n")))
    return F.filter(spans, lambda c: c["n"] >= 2)


def chunked(docs: DataFrame, key: str, text: str, divisors: tuple, least_chars: int) -> DataFrame:
    """docs with chunks: an array of (s, n), the first line's index and the number of lines, n at least 2."""
    out = docs.withColumn("_lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    out = out.withColumn("_h", F.transform("_lines", _line_hash))
    out = out.withColumn("_r", F.transform("_h", lambda h, i: F.pmod(F.coalesce(F.get("_h", i - 1), F.lit(0)) * 31 + h, F.lit(2**32))))
    out = out.withColumn("_ends", F.transform("_lines", lambda x, i: F.length(x).cast("long")))
    found = []
    for d in divisors:
        out = out.withColumn(f"_c{d}", _cuts(d))
        found.append(_spans(f"_c{d}"))
    chars = lambda c: F.aggregate(F.slice("_ends", c["s"] + 1, c["n"]), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn("_chunks", F.filter(F.array_distinct(F.concat(*found)), lambda c: chars(c) + c["n"] - 1 >= least_chars))


def _chunk_text(c) -> Column:
    return F.array_join(F.slice("_lines", c["s"] + 1, c["n"]), "\n")


def _long_runs(spans: str, lines: Column, least_chars: int) -> Column:
    """Overlapping spans (s, n) of lines united, without those of fewer characters; null if none is left."""
    # Sorted by s: a span begins a run if it starts where all before it have ended, and ends one if the next begins one.
    spans = F.array_sort(spans)
    reach = F.aggregate(spans, F.struct(F.array().cast("array<struct<s:int,n:int>>").alias("runs"), F.lit(0).alias("s"), F.lit(0).alias("e")), lambda a, g: F.when(g["s"] < a["e"], F.struct(a["runs"].alias("runs"), a["s"].alias("s"), F.greatest(a["e"], g["s"] + g["n"]).alias("e"))).otherwise(F.struct(F.concat(a["runs"], F.array(F.struct(a["s"].alias("s"), (a["e"] - a["s"]).alias("n")))).alias("runs"), g["s"].alias("s"), (g["s"] + g["n"]).alias("e"))), lambda a: F.concat(a["runs"], F.array(F.struct(a["s"].alias("s"), (a["e"] - a["s"]).alias("n")))))
    chars = lambda c: F.aggregate(F.slice(lines, c["s"] + 1, c["n"]), F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    long = F.filter(reach, lambda c: (c["n"] > 0) & (chars(c) + c["n"] - 1 >= least_chars))
    return F.when(F.size(long) > 0, long)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", divisors: tuple = DIVISORS, least_chars: int = LEAST_CHARS, runs: bool = False) -> DataFrame:
    """docs with text replaced, plus _n_lines and _n_removed; where docs has such columns, these stay and the new
    ones get further underscores (`fresh` tells the names). Other columns never matter, whatever their names.

    Of every multi-line chunk that occurs more than once, in one document or several, the occurrence with the
    least (key, line) stays and the lines of all others go. Lines are parted by line feeds; what remains is
    joined by them; a document may become empty, but no row goes. Null texts stay null and have no lines to
    lose; rows with a null key are left as they are and seen by no other; rows with one key and one text
    count as one occurrence and are cut alike, rows with one key and other texts as documents of their own.

    Runs Spark jobs when called: chunks that repeat are found in steps, each a table in the shared folder.

    runs: a run of lines also goes if every two neighbouring lines of it occur earlier and it has least_chars
    characters or more. Of every line that goes an earlier one with the same text stays.
    """
    ident = [F.col(key).alias("_k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_v")]
    own = docs.select(*ident, F.col(text).alias("_t")).where(F.col("_k").isNotNull() & F.col("_t").contains("\n"))
    parts = chunked(own, "_k", "_t", divisors, least_chars)
    if runs:
        pairs = F.transform(F.sequence(F.lit(0), F.size("_lines") - 2), lambda i: F.struct(i.alias("s"), F.lit(2).alias("n")))
        parts = parts.withColumn("_chunks", F.array_union("_chunks", pairs))
    # Which chunk hashes repeat: only keys and hashes are shuffled.
    marks = parts.select("_k", "_v", F.explode(F.transform("_chunks", lambda c: F.struct(c["s"].alias("s"), c["n"].alias("n"), F.xxhash64(_chunk_text(c)).alias("h")))).alias("c")).select("_k", "_v", "c.*")
    marks = materialize(marks, "marks")
    twice = marks.groupBy("h").agg(F.min(F.struct("_k", "_v", "s")).alias("lo"), F.max(F.struct("_k", "_v", "s")).alias("hi")).where("lo <> hi").select("h")
    wanted = marks.join(twice, "h", "left_semi").groupBy("_k", "_v").agg(F.collect_set(F.struct("s", "n")).alias("_want"))
    # Byte comparison: the texts of chunks whose hashes repeat, grouped by the text itself.
    held = own.join(wanted.hint("merge"), ["_k", "_v"]).withColumn("_lines", F.split("_t", "\n"))
    held = held.select("_k", "_v", F.explode(F.transform("_want", lambda c: F.struct(c["s"].alias("s"), c["n"].alias("n"), _chunk_text(c).alias("x")))).alias("c")).select("_k", "_v", "c.*")
    held = materialize(held, "held")
    first = held.groupBy("x").agg(F.min(F.struct("_k", "_v", "s")).alias("first"), F.max(F.struct("_k", "_v", "s")).alias("last")).where("first <> last").select("x", "first")
    first = materialize(first, "first")  # else the join below would reuse the aggregate's exchange, which cannot be split
    gone = held.join(first.hint("merge"), "x").where(F.struct("_k", "_v", "s") != F.col("first")).groupBy("_k", "_v").agg(F.collect_set(F.struct("s", "n")).alias("_gone"))
    gone = materialize(gone, "gone")
    release(marks, held, first)
    k, v, cut, n_lines, n_removed = fresh(docs, "_k", "_v", "_gone", "_n_lines", "_n_removed")
    gone = gone.withColumnsRenamed({"_k": k, "_v": v, "_gone": cut})
    out = docs.withColumns({k: ident[0], v: ident[1]}).join(gone.hint("merge"), [k, v], "left")
    lines = F.split(text, "\n")
    if runs:
        out = out.withColumn(cut, _long_runs(cut, lines, least_chars))
    n = F.when(F.col(text).isNull(), 0).otherwise(F.coalesce(F.size(lines), F.lit(0)))
    # Places that stay, by a set difference: linear in the lines, however many spans go.
    lost = F.flatten(F.transform(cut, lambda g: F.sequence(g["s"], g["s"] + g["n"] - 1)))
    stay = F.when(F.col(cut).isNotNull(), F.array_except(F.sequence(F.lit(0), n - 1), lost))
    out = out.withColumn(n_lines, n).withColumn(cut, stay).withColumn(n_removed, F.when(F.col(cut).isNull(), 0).otherwise(n - F.size(cut)))
    joined = F.transform(F.array(lines), lambda all_: F.array_join(F.transform(cut, lambda i: F.get(all_, i)), "\n"))
    return out.withColumn(text, F.when(F.col(cut).isNull(), F.col(text)).otherwise(F.get(joined, F.lit(0)))).drop(k, v, cut)


def line_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the digest of the text that stays."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_removed").cast("long").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
u AS (SELECT doc_id, len(l) AS n, unnest(range(len(l))) AS i, unnest(l) AS line FROM d),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM u),
r AS (SELECT *, (coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * 31 + h) % 4294967296 AS r FROM h),
c AS (SELECT doc_id, i, line, n, d, CASE WHEN i = 0 OR lag(r) OVER (PARTITION BY doc_id, d ORDER BY i) % d = 0 THEN i END AS cut
  FROM r, (VALUES (2), (4), (8)) v(d)),
g AS (SELECT *, max(cut) OVER (PARTITION BY doc_id, d ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM c),
k AS (SELECT doc_id, d, s, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS x FROM g GROUP BY ALL),
o AS (SELECT DISTINCT doc_id, s, n, x FROM k WHERE n >= 2 AND length(x) >= 80),
f AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS k FROM o),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS i FROM f WHERE k > 1)
SELECT u.doc_id, CASE WHEN any_value(d.text) IS NULL THEN 0 ELSE count(*) END AS n_lines, count(gone.i) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY u.i) FILTER (gone.i IS NULL), '')) AS kept_sha256
FROM u JOIN d USING (doc_id) LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.i = u.i GROUP BY u.doc_id"""
