"""Benchmark passages in documents: a prefix-filtered join with exact verification.

Words are runs of characters other than ASCII ones that are no letter or digit, A-Z
in lower case.  An item's windows are its runs of ``WINDOW`` words, or the whole item
if it is shorter.  A window occurs where all its words stand one after another.

A window contained in a document has all its shingles (``SHINGLE`` words, or the whole
window if shorter) there, so one shared token suffices as the join's prefix: the
window's shingle that is rarest over all documents.

1. A bitmap of fixed size holds the hashes of all windows' shingles.  One pass over the
   texts keeps, per document, the runs of neighbouring positions whose shingle is in
   the bitmap, if they are long enough for a window (length bound).  They are written.
2. Shingles are counted over these runs; each window keeps its rarest as its prefix.
3. Positions with a prefix shingle are joined with the windows, the window has to fit
   into the run there (positional bound), and all its words are compared.  A position
   carries the words that a window there can reach and no more.

The join is salted, so a passage that a third of all documents share is dealt over
``SALTS`` tasks.  The driver gets the bitmap (128 KB) and at most three rows of lengths.

On a local or mounted file system an executor starts a process for every file it writes
(Hadoop's ``chmod``), so no table here has more files than it needs: windows and prefixes
``FILES`` at most, the result of ``contamination`` as many as its documents were written in.

Null texts and texts without words have no words and are clean.  Items without words
have no windows.  Repeated documents are judged each; repeated items count once.  An
item whose id is null marks words but is not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.storage import written

WINDOW = 13
SHINGLE = 3
SALTS = 16
FILES = 32
BITS = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """Each different window once: its words joined by spaces, their number, the shingle length, its items."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), words(text).alias("words"))
    size = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(size - (WINDOW - 1), F.lit(1)))
    each = items.filter(size > 0).select("item", "words", F.explode(starts).alias("start"))
    cut = each.select("item", F.array_join(F.slice("words", F.col("start"), F.lit(WINDOW)), " ").alias("window"))
    length = F.size(F.split("window", " "))
    return cut.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        "window", "items", length.alias("length"), F.least(length, F.lit(SHINGLE)).alias("k")
    )


def shingle_hash(array: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*(F.get(array, i + j) for j in range(k)))


def positions(size: Column, k: int) -> Column:
    """0 to size - k, or nothing."""
    return F.when(size >= k, F.sequence(F.lit(0), size - k)).otherwise(F.array().cast("array<int>"))


def shingles(words_: Column, k: int) -> Column:
    return F.transform(
        positions(F.size(words_), k),
        lambda i: F.struct(i.alias("at"), F.array_join(F.slice(words_, i + 1, F.lit(k)), " ").alias("shingle")),
    )


def bitmap(hashes: DataFrame) -> Column:
    """A literal of 2 ** BITS bits in longs, set for the column ``h`` of ``hashes``."""
    bit = F.col("h").bitwiseAND(F.lit((1 << BITS) - 1))
    cells = hashes.groupBy(F.shiftright(bit, 6).alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("bits")
    )
    filled = [0] * (1 << (BITS - 6))
    for row in cells.collect():  # at most as many rows as the bitmap has cells
        filled[row["cell"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, filled))), ",").cast("array<bigint>")


def in_bitmap(bits: Column, h: Column) -> Column:
    cell = F.get(bits, F.shiftright(h.bitwiseAND(F.lit((1 << BITS) - 1)), 6).cast("int"))
    # a shift takes its distance modulo 64
    return F.call_function("getbit", cell, h.bitwiseAND(F.lit(63)).cast("int")) == 1


def marked_positions(k: int, bits: Column) -> Column:
    """Positions of ``words`` whose shingle of ``k`` words is in the bitmap."""
    array = F.col("words")
    return F.filter(positions(F.size(array), k), lambda i: in_bitmap(bits, shingle_hash(array, i, k)))


def runs(words_: Column, hits: Column, k: int, least: int) -> Column:
    """Runs of neighbouring hits that cover at least ``least`` words: shingle length, first position, words."""
    first = F.filter(hits, lambda x, j: (j == 0) | (F.get(hits, j - 1) != x - 1))
    last = F.filter(hits, lambda x, j: (j == F.size(hits) - 1) | (F.get(hits, j + 1) != x + 1))
    spans = F.zip_with(first, last, lambda a, b: F.struct(a.alias("a"), (b - a + k).alias("n")))
    return F.transform(
        F.filter(spans, lambda s: s["n"] >= least),
        lambda s: F.struct(
            F.lit(k).alias("k"), s["a"].alias("start"), F.slice(words_, s["a"] + 1, s["n"]).alias("words")
        ),
    )


#: Names of columns that come and go here; a document's columns of these names are not kept.
OWN = ("row", "key", "words", "n_words", "runs", "hits1", "hits2", "hits3", "n_hit", "items", "contaminated")
RUNS = "array<struct<k:int,start:int,words:array<string>>>"


def occurrences(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """Documents (``row``, all columns but ``text``, ``key``, ``n_words``), and where windows occur in them (``row``, ``a``, ``b``, ``items``)."""
    wanted = written(windows(benchmark, item, item_text), "windows", files=FILES)
    lengths = {r["k"]: r["least"] for r in wanted.groupBy("k").agg(F.min("length").alias("least")).collect()}
    split = wanted.withColumn("words", F.split("window", " "))

    marks = {}
    for k in lengths:
        own = split.filter(F.col("k") == k)
        at = F.explode(positions(F.size("words"), k)).alias("i")
        marks[k] = bitmap(own.select("words", at).select(shingle_hash(F.col("words"), F.col("i"), k).alias("h")))

    read = docs.select(
        F.monotonically_increasing_id().alias("row"),
        *(c for c in docs.columns if c not in (text, *OWN)),
        F.md5(F.col(text).cast("binary")).alias("key"),
        words(text).alias("words"),
    )
    size = F.size("words")
    for k, bits in marks.items():
        read = read.withColumn(f"hits{k}", marked_positions(k, bits))
    found = [runs(F.col("words"), F.col(f"hits{k}"), k, lengths[k]) for k in lengths]
    kept = read.withColumns({"n_words": size.cast("long"), "runs": F.concat(*found) if found else F.array().cast(RUNS)})
    marked = written(kept.drop("words", *(f"hits{k}" for k in lengths)), "marked")

    inside = marked.select("row", F.explode("runs").alias("run")).select("row", "run.*")
    parts = [_verified(inside.filter(F.col("k") == k), split.filter(F.col("k") == k), k) for k in lengths]
    spans = parts[0] if parts else inside.select("row", F.lit(0).alias("a"), F.lit(0).alias("b"), F.array().cast("array<string>").alias("items"))
    for part in parts[1:]:
        spans = spans.unionAll(part)
    return marked.drop("runs"), spans


def _verified(inside: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Occurrences of windows with shingles of ``k`` words."""
    counts = (
        inside.select(F.explode(shingles(F.col("words"), k)).alias("s"))
        .groupBy(F.col("s.shingle").alias("shingle")).agg(F.count(F.lit(1)).alias("rows"))
    )
    of_windows = wanted.select("window", F.explode(shingles(F.col("words"), k)).alias("s")).select("window", "s.*")
    # a window one of whose shingles no document has occurs nowhere: it has no rarest shingle
    ranked = of_windows.join(counts, "shingle", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "shingle", "at")).alias("rarest")
    )
    prefix = written(
        ranked.filter(F.col("rarest.rows") > 0)
        .select("window", F.col("rarest.shingle").alias("shingle"), F.col("rarest.at").alias("offset"))
        .join(wanted.select("window", "items", "length"), "window"),
        "prefix",
        files=FILES,
    )
    bits = bitmap(prefix.select(F.split("shingle", " ").alias("w")).select(shingle_hash(F.col("w"), F.lit(0), k).alias("h")))
    salted = prefix.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    reach = WINDOW - 1
    at = F.transform(
        marked_positions(k, bits),
        lambda i: F.struct(
            i.alias("at"), F.greatest(i - reach, F.lit(0)).alias("low"),
            F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("near"),
        ),
    )
    candidates = inside.select("row", "start", F.size("words").alias("size"), F.explode(at).alias("p")).select(
        "row", "start", "size", "p.*",
        F.pmod(F.col("row"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    candidates = candidates.withColumn(
        "shingle", F.array_join(F.slice("near", F.col("at") - F.col("low") + 1, F.lit(k)), " ")
    )
    first = F.col("at") - F.col("offset")
    fits = (first >= 0) & (first + F.col("length") <= F.col("size"))
    here = F.array_join(F.slice("near", F.greatest(first - F.col("low"), F.lit(0)) + 1, F.col("length")), " ")
    return (
        candidates.join(salted, ["shingle", "salt"])
        .filter(fits & (here == F.col("window")))
        .select("row", (F.col("start") + first).alias("a"), (F.col("start") + first + F.col("length")).alias("b"), "items")
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """All columns but the text, ``key`` (MD5 of the text), ``n_words``, ``n_hit``, ``items`` (sorted) and ``contaminated``."""
    marked, spans = occurrences(docs, benchmark, text, item, item_text)
    by_row = spans.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    covered = F.aggregate(
        "spans", start,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["b"] - F.greatest(x["a"], s["to"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(s["to"], x["b"]).alias("to"),
        ),
        lambda s: s["n"],
    )
    hit = by_row.select("row", covered.alias("n_hit"), "items")
    # a row for each of the documents, in as many parts as they were written in
    joined = marked.join(hit, "row", "left").drop("row").coalesce(max(1, len(marked.inputFiles())))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.withColumns({
        "n_hit": n_hit,
        "items": F.coalesce("items", F.array().cast("array<string>")),
        "contaminated": (n_hit > 0) & (20 * n_hit >= F.col("n_words")),
    })


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, columns as they were."""
    bad = contamination(docs.select(text), benchmark, text).filter("contaminated").select(F.col("key").alias("bad_text_key_")).distinct()
    return docs.join(bad, F.md5(F.col(text).cast("binary")) == F.col("bad_text_key_"), "left_anti")
