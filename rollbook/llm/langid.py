"""Language identification with interpolated Kneser-Ney character models.

A text's words are its runs of letters in lower case; a word's symbols are its letters
and its end, each predicted from the three symbols before it in the word.  Characters
are classes of 16 bits, the code point itself up to U+FFFF; letters beyond (historic
scripts, rare Han) share the classes that no letter has.  So four symbols pack into one
long, the gram's hash.  Grams of all training words are counted over all training rows
in Spark; lower orders count distinct continuations, as Kneser and Ney have it.

The model keeps, per order, written tables of all languages' grams with their
log-probabilities, and of contexts with what they leave to the next lower order.
Discounts, totals and kinds are counted in Spark over all grams; nothing is cut off and
the tables are never collected.  The different grams of the texts to judge meet them in
joins; executors hold the most frequent grams' scores, the other grams' are joined.

Texts are read twice by ``judged``: once to count the grams of all of them, training rows by
their language, and once for the sums, from which training rows set the limits and all get their language.

A text gets the language of lowest cross-entropy per symbol.  Its score is a softmax of
these entropies times the root of the number of symbols, with a temperature fitted on
all training rows.  ``rejected`` marks texts without letters (``und``, score 0), texts
whose entropy is ``SLACK`` times that of nearly all training rows of the language, and
texts whose score is below theirs.

Null and empty texts are ``und``.  Without training rows every text is.  Ties go to the
language first by name.  Repeated rows count as often as they stand there.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache, reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.arrowtext import release, slices, texts
from rollbook.llm.storage import written

ORDER = 4
CLASS_BITS = 16
#: Scores that an executor holds at most, over all languages, in 32 bits; the other grams' scores are joined.
CELLS = 8_000_000
#: Log-probabilities are added as whole numbers of this unit's inverse.
UNIT = 1 << 20
#: Quantiles of all training rows are right to this part of their number.
ACCURACY = 100_000
#: Words that a task counts or scores at once, and their characters.
REMEMBERED, REMEMBERED_CHARACTERS = 200_000, 8_000_000
#: Words whose grams are worked out at once.
PART = 20_000
#: A rejected text's entropy is this many times that of all but a thousandth of the training rows.
SLACK = 2.0
UNKNOWN = "und"
#: Columns that scoring adds for a while.
SUMS, REST, KEY, MORE, TAUGHT = "langid_sums_", "langid_rest_", "langid_key_", "langid_more_", "langid_taught_"
WORD = re.compile(r"[^\W\d_]+")


@cache
def classes() -> np.ndarray:
    """The class of each code point: 0 for what is no letter."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    found = np.where(letters, np.arange(0x110000, dtype=np.int64), 0)
    free = np.flatnonzero(~letters[: 1 << CLASS_BITS])[1:]
    beyond = np.flatnonzero(letters[1 << CLASS_BITS :]) + (1 << CLASS_BITS)
    found[beyond] = free[beyond * 40503 % len(free)]
    return found


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed grams of the words' symbols, and where each word's symbols start."""
    codes = np.frombuffer((" ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = classes()[codes]
    packed, live = symbols.copy(), np.ones(len(symbols), dtype=bool)
    for back in range(1, ORDER):
        before = np.zeros_like(symbols)
        before[back:] = symbols[:-back]
        live &= before != 0
        packed |= np.where(live, before, 0) << (CLASS_BITS * back)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return packed, np.cumsum(lengths) - lengths


# ---------------------------------------------------------------- counting


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each different key once, with the sum of its numbers."""
    found, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(found), dtype=np.int64)
    np.add.at(sums, at, n)
    return found, sums


def counted(rows: DataFrame, lang: Column, text: str) -> DataFrame:
    """(lang, gram, n): grams of the highest order over all rows."""
    rows = rows.select(lang.alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, counts in words.items():
                if not counts:
                    continue
                listed, numbers = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                parts = []
                for at in range(0, len(listed), PART):
                    packed, starts = grams(listed[at : at + PART])
                    parts.append(summed(packed, np.repeat(numbers[at : at + PART], np.diff([*starts, len(packed)]))))
                keys, n = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"])
            words.clear()

        read = 0
        for batch in batches:
            for part in slices(batch, "text"):
                for name, doc in zip(part.column("lang").to_pylist(), texts(part, "text"), strict=True):
                    words.setdefault(name, Counter()).update(WORD.findall(doc.lower()))
                    read += len(doc)
                if sum(map(len, words.values())) > REMEMBERED or read > 8 * REMEMBERED_CHARACTERS:
                    yield from flush()
                    read = 0
        yield from flush()
        release()

    partial = rows.mapInArrow(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def low(gram: str, order: int) -> Column:
    """The last ``order`` symbols of a gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << (CLASS_BITS * order)) - 1))


def lower_order(higher: DataFrame, order: int) -> DataFrame:
    """Continuation counts: how many different symbols stand before each shorter gram."""
    return higher.groupBy("k", low("gram", order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- the model


class Model:
    """Per order from 1, as written tables of all grams: (gram, p) and (context, passed).

    ``p`` maps a language's number to the log-probability of the gram's last symbol,
    ``passed`` to the log of what the context leaves to the next lower order.
    """

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.grams: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        self.floor = -CLASS_BITS * float(np.log(2))
        #: Set by calibration: temperature, least score, and the highest entropy of each language.
        self.heat, self.least = 1.0, 0.0
        self.most = np.full(len(languages), np.inf)

    def scored(self, wanted: DataFrame, order: int = ORDER) -> DataFrame:
        """``wanted`` (different grams) with ``scores``: by language, the log-probability of the last symbol after the others."""
        floor = F.array(*[F.lit(self.floor)] * len(self.languages))
        if order == 1:
            with_lower = wanted.withColumn("lower", floor)
        else:
            short = wanted.select(low("gram", order - 1).alias("gram")).distinct()
            lower = self.scored(short, order - 1).select(F.col("gram").alias("short"), F.col("scores").alias("lower"))
            with_lower = wanted.withColumn("short", low("gram", order - 1)).join(lower, "short")
        joined = (
            with_lower.withColumn("context", F.shiftrightunsigned("gram", CLASS_BITS))
            .join(self.grams[order], "gram", "left").join(self.contexts[order], "context", "left")
        )
        passed = lambda v, k: F.coalesce(F.col("p")[k], v + F.coalesce(F.col("passed")[k], F.lit(0.0)))
        return joined.select(*wanted.columns, F.transform("lower", passed).alias("scores"))


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def build(languages: list[str], highest: DataFrame) -> Model:
    """Interpolated Kneser-Ney from the counts (k, gram, n) of all grams of the highest order."""
    model = Model(languages)
    if not languages:
        return model
    counts = {ORDER: highest}
    for order in range(ORDER - 1, 0, -1):
        counts[order] = written(lower_order(counts[order + 1], order), f"grams-{order}")
    # per order and language: how many grams were counted once and twice
    few = [t.filter("n <= 2").select(F.lit(o).alias("o"), "k", "n") for o, t in counts.items()]
    seen = {(r["o"], r["k"], r["n"]): r["rows"] for r in reduce(DataFrame.unionAll, few).groupBy("o", "k", "n").agg(F.count(F.lit(1)).alias("rows")).collect()}

    def discount(order: int, k: int) -> float:
        ones, twos = (seen.get((order, k, n), 0) for n in (1, 2))
        return min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones + twos else 0.5

    def by_language(key: str, value: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("k", F.log(value).alias("v")))).alias(key)

    for order in range(1, ORDER + 1):
        off = F.array(*(F.lit(float(discount(order, k))) for k in range(len(languages))))[F.col("k")]
        context = F.shiftrightunsigned("gram", CLASS_BITS).alias("context")
        totals = counts[order].groupBy("k", context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        shares = written(totals.withColumn("share", off * F.col("kinds") / F.col("total")), f"contexts-{order}")
        each = counts[order].select("k", "gram", "n", context, low("gram", order - 1).alias("short")).join(shares, ["k", "context"])
        if order == 1:
            each = each.withColumn("below", F.lit(float(np.exp(model.floor))))
        else:
            lower = model.grams[order - 1].select(F.col("gram").alias("short"), F.explode("p").alias("k", "v"))
            each = each.join(lower, ["k", "short"]).withColumn("below", F.exp("v"))
        p = F.greatest(F.col("n") - off, F.lit(0.0)) / F.col("total") + F.col("share") * F.col("below")
        model.grams[order] = written(each.select("k", "gram", p.alias("each")).groupBy("gram").agg(by_language("p", "each")), f"model-{order}")
        model.contexts[order] = written(shares.groupBy("context").agg(by_language("passed", "share")), f"passed-{order}")
    return model


# ---------------------------------------------------------------- scoring


class Scorer:
    """Sums over texts' words of what grams score; remembers a bounded number of words."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray):
        self.keys, self.scores = keys, scores
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.characters = 0
        #: Words with grams that are not held, and these grams; by place, whether a word is one.
        self.open: dict[str, list[int]] = {}
        self.is_open = np.zeros(0, dtype=bool)
        self.rows = np.zeros((0, self.scores.shape[1] + 2), dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        packed, starts = grams(new)
        at, known = _find(self.keys, packed)
        each = np.zeros((len(packed), self.rows.shape[1]), dtype=np.int64)
        each[known, :-2] = self.scores[at[known]]
        each[:, -2], each[:, -1] = 1, (packed & ((1 << CLASS_BITS) - 1)) != 0
        is_open = np.zeros(len(new), dtype=bool)
        if not known.all():
            word = np.searchsorted(starts, np.flatnonzero(~known), side="right") - 1
            is_open[word] = True
            for k, gram in zip(word.tolist(), packed[~known].tolist(), strict=True):
                self.open.setdefault(new[k], []).append(gram)
        self.is_open = np.concatenate([self.is_open, is_open])
        self.place.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.characters += sum(map(len, new))
        self.rows = np.concatenate([self.rows, np.add.reduceat(each, starts, axis=0)])

    def sums(self, docs: list[str]) -> tuple[np.ndarray, list[Counter]]:
        """Of each text: scores by language, symbols, letters; and how often it has each gram that is not held."""
        if len(self.place) > REMEMBERED or self.characters > REMEMBERED_CHARACTERS:
            self._forget()
        words = [WORD.findall(x.lower()) for x in docs]
        ends = np.cumsum([0, *map(len, words)])
        flat = list(chain.from_iterable(words))
        at = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
        if len(missing := np.flatnonzero(at < 0)):
            unknown = [flat[k] for k in missing.tolist()]
            self._learn(list(dict.fromkeys(unknown)))
            at[missing] = np.fromiter(map(self.place.__getitem__, unknown), np.int64, len(unknown))
        out = np.zeros((len(docs), self.rows.shape[1]), dtype=np.int64)
        some = np.flatnonzero(np.diff(ends))
        if len(some):
            out[some] = np.add.reduceat(self.rows[at], ends[:-1][some], axis=0)
        rest: list[Counter] = [Counter()] * len(docs)
        for k in np.flatnonzero(self.is_open[at]).tolist():
            doc = int(np.searchsorted(ends, k, side="right")) - 1
            if not rest[doc]:
                rest[doc] = Counter()
            rest[doc].update(self.open[flat[k]])
        return out, rest


def least_count(table: DataFrame, held: int) -> int:
    """The least power of two such that at most ``held`` grams of (gram, n) have that count."""
    power = F.floor(F.log2("n")).cast("int")
    rows = {r["power"]: r["rows"] for r in table.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    least, total = max(rows, default=0) + 1, 0
    while least > 0 and total + rows.get(least - 1, 0) <= held:
        least, total = least - 1, total + rows.get(least - 1, 0)
    return 1 << least


def with_sums(
    df: DataFrame, model: Model, text: str, wanted: DataFrame | None = None, held: int | None = None, keep_text: bool = True
) -> DataFrame:
    """``df`` with ``SUMS``: by language the sum of log-probabilities in units of 1 / ``UNIT``, then symbols, letters.

    Every executor holds the ``held`` grams of most occurrences; the others of a text meet
    their scores in a join, by the text's MD5.  Whole numbers are added, so that the way
    a gram takes cannot change a sum.  ``wanted``: (gram, n), all grams of the texts.
    """
    n = len(model.languages)
    held = CELLS // n if held is None else held
    if wanted is None:
        wanted = written(counted(df, F.lit(""), text).select("gram", "n"), "wanted")
    whole = F.transform("scores", lambda x: F.round(x * UNIT).cast("long"))
    table = written(model.scored(wanted).select("gram", "n", whole.alias("scores")), "gram-scores")
    least = least_count(table, held)
    first = table.filter(F.col("n") >= least).select("gram", "scores").toArrow().combine_chunks()
    keys = first.column("gram").to_numpy()
    scores = first.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
    order = np.argsort(keys)
    shared = df.sparkSession.sparkContext.broadcast((keys[order], scores[order].astype(np.int32)))
    rest_type = T.ArrayType(T.StructType([T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())]))
    if least > 1:  # copies of a text have the same grams; one of them is enough
        df = df.withColumn(KEY, F.md5(F.col(text).cast("binary")))
    kept = [f for f in df.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, T.StructField(SUMS, T.ArrayType(T.LongType())), T.StructField(REST, rest_type)])
    arrow_rest = pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            for part in slices(batch, text):
                sums, rest = scorer.sums(texts(part, text))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1, dtype=np.int32) * (n + 2)), pa.array(sums.reshape(-1)))
                others = pa.array([[{"gram": g, "n": c} for g, c in x.items()] for x in rest], arrow_rest)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), listed, others], names=schema.names)
        del scorer
        release()

    read = df.mapInArrow(work, schema)
    if least == 1:  # all grams are held
        return read.drop(REST)
    read = written(read, "read")
    left = read.filter(F.size(REST) > 0)
    tokens = left.select(KEY, F.explode(REST).alias("t")).select(KEY, "t.*").dropDuplicates([KEY, "gram"])
    joined = tokens.join(table.select("gram", "scores"), "gram")
    more = joined.groupBy(KEY).agg(F.array(*(F.sum(F.col("n") * F.col("scores")[k]) for k in range(n))).alias(MORE))
    both = F.zip_with(SUMS, MORE, lambda x, y: x + F.coalesce(y, F.lit(0)))
    summed = left.drop(REST).join(more, KEY).withColumn(SUMS, both).drop(KEY, MORE)
    return read.filter(F.size(REST) == 0).drop(REST, KEY).unionByName(summed)


def confidence(sums: Column, symbols: Column, heat: float) -> Column:
    """By language: a softmax of entropies times the root of the number of symbols."""
    x = F.transform(sums, lambda x: F.exp((x - F.array_max(sums)) / UNIT / symbols * heat * F.sqrt(symbols)))
    total = F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    return F.transform(x, lambda v: v / total)


def calibrate(model: Model, scored: DataFrame) -> None:
    """The lowest temperature of nearly least log-loss, and which entropies and scores training rows (k, SUMS) have."""
    n = len(model.languages)
    rows = scored.filter(F.col(SUMS)[n + 1] > 0).select("k", F.slice(SUMS, 1, n).alias("sums"), F.col(SUMS)[n].cast("double").alias("symbols"))
    rows = written(rows, "calibration")
    heats = 2.0 ** np.arange(-4, 7)
    loss = [-F.log(F.greatest(confidence(F.col("sums"), F.col("symbols"), float(h))[F.col("k")], F.lit(1e-6))) for h in heats]
    # whole numbers, so that the order of adding cannot change the choice
    found = rows.agg(F.count(F.lit(1)), *(F.sum(F.round(x * UNIT).cast("long")) for x in loss)).first()
    if not found[0]:
        return
    losses = np.array(found[1:], dtype=np.float64) / UNIT / found[0]
    model.heat = float(heats[int(np.argmax(losses <= losses.min() + 1e-3))])
    score = F.array_max(confidence(F.col("sums"), F.col("symbols"), model.heat))
    least = rows.agg(F.percentile_approx(score, 0.001, ACCURACY)).first()[0]
    model.least = float(min(least, 1.5 / max(n, 2)))
    own = -F.col("sums")[F.col("k")] / UNIT / F.col("symbols")
    for r in rows.groupBy("k").agg(F.percentile_approx(own, 0.999, ACCURACY).alias("most")).collect():
        model.most[r["k"]] = SLACK * r["most"]


def model_of(found: DataFrame) -> Model:
    """A model from counts (lang, gram, n) of the highest order; rows without a language teach nothing."""
    taught = found.filter("lang IS NOT NULL")
    names = sorted(r["lang"] for r in taught.select("lang").distinct().collect())
    return build(names, taught.select(_number(names), "gram", "n")) if names else Model(names)


def _number(names: list[str]) -> Column:
    pairs = chain.from_iterable((F.lit(x), F.lit(k)) for k, x in enumerate(names))
    return F.create_map(*pairs)[F.col("lang")].alias("k")


def trained(rows: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """A model of all rows whose ``lang`` is not null."""
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL")
    found = written(counted(rows, F.col("lang"), "text"), f"grams-{ORDER}")
    model = model_of(found)
    if model.languages:
        wanted = written(found.groupBy("gram").agg(F.sum("n").alias("n")), "wanted")
        scored = with_sums(rows.select(_number(model.languages), "text"), model, "text", wanted)
        calibrate(model, scored.select("k", SUMS))
    return model


def judged(df: DataFrame, learn: Column, lang: str = "lang", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with what a model of its rows with ``learn`` and a language tells of all of them (see ``predict``).

    The same as ``predict`` with ``trained`` rows, in two passes over the texts.
    """
    taught = F.when(learn, F.col(lang))
    found = written(counted(df, taught, text), f"grams-{ORDER}")
    model = model_of(found)
    if not model.languages:
        return predict(df if keep_text else df.drop(text), model, text)
    wanted = written(found.groupBy("gram").agg(F.sum("n").alias("n")), "wanted")
    rows = df.drop("lang_pred", "score", "rejected").withColumn(TAUGHT, taught)
    sums = written(with_sums(rows, model, text, wanted, keep_text=keep_text), "sums")
    marked = sums.filter(F.col(TAUGHT).isNotNull()).select(F.col(TAUGHT).alias("lang"), SUMS)
    calibrate(model, marked.select(_number(model.languages), SUMS))
    return told(sums.drop(TAUGHT), model)


def predict(df: DataFrame, model: Model, text: str = "text", held: int | None = None) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``rejected``, which replace columns of these names."""
    df = df.drop("lang_pred", "score", "rejected")
    if not model.languages:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)})
    return told(with_sums(df, model, text, held=held), model)


def told(scored: DataFrame, model: Model) -> DataFrame:
    """Language, score and rejection from the sums."""
    n = len(model.languages)
    sums, symbols = F.slice(SUMS, 1, n), F.greatest(F.col(SUMS)[n], F.lit(1)).cast("double")
    most, none = F.array_max(sums), F.col(SUMS)[n + 1] == 0
    best = F.array_position(sums, most).cast("int") - 1
    score = F.array_max(confidence(sums, symbols, model.heat))
    highest = F.array(*(F.lit(float(x)) for x in model.most))[best]
    return scored.withColumns({
        "lang_pred": F.when(none, UNKNOWN).otherwise(F.array(*map(F.lit, model.languages))[best]),
        "score": F.when(none, 0.0).otherwise(score),
        "rejected": none | (-most / UNIT / symbols > highest) | (score < model.least),
    }).drop(SUMS)


def remainder(key: str, divisor: int) -> Column:
    """CRC-32 of the key as text, modulo ``divisor``; null for a null key."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(divisor))
