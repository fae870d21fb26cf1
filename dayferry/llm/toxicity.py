"""Toxicity by class-conditional Kneser-Ney models of the spelling of words.

Two models, one of toxic and one of ordinary documents, give each letter of a word a probability after
the letters before it. Both back off to one distribution that they share, whose lower orders count
in how many different contexts a letter was seen, down to single letters; so an expression too rare to be told
from chance is about as likely in both, and an inflected one is judged by its stem. Toxic documents are fewer; the
ordinary model is thinned to as many, in expectation and without drawing, so that neither has the longer memory.

A toxic text is ordinary but for a small share of its words: its log-likelihood takes each word from the toxic model with
that share and else from the ordinary one. A text's figures are the difference of its two length-normalised
log-likelihoods, over all words as often as they occur, and how far single words pass a margin. A logistic
curve, fitted on labelled documents that the models did not see, makes the score. Without the share, as all words
from the one model or all from the other, what the few toxic words say vanishes among the others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayferry.frames import written
from dayferry.llm.shingles import as_strings, mix
from dayferry.llm.slots import Slots
from dayferry.llm.text import fold, packed, unpacked
from dayferry.llm.tokens import in_slices
from dayferry.llm.workers import takes_over

#: Labelled documents that are learnt from at most, chosen by the hash of their ids.
SAMPLE_DOCS = 20_000
CALIBRATED_PERCENT = 25  # of them, for the logistic curve
ORDERS = (7, 5, 3, 1)  # letters of context: of the two models, then of the orders that they share
DISCOUNT = 0.9
SHARE = 0.02  # of toxic words in a toxic text
MARGIN = 3.0  # nats from which a word counts as an expression of its class
THRESHOLD = 0.7
REMEMBERED = 500_000
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_ASCII_EDGES = "".join(c for c in map(chr, range(128)) if not c.isalnum())
_START, _STOP = "\x02", "\x03"


def core(token: str) -> str:
    """The word in a token: lower case, without marks at its ends."""
    return _EDGES.sub("", token.lower())


def cores(tokens: pa.Array) -> pa.Array:
    """The word in each token, as ``core`` finds it; only tokens with other letters than ASCII's are looked at one by one."""
    plain = pc.string_is_ascii(tokens)
    words = pc.ascii_trim(pc.ascii_lower(tokens), characters=_ASCII_EDGES)
    others = tokens.filter(pc.invert(plain)).to_numpy(zero_copy_only=False).tolist()
    if others:
        words = pc.replace_with_mask(words, pc.invert(plain), pa.array([core(t) for t in others], pa.string()))
    return words


def _word_counts(docs: DataFrame) -> DataFrame:
    """word, toxic and ordinary: how often in documents of each class. Summed in each task, then by word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()

        def out() -> pa.RecordBatch:
            sums: dict[str, list[int]] = {}
            for k, found in enumerate(counts):
                for token, n in found.items():
                    if word := core(token.decode("utf-8", "replace")):
                        sums.setdefault(word, [0, 0])[k] += n
                found.clear()
            columns = [list(sums), [x[1] for x in sums.values()], [x[0] for x in sums.values()]]
            kinds = [pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "toxic", "ordinary"]
            )

        for part in in_slices(batches):
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counts[toxic].update((text or b"").split())
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield out()
        yield out()

    found = docs.select(F.col("text").cast("binary"), "toxic").mapInArrow(run, "word string, toxic bigint, ordinary bigint")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _kept(context: Column, letters: int) -> Column:
    """The last letters of a context."""
    return F.substring(context, F.greatest(F.length(context) - (letters - 1), F.lit(1)), F.lit(letters))


def letter_ratios(words: DataFrame, thinned: float = 1.0, discount: float = DISCOUNT) -> DataFrame:
    """context, letter, ratio: log p(letter | context) in toxic words over that in ordinary ones.

    Of the ordinary counts a share ``thinned`` is taken in expectation: of n, n * thinned remain, and at
    least one does with probability 1 - (1 - thinned) ** n.
    The row of a context without a letter is for all letters not seen after it: there both models
    are shares of the same shared probability. After a context that neither has seen both are that probability.
    """
    whole = F.concat(F.lit(_START), F.col("word"), F.lit(_STOP))
    places = F.sequence(F.lit(2), F.length(whole))
    pairs = F.transform(
        places,
        lambda i: F.struct(
            F.substring(whole, F.greatest(i - ORDERS[0], F.lit(1)), i - F.greatest(i - ORDERS[0], F.lit(1))).alias("c"),
            F.substring(whole, i, F.lit(1)).alias("a"),
        ),
    )
    grams = words.select("toxic", "ordinary", F.explode(pairs).alias("g")).groupBy("g.c", "g.a")
    # Read many times below; at most the letters of the labelled sample.
    grams = written(grams.agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")), "toxicity-letters")

    def stats(table: DataFrame, n: str, context: str, as_: str) -> DataFrame:
        seen = F.sum(F.when(F.col(n) > 0, 1).otherwise(0))
        return table.groupBy(context).agg(F.sum(n).alias(f"{as_}_sum"), seen.alias(f"{as_}_kinds"))

    # Lower orders of the shared model, from the shortest context up: in how many contexts of the
    # order above a letter was seen. The lowest backs off to equal shares of all letters.
    levels = [grams.select("c", "a")]
    for letters in ORDERS[1:]:
        above = levels[-1]
        levels.append(above.select(_kept(F.col("c"), letters).alias("c"), "a", F.col("c").alias("of")).distinct())
    letters_seen = grams.agg(F.countDistinct("a").alias("n")).first()["n"] or 1  # one number
    shared, below = None, None
    for i in range(len(ORDERS) - 1, 0, -1):
        kinds = levels[i].groupBy("c", "a").agg(F.count(F.lit(1)).alias("k"))
        known = kinds.join(stats(kinds, "k", "c", "x"), "c")
        if below is None:
            lower = F.lit(1.0 / letters_seen)
        else:
            known = known.withColumn("short", _kept(F.col("c"), ORDERS[i + 1]))
            known = known.join(
                below.select(F.col("c").alias("short"), "a", F.col("p").alias("lower_p")), ["short", "a"], "left"
            )
            lower = F.coalesce(F.col("lower_p"), F.lit(1.0 / letters_seen))
        p = (F.greatest(F.col("k") - discount, F.lit(0.0)) + discount * F.col("x_kinds") * lower) / F.col("x_sum")
        below = known.select("c", "a", p.alias("p"))
    shared = below.select(F.col("c").alias("short"), "a", F.col("p").alias("lower_p"))

    kept = 1 - F.pow(F.lit(1.0 - thinned), F.col("o"))
    both = grams.select("c", "a", *[
        x.alias(n)
        for n, x in {
            "t": F.col("t").cast("double"), "t_kept": F.when(F.col("t") > 0, 1.0).otherwise(0.0),
            "o": F.col("o") * F.lit(float(thinned)), "o_kept": kept,
        }.items()
    ])
    sums = both.groupBy("c").agg(
        *[F.sum(n).alias(f"{n}_sum") for n in "to"], *[F.sum(f"{n}_kept").alias(f"{n}_kinds") for n in "to"]
    )

    def rest(n: str) -> Column:
        """The share that a model leaves to the distribution below; all of it for a context it never saw."""
        left = F.least(discount * F.col(f"{n}_kinds") / F.col(f"{n}_sum"), F.lit(1.0))  # thinned counts can be below their kinds
        return F.when(F.col(f"{n}_sum") > 0, left).otherwise(1.0)

    def own(n: str) -> Column:
        share = F.greatest(F.col(n) - discount * F.col(f"{n}_kept"), F.lit(0.0)) / F.col(f"{n}_sum")
        return F.when(F.col(f"{n}_sum") > 0, share).otherwise(0.0)

    at = both.join(sums, "c").withColumn("short", _kept(F.col("c"), ORDERS[1]))
    at = at.join(shared, ["short", "a"], "left")
    lower = F.coalesce(F.col("lower_p"), F.lit(1.0 / letters_seen))
    ratio = F.log(own("t") + rest("t") * lower) - F.log(own("o") + rest("o") * lower)
    seen = at.select(F.col("c").alias("context"), F.col("a").alias("letter"), ratio.alias("ratio"))
    unseen = sums.select(
        F.col("c").alias("context"), F.lit("").alias("letter"), (F.log(rest("t")) - F.log(rest("o"))).alias("ratio")
    )
    return seen.unionByName(unseen)


_STEP, _CONTEXT_ONLY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x1F0000)


def _keys(letters: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the contexts before places of a row of letters, and of contexts with the letter; zeros are none."""
    context = np.zeros(len(at), np.uint64)
    for j in range(ORDERS[0], 0, -1):
        context = mix(context * _STEP + letters[at - j])
    return mix(context * _STEP + _CONTEXT_ONLY), mix(context * _STEP + letters[at])


def _letters(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words on end, each after as many zeros as a context is long, and where each word starts."""
    pad = "\0" * ORDERS[0]
    lengths = np.array([len(w) for w in words], np.int64) + ORDERS[0]
    text = "".join([x for w in words for x in (pad, w)])
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), np.cumsum(lengths) - lengths + ORDERS[0]


def pack_ratios(ratios: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``letter_ratios`` as sorted hashes and ratios, 16 bytes a row, hashed in tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, 10_000):
            contexts, letters = part.column(0).to_pylist(), part.column(1).to_pylist()
            codes, starts = _letters([c + a for c, a in zip(contexts, letters)])
            ends = starts + np.array([len(c) for c in contexts], np.int64)  # the letter, or behind the end
            alone, with_letter = _keys(np.append(codes, np.uint64(0)), ends)
            keys = np.where(np.array([not a for a in letters], bool), alone, with_letter)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), part.column(2)], names=["key", "ratio"])

    found = ratios.select("context", "letter", "ratio").mapInArrow(run, "key bigint, ratio double").toArrow()
    keys = found["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], found["ratio"].to_numpy()[order]


class Scorer:
    """The figures of texts; a worker remembers the differences of a bounded number of words."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray, remembered: int = REMEMBERED):
        self.ratios, self.remembered = Slots(keys, ratios), remembered
        self.known: dict[str, float] = {}

    def words(self, words: Sequence[str]) -> np.ndarray:
        """The log-likelihood difference of each word; none, as not a number, of an empty one."""
        letters, starts = _letters([_START + w + _STOP for w in words])
        lengths = np.array([len(w) + 1 for w in words], np.int64)  # letters after the start
        owner = np.repeat(np.arange(len(words)), lengths)
        at = np.repeat(starts + 1 - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        alone, with_letter = _keys(letters, at)
        found, there = self.ratios(with_letter)
        unseen = np.flatnonzero(~there)
        found[unseen] = self.ratios(alone[unseen])[0]
        return np.where([bool(w) for w in words], np.bincount(owner, found, len(words)), np.nan)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the difference of the log-likelihoods per word, what passes the margin per word, and the words."""
        lists = pc.ascii_split_whitespace(as_strings(texts))
        tokens = lists.flatten().dictionary_encode()
        owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        words = cores(tokens.dictionary).dictionary_encode()  # one for all its cases and the marks beside it
        different = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > self.remembered:
            self.known.clear()
        found = list(map(self.known.get, different))
        new = [i for i, x in enumerate(found) if x is None]
        values = np.array(found, np.float64)
        values[new] = self.words([different[i] for i in new])
        self.known.update(zip([different[i] for i in new], values[new].tolist()))
        mixed = np.log(1 - SHARE + SHARE * np.exp(np.clip(values, -10, 10)))
        passed = np.maximum(values - MARGIN, 0)
        codes = words.indices.to_numpy()[tokens.indices.to_numpy()]
        real = ~np.isnan(values)[codes] if len(values) else np.zeros(0, bool)
        codes, owner = codes[real], owner[real]
        n = np.bincount(owner, minlength=len(texts))
        sums = [np.bincount(owner, x[codes] if len(codes) else None, len(texts)) / np.maximum(n, 1) for x in (mixed, passed)]
        return sums[0], sums[1], n


_SCORERS: dict = {}


def _scorer(model, remembered: int) -> Scorer:
    """One for the models a worker used last."""
    takes_over("toxicity", _SCORERS.clear)
    if model.value is not _SCORERS.get("of"):
        _SCORERS.update({"of": model.value, "scorer": Scorer(*model.value, remembered)})
    return _SCORERS["scorer"]


def _figures(rows: DataFrame, model, remembered: int) -> DataFrame:
    """The rows, text replaced by figures; ``model`` is a Spark broadcast of the models' table."""
    kept = [c for c in rows.columns if c != "__text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model, remembered)
        for part in in_slices(batches):
            mixed, passed, words = score(part.column(0))
            found = [pa.array(mixed, pa.float64()), pa.array(passed, pa.float64()), pa.array(words, pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *found], names=[*kept, "__mixed", "__passed", "__words"])

    schema = rows.select(*kept, F.lit(0.0).alias("__mixed"), F.lit(0.0).alias("__passed"), F.lit(0).cast("bigint").alias("__words")).schema
    return rows.select(F.col("__text").cast("binary").alias("__text"), *kept).mapInArrow(run, schema)


def _inputs() -> list[Column]:
    """What the curve sees."""
    return [F.col("__mixed"), F.log(F.col("__passed") + 0.002), F.log1p(F.col("__words").cast("double"))]


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-3) -> tuple[list[float], float]:
    """Slopes and offset of the logistic curve, by Newton steps. Without both classes a flat 0."""
    if len(set(y.tolist())) < 2:
        return [0.0] * x.shape[1], -30.0
    middle, scale = x.mean(0), x.std(0) + 1e-12
    a = np.concatenate([(x - middle) / scale, np.ones((len(x), 1))], 1)
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + ridge * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[:-1] / scale
    return slopes.tolist(), float(w[-1] - slopes @ middle)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    sample_docs: int = SAMPLE_DOCS,
    columns: Sequence[str] | None = None,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The columns of ``docs`` (or those named) with ``score`` and ``predicted``; only the text decides.

    ``labels`` has doc_id and toxic (0 or 1); null labels are left out, and an id that has several
    counts as toxic if one says so. At most ``sample_docs`` labelled ids are learnt from, those whose ids
    have the smallest hashes. A null text counts as an empty one and gets the score of no evidence;
    null ids are scored but never learnt from; rows that repeat are scored alike; without labels of both
    classes every score is about 0. Whole texts are read. Other columns pass through, but for those
    that have an added name. An empty table stays empty. ``remembered`` bounds the words whose figures a
    worker holds, about 150 bytes each.
    """
    spark = docs.sparkSession
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = marks.orderBy(F.xxhash64(F.lit(10), "__id"), "__id").limit(sample_docs)
    calibrates = F.pmod(F.xxhash64(F.lit(11), "__id"), F.lit(100)) < CALIBRATED_PERCENT
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text"))
    # At most ``sample_docs`` ids are broadcast, and that many texts written for the jobs that learn.
    known = texts.join(F.broadcast(sample), "__id").select("text", "toxic", calibrates.alias("calibrates"))
    known = written(known, "toxicity-sample")
    fitted = known.where(~F.col("calibrates"))
    sizes = {r["toxic"]: r["n"] for r in fitted.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    thinned = min(1.0, sizes.get(1, 0) / max(sizes.get(0, 0), 1)) or 1.0
    model = pack_ratios(letter_ratios(_word_counts(fitted), thinned))  # the contexts of the sample
    ratios = spark.sparkContext.broadcast(model)
    held = known.where(F.col("calibrates")).select(F.col("text").alias("__text"), "toxic")
    inputs = _inputs()
    seen = _figures(held, ratios, remembered).select("toxic", *[c.cast("double").alias(f"x{i}") for i, c in enumerate(inputs)]).toArrow()
    x = np.stack([seen[f"x{i}"].to_numpy() for i in range(len(inputs))], 1)  # a few numbers per labelled text
    slopes, offset = fit_curve(x, seen["toxic"].to_numpy().astype(float))
    kept = docs.select(*[docs[f"`{c}`"] for c in columns]) if columns else docs
    rows = docs.select(packed(kept), F.col(text_column).alias("__text"))
    z = sum([F.lit(w) * c for w, c in zip(slopes, inputs)], F.lit(offset))
    scored = _figures(rows, ratios, remembered).withColumn("__score", F.round(1 / (1 + F.exp(-z)), 9))
    return unpacked(
        scored, kept, score=F.col("__score"), predicted=(F.col("__score") >= F.lit(threshold)).cast("int")
    )


def op10_kneser_ney_toxicity(spark, sf_dir):
    """The score of every document; labels of the held-out ids are not learnt from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = fold(F.col("doc_id"), 3) == 1
    scored = score_toxicity(docs, labels.where(~held_out), columns=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
