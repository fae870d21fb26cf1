"""Scoring texts by context-tree weighting over bytes.

A byte is eight binary decisions. At every context, the bytes before, from none to a fixed depth, each
decision has a Krichevsky-Trofimov estimate from the counts of the training texts, and the tree's weights say
how far to trust the estimate of a context against those of the longer ones. Training counts the
byte strings of context and next byte in all training texts; the tree is computed from these counts, from the
longest contexts down, and the probabilities from the empty context up. Tasks compute a branch each, the
strings whose contexts end with the same bytes; only the levels above the branches, which have a fixed number
of decisions, come to the driver. A decision that was
never seen in a longer context is taken from the longest in which it was.

The text of a document is its words in lower case, a space between them, and a line feed as the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayferry.frames import written
from dayferry.llm.shingles import as_strings, mix, word_hashes
from dayferry.llm.slots import Slots
from dayferry.llm.text import fold
from dayferry.llm.tokens import SLICE_BYTES, in_slices

DEPTH = 5
#: Bytes at the end of a context that name its branch of the tree.
BRANCH = 2
#: Strings of context and next byte whose log probabilities tasks hold at most, the most frequent ones of all
#: texts; the others' are joined. The tree itself is built from all strings.
HELD_STRINGS = 600_000
#: Words whose counts tasks hold at most, the most frequent ones; the others' counts are joined.
HELD_WORDS = 1_000_000
#: Counts of one kind that a task holds before it merges them; it lets them go if more than half are different.
_FLUSH = 1_000_000
_END = b"\n"
_END_HASH = np.array([xxhash.xxh3_64_intdigest(_END)], np.uint64)
_ONE, _EIGHT, _LOW = np.uint64(1), np.uint64(8), np.uint64(255)


def _lower_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts in lower case, the hashes of their words, and where each text's words start."""
    lower = pc.ascii_lower(as_strings(column))
    return lower, *word_hashes(lower)


def _strings_of(lower: pa.Array, depth: int, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Context and next byte of every byte of the texts as one number, the texts they are of, and where each starts.

    Texts come together as long as they are short; a long one comes in parts of ``most`` bytes, each with
    the bytes before it as its first context.
    """
    pad, texts, held = _END * depth, [], 0
    for i, t in enumerate(_bytes_of(lower)):
        if texts and held + len(t) > most:
            yield _codes(texts, depth)
            texts, held = [], 0
        if len(t) > most:
            for at in range(0, len(t), most):
                before = t[at - depth : at] if at >= depth else pad[: depth - at] + t[:at]
                yield _codes([(i, before + t[at : at + most])], depth)
        else:
            texts.append((i, pad + t))
            held += len(t)
    if texts:
        yield _codes(texts, depth)


def _bytes_of(lower: pa.Array) -> Iterator[bytes]:
    """Each text with one space between its words, and its end."""
    for text in lower:
        yield b" ".join(text.as_py().encode().split()) + _END


def _codes(texts: list[tuple[int, bytes]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join([t for _, t in texts]), np.uint8)
    sizes = np.array([len(t) - depth for _, t in texts], np.int64)
    ends = np.cumsum(sizes)
    found = np.zeros(len(data) - depth, np.uint64)
    for j in range(depth + 1):
        found <<= _EIGHT
        found |= data[j : j + len(found)]
    if len(texts) > 1:  # without those that end in what is before a text
        found = found[np.repeat(depth * np.arange(len(texts)), sizes) + np.arange(ends[-1])]
    return found, np.array([i for i, _ in texts], np.int64), ends - sizes


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each different one of sorted values starts."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, sorted, and how often they occur."""
    values = np.sort(values)
    first = _firsts(values)
    return values[first], np.diff(first, append=len(values))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of parts as one. The stable sort is quick for parts that are sorted."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def count_texts(texts: DataFrame, depth: int) -> DataFrame:
    """kind, key, n over texts with a mark of those that are learnt from. Tasks sum their own first.

    Kind 0 is the hash of a word, 1 context and next byte, both of training texts; 2 is 1 of the other texts.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], []]

        def out(kind: int) -> pa.RecordBatch:
            keys, n = _merged(held[kind])
            held[kind] = []
            columns = [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)]
            return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "n"])

        def full(kind: int) -> Iterator[pa.RecordBatch]:
            if sum(len(k) for k, _ in held[kind]) > _FLUSH:
                held[kind] = [_merged(held[kind])]
                if len(held[kind][0][0]) > _FLUSH // 2:
                    yield out(kind)

        for part in in_slices(batches, 1024):
            learnt = part.column(1)
            for kind, texts in ((1, part.column(0).filter(learnt)), (2, part.column(0).filter(pc.invert(learnt)))):
                if not len(texts):
                    continue
                lower = pc.ascii_lower(as_strings(texts))
                if kind == 1:
                    held[0].append(_counted(np.concatenate([word_hashes(lower)[0], np.repeat(_END_HASH, len(lower))])))
                for found, _, _ in _strings_of(lower, depth):
                    held[kind].append(_counted(found))
                    yield from full(kind)
            yield from full(0)
        for kind in (0, 1, 2):
            if held[kind]:
                yield out(kind)

    found = texts.mapInArrow(run, "kind int, key bigint, n bigint")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 8
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    for i in range(8):
        out -= np.log(x + i)
    return out


def _evidence(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives to such counts, in slices to spare memory."""
    out = np.empty(len(zeros))
    for at in range(0, len(zeros), 1 << 18):
        a, b = zeros[at : at + (1 << 18)], ones[at : at + (1 << 18)]
        out[at : at + (1 << 18)] = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)
    return out


def _climb(nodes: tuple, deep: int, least: int) -> tuple[list[tuple], tuple]:
    """The levels from ``deep`` to ``least`` as key, estimate, trust and place of the parent, and the parents of the last.

    Nodes are sorted keys of context and bits so far, counts of either bit, and what the contexts below
    say together, or none for the longest contexts.
    """
    levels = []
    for d in range(deep, least - 1, -1):
        key, zeros, ones, below = nodes
        evidence = _evidence(zeros, ones)
        if below is None:
            trust, weighted = np.ones(len(key)), evidence
        else:
            both = np.logaddexp(evidence, below)
            trust, weighted = np.exp(evidence - both), both - math.log(2)
        shorter, up = key[:0], np.zeros(len(key), np.int64)
        if d:
            mask = np.uint64((1 << (8 * (d - 1))) - 1)
            shorter, up = np.unique((((key >> _EIGHT) & mask) << _EIGHT) | (key & _LOW), return_inverse=True)
        levels.append((key, (ones + 0.5) / (zeros + ones + 1), trust, up))
        if d:
            nodes = shorter, np.bincount(up, zeros), np.bincount(up, ones), np.bincount(up, weighted)
    return levels, nodes


class Tree:
    """The probabilities of all decisions seen, by depth of context; sorted keys, so that numpy finds them.

    ``top`` has the levels above a branch; without it the strings are those of the whole tree.
    """

    def __init__(self, strings: np.ndarray, counts: np.ndarray, depth: int, top: Top | None = None):
        order = np.argsort(strings)
        strings, counts = strings[order], counts[order].astype(np.float64)
        levels, (key, *_) = _climb((*self._decisions(strings, counts), None), depth, top.depth + 1 if top else 0)
        self.depth, self.keys, self.ones = depth, list(top.keys) if top else [], list(top.ones) if top else []
        if top:
            at = np.searchsorted(top.keys[-1], key)
            mixed, left = top.mixed[at], top.left[at]
        else:
            mixed, left = np.zeros(1), np.ones(1)
        self._descend(levels, mixed, left)
        self.strings = strings
        self.logs = self._from_decisions(strings).astype(np.float32)

    def _descend(self, levels: list[tuple], mixed: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key, estimate, trust, up in levels[::-1]:
            mixed, left = mixed[up], left[up]
            self.keys.append(key)
            self.ones.append((mixed + left * estimate).astype(np.float32))
            mixed, left = mixed + left * trust * estimate, left * (1 - trust)
        return mixed, left

    @staticmethod
    def _decisions(strings: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The decisions of the longest contexts: a key of context and bits so far, and counts of either bit."""
        context, byte = strings >> _EIGHT, (strings & _LOW).astype(np.int64)
        parts = []
        for j in range(8):
            key = (context << _EIGHT) | ((1 << j) | (byte >> (8 - j))).astype(np.uint64)
            bit = (byte >> (7 - j)) & 1
            first = _firsts(key)
            if len(first):
                parts.append((key[first], np.add.reduceat(counts * (1 - bit), first), np.add.reduceat(counts * bit, first)))
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
        key, zeros, ones = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(key)
        return key[order], zeros[order], ones[order]

    def _from_decisions(self, strings: np.ndarray) -> np.ndarray:
        """Log probability of the next byte, decision by decision, each in the longest context that had it."""
        byte = (strings & _LOW).astype(np.int64)
        out = np.zeros(len(strings))
        for j in range(8):
            bits = ((1 << j) | (byte >> (8 - j))).astype(np.uint64)
            p, todo = np.full(len(strings), 0.5), np.arange(len(strings))
            for d in range(self.depth, -1, -1):
                keys = self.keys[d]
                if not len(todo) or not len(keys):
                    continue
                wanted = (((strings[todo] >> _EIGHT) & np.uint64((1 << (8 * d)) - 1)) << _EIGHT) | bits[todo]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[at] == wanted
                p[todo[hit]] = self.ones[d][at[hit]]
                todo = todo[~hit]
            one = (byte >> (7 - j)) & 1
            out += np.log(np.where(one == 1, p, 1 - p))
        return out

    def logs_of(self, strings: np.ndarray) -> np.ndarray:
        """Log probabilities; each different string is looked up once."""
        coded = pa.array(strings).dictionary_encode()
        unique = coded.dictionary.to_numpy()
        logs = np.empty(len(unique))
        if len(self.strings):
            at = np.minimum(np.searchsorted(self.strings, unique), len(self.strings) - 1)
            hit = self.strings[at] == unique
            logs[hit] = self.logs[at[hit]]
        else:
            hit = np.zeros(len(unique), bool)
        logs[~hit] = self._from_decisions(unique[~hit])
        return logs[coded.indices.to_numpy()]


class Top(Tree):
    """The levels above the branches, and what is mixed and left where the branches begin."""

    def __init__(self, nodes: tuple, depth: int):
        self.depth, self.keys, self.ones = depth, [], []
        self.mixed, self.left = self._descend(_climb(nodes, depth, 0)[0], np.zeros(1), np.ones(1))


def string_logs(strings: DataFrame, depth: int) -> DataFrame:
    """key, seen and log, the log probability of the last byte, of strings with n, their count in training texts.

    Each branch is computed twice in its task: up to the levels above, and down again from them. Those have
    255 decisions for each of at most 256 contexts.
    """
    branch = min(BRANCH, depth)
    place = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * branch)) - 1))
    strings = strings.select(place.alias("branch"), "key", "n", "seen")
    top = None
    if branch:

        def up(table: pa.Table) -> pa.Table:
            keys, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
            order = np.argsort(keys)
            leaves = Tree._decisions(keys[order], n[order].astype(np.float64))
            key, zeros, ones, below = _climb((*leaves, None), depth, branch)[1]
            return pa.table({"key": key.view(np.int64), "zeros": zeros, "ones": ones, "below": below})

        above = strings.where(F.col("n") > 0).groupBy("branch").applyInArrow(
            up, "key bigint, zeros double, ones double, below double"
        )
        above = above.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toArrow()
        key = above["key"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        top = Top((key[order], *[above[c].to_numpy()[order] for c in ("zeros", "ones", "below")]), branch - 1)
    shared = strings.sparkSession.sparkContext.broadcast(top)

    def down(table: pa.Table) -> pa.Table:
        keys, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
        tree = Tree(keys[n > 0], n[n > 0], depth, shared.value)
        return pa.table({"key": table["key"], "seen": table["seen"], "log": tree.logs_of(keys)})

    return strings.groupBy("branch").applyInArrow(down, "key bigint, seen bigint, log double")


def _threshold(counts: DataFrame, most: int, n: str = "n") -> int:
    """The least count, a power of two, that at most so many keys reach. One row per power comes to the driver."""
    power = F.floor(F.log2(n)).cast("int")
    sizes = {r["p"]: r["k"] for r in counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("k")).collect()}
    total, least = 0, 1 << 62
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > most:
            break
        least = 1 << p
    return least


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the spans that start there; the last one ends with the values."""
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return np.diff(sums[np.concatenate([starts, [len(values)]])])


def _others(keys: np.ndarray, known: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The keys of each text that are not known; texts lie between the bounds."""
    ends = np.concatenate([[0], np.cumsum(~known)])[bounds]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[~known].view(np.int64)))


def score_texts(
    docs: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    depth: int = DEPTH,
    held_strings: int = HELD_STRINGS,
    held_words: int = HELD_WORDS,
) -> DataFrame:
    """The id of every document with n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    ``training`` is a condition on the rows of ``docs`` that are learnt from. ``base_score`` is the log10
    probability of the words and the end under smoothed counts of single words; ``score`` that of the bytes
    under the tree. A null text counts as an empty one, just the end; rows are scored one by one, so
    null and repeated ids do not matter. Without training texts all bytes are equally likely. Other
    columns take no part, whatever their names. An empty table stays empty. Words are told apart by a
    64-bit hash.
    """
    spark = docs.sparkSession
    text = F.col(text_column).cast("binary").alias("text")
    learnt = F.coalesce(training, F.lit(False)).alias("learnt")
    counts = written(count_texts(docs.select(text, learnt), depth), "ctw-counts")
    words = counts.where(F.col("kind") == 0).select("key", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    strings = counts.where(F.col("kind") > 0).groupBy("key").agg(
        F.sum(F.when(F.col("kind") == 1, F.col("n")).otherwise(0)).alias("n"), F.sum("n").alias("seen")
    )
    strings = written(string_logs(strings, depth), "ctw-logs")
    frequent = _threshold(strings, held_strings, "seen")
    kept = strings.where(F.col("seen") >= frequent).toArrow()  # bounded by ``held_strings``
    least = _threshold(words, held_words)
    held = words.where(F.col("n") >= least).toArrow()  # bounded by ``held_words``
    below = total + 0.5 * (distinct + 1)
    # Strings are spread over 64 bits; words are hashes.
    grams, hashes = mix(kept["key"].to_numpy().view(np.uint64)), held["key"].to_numpy().view(np.uint64)
    known, order = np.argsort(grams), np.argsort(hashes)
    model = spark.sparkContext.broadcast(
        (
            (grams[known], kept["log"].to_numpy()[known]),
            (hashes[order], np.log10((held["n"].to_numpy()[order] + 0.5) / below)),
        )
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_of_string, log_of_word = (Slots(*table) for table in model.value)
        row = TaskContext.get().partitionId() << 40
        for part in in_slices(batches, 1024):
            lower, found, starts = _lower_words(part.column(1))
            n = np.diff(starts)
            logs, hit = log_of_word(found)
            rare = _others(found, hit, starts)
            score, sizes = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
            unknown, unknown_of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for grams, texts, first in _strings_of(lower, depth):
                logs_of, there = log_of_string(mix(grams))
                lengths = np.diff(np.append(first, len(grams)))
                score[texts] += _sums(logs_of, first) / math.log(10)
                sizes[texts] += lengths
                at = np.flatnonzero(~there)
                unknown.append(grams[at])
                unknown_of.append(texts[np.searchsorted(first, at, "right") - 1])
            rare_of = np.concatenate(unknown_of)
            offsets = np.searchsorted(rare_of, np.arange(part.num_rows + 1)).astype(np.int32)
            rare_strings = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(unknown).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(part.num_rows)), part.column(0), pa.array(n + 1),
                    pa.array(_sums(hit.astype(float), starts[:-1]).astype(np.int64)),
                    pa.array(_sums(logs, starts[:-1])), pa.array(score), pa.array(sizes),
                    rare, rare_strings,
                ],
                names=["row", "id", "n_tokens", "known", "base", "score", "bytes", "rare", "rare_strings"],
            )
            row += part.num_rows

    ids = docs.select(F.col(id_column).alias("id"), text)
    schema = ids.select(
        F.lit(0).cast("bigint").alias("row"), "id", *[F.lit(0).cast("bigint").alias(c) for c in ("n_tokens", "known")],
        F.lit(0.0).alias("base"), F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("bytes"),
        *[F.array().cast("array<bigint>").alias(c) for c in ("rare", "rare_strings")],
    ).schema
    scored = written(ids.mapInArrow(run, schema), "ctw-scored")
    # The words and strings that tasks don't hold: each document's own few, with their logs by a join.
    # The end is a token of every text, counted with the training texts.
    missing = [
        scored.select("row", F.lit(kind).alias("kind"), F.explode(c).alias("key")) for kind, c in ((0, "rare"), (1, "rare_strings"))
    ]
    missing = missing[0].unionByName(missing[1])
    few = words.where(F.col("n") < least).select(F.lit(0).alias("kind"), "key", F.log10((F.col("n") + 0.5) / F.lit(below)).alias("log"))
    others = strings.where(F.col("seen") < frequent).select(F.lit(1).alias("kind"), "key", (F.col("log") / math.log(10)).alias("log"))
    found = missing.join(few.unionByName(others), ["kind", "key"], "left")
    word = F.col("kind") == 0
    more = found.groupBy("row").agg(
        F.sum(F.when(word, F.coalesce("log", F.log10(F.lit(0.5) / F.lit(below))))).alias("more"),
        F.count(F.when(word, F.col("log"))).alias("more_known"),
        F.sum(F.when(~word, F.col("log"))).alias("more_score"),
    )
    ends = words.where(F.col("key") == int(_END_HASH.view(np.int64)[0])).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        F.col("id").alias(id_column),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(math.log10((ends + 0.5) / below))).alias("base_score"),
        score.alias("score"),
        (-score * math.log2(10) / F.col("bytes")).alias("bits_per_byte"),
    )


def op5_context_tree_score(spark, sf_dir):
    """The scores of every document; one fold of five is not learnt from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 1
    scored = score_texts(docs, ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )
