"""Token ids of texts by a public tokenizer file, inside tasks.

A space before a character that is no white space always starts a new piece in the tokenizers used
here, and so does the end of a line after such a character. So a text can be cut there, each cut piece
encoded alone, and the ids joined: the result is the same. Pieces repeat: Arrow finds the different ones of a slice of texts, a worker remembers their ids,
and numpy joins them. What a worker remembers is bounded and lives as long as the worker.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import string
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from dayferry.llm.workers import takes_over

#: Pieces a worker remembers; beyond it only those at hand stay. About 250 bytes each.
REMEMBERED = 600_000
LONGEST = 64
#: A space before white space or the end, where a text can't simply be cut; wider than needed.
_ODD = r" [\pZ\s\x0b\x1c-\x1f\x85]| $"
_CUT = re.compile(r" (?=\S)")
#: The end of a line that does not end in white space, which always starts a new piece, too.
_LINE_END = r"([^\pZ\s\x0b\x1c-\x1f\x85])\n"
_MARKS = string.punctuation.replace("'", "")  # an apostrophe may belong to what follows
#: What marks are surely no part of: Latin letters that stay letters in lower case, and digits.
_PLAIN_END = r"[0-9A-Za-zÀ-ÖØ-öø-įı-ɏ]$"
_LETTERS = r"^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"


class Encoder:
    """Encodes texts to unsigned 32-bit ids, as the library does with ``add_special_tokens=False``.

    So the string of a special token in a text becomes its id; with ``special_as_text`` it is ordinary text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks use the cores
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = "|".join(re.escape(x) for x in added)  # texts with one of these can't be cut at spaces
        self.spaced = self._alone(" a").tolist() != self._alone("a").tolist()  # whether the space is part of a token
        # For Latin letters alone, in lower case if case is normalised, which are one piece to the tokenizer and normal already.
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = special_as_text
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        whole = self.tokenizer.pre_tokenizer
        self.keeps_bytes = isinstance(whole, pre_tokenizers.ByteLevel) and not whole.add_prefix_space
        self.keeps_bytes &= self.tokenizer.normalizer is None
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.token_bytes = self._token_bytes()
        self.lower = self._alone("AÉ").tolist() == self._alone("aé").tolist()  # whether capitals make a difference
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    def _keep_only(self, keys: list[str]) -> None:
        """Forget all pieces but those at hand, which hold the frequent ones."""
        held = {k: self.known[k] for k in keys if k in self.known}
        at = np.array(list(held.values()), np.int64)
        ids, counts = self._joined(at), self.length[at]
        self._forget()
        self._remember(list(held), ids, counts)

    def _encode(self, texts: Sequence[str], plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and how many each has; each text is encoded alone."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts, tokenizer = list(texts), self.plain if plain else self.tokenizer
        if self.keeps_bytes or plain:
            # The quicker call does not say which text an id is of; its bytes do.
            ids = np.array(tokenizer.encode_batch_fast([texts], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
            counts = self._counts(ids, texts)
            if counts is not None:
                return ids, counts
        found = tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
        words = np.array(found.word_ids, np.int64)
        return np.array(found.ids, np.uint32), np.bincount(words, minlength=len(texts))

    def _token_bytes(self) -> np.ndarray:
        """Bytes that each id stands for: a byte is one character of a token; 0 for added tokens."""
        end = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        sizes = np.zeros(self.vocabulary, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            sizes[i] = len(token.removesuffix(end)) if end else len(token)
        sizes[list(self.tokenizer.get_added_tokens_decoder())] = 0
        return sizes

    def _counts(self, ids: np.ndarray, texts: list[str]) -> np.ndarray | None:
        """How many of the ids each text has, if the bytes of ids end wherever a text ends; else None."""
        sizes = self.token_bytes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        wanted = np.cumsum(pc.binary_length(pa.array(texts, pa.string())).to_numpy(), dtype=np.int64)
        if not sizes.all() or ends[-1] != wanted[-1]:
            return None
        at = np.searchsorted(ends, wanted)
        return np.diff(at, prepend=0) if (ends[at] == wanted).all() else None

    def _remember(self, pieces: Sequence[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, first = len(pieces), len(self.known)
        while first + n > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[first : first + n] = self.used + np.cumsum(counts) - counts
        self.length[first : first + n] = counts
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(pieces, range(first, first + n)))

    def _text(self, piece: str) -> str:
        """What a key stands for: the piece after a space, or alone if it starts with a zero."""
        return piece[1:] if piece[:1] == "\0" else " " + piece if self.spaced else piece

    def _learn(self, pieces: list[str]) -> None:
        plain = {p for p in pieces if p.isalpha() and (self.spaced or p.islower()) and (p.isascii() or max(p) < "ɐ")}
        for some in (list(plain), [p for p in pieces if p not in plain]):
            self._remember(some, *self._encode([self._text(p) for p in some], plain=some and some[0] in plain))

    def _joined(self, codes: np.ndarray) -> np.ndarray:
        lengths = self.length[codes]
        ends = np.cumsum(lengths)
        at = np.repeat(self.start[codes] - (ends - lengths), lengths)
        return self.flat[at + np.arange(len(at))]

    def _alone(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a binary column. Null is empty; bytes that are no UTF-8 are replaced."""
        try:
            texts = column.cast(pa.string())
        except pa.ArrowInvalid:
            texts = pa.array([None if b is None else b.decode("utf-8", "replace") for b in column.to_pylist()], pa.string())
        texts = pc.fill_null(texts, "")
        # A zero is the mark of first pieces.
        marked = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)
        if self.added:
            marked = marked | pc.match_substring_regex(texts, self.added, ignore_case=True).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False) & ~marked
        found: list = [None] * len(texts)
        for i in np.flatnonzero(marked):
            found[i] = self._alone(texts[int(i)].as_py())
        for chosen, cut in ((~odd & ~marked, self._even), (odd, self._odd)):
            if chosen.any():
                # Where a space is no part of a token a line end is like one; else it starts a piece without one.
                lines = pc.replace_substring_regex(texts.filter(pa.array(chosen)), _LINE_END, r"\1 " + "\0\n" * self.spaced)
                for i, ids in zip(np.flatnonzero(chosen), cut(lines)):
                    found[i] = ids
        return found

    def _odd(self, texts: pa.Array) -> list[np.ndarray]:
        parts = [_CUT.split(t) for t in _strings(texts)]
        offsets = np.cumsum([0, *map(len, parts)])
        return self._join_pieces(pa.array([p for t in parts for p in t], pa.string()), offsets)

    def _even(self, texts: pa.Array) -> list[np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        pieces = lists.flatten()
        return self._join_pieces(pieces, offsets)

    def _join_pieces(self, pieces: pa.Array, offsets: np.ndarray) -> list[np.ndarray]:
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        whole = coded.dictionary
        if self.spaced:  # first pieces have no space before them
            codes[offsets[:-1]] = len(whole) + np.arange(len(offsets) - 1)
            firsts = pc.binary_join_element_wise("\0", pieces.take(pa.array(offsets[:-1])), "")
            whole = pa.concat_arrays([whole, firsts])
        # Marks after a letter or digit are tokens of their own, so stems and marks are looked up apart.
        stems = pc.utf8_rtrim(whole, _MARKS)
        marked = pc.and_(pc.not_equal(stems, whole), pc.match_substring_regex(stems, _PLAIN_END))
        stems = pc.if_else(marked, stems, whole)
        if self.lower:
            stems = pc.if_else(pc.match_substring_regex(stems, _LETTERS), pc.utf8_lower(stems), stems)
        at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        some = pa.array(at)
        marks = ["\0" + w[len(s) :] for w, s in zip(_strings(whole.take(some)), _strings(stems.take(some)))]
        different = stems.dictionary_encode()
        keys = [*_strings(different.dictionary), *dict.fromkeys(marks), "\0"]
        if len(self.known) > self.remembered:
            self._keep_only(keys)
        known = self.known
        found = np.fromiter(map(known.get, keys, itertools.repeat(-1)), np.int64, len(keys))
        unknown = np.flatnonzero(found < 0)
        new = list(dict.fromkeys(keys[i] for i in unknown))
        long = [k for k in new if len(k) > LONGEST]
        self._learn([k for k in new if len(k) <= LONGEST] if long else new)
        used = self.used
        self._remember(long, *self._encode([self._text(k) for k in long]))
        found[unknown] = [known[keys[i]] for i in unknown]
        pairs = np.full((len(whole), 2), known["\0"], np.int64)  # the empty piece, without ids
        pairs[:, 0] = found[different.indices.to_numpy()]
        pairs[at, 1] = [known[m] for m in marks]
        places = pairs[codes]
        ids = self._joined(places.reshape(-1))
        ends = np.concatenate([[0], np.cumsum(self.length[places].sum(1))])[offsets]
        for k in long:  # only while this slice lasts
            del known[k]
        self.used = used
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def encoder(path: str, remembered: int = REMEMBERED, special_as_text: bool = False) -> Encoder:
    """One for each file in a worker."""
    takes_over("tokens", _encoder.cache_clear)
    return _encoder(path, remembered, special_as_text)


_encoder = functools.cache(Encoder)


#: Bytes of texts in a slice. What is worked out beside a text is some dozens of times as large.
SLICE_BYTES = 1 << 20


def _row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of the texts and binary values of each row."""
    total = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return total


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 1024, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in small slices, so that no more than these rows and bytes are worked on at once.

    A row that is longer by itself is a slice of its own.
    """
    for batch in batches:
        ends = np.cumsum(_row_bytes(batch))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = min(int(np.searchsorted(ends, before + size, "right")), at + rows, batch.num_rows)
            end = max(end, at + 1)
            yield batch.slice(at, end - at)
            at = end
