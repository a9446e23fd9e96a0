"""Token counts by prefix dynamic programming.

A byte-pair encoder splits a text before it merges, so counts of the pieces add up. Inside a
piece the encoding of every prefix ends in exactly one token, and that token is the one which
may follow the last token of the shorter prefix. One pass over the piece therefore finds the
count at every prefix, and no prefix is ever encoded by itself.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import table

END = "</w>"
#: Control characters that str.split takes for white space and the encoder does not.
_ODD = regex.compile(r"[\x1c-\x1f]")
_ascii_pieces = regex.compile(r"'(?:[stmd]|re|ve|ll)|[a-z]+|[0-9]|[^ a-z0-9]+").findall
_ONE = [1]
_SPACES = regex.compile(r"\p{White_Space}+")


def _lengths(tokens: Iterable[str]) -> dict[str, list[int]]:
    ends: dict[str, set[int]] = {}
    for t in tokens:
        ends.setdefault(t[-2:], {1}).add(len(t))
    return {end: sorted(found - {0}, reverse=True) for end, found in ends.items()}


class _Known(dict):
    """Counts by text, found on first use."""

    def __init__(self, find: Callable[[str], int]):
        self.find = find

    def __missing__(self, text: str) -> int:
        return self.find(text)

    def keep(self, text: str, count: int, limit: int) -> None:
        if len(text) <= 48:
            if len(self) >= limit:
                self.clear()
            self[text] = count


class PrefixCounter:
    """Exact token counts at every prefix, for a vocabulary file with word ends."""

    def __init__(self, path: str, cache_limit: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(spec["model"]["merges"])}
        self.vocab = spec["model"]["vocab"]
        # the library's own Unicode tables decide on cases and on what a letter is
        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"])) if spec["added_tokens"] else None
        # lengths of the tokens inside a word, and of those that end one, by their last two letters, longest first
        self.inner = _lengths(t for t in self.vocab if not t.endswith(END))
        self.final = _lengths(t.removesuffix(END) for t in self.vocab if t.endswith(END))
        self.follows: dict[tuple[str, str], bool] = {}
        self.words, self.wholes = _Known(self.word), _Known(lambda s: self.piece(s)[1])
        self.limit = cache_limit

    def _merge(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.ranks.get((symbols[i], symbols[i + 1]), 1 << 60))
            if (symbols[best], symbols[best + 1]) not in self.ranks:
                break
            symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        body = token.removesuffix(END) if token != END else token
        out = list(body)
        if len(body) < len(token):
            out[-1] += END
        return out

    def _may_follow(self, a: str, b: str) -> bool:
        """Whether a + b encodes to just a, b ("" before the first token)."""
        found = self.follows.get((a, b))
        if found is None:
            whole = [a, b] if a else [b]
            found = self._merge([s for t in whole for s in self._symbols(t)]) == whole
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            self.follows[a, b] = found
        return found

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text that are merged each by itself, as the letters that stand for their bytes.
        On printable ASCII, which stands for itself, all Unicode tables agree, so the library is asked about other texts alone."""
        if text.isascii() and text.isprintable():
            return _ascii_pieces(text.lower())
        return [p for p, _ in self.split(self.normal(text))]

    def piece(self, s: str) -> tuple[list[int], int]:
        """(tokens of every prefix while the word goes on, tokens of the whole word) of a piece."""
        last, count = self._opened(s, len(s) - 1)
        whole = self._closed(s, len(s), last, count)
        self.wholes.keep(s, whole, self.limit)
        return count, whole

    def _opened(self, s: str, upto: int) -> tuple[list[str], list[int]]:
        """(last token, tokens) of every prefix of at most `upto` letters while the word goes on."""
        vocab, follows, inner = self.vocab, self.follows, self.inner
        last, count = [""] * (len(s) + 1), [0] * (len(s) + 1)
        for i in range(1, upto + 1):
            for size in inner.get(s[i - 2 : i] if i > 1 else s[0], _ONE):
                if size > i:
                    continue
                t = s[i - size : i]
                if t in vocab:
                    a = last[i - size]
                    ok = follows.get((a, t))
                    if ok or (ok is None and self._may_follow(a, t)):
                        last[i], count[i] = t, count[i - size] + 1
                        break
        return last, count

    def _closed(self, s: str, i: int, last: list[str], count: list[int]) -> int:
        """Tokens of the first i letters as a word of their own."""
        for size in self.final.get(s[max(i - 2, 0) : i], _ONE):
            if size > i:
                continue
            t = s[i - size : i] + END
            if t in self.vocab and self._may_follow(last[i - size], t):
                return count[i - size] + 1
        return 0

    def closed_prefixes(self, text: str) -> list[int]:
        """Tokens of text[:k] for k = 0..len(text), for a text that is one piece in its normal form."""
        s = "".join(self.pieces(text))
        last, count = self._opened(s, len(s))
        out, at = [0], 0
        for c in text:
            at += len(c.encode())
            out.append(self._closed(s, at, last, count))
        return out

    def word(self, word: str) -> int:
        """Tokens of a run without white space."""
        found = self.words.get(word)
        if found is None:
            found = sum(map(self.wholes.__getitem__, self.pieces(word)))
            self.words.keep(word, found, self.limit)
        return found

    def running(self, text: str) -> np.ndarray:
        """Tokens up to the end of each word, special strings counting as a word of one token."""
        if self.special is not None and "<|" in text and self.special.search(text):
            counts, at = [], 0
            for m in self.special.finditer(text):
                counts += [*self._counts(text[at : m.start()]), 1]
                at = m.end()
            counts += self._counts(text[at:])
        else:
            counts = self._counts(text)
        return np.cumsum(np.array(counts, np.int64)).astype(np.int32) if counts else np.zeros(0, np.int32)

    def _counts(self, text: str) -> list[int]:
        words = [w for w in _SPACES.split(text) if w] if _ODD.search(text) else text.split()
        return list(map(self.words.__getitem__, words))

    def truncate(self, text: str, budget: int) -> str:
        """The longest prefix of text of at most budget tokens, from the stored counts: whole words first,
        then the prefix table of the word in which the budget ends."""
        ends = [m.end() for m in regex.finditer(r"\P{White_Space}+", text)]
        counts = [0, *self.running(text).tolist()]
        if len(ends) + 1 != len(counts):
            raise ValueError("special strings in the text: split it at them first")
        k = int(np.searchsorted(counts, budget, side="right")) - 1
        if k >= len(ends):
            return text
        start = regex.search(r"\P{White_Space}", text, pos=ends[k - 1] if k else 0).start()
        word, used, size = text[start : ends[k]], counts[k], 0
        for j in range(1, len(word) + 1):
            if used + sum(self.wholes[p] for p in self.pieces(word[:j])) <= budget:
                size = j
        return text[: start + size] if size else text[: ends[k - 1] if k else 0]


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter for each vocabulary and Python process."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_prefixes(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, prefix_tokens): the exact token count after each word of every whole text.

    prefix_tokens[i] answers how many tokens the text has up to the end of its i-th word, so budget and truncation
    questions are array look-ups (`tokens_within`); PrefixCounter.truncate goes on inside a word.
    Null and empty texts have 0 bytes and an empty array. Repeated rows are counted each. Other columns of docs are not read.
    vocabulary is a path that every executor can open; the default asks the installed public vocabulary files.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        c = counter(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                counts = [c.running(t) for t in texts]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in counts])]).astype(np.int32)
                values = np.concatenate(counts) if counts else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))],
                    names=["id", "n_bytes", "prefix_tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, f"id {kind}, n_bytes bigint, prefix_tokens array<int>").withColumnRenamed("id", id_col)


def total_tokens(prefix_tokens) -> "F.Column":
    return F.coalesce(F.try_element_at(prefix_tokens, F.lit(-1)), F.lit(0)).cast("long")


def tokens_within(prefix_tokens, budget: int) -> "F.Column":
    """Whole words that fit into budget tokens."""
    return F.size(F.filter(prefix_tokens, lambda n: n <= budget))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_prefixes(table(spark, sf_dir, "documents"))
    n = total_tokens(F.col("prefix_tokens"))
    return rows.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > 2048).alias("over_limit"))
