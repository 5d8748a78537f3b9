"""Exact token counts of every prefix of a text, by dynamic programming over its pre-tokens.

A byte-pair encoding is the only split of a pre-token into vocabulary entries in which every two neighbours are
what the encoder makes of their joint bytes. So the last token of a prefix is the one that ends there and gets
on with the last token of the prefix it leaves: one table of (last token, count) per prefix answers every prefix
in a single pass, and prefixes of different words share their entries.

Over a text the counts are kept as one signed byte per character, the change of the count from the prefix before.
Their running sum is the count of each prefix, which answers totals, budgets and truncation without encoding
again.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm.encoding import ByteEncoder, byte_symbols, known_characters

#: Entries that a worker keeps of each memo.
MEMO_PIECES = 250_000
MEMO_RUNS = 100_000
MEMO_PAIRS = 400_000
#: Longer prefixes are not kept.
_MEMO_BYTES = 12

#: Where one blank stands between two other characters than white space, a text comes apart into pieces.
#: A word with marks after it, of which no letter follows.
_WORD_AND_MARKS = re.compile(r"( ?[^\W\d_]+)([^\w\s]+)")
_BESIDE = re.compile(r"\s | \s|^ | $")


class PrefixCounter(ByteEncoder):
    """Counts of all prefixes, as the tokenizers library would count each of them."""

    #: Pre-tokens of the file's byte-level pattern without the blank before them; white space apart.
    _KNOWN_TOKEN = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+|\s+")
    _ANY_TOKEN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+")
    _ANY_SPACE = regex.compile(r"\s+")
    _CONTRACTION = re.compile(r"'(?:s|t|re|ve|m|ll|d)")

    def __init__(self, path: str) -> None:
        super().__init__(path)
        numbers = self.vocabulary_bytes()
        self.of = {n: b for b, n in numbers.items()}
        self.entries = ahocorasick.Automaton()
        for entry, number in numbers.items():
            self.entries.add_word(entry.decode("latin-1"), (len(entry), number))
        self.entries.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.runs: dict[str, list[int]] = {}
        self.symbols = {b: s for s, b in byte_symbols().items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def _agree(self, left: int, right: int) -> bool:
        """Whether the encoder leaves the two tokens as they are when they stand side by side."""
        key = (left << 32) | right
        joined = "".join(map(self.symbols.__getitem__, self.of[left] + self.of[right]))
        tokens = self.tokenizer.model.tokenize(joined)
        agree = len(tokens) == 2 and tokens[0].id == left
        if len(self.pairs) < MEMO_PAIRS:
            self.pairs[key] = agree
        return agree

    def _table(self, word: bytes) -> list[int]:
        """Token count of each prefix of a pre-token, in bytes, the empty one first."""
        last, counts, pairs = [-1], [0], self.pairs
        done = 0
        # vocabulary entries by the place where they end, the longest first
        for end, (length, token) in self.entries.iter(word.decode("latin-1")):
            if end < done:
                continue
            start = end + 1 - length
            if start:
                left = last[start]
                agree = pairs.get((left << 32) | token)
                if not (self._agree(left, token) if agree is None else agree):
                    continue
            last.append(token)
            counts.append(counts[start] + 1)
            done = end + 1
        return counts

    def _run(self, text: str) -> list[int]:
        """Token count of each prefix, in characters, of one pre-token."""
        known = self.runs.get(text)
        if known is not None:
            return known
        counts = self._table(text.encode("utf-8"))
        if not text.isascii():
            ends = np.cumsum([0, *(len(c.encode("utf-8")) for c in text)])
            counts = [counts[n] for n in ends.tolist()]
        if len(self.runs) < MEMO_RUNS and len(text) < _MEMO_BYTES:
            self.runs[text] = counts
        return counts

    def _steps(self, piece: str, known: bool = True) -> list[int]:
        """Change of the count at each character of a piece that starts a text or a pre-token."""
        pattern = self._KNOWN_TOKEN if known else self._ANY_TOKEN
        space = str.isspace if known else self._ANY_SPACE.fullmatch
        totals, base, at, end_of_text = [0], 0, 0, len(piece)
        while at < end_of_text:
            if self._CONTRACTION.match(piece, at):
                # until it is whole, a contraction is its mark and the letters after it
                end = self._CONTRACTION.match(piece, at).end()
                mark = base + self._run("'")[-1]
                totals += [mark + n for n in self._run(piece[at + 1:end - 1])]
                base += self._run(piece[at:end])[-1]
                totals.append(base)
                at = end
                continue
            end = pattern.match(piece, at).end()
            blank = 0
            if space(piece[at:end]):
                # a prefix that ends in white space has all of it, back to the last other character, in one pre-token
                white = piece[at:end]
                totals += [base + n for n in self._run(white)[1:]]
                if end == end_of_text:
                    break
                if len(white) > 1:
                    base += self._run(white[:-1])[-1]
                if white[-1] != " ":
                    base += self._run(white[-1])[-1]
                    at = end
                    continue
                at, end, blank = end - 1, pattern.match(piece, end).end(), 1
            counts = self._run(piece[at:end])
            totals += [base + n for n in counts[1 + blank:]]
            base += counts[-1]
            at = end
        return [b - a for a, b in zip(totals, totals[1:])]

    def _piece(self, piece: str) -> bytes:
        if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):  # one pre-token
            totals = self._run(piece)
            steps = [b - a for a, b in zip(totals, totals[1:])]
        elif (parts := _WORD_AND_MARKS.fullmatch(piece)) is not None:  # two
            totals = self._run(parts[1])
            marks = self._run(parts[2])
            totals = totals + [totals[-1] + n for n in marks[1:]]
            steps = [b - a for a, b in zip(totals, totals[1:])]
        else:
            steps = self._steps(piece)
        return struct.pack(f"{len(steps)}b", *steps)

    def steps(self, text: str) -> np.ndarray:
        """Change of the token count with each character of a text."""
        special = self._special.search(text)
        if special is None:
            return self._without_special(text)
        # a special string counts once when it is whole; until then it is ordinary text
        out, at = [], 0
        while special is not None:
            ordinary = self._without_special(text[at:special.end() - 1])
            before = int(self._without_special(text[at:special.start()]).sum(dtype=np.int64))
            out += [ordinary, np.asarray([before + 1 - ordinary.sum(dtype=np.int64)], dtype=np.int8)]
            at = special.end()
            special = self._special.search(text, at)
        return np.concatenate([*out, self._without_special(text[at:])])

    def _without_special(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int8)
        if not known_characters(text):
            steps = self._steps(text, known=False)
            if sum(steps) != len(self.whole(text)) // 4:  # another Unicode version: every prefix by the library
                counts = [len(self.whole(text[:n])) // 4 for n in range(len(text) + 1)]
                steps = np.diff(counts)
            return np.asarray(steps, dtype=np.int8)
        if _BESIDE.search(text):
            return np.frombuffer(self._piece(text), dtype=np.int8)
        memo = self.pieces
        pieces = text.split(" ")
        out = [self._piece(pieces[0])]
        for piece in pieces[1:]:
            found = memo.get(piece)
            if found is None:
                found = self._piece(" " + piece)
                if len(memo) < MEMO_PIECES:
                    memo[piece] = found
            out.append(found)
        return np.frombuffer(b"".join(out), dtype=np.int8)


@lru_cache(maxsize=1)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter for each Python worker."""
    return PrefixCounter(path)


def _longest(totals: np.ndarray, budget: int) -> int:
    if not len(totals) or totals[-1] <= budget:
        return len(totals)
    fits = np.flatnonzero(totals <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    budgets: tuple[int, ...] = (512,), keep_steps: bool = True,
) -> DataFrame:
    """One row per text: doc_id, n_bytes, n_chars, n_tokens, fits_<b> per budget and, if kept, steps.

    ``steps`` is binary, a signed byte per character: their running sum is the token count of each prefix.
    ``fits_<b>`` is the length in characters of the longest prefix of at most b tokens. Counts are the library's,
    without begin, end or added special tokens; special strings in a text count as the library counts them.

    Null text counts as empty (all zero). Null ids, repeated rows and extra columns do no harm; an empty table
    gives no rows. Texts of any length are counted whole.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    names = ["doc_id", "n_bytes", "n_chars", "n_tokens", *[f"fits_{b}" for b in budgets]]
    schema = ", ".join(f"{n} long" for n in names) + (", steps binary" if keep_steps else "")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(tokenizer)
        for batch in batches:
            rows, kept = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                steps = counter.steps(text)
                totals = np.cumsum(steps, dtype=np.int64)
                n = int(totals[-1]) if len(totals) else 0
                fits = [_longest(totals, b) for b in budgets]
                rows.append((len(text.encode("utf-8")), len(text), n, *fits))
                if keep_steps:
                    kept.append(steps.tobytes())
            columns = [batch.column(0).cast(pa.int64())] + [pa.array(c, pa.int64()) for c in zip(*rows)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    columns + ([pa.array(kept, pa.binary())] if keep_steps else []), names=names + ["steps"] * keep_steps
                )

    return docs.mapInArrow(count, schema)


def truncation(steps: bytes, budget: int) -> int:
    """Length of the longest prefix of at most ``budget`` tokens, from a stored row."""
    return _longest(np.cumsum(np.frombuffer(steps, dtype=np.int8), dtype=np.int64), budget)
