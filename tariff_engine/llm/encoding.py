"""Token ids of whole texts, exactly as the tokenizers library gives them, at a few times its speed.

Both encoders read the library's own file and run its merges on tiktoken's byte-pair engine, which merges any two
neighbours that spell an entry, in order of rank. That equals merging by rules if every entry that takes part is
encoded to itself by the rules: then, when two neighbours spell an entry, the rules applied to that stretch alone
must just have come to the entry's own two parts. Loading checks this for every entry with the library's model and
leaves out entries that the rules never reach.

Every text that the encoders cannot vouch for goes to the library: texts with a special token's string, and texts
with characters outside `_KNOWN`, on which regex engines, lower-casing and normalisation might differ.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Latin letters and marks (without superscript digits, fractions and the dotted capital I), punctuation, white space.
_KNOWN = re.compile("[\t-\r -~¡-±´-¸º»¿-įı-ɏ‐-‧]*")


def known_characters(text: str) -> bool:
    return _KNOWN.fullmatch(text) is not None


def byte_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for (fixed by the file format)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


class _Library:
    """The tokenizers library over one file, without truncation, padding or added special tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special = [t["content"] for t in self.spec["added_tokens"]]

    def ordinary(self, text: str) -> bool:
        return known_characters(text) and not any(s in text for s in self.special)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def engine(self, pattern: str, singles: dict[bytes, str], to_bytes: Callable[[str], bytes]) -> Callable[[str], np.ndarray]:
        """A function from a text to ids, for pre-tokens by ``pattern``.

        ``singles`` spells the symbols that words start out as; ``to_bytes`` spells any entry.
        """
        import tiktoken

        vocab, suffix = self.spec["model"]["vocab"], self.spec["model"]["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in self.spec["model"]["merges"]]
        # a last symbol that merges with nothing, to see what an entry becomes inside a word
        used = {part for merge in merges for part in merge}
        quiet = next(s for s in byte_symbols() if s + suffix not in used)
        ranks = {spelled: rank for rank, spelled in enumerate(singles)}
        ids = [vocab[entry] for entry in singles.values()]
        for left, right in merges:
            entry = left + right
            at_end = not suffix or entry.endswith(suffix)
            alone = entry.removesuffix(suffix) if at_end and suffix else entry if at_end else entry + quiet
            became = [t.id for t in self.tokenizer.model.tokenize(alone)]
            if became == [vocab[entry]] + ([] if at_end else [vocab[quiet + suffix]]) and to_bytes(entry) not in ranks:
                ranks[to_bytes(entry)] = len(ids)
                ids.append(vocab[entry])
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        by_rank = np.asarray(ids, dtype="<u4")
        return lambda text: by_rank[encoding.encode_to_numpy(text, disallowed_special=())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        return [b"" if not t else self._ordinary(t) if self.ordinary(t) else self.whole(t) for t in texts]

    def _ordinary(self, text: str) -> bytes:
        raise NotImplementedError


class ByteEncoder(_Library):
    """Byte-level BPE: pre-tokens by the file format's fixed pattern."""

    def __init__(self, path: str) -> None:
        import public_tokenizers

        super().__init__(path)
        symbols = byte_symbols()
        spelled = lambda entry: bytes(map(symbols.__getitem__, entry))
        self._ids = self.engine(public_tokenizers.PATTERN, {bytes([b]): s for s, b in symbols.items()}, spelled)

    def vocabulary_bytes(self) -> dict[bytes, int]:
        symbols, special = byte_symbols(), set(self.special)
        vocab = self.spec["model"]["vocab"]
        return {bytes(map(symbols.__getitem__, t)): n for t, n in vocab.items() if t not in special}

    def _ordinary(self, text: str) -> bytes:
        return self._ids(text).tobytes()


#: Stands at the end of a word; not in any known text.
_END = "\x01"
#: Words whose ids a worker keeps; beyond them it starts anew, so that they follow the texts.
MEMO_WORDS = 250_000
#: Texts whose words are looked up together.
BATCH_TEXTS = 256


class WordEncoder(_Library):
    """Lower-cased BPE with word ends, white space dropped: a mark at each word's end merges before all else.

    Words are encoded on their own, so the distinct new ones of some texts are encoded at once, and kept.
    """

    _WORD = re.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+)\s*")

    def __init__(self, path: str) -> None:
        super().__init__(path)
        symbols, suffix = byte_symbols(), self.spec["model"]["end_of_word_suffix"]
        end = _END.encode()

        def spelled(entry: str) -> bytes:
            bare = entry.removesuffix(suffix)
            return bytes(map(symbols.__getitem__, bare)) + (end if bare != entry else b"")

        singles = {bytes([b]): s for s, b in symbols.items()} | {bytes([b]) + end: s + suffix for s, b in symbols.items()}
        self._ids = self.engine(rf"[^{_END}]+{_END}", singles, spelled)
        #: Whether an id ends a word.
        self._closes = np.zeros(self.vocabulary, dtype=bool)
        self._closes[[n for entry, n in self.spec["model"]["vocab"].items() if entry.endswith(suffix)]] = True
        self._memo: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [ids for low in range(0, len(texts), BATCH_TEXTS) for ids in self._encoded(texts[low:low + BATCH_TEXTS])]

    def _encoded(self, texts: list[str | None]) -> list[bytes]:
        words = [self._WORD.findall(t.lower().strip()) if t and self.ordinary(t) else [] for t in texts]
        known = self._known(set().union(*words))
        ids = [b"".join(map(known.__getitem__, own)) for own in words]
        return [x if not t or own or self.ordinary(t) else self.whole(t) for t, own, x in zip(texts, words, ids)]

    def _known(self, words: set[str]) -> dict[str, bytes]:
        """The memo, with the ids of all these words."""
        if len(self._memo) > MEMO_WORDS:
            self._memo.clear()
        new = list(words.difference(self._memo))
        if new:
            ids = self._ids(_END.join(new) + _END)
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self._closes[ids]) + 4).tolist()
            self._memo.update(zip(new, (raw[a:b] for a, b in zip([0, *ends], ends)), strict=True))
        return self._memo


@lru_cache(maxsize=1)
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder for each Python worker."""
    return ByteEncoder(path)


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)
