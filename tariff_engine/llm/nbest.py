"""N-best segmentation into a SentencePiece vocabulary, and decoding.

A lattice has an edge for every piece that spells a stretch of the normalised text; a segmentation's score is the sum
of its pieces' scores in the model file. Forward Viterbi gives each place the best score of any path to it, which is
an exact heuristic for an A* search from the end backwards: it completes segmentations in order of their scores.

No piece crosses from other characters into a word mark, so a text's lattice is a chain of its words' lattices, and
its segmentations are combinations of theirs. Viterbi with the two best scores of each place gives each word's best
score and how much its second-best segmentation loses. Only the n - 1 words that lose least can differ among a text's
n best; A* runs over these and their results are combined. Viterbi solves the lattices of many words at once in numpy,
place by place, while it follows the pieces that begin there; best paths and losses of words are kept in a bounded memo.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N_BEST = 4
#: Words that a worker keeps.
MEMO_WORDS = 250_000
MEMO_SEARCHES = 20_000
#: Words that are solved together, and the length above which a word is solved alone.
BLOCK_WORDS = 8_192
LONG_WORD = 64
#: Up to this size, prefixes times characters are a table; above, their pairs are sorted and searched.
TABLE_CELLS = 2**25
#: Texts that are encoded together.
BATCH_TEXTS = 512
#: An unknown character is spelled by bytes, at this much less than the least score of any piece.
UNKNOWN_PENALTY = 10.0

_MARK = "▁"
_NEVER = float("inf")

#: (start, end, ids, score)
Edge = tuple[int, int, tuple[int, ...], float]


class Solved(NamedTuple):
    """Of each text the ids of its best segmentation, one after the other, their number, its score, and what the
    second-best segmentation loses."""

    ids: np.ndarray
    counts: np.ndarray
    scores: np.ndarray
    losses: np.ndarray

    @classmethod
    def joined(cls, parts: list[Solved]) -> Solved:
        none = cls(np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        return cls(*map(np.concatenate, zip(none, *parts)))

    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    def rows(self, at: np.ndarray, starts: np.ndarray) -> Solved:
        """These rows in this order; starts are the table's own."""
        counts = self.counts[at]
        ends = np.cumsum(counts)
        places = np.repeat(starts[at] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
        return Solved(self.ids[places], counts, self.scores[at], self.losses[at])

    def first(self, n: int) -> Solved:
        return Solved(self.ids[: self.counts[:n].sum()].copy(), *(x[:n].copy() for x in self[1:]))


class PieceLattice:
    """Segmentations by the vocabulary of a model file."""

    def __init__(self, path: str) -> None:
        self.model = _model(path)
        kinds = [
            (n, self.model.id_to_piece(n), self.model.get_score(n), self.model.is_byte(n))
            for n in range(self.model.get_piece_size())
            if not (self.model.is_control(n) or self.model.is_unknown(n) or self.model.is_unused(n))
        ]
        self.byte_ids = {int(piece[3:5], 16): n for n, piece, _, is_byte in kinds if is_byte}
        pieces = {piece: (n, score) for n, piece, score, is_byte in kinds if not is_byte}
        #: Whether words can be told apart: no piece has a mark after another character.
        self.by_word = not any(_MARK in piece.lstrip(_MARK) for piece in pieces)
        self.single = {piece for piece in pieces if len(piece) == 1}
        # scores far below all others stand for pieces that are never preferred
        self.unknown = min(score for _, score in pieces.values() if score > -1e8) - UNKNOWN_PENALTY
        self.entries_by_end = ahocorasick.Automaton()
        for k, piece in enumerate(pieces):
            self.entries_by_end.add_word(piece, k)
        self.entries_by_end.make_automaton()
        self.lengths = np.fromiter(map(len, pieces), dtype=np.int64)
        self.ids, self.scores = (np.asarray(x) for x in zip(*pieces.values()))
        self._number_prefixes(list(pieces))
        #: Rows of words in the table of those that are kept.
        self.words: dict[str, int] = {}
        self.kept = Solved.joined([])
        self.searches: dict[tuple[str, int], list[tuple[float, bytes]]] = {}

    def _number_prefixes(self, pieces: list[str]) -> None:
        """Prefixes of pieces as numbers, those that some piece extends first; 0 is none."""
        extended = sorted({piece[:k] for piece in pieces for k in range(1, len(piece))})
        number = {prefix: k for k, prefix in enumerate(extended, 1)}
        for piece in pieces:
            number.setdefault(piece, len(number) + 1)
        #: Characters as numbers, those that extend a prefix first; 0 is any other.
        inner = sorted({c for piece in pieces for c in piece[1:]})
        code = {c: k for k, c in enumerate(dict.fromkeys([*inner, *(piece[0] for piece in pieces)]), 1)}
        self.n_extended, self.n_inner = len(extended), len(inner)
        self.code = np.zeros(0x110000, dtype=np.int32)
        self.code[[ord(c) for c in code]] = list(code.values())
        self.prefix_of_first = np.zeros(len(code) + 1, dtype=np.int64)
        extension = {}
        for prefix, k in number.items():
            if len(prefix) == 1:
                self.prefix_of_first[code[prefix]] = k
            else:
                extension[number[prefix[:-1]] * (len(inner) + 1) + code[prefix[-1]]] = k
        self.cells = np.asarray([*sorted(extension), np.iinfo(np.int64).max])
        self.extensions = np.asarray([*map(extension.__getitem__, sorted(extension)), 0])
        self.table = None
        if (len(extended) + 1) * (len(inner) + 1) <= TABLE_CELLS:
            self.table = np.zeros((len(extended) + 1) * (len(inner) + 1), dtype=np.min_scalar_type(len(number) + 1))
            self.table[self.cells[:-1]] = self.extensions[:-1]
        self.piece_of_prefix = np.full(len(number) + 1, -1, dtype=np.int64)
        self.piece_of_prefix[[number[piece] for piece in pieces]] = range(len(pieces))

    def _extended(self, prefixes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The prefixes with one more character each."""
        cells = prefixes * (self.n_inner + 1) + characters
        if self.table is not None:
            return self.table[cells].astype(np.int64)
        at = np.searchsorted(self.cells, cells)
        return np.where(self.cells[at] == cells, self.extensions[at], 0)

    def edges(self, text: str) -> list[Edge]:
        """By end, ascending."""
        out = []
        for end, k in self.entries_by_end.iter(text):
            out.append((end + 1 - int(self.lengths[k]), end + 1, (int(self.ids[k]),), float(self.scores[k])))
        unknown = () if self.single.issuperset(text) else [k for k, c in enumerate(text) if c not in self.single]
        if unknown:
            for k in unknown:
                out.append((k, k + 1, self._spelled(text[k]), self.unknown))
            out.sort(key=lambda edge: edge[1])
        return out

    @staticmethod
    def forward(edges: list[Edge], length: int) -> list[float]:
        """Viterbi: the best score of any path to each place."""
        best = [0.0] + [-_NEVER] * length
        for start, end, _, score in edges:
            if best[start] + score > best[end]:
                best[end] = best[start] + score
        return best

    def solved(self, texts: list[str]) -> Solved:
        """The texts by length, in blocks."""
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(-sizes, kind="stable")
        n_long = int((sizes > LONG_WORD).sum())
        parts = [self._solved_alone(texts[k]) for k in order[:n_long].tolist()]
        for low in range(n_long, len(texts), BLOCK_WORDS):
            block = order[low:low + BLOCK_WORDS]
            parts.append(self._solved_block([texts[k] for k in block.tolist()], sizes[block]))
        place = np.empty(len(texts), dtype=np.int64)
        place[order] = np.arange(len(texts))
        found = Solved.joined(parts)
        return found.rows(place, found.starts())

    def _solved_block(self, texts: list[str], sizes: np.ndarray) -> Solved:
        """Viterbi over all lattices at once, by starts: where a place's pieces begin, its two best scores are final.

        Texts come longest first. Of equal scores the piece with the smaller id is the last, an unknown character
        before all pieces.
        """
        width, length = len(texts), int(sizes[0])
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        own = np.repeat(np.arange(width), sizes)
        at = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        first = np.zeros((length + 1, width), dtype=np.int64)
        first[at, own] = self.code[points]
        inner = np.where(first <= self.n_inner, first, 0)
        best, second = np.full((length + 1, width), -np.inf), np.full((length + 1, width), -np.inf)
        best[0] = 0.0
        last, back = np.zeros((length + 1, width), dtype=np.int64), np.zeros((length + 1, width), dtype=np.int64)

        def extend(start: int, end: int, of: np.ndarray, ids: np.ndarray, scores: np.ndarray | float) -> None:
            one, two = best[start][of] + scores, second[start][of] + scores
            old = best[end][of]
            wins = (one > old) | ((one == old) & (ids < last[end][of]))
            best[end][of] = np.maximum(one, old)
            second[end][of] = np.maximum(np.maximum(np.minimum(one, old), second[end][of]), two)
            last[end][of[wins]], back[end][of[wins]] = ids[wins], end - start

        unknown = np.flatnonzero(self.piece_of_prefix[self.prefix_of_first[self.code[points]]] < 0)
        unknown = unknown[np.argsort(at[unknown], kind="stable")]
        cuts = np.searchsorted(at[unknown], np.arange(length + 1)).tolist()
        for start in range(length):
            odd = unknown[cuts[start]:cuts[start + 1]]
            if len(odd):
                extend(start, start + 1, own[odd], -1 - points[odd], self.unknown)
            prefix = self.prefix_of_first[first[start]]
            of = np.flatnonzero(prefix)
            prefix = prefix[of]
            for end in range(start + 1, length + 1):
                piece = self.piece_of_prefix[prefix]
                found = piece >= 0
                piece = piece[found]
                extend(start, end, of[found], self.ids[piece], self.scores[piece])
                longer = prefix <= self.n_extended
                of, prefix = of[longer], prefix[longer]
                prefix = self._extended(prefix, inner[end][of])
                longer = prefix > 0
                of, prefix = of[longer], prefix[longer]
                if not len(of):
                    break

        of, end, path = np.arange(width), sizes, []
        while len(of):
            path.append((of, last[end, of]))
            end = end - back[end, of]
            of, end = of[end > 0], end[end > 0]
        counts = np.bincount(np.concatenate([of for of, _ in path]), minlength=width)
        ids, ends = np.empty(counts.sum(), dtype=np.int64), np.cumsum(counts)
        for k, (of, own_ids) in enumerate(path, 1):
            ids[ends[of] - k] = own_ids
        if (ids < 0).any():
            spelled = [self._spelled(chr(-1 - i)) for i in ids[ids < 0].tolist()]
            sizes_of = np.ones(len(ids), dtype=np.int64)
            sizes_of[ids < 0] = list(map(len, spelled))
            counts = np.add.reduceat(sizes_of, ends - counts)
            ids = np.repeat(ids, sizes_of)
            ids[ids < 0] = list(itertools.chain.from_iterable(spelled))
        top = best[sizes, np.arange(width)]
        return Solved(ids.astype("<u4"), counts, top, top - second[sizes, np.arange(width)])

    def _solved_alone(self, text: str) -> Solved:
        """The same for one text, edge by edge."""
        length = len(text)
        best, second = [0.0] + [-_NEVER] * length, [-_NEVER] * (length + 1)
        last: list[Edge | None] = [None] * (length + 1)
        for edge in self.edges(text):
            start, end, ids, score = edge
            one, old = best[start] + score, best[end]
            if one > old or (one == old and ids < last[end][2]):
                second[end] = max(old, second[end], second[start] + score)
                best[end], last[end] = one, edge
            elif one > second[end]:
                second[end] = one
        path, at = [], length
        while at:
            at, _, ids, _ = last[at]
            path.append(ids)
        ids = np.asarray([i for part in reversed(path) for i in part], dtype="<u4")
        return Solved(ids, np.asarray([len(ids)]), np.asarray([best[length]]), np.asarray([best[length] - second[length]]))

    def _spelled(self, character: str) -> tuple[int, ...]:
        """The byte pieces of an unknown character."""
        return tuple(self.byte_ids[b] for b in character.encode("utf-8"))

    def search(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations (score, ids) by backward A*, best first; of equal scores those whose ids are
        smaller, compared piece by piece from the end."""
        edges, length = self.edges(text), len(text)
        best = self.forward(edges, length)
        into: list[list[Edge]] = [[] for _ in range(length + 1)]
        for edge in edges:
            into[edge[1]].append(edge)
        heap = [(-best[length], (), length, 0.0)]
        out = []
        while heap and len(out) < n:
            _, behind, at, score = heapq.heappop(heap)
            if not at:
                out.append((score, tuple(i for part in reversed(behind) for i in part)))
                continue
            for start, _, ids, own in into[at]:
                heapq.heappush(heap, (-(best[start] + own + score), (*behind, ids), start, score + own))
        return out

    def units(self, normalised: str) -> list[str]:
        """The stretches that no piece crosses, each without its first mark."""
        if not self.by_word or not normalised.startswith(_MARK):
            return []
        parts = normalised[1:].split(_MARK)
        if "" in parts:  # marks in a row belong to the word after them
            joined, marks = [], ""
            for k, part in enumerate(parts):
                if part or k == len(parts) - 1:
                    joined.append(marks + part)
                    marks = ""
                else:
                    marks += _MARK
            return joined
        return parts

    def n_best(self, texts: list[str], n: int) -> list[NBest]:
        """Of each text the best ids and score, and the n best."""
        normalised = [self.model.normalize(text) for text in texts]
        all_words = [self.units(t) for t in normalised]
        gc.disable()  # there are no cycles to find among the many small objects below
        try:
            memo = self.words
            new = list(set().union(*all_words).difference(memo))
            table = Solved.joined([self.kept, self.solved([_MARK + word for word in new])]) if new else self.kept
            memo.update(zip(new, itertools.count(len(memo))))
            starts, out = table.starts(), []
            for text, words in zip(normalised, all_words):
                if words:
                    numbers = np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words))
                    out.append(self._combined(words, table.rows(numbers, starts), n))
                else:
                    out.append(self._whole(text, n))
        finally:
            gc.enable()
        n_kept = min(MEMO_WORDS, len(memo))
        for word in new[len(new) - (len(memo) - n_kept):]:
            del memo[word]
        if n_kept > len(self.kept.counts):
            self.kept = table.first(n_kept)
        return out

    def _whole(self, normalised: str, n: int) -> NBest:
        """One lattice."""
        if not normalised:
            return NBest(b"", 0.0, [(0.0, [])])
        found = [(score, _packed(ids)) for score, ids in self.search(normalised, n)]
        score, best = found[0]
        return NBest(best, score, [(s, [(0, len(best), ids)] if k else []) for k, (s, ids) in enumerate(found)])

    def _combined(self, words: list[str], found: Solved, n: int) -> NBest:
        score = float(found.scores.sum())
        losses, cuts = found.losses, np.concatenate(([0], np.cumsum(found.counts) * 4))
        loose = [k for k in np.argsort(losses, kind="stable")[: n - 1].tolist() if losses[k] < _NEVER]
        options = [self._options(words[k], n) for k in loose]
        combined = []
        for choice in _choices(tuple(map(len, options)), n):
            combined.append((score + sum([o[c][0] for o, c in zip(options, choice)]), choice))
        combined.sort(key=lambda c: (-c[0], c[1]))
        places = [(int(cuts[k]), int(cuts[k + 1])) for k in loose]
        ranked = [
            (total, sorted((*place, o[c][1]) for place, o, c in zip(places, options, choice) if c)) for total, choice in combined[:n]
        ]
        return NBest(found.ids.tobytes(), score, ranked)

    def _options(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The word's n best segmentations: what is lost against the best, and the ids."""
        options = self.searches.get((word, n))
        if options is None:
            found = self.search(_MARK + word, n)
            options = [(score - found[0][0], _packed(ids)) for score, ids in found]
            if len(self.searches) < MEMO_SEARCHES:
                self.searches[word, n] = options
        return options


def _packed(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1024)
def _choices(sizes: tuple[int, ...], n: int) -> list[tuple[int, ...]]:
    """Combinations of ranks that can be among the n best: all with no greater rank anywhere come before them."""
    if not sizes:
        return [()]
    return [(c, *others) for c in range(min(sizes[0], n)) for others in _choices(sizes[1:], n // (c + 1))]


class NBest(NamedTuple):
    ids: bytes
    score: float
    #: (score, what differs from the best segmentation: from which byte to which, and the bytes there)
    ranked: list[tuple[float, list[tuple[int, int, bytes]]]]

    def all_ids(self) -> list[bytes]:
        """The ids of every one of the n best."""
        out = []
        for _, changed in self.ranked:
            parts, at = [], 0
            for low, high, ids in changed:
                parts += [self.ids[at:low], ids]
                at = high
            out.append(b"".join([*parts, self.ids[at:]]))
        return out


class PieceDecoder:
    """Ids back to text; holds no lattice."""

    def __init__(self, path: str) -> None:
        model = _model(path)
        pieces = ((n, model.id_to_piece(n)) for n in range(model.get_piece_size()))
        spelled = [
            bytes([int(piece[3:5], 16)]) if model.is_byte(n) else piece.replace(_MARK, " ").encode("utf-8") for n, piece in pieces
        ]
        self.lengths = np.fromiter(map(len, spelled), dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(spelled), dtype=np.uint8)

    def decode_all(self, ids: np.ndarray, edges: np.ndarray) -> pa.StringArray:
        """The text of each run of ids between two edges: marks become blanks, the first one goes, bytes join."""
        lengths, starts = self.lengths[ids], self.starts[ids]
        first = edges[:-1][edges[:-1] < edges[1:]]
        first = first[self.table[starts[first]] == 32]
        lengths[first] -= 1
        starts[first] += 1
        ends = np.cumsum(lengths)
        spelled = self.table[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[edges]
        raw = spelled.tobytes()
        heads = spelled[cuts[:-1][cuts[:-1] < cuts[1:]]]
        try:
            raw.decode("utf-8")
            whole = not ((heads >= 0x80) & (heads < 0xC0)).any()
        except UnicodeDecodeError:
            whole = False
        if not whole:  # ids that spell no text
            return pa.array([raw[x:y].decode("utf-8", errors="replace") for x, y in zip(cuts, cuts[1:])], pa.string())
        return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw))

    def decode(self, ids: bytes) -> str:
        """The text that one row of ids spells."""
        numbers = np.frombuffer(ids, dtype="<u4")
        return self.decode_all(numbers, np.asarray([0, len(numbers)]))[0].as_py()


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=1)
def lattice(path: str) -> PieceLattice:
    """One lattice for each Python worker."""
    return PieceLattice(path)


@lru_cache(maxsize=1)
def decoder(path: str) -> PieceDecoder:
    """One decoder for each Python worker."""
    return PieceDecoder(path)


def encode_n_best(
    df: DataFrame, model: str, n: int = N_BEST, id_col: str = "doc_id", text_col: str = "text", keep_alternatives: bool = True
) -> DataFrame:
    """One row per text: doc_id, ids (bytes, unsigned 32 bit), score, scores (of the n best) and alternatives.

    ``alternatives`` holds the ids of the second to n-th best. Equal scores come in a fixed order. Scores are sums
    of the model file's; an unknown character counts as its bytes, at a penalty below the least score.

    Null and empty texts have no ids, score 0 and one (empty) segmentation. Null ids, repeated rows and extra
    columns do no harm; an empty table gives no rows. Texts of any length are encoded whole.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, score double, scores array<double>" + ", alternatives array<binary>" * keep_alternatives
    names = ["doc_id", "ids", "score", "scores", "alternatives"][: 4 + keep_alternatives]
    kinds = [pa.binary(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.binary())]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model)
        gc.freeze()  # the tables and the memo so far: nothing to look for in them
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(low, BATCH_TEXTS)
                rows = []
                for found in pieces.n_best([t or "" for t in part.column(1).to_pylist()], n):
                    others = found.all_ids()[1:] if keep_alternatives else None
                    rows.append((found.ids, found.score, [s for s, _ in found.ranked], others)[: 3 + keep_alternatives])
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=names)

    return docs.mapInArrow(encode, schema)


def decode_pieces(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """The rows with their ids replaced by the text that these spell; null ids give null.

    The text is the normalised one: a blank for each mark, without the first.
    """
    rest = [c for c in df.columns if c != ids_col]
    rows = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{ids_col}`"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = decoder(model)
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(low, BATCH_TEXTS)
                column = part.column(len(rest)).cast(pa.large_binary())
                null = column.is_null()
                column = column.fill_null(b"")
                edges = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] // 4
                ids = np.frombuffer(column.buffers()[2] or b"", dtype="<u4")[edges[0]:edges[-1]]
                texts = pieces.decode_all(ids, edges - edges[0])
                texts = pc.if_else(null, pa.scalar(None, pa.string()), texts) if null.true_count else texts
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=[*rest, text_col])

    return rows.mapInArrow(decode, f"{schema}, `{text_col}` string")
