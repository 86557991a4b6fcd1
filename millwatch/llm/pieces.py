"""SentencePiece BPE encoding and decoding by vectorised merge rounds. Numpy inside tasks."""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millwatch.llm.common import table
from millwatch.session import ship

#: Types of pieces in a model file: fixed values of the format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"
#: Marks a word without a space ahead.
NO_SPACE = " "
#: Words of a batch that are merged together, and words whose ids a task remembers; neither changes a result.
ROUND_WORDS = 20000
MEMORY_WORDS = 500000
NONE = np.iinfo("int32").max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: number and value (varint, fixed bytes or length-delimited)."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            length, at = (8, at) if tag & 7 == 1 else (4, at) if tag & 7 == 5 else varint(at)
            value, at = data[at:at + length], at + length
        yield tag >> 3, value


class PieceModel:
    """The pieces of a BPE model file, as tables for merging.

    Symbols are numbers: single characters first met in pieces, then pieces; a pair of symbols
    merges if their texts joined are a piece, the pair of the best score first, then the leftmost.
    """

    def __init__(self, data: bytes):
        pieces, spec = [], {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece.get(1, b"").decode(), float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = dict(_fields(value))
        if trainer.get(3, 1) != 2 or spec.get(2) or any(kind in (USER, UNUSED) for *_, kind in pieces):
            raise ValueError("only BPE models without own normalisation, user-defined or unused pieces are handled")
        self.dummy_prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if self.squeeze or not spec.get(5, 1):
            raise ValueError("only models that keep all white space and escape it are handled")
        self.unk = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        names = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.begin, self.end = names["<s>"], names["</s>"]
        byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.byte = np.array([byte[b] for b in range(256)], "int32") if len(byte) == 256 else None
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        # What an id decodes to: the text of a normal piece, a byte, or nothing.
        self.surface = [p.replace(SPACE, " ").encode() if kind == NORMAL else bytes([int(p[3:5], 16)]) if kind == BYTE
                        else b" \xe2\x81\x87 " if kind == UNKNOWN else b"" for p, _, kind in pieces]
        self.is_byte = np.array([kind == BYTE for *_, kind in pieces])
        # Equal scores tie, so ranks are dense.
        scores = np.array([-p[1] for p in pieces])
        rank = np.unique(scores, return_inverse=True)[1]
        chars = sorted({c for p in self.ids for c in p})
        self.char = {c: i for i, c in enumerate(chars)}
        symbol = dict(self.char)
        for p in self.ids:
            symbol.setdefault(p, len(symbol))
        self.n_symbols = len(symbol) + 1  # the last one stands for any character that no piece has
        self.symbol_id = np.full(self.n_symbols, -1, "int32")
        for p, s in symbol.items():
            self.symbol_id[s] = self.ids.get(p, -1)
        pairs = sorted((symbol[p[:i]] * self.n_symbols + symbol[p[i:]], rank[k], symbol[p])
                       for p, k in self.ids.items() for i in range(1, len(p)) if p[:i] in symbol and p[i:] in symbol)
        self.pair = np.array([p[0] for p in pairs], "int64")
        self.pair_rank, self.pair_to = np.array([p[1] for p in pairs], "int32"), np.array([p[2] for p in pairs], "int32")
        # A hashed table of the pairs: two probes per look-up instead of a binary search.
        self.bits = max(4, int(np.ceil(np.log2(len(pairs) * 4 + 1))))
        slots = np.full(1 << self.bits, -1, "int32")
        left = np.arange(len(pairs))
        spot = self._spot(self.pair)
        while len(left):
            free = slots[spot] < 0
            first = np.zeros(len(left), bool)
            first[np.unique(spot, return_index=True)[1]] = True
            put = free & first
            slots[spot[put]] = left[put]
            left, spot = left[~put], (spot[~put] + 1) & ((1 << self.bits) - 1)
        self.slots = slots
        # Two neighbouring characters that no piece has side by side are never merged over.
        self.joined = np.unique(np.array([self.char[a] * self.n_symbols + self.char[b] for p in self.ids for a, b in zip(p, p[1:])], "int64"))

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype("int64")

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 for those that don't merge."""
        found = np.full(len(keys), -1, "int32")
        todo, spot = np.arange(len(keys)), self._spot(keys)
        while len(todo):
            at = self.slots[spot]
            hit = (at >= 0) & (self.pair[at] == keys[todo])
            found[todo[hit]] = at[hit]
            go = (at >= 0) & ~hit
            todo, spot = todo[go], (spot[go] + 1) & ((1 << self.bits) - 1)
        return found

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge rounds over flat symbols; ``word`` numbers each symbol's word, not falling.

        Each round finds every word's best pair and merges its occurrences from the left, all words
        at once; words without a pair leave, the rest is compacted. Later occurrences wait for the
        next round where a merge makes a pair that is as good or better, for that one goes first.
        Returns symbols, words and each symbol's place among the characters.
        """
        place = np.arange(len(symbols))
        out = []
        while len(symbols):
            number = np.full(len(symbols), -1, "int32")
            if len(symbols) > 1:
                same = np.flatnonzero(word[:-1] == word[1:])
                number[same] = self.look_up(symbols[same].astype("int64") * self.n_symbols + symbols[same + 1])
            rank = np.where(number >= 0, self.pair_rank[number], NONE)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(word)])
            best = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(best < NONE, counts)
            out.append((symbols[~open_], word[~open_], place[~open_]))
            if not open_.any():
                break
            hit = (rank == np.repeat(best, counts)) & (rank < NONE)
            at = np.flatnonzero(hit)
            first = np.r_[True, word[at[1:]] != word[at[:-1]]]
            # Of hits that overlap in a run (a a a), every second one counts, from the left; only equal pairs go together.
            run = np.r_[True, at[1:] != at[:-1] + 1]
            lead = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            take = ((np.arange(len(at)) - lead) % 2 == 0)
            lead_first = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            take &= number[at] == number[at[lead_first]]
            take &= first | self._calm(symbols, word, at, number[at], rank[at], lead_first)
            at = at[take]
            symbols, merged = symbols.copy(), self.pair_to[number[at]]
            symbols[at] = merged
            keep = open_.copy()
            keep[at + 1] = False
            symbols, word, place = symbols[keep], word[keep], place[keep]
        symbols, word, place = (np.concatenate(x) if x else np.zeros(0, "int64") for x in zip(*out)) if out else (symbols, word, place)
        order = np.argsort(place, kind="stable")
        return symbols[order], word[order], place[order]

    def _calm(self, symbols, word, at, number, rank, lead_first) -> np.ndarray:
        """Whether no merge of its word's best pair makes a pair as good, before or after its neighbours are merged."""
        merged, n = self.pair_to[number].astype("int64"), len(symbols)
        better = np.zeros(len(at), bool)
        for left, right, valid in (
            (symbols[np.maximum(at - 1, 0)], merged, (at > 0) & (word[np.maximum(at - 1, 0)] == word[at])),
            (merged, symbols[np.minimum(at + 2, n - 1)], (at + 2 < n) & (word[np.minimum(at + 2, n - 1)] == word[at])),
            (merged, merged, np.ones(len(at), bool)),
        ):
            found = self.look_up(np.asarray(left, "int64") * self.n_symbols + right)
            better |= valid & (found >= 0) & (np.where(found >= 0, self.pair_rank[found], NONE) <= rank)
        # One such occurrence holds up all the others of its word.
        group = np.cumsum(lead_first == np.arange(len(at))) - 1
        held = np.zeros(group[-1] + 1, bool)
        held[group[better]] = True
        return ~held[group]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word (escaped, with its leading spaces): flat ids and the number for each word."""
        text = "".join(words)
        code = np.frombuffer(text.encode("utf-32-le"), "uint32")
        lengths = np.fromiter(map(len, words), "int64", len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        points, back = np.unique(code, return_inverse=True)
        symbol = np.array([self.char.get(chr(p), self.n_symbols - 1) for p in points], "int64")[back] if len(points) else np.zeros(0, "int64")
        # Words fall apart where no piece reaches over.
        pairs = symbol[:-1] * self.n_symbols + symbol[1:] if len(symbol) else symbol
        spot = np.minimum(np.searchsorted(self.joined, pairs), len(self.joined) - 1)
        cut = np.r_[True, (self.joined[spot] != pairs) | (word[1:] != word[:-1])] if len(symbol) else np.zeros(0, bool)
        symbols, _, place = self.merge(symbol, np.cumsum(cut))
        ids = self.symbol_id[symbols]
        bad = np.flatnonzero(ids < 0)
        if len(bad):  # single characters without a piece: their bytes, or the unknown piece
            spelled = [self.byte[np.frombuffer(chr(code[place[b]]).encode(), "uint8")] if self.byte is not None else np.array([self.unk], "int32") for b in bad]
            width = np.ones(len(ids), "int64")
            width[bad] = [len(s) for s in spelled]
            new = np.repeat(ids, width)
            new[np.repeat(ids < 0, width)] = np.concatenate(spelled)
            ids, place = new, np.repeat(place, width)
        return ids, np.bincount(word[place], minlength=len(words))

    def split(self, text: str) -> list[str]:
        """Words of a text, cut before each run of spaces: no piece has a space after another character.

        A word stands for itself with one space ahead; one that begins with the escaped space is
        complete as it is.
        """
        if self.dummy_prefix and text and text[0] != " " and text[-1] != " " and "  " not in text and SPACE not in text:
            return text.split(" ")
        if not text:
            return []
        text = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        parts = text.split(SPACE)
        # Without an added space the text may begin in the middle of a word; nothing marks such a word.
        words, spaces = ([NO_SPACE + parts[0]] if parts[0] else []), 0
        for part in parts[1:]:
            spaces += 1
            if part:
                words.append(SPACE * spaces + part)
                spaces = 0
        return words + [SPACE * spaces] if spaces else words

    def encode(self, texts: list[str | None], memory: WordIds | None = None) -> list[np.ndarray]:
        """Ids of whole texts, with begin and end. ``memory`` keeps ids of words between calls."""
        memory = WordIds() if memory is None else memory
        cut = [self.split(text or "") for text in texts]
        seen = set(itertools.chain.from_iterable(cut))
        if len(memory.number) + len(seen) > MEMORY_WORDS:
            memory.clear()
        new = [w for w in seen if w not in memory.number]
        for at in range(0, len(new), ROUND_WORDS):
            part = new[at:at + ROUND_WORDS]
            memory.add(part, *self.encode_words([w[1:] if w[0] == NO_SPACE else w if w[0] == SPACE else SPACE + w for w in part]))
        out = []
        for words in cut:
            at = np.fromiter(map(memory.number.__getitem__, words), "int64", len(words))
            width = memory.width[at]
            ids = np.empty(width.sum() + 2, "int32")
            ids[0], ids[-1] = self.begin, self.end
            shift = memory.start[at] - (np.cumsum(width) - width)
            ids[1:-1] = memory.ids[np.repeat(shift, width) + np.arange(len(ids) - 2)]
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: control pieces drop out, bytes are put together, the added space goes.

        Neighbouring bytes that form no character become U+FFFD, one for each byte.
        """
        ids = np.asarray(ids).tolist()
        while ids and not self.surface[ids[0]] and not self.is_byte[ids[0]]:
            ids = ids[1:]
        surface = [self.surface[i] for i in ids]
        if b"" in surface[:-1]:  # a control piece parts the bytes beside it
            text = "".join(b"".join(run).decode(errors="piece_bytes") for text, run in itertools.groupby(surface, bool) if text)
        else:
            text = b"".join(surface).decode(errors="piece_bytes")
        lead = self.dummy_prefix and ids and not self.is_byte[ids[0]] and ids[0] != self.unk and text.startswith(" ")
        return text[1:] if lead else text


class WordIds:
    """Ids of words met so far in a task."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.start, self.width = np.zeros(0, "int32"), np.zeros(0, "int64"), np.zeros(0, "int64")

    def add(self, words: list[str], ids: np.ndarray, width: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(width) - width]
        self.ids, self.width = np.r_[self.ids, ids], np.r_[self.width, width]


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("piece_bytes", _each_byte)


@functools.lru_cache(2)
def _model(data: bytes) -> PieceModel:
    return PieceModel(data)


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver and sent with the tasks: half a megabyte."""
    with open(path, "rb") as file:
        return file.read()


def encode_decode(docs: DataFrame, model: bytes, text: str = "text", digests: bool = False) -> DataFrame:
    """Add ``piece_ids`` (with begin and end) and ``decoded`` to documents, or figures of both.

    With ``digests``, n_tokens, ids_sha256 (of ids as little-endian unsigned 32-bit integers) and
    decoded_sha256 come instead, so that the long columns don't leave the task. Every text is
    encoded whole, in the task that read it: no shuffle. Columns of these names in the input are
    replaced; all others, nulls and repeated rows pass as they are. A null text counts as empty and
    gives just begin and end. No rows, no output.
    """
    ship(docs.sparkSession)
    made = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} if digests else {"piece_ids": "array<int>", "decoded": "string"}
    rest = docs.drop(*made)
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, memory = _model(model), WordIds()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = pieces.encode(batch.column("_text").to_pylist(), memory)
                texts = [pieces.decode(x) for x in ids]
                if digests:
                    sha = lambda data: hashlib.sha256(data).hexdigest()
                    new = [[len(x) for x in ids], [sha(x.astype("<u4").tobytes()) for x in ids], [sha(x.encode()) for x in texts]]
                else:
                    new = [ids, texts]
                old = [batch.column(i) for i in range(batch.num_columns - 1)]
                names = [*batch.schema.names[:-1], *made]
                yield pa.RecordBatch.from_arrays([*old, *(pa.array(x, kinds[k]) for x, k in zip(new, made.values()))], names=names)

    # The text may itself be named like an added column, so it goes along under a name of its own, last.
    schema = rest.withColumns({name: F.lit(None).cast(kind) for name, kind in made.items()}).schema
    return rest.withColumn("_text", docs[text].cast("string")).mapInArrow(run, schema)


def piece_model() -> bytes:
    import public_tokenizers

    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def op4_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, piece_model(), digests=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
