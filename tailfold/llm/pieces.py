"""SentencePiece BPE encoding by backtracking, and decoding.

A token sequence is the one that merging would give exactly if each two neighbours, merged again
from characters, come out as those two tokens.  So a text is encoded from left to right: one
Aho-Corasick pass lists the pieces that start at each position, the longest that is compatible with
the piece before is taken, and a position from which no continuation works is marked in a bit field
and never tried again.  The work is linear in the text, whatever the text is.

No piece of the vocabulary runs over a word start (checked when the vocabulary is read), so texts
are encoded word by word and a bounded cache keeps the words seen last.

Supported models: BPE with byte fallback, identity normalisation and escaped white space.
Defined results: null counts as empty; an empty text has only the begin and end ids.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE_WORDS = 150_000
CACHE_CHARS = 64  # longer words, as of texts without spaces, are not kept
_CHAR = -1  # rank of a single character, which needs no merge


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model file; small enough to go with each task."""

    rank: dict[str, float]             # pieces of two or more characters, lower merges first
    ids: dict[str, int]
    byte_ids: list[int]
    begin_id: int
    end_id: int
    hidden: frozenset[int]             # control ids, which decode to nothing
    unknown_id: int
    unknown_text: str
    prefix: bool                       # a space is put before each text
    split: dict[str, tuple[str, str]] = field(default_factory=dict)
    plain: frozenset[str] = frozenset()  # pieces whose parts merge in order of rank, without ties

    def merge(self, text: str) -> list[str]:
        """Merging by its definition: lowest rank first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = min(
                ((self.rank.get(a + b, float("inf")), i)
                 for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best == float("inf"):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> Vocabulary:
    """Reads a model file on the driver."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    if (trainer.model_type != trainer.BPE or not trainer.byte_fallback
            or normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces
            or not normalizer.escape_whitespaces or trainer.treat_whitespace_as_suffix):
        raise ValueError(f"{path}: only identity-normalised BPE with byte fallback is supported")
    kinds = type(model.pieces[0])
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError(f"{path}: user-defined and unused pieces are not supported")
    normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    byte_ids = [0] * 256
    for i, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            byte_ids[int(p.piece[1:-1], 16)] = i
    if any(SPACE in p.lstrip(SPACE) for p in normal):
        raise ValueError(f"{path}: a piece runs over the start of a word")
    vocabulary = Vocabulary(
        rank={p: -model.pieces[i].score for p, i in normal.items() if len(p) > 1},
        ids=normal, byte_ids=byte_ids, begin_id=trainer.bos_id, end_id=trainer.eos_id,
        hidden=frozenset(i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL),
        unknown_id=trainer.unk_id, unknown_text=trainer.unk_surface,
        prefix=normalizer.add_dummy_prefix)
    rank, counts = vocabulary.rank, {}
    for r in rank.values():
        counts[r] = counts.get(r, 0) + 1
    plain = set()
    for piece in sorted(rank, key=len):
        parts = list(piece)
        while len(parts) > 2:
            best, at = min((rank.get(a + b, float("inf")), i)
                           for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == float("inf"):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            left, right = parts
            vocabulary.split[piece] = (left, right)
            if counts[rank[piece]] == 1 and all(
                    len(p) == 1 or p in plain and rank[p] < rank[piece] for p in parts):
                plain.add(piece)
    vocabulary.plain = frozenset(plain)
    return vocabulary


class Encoder:
    """Encodes with one vocabulary; built once per worker process."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        self.pieces = {i: p for p, i in vocabulary.ids.items()}
        self.byte_of = {i: b for b, i in enumerate(vocabulary.byte_ids)}
        self.alphabet = frozenset("".join(vocabulary.ids))
        self.automaton = ahocorasick.Automaton()
        for piece in vocabulary.split:  # a piece that cannot be merged is no match
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        # the longest match that is a proper prefix of a match; characters match themselves
        self.shorter = {piece: next(piece[:k] for k in range(len(piece) - 1, 0, -1)
                                    if k == 1 or piece[:k] in vocabulary.split)
                        for piece in vocabulary.split}
        self.plain = vocabulary.plain | self.alphabet
        self.shown = {i: piece.replace(SPACE, " ") for i, piece in self.pieces.items()}
        breakers = "".join(re.escape(c) for c in "\t\n\r" if c not in self.alphabet)
        self.words = re.compile(
            f"{SPACE}+[^{SPACE}{breakers}]*|[^{SPACE}{breakers}]+" + (f"|[{breakers}]" * bool(breakers)))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.seen: dict[str, tuple[bytes, str]] = {}   # the younger half of the cache
        self.older: dict[str, tuple[bytes, str]] = {}
        self.strange = re.compile(f"([^{re.escape(''.join(sorted(self.alphabet)))}])")

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens, merged again from their characters, come out as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= 4 * CACHE_WORDS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._remerge(left, right)
        return known

    def _remerge(self, left: str, right: str) -> bool:
        if left not in self.plain or right not in self.plain:
            return self.v.merge(left + right) == [left, right]
        # Back in time: x ends the left token and y begins the right one until a merge uses them.
        rank, split = self.v.rank.get, self.v.split
        x, y, x_used, y_used = left, right, float("inf"), float("inf")
        made_x, made_y = rank(x, _CHAR), rank(y, _CHAR)
        while True:
            joint = rank(x + y)
            if joint is not None and joint < x_used and joint <= y_used:
                return False
            if made_x > made_y:
                x, x_used = split[x][1], made_x
                made_x = rank(x, _CHAR)
            elif made_y == _CHAR:
                return True
            else:
                y, y_used = split[y][0], made_y
                made_y = rank(y, _CHAR)

    def segment(self, text: str) -> list[str]:
        """Tokens of a text whose characters all occur in pieces."""
        n = len(text)
        if n == 1 or text in self.shorter:
            return [text]
        longest = list(text)  # by start; ends come in rising order, so the last match of a start stays
        for end, piece in self.automaton.iter(text):
            longest[end + 1 - len(piece)] = piece
        shorter, pairs = self.shorter, self.pairs
        failed = bytearray((n >> 3) + 1)
        tokens: list[str] = []
        at, before, piece = 0, None, longest[0]
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if before is None:
                        break
                    fits = pairs.get((before, piece))
                    if fits or fits is None and self.compatible(before, piece):
                        break
                piece = shorter.get(piece)
            if piece is not None:
                tokens.append(piece)
                at, before = end, piece
                if at < n:
                    piece = longest[at]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = tokens.pop()
                at -= len(piece)
                piece = shorter.get(piece)
                before = tokens[-1] if tokens else None
        return tokens

    def _ids(self, word: str) -> list[int]:
        ids: list[int] = []
        if self.alphabet.issuperset(word):
            try:
                return [self.v.ids[token] for token in self.segment(word)]
            except KeyError:  # a character that only longer pieces hold
                runs = [word]
        else:  # characters without a piece stand alone, as their bytes
            runs = self.strange.split(word)
        for run in runs:
            if not run:
                continue
            if run[0] not in self.alphabet:
                ids.extend(self.v.byte_ids[b] for b in run.encode())
                continue
            for token in self.segment(run):
                own = self.v.ids.get(token)
                ids.extend([own] if own is not None else
                           [self.v.byte_ids[b] for b in token.encode()])
        return ids

    def _word(self, word: str) -> tuple[bytes, str]:
        """Ids and surface of a word that the younger half of the cache lacks."""
        known = self.older.get(word)
        if known is None:
            ids = self._ids(word)
            known = struct.pack(f"<{len(ids)}I", *ids), self._surface(ids)
        if len(word) > CACHE_CHARS:
            return known
        if len(self.seen) >= CACHE_WORDS:
            self.older, self.seen = self.seen, {}
        self.seen[word] = known
        return known

    def _words(self, text: str) -> list[tuple[bytes, str]]:
        if not text:
            return []
        text = text.replace(" ", SPACE)
        words = self.words.findall(SPACE + text if self.v.prefix else text)
        return [self.seen.get(word) or self._word(word) for word in words]

    def encode(self, text: str | None) -> list[int]:
        """Ids without begin and end."""
        data = b"".join(own for own, _ in self._words(text or ""))
        return [int.from_bytes(data[i:i + 4], "little") for i in range(0, len(data), 4)]

    def round_trip(self, text: str | None) -> tuple[bytes, str]:
        """All ids, begin and end too, as little-endian 32-bit integers; the text decoded from them."""
        words = self._words(text or "")
        ids = b"".join([own for own, _ in words])
        decoded = "".join([surface for _, surface in words])
        return (self.v.begin_id.to_bytes(4, "little") + ids + self.v.end_id.to_bytes(4, "little"),
                decoded[1:] if self.v.prefix else decoded)

    def _surface(self, ids: list[int]) -> str:
        try:
            return "".join(map(self.shown.__getitem__, ids))
        except KeyError:  # bytes and control ids take the long way
            pass
        out, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(run[at:at + width].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    width = 1
                at += width
            run.clear()

        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            flush()
            if i in self.pieces:
                out.append(self.shown[i])
            elif i == self.v.unknown_id:
                out.append(self.v.unknown_text)
            elif i not in self.v.hidden:
                raise ValueError(f"no piece has the id {i}")
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; the space that encoding puts before a text is taken off again."""
        shown = [i for i in ids if i not in self.v.hidden]
        text = self._surface(shown)
        first = self.pieces.get(shown[0], "") if shown else ""
        return text[1:] if self.v.prefix and first.startswith(SPACE) else text


_encoders: dict[int, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    """The process's encoder for a vocabulary; the cache of words lives as long as the worker."""
    key = hash((len(vocabulary.ids), vocabulary.begin_id, vocabulary.end_id,
                hash(frozenset(vocabulary.ids.items()))))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def encoded(docs: DataFrame, model: str | None = None, id_col: str = "doc_id",
            text_col: str = "text", keep_ids: bool = False,
            extra: tuple[str, ...] = ()) -> DataFrame:
    """Per document its token count and the digests of ids and decoded text, without a shuffle.

    ``keep_ids`` adds ``ids``, an array of all ids; ``extra`` names columns of ``docs`` that stay.
    The model file is read on the driver only.
    """
    vocabulary = read_vocabulary(model or default_model())

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in source:
            counts, ids_sha, text_sha, ids = [], [], [], []
            for text in batch.column(1):
                data, decoded = own.round_trip(text.as_py())
                counts.append(len(data) // 4)
                ids_sha.append(hashlib.sha256(data).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                if keep_ids:
                    ids.append([int.from_bytes(data[i:i + 4], "little")
                                for i in range(0, len(data), 4)])
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                       pa.array(text_sha, pa.string())]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            columns += [batch.column(2 + k) for k in range(len(extra))]
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids, *extra]
    kinds = [docs.schema[id_col].dataType.simpleString(), "long", "string", "string",
             *["array<int>"] * keep_ids, *[docs.schema[c].dataType.simpleString() for c in extra]]
    # numbered inside, so that no name of a column can clash
    return (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                    *[F.col(f"`{c}`").alias(f"extra{i}") for i, c in enumerate(extra)])
        .mapInArrow(batches, ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds)))
        .toDF(*names))
