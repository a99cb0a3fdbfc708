"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is normalised (spaces become ``▁``, one of them goes in front), its characters are the first symbols, and an
agenda holds every pair of neighbours that together make a piece of the vocabulary: the pair with the highest
score, the leftmost among equals, is merged, and the pairs that the new symbol makes with its neighbours join the agenda.
Entries whose symbols have changed since are skipped. Characters outside the vocabulary become byte pieces.

No piece of a usual vocabulary has a space after another character, so merges stay within words: the distinct words of a run of texts
that the task has not met before are encoded together and kept in a bounded cache. All their symbols lie in flat arrays, the
agenda of a word is its stretch of the array of pair scores, and each round takes the best entry of every word. Words of more than
``SHORT`` characters (a text without any space) are cut where no piece of the vocabulary has the two characters side by side, which
merges can't cross either, and each section has a heap as its agenda, since a round for each merge would take quadratic time; the order of
merges is the same. A vocabulary with spaces inside pieces is cut by that second rule alone.

There is no shuffle: a task streams Arrow batches and holds at most one run of texts, the vocabulary and the cache.
``check=True`` adds the column ``agrees``: whether the sentencepiece library, given the new words of the same batch, returns the same ids
for every word of the row. Texts over ``LONG_TEXT`` characters are encoded and digested word by word as a stream; what a task holds then
follows the longest section without a cut, not the text.

Null and empty texts have the end id only and decode to the empty text. Repeated rows give repeated rows, ids of any type pass through,
an empty table gives an empty result, and other columns of the input are not read. Vocabularies of other kinds, with a character
map, or with user-defined or unused pieces are refused with ``ValueError``.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import NONE, PairTable
from tessera.llm.common import batch_of, packs, table

SPACE = "▁"
CACHE_WORDS = 400_000
SHORT = 64
LONG_TEXT = 1_000_000
# The numbers that the public model format gives to kinds of models and of pieces.
MERGE_TYPE, NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 2, 1, 2, 3, 4, 5, 6

BYTES = "".join(map(chr, range(0xDC80, 0xDD00)))
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


@dataclass
class Vocabulary:
    """What encoding needs of a model file, in plain values that travel to the workers."""
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool
    squeeze: bool
    escape: bool
    byte_fallback: bool
    unknown_text: str
    end: int


def read_model(path: str) -> Vocabulary:
    from sentencepiece import sentencepiece_model_pb2 as proto
    with open(path, "rb") as f:
        m = proto.ModelProto.FromString(f.read())
    kinds = [p.type for p in m.pieces]
    if m.trainer_spec.model_type != MERGE_TYPE:
        raise ValueError("not a merge-type vocabulary")
    if m.normalizer_spec.precompiled_charsmap or m.trainer_spec.treat_whitespace_as_suffix or USER in kinds or UNUSED in kinds:
        raise ValueError("character maps, spaces as suffixes, user-defined and unused pieces are not supported")
    n = m.normalizer_spec
    return Vocabulary([p.piece for p in m.pieces], [p.score for p in m.pieces], kinds, n.add_dummy_prefix, n.remove_extra_whitespaces,
                      n.escape_whitespaces, m.trainer_spec.byte_fallback, m.trainer_spec.unk_surface, m.trainer_spec.eos_id)


class Agenda:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.ids = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == NORMAL}
        order = {x: r for r, x in enumerate(sorted({v.scores[i] for i in self.ids.values()}, reverse=True))}
        self.rank = {p: order[v.scores[i]] for p, i in self.ids.items()}  # equal scores share a rank; the least comes first from a heap
        self.unknown = v.kinds.index(UNKNOWN)
        byte_ids = {int(p[3:-1], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == BYTE}
        self.bytes = [byte_ids[b] for b in range(256)] if v.byte_fallback and len(byte_ids) == 256 else None
        self.adjacent = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        by_words = v.escape and not any(a != SPACE == b for a, b in self.adjacent)
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if by_words else "(?s:.+)")
        # What each id says; bytes over 127 stand as the lone surrogates that Python's "surrogateescape" reads as bytes.
        self.say = [v.unknown_text if k == UNKNOWN else "" if k == CONTROL else p.replace(SPACE, " ") for p, k in zip(v.pieces, v.kinds)]
        self.controls = {i for i, k in enumerate(v.kinds) if k == CONTROL}
        for b, i in byte_ids.items():
            self.say[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        # Symbols that can merge: the pieces under their ids, and characters that occur in pieces without being one.
        symbols = dict(self.ids)
        for c in sorted(set("".join(self.ids)) - symbols.keys()):
            symbols[c] = len(v.pieces) + len(symbols) - len(self.ids)
        self.pairs = PairTable(symbols)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.rank_of = np.full(len(v.pieces), NONE, np.int64)
        for p, r in self.rank.items():
            self.rank_of[self.ids[p]] = r
        self.cache: dict[str, list[int]] = {}
        self.wrong: set[str] = set()

    def normalise(self, text: str) -> str:
        v = self.v
        if v.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if text and v.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE) if v.escape else text

    def merge(self, s: str) -> list[int]:
        """Ids of one section. An entry of the agenda is the rank of a pair and the place of its left symbol in one number, so the
        best score comes first and the leftmost among equals; it counts as long as the pair at that place still has this rank."""
        n, rank = len(s), self.rank
        if n == 1:
            return self.lookup(s)
        pair = [rank.get(s[k : k + 2], -1) for k in range(n - 1)]  # of each symbol with the next one; -1: no piece
        agenda = [r << 32 | k for k, r in enumerate(pair) if r >= 0]
        pair.append(-1)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # where a symbol ends is where the next one begins
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & 0xFFFFFFFF
            if pair[left] != entry >> 32:
                continue
            right = end[left]
            pair[right] = -1
            stop = end[left] = end[right]
            if stop < n:
                before[stop] = left
                r = pair[left] = rank.get(s[left : end[stop]], -1)
                if r >= 0:
                    heappush(agenda, r << 32 | left)
            else:
                pair[left] = -1
            prev = before[left]
            if prev >= 0:
                r = pair[prev] = rank.get(s[prev:stop], -1)
                if r >= 0:
                    heappush(agenda, r << 32 | prev)
        out, k = [], 0
        while k < n:
            out += self.lookup(s[k : end[k]])
            k = end[k]
        return out

    def lookup(self, symbol: str) -> list[int]:
        i = self.ids.get(symbol)
        if i is not None:
            return [i]
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else [self.unknown]

    def long_word(self, word: str) -> list[int]:
        """Ids of a long word, cut where no piece has the two characters side by side."""
        adjacent, out, start = self.adjacent, [], 0
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in adjacent:
                out += self.merge(word[start:k])
                start = k
        return out + self.merge(word[start:])

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that pairs make and their ranks (NONE: no piece)."""
        made = self.pairs.get(left, right)
        rank = np.full(len(made), NONE, np.int64)
        hit = made != NONE
        rank[hit] = self.rank_of[made[hit]]
        return made, rank

    def short_words(self, words: list[str]) -> list[list[int]]:
        """Ids of many words at once: every round takes the best entry of each word's agenda."""
        out: list = [None] * len(words)
        size = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbol = self.symbol_of[code]
        symbol = np.where(symbol < 0, -2 - code, symbol).astype(np.int32)  # outside the vocabulary: the character itself, never merged
        made, rank = np.full(len(code), NONE, np.int32), np.full(len(code), NONE, np.int64)
        made[:-1], rank[:-1] = self.ranked(symbol[:-1], symbol[1:])
        last = np.cumsum(size) - 1
        made[last], rank[last] = NONE, NONE
        word = np.arange(len(words))
        while len(word):
            start = np.cumsum(size) - size
            best = np.minimum.reduceat(rank << 32 | np.arange(len(symbol)), start)
            go = best < int(NONE) << 32
            if not go.all():
                stay = np.repeat(go, size)
                done, cut = symbol[~stay], np.cumsum(size[~go])
                ids, cuts, ended = done.tolist(), cut.tolist(), word[~go].tolist()
                for w, a, b in zip(ended, [0, *cuts], cuts):
                    out[w] = ids[a:b]
                odd = np.searchsorted(cut, np.flatnonzero((done < 0) | (done >= len(self.v.pieces))), "right")
                for k in np.unique(odd).tolist():
                    out[ended[k]] = self.spell(out[ended[k]])
                shift = np.cumsum(~stay)
                at = (best[go] & 0xFFFFFFFF)
                at -= shift[at]
                symbol, made, rank, word, size = symbol[stay], made[stay], rank[stay], word[go], size[go]
                start = np.cumsum(size) - size
                if not len(word):
                    break
            else:
                at = best & 0xFFFFFFFF
            symbol[at] = made[at]
            end = start + size
            after = np.minimum(at + 2, len(symbol) - 1)
            m, r = self.ranked(symbol[at], np.where(at + 2 < end, symbol[after], -1))
            made[at], rank[at] = m, r
            has = at[at > start]
            made[has - 1], rank[has - 1] = self.ranked(symbol[has - 1], symbol[has])
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, made, rank, size = symbol[keep], made[keep], rank[keep], size - 1
        return out

    def spell(self, symbols: list[int]) -> list[int]:
        """Ids of symbols some of which are no pieces."""
        out: list[int] = []
        extra = len(self.v.pieces)
        for s in symbols:
            out += [s] if 0 <= s < extra else self.lookup(chr(-2 - s) if s < 0 else chr(int(np.flatnonzero(self.symbol_of == s)[0])))
        return out

    def learn(self, words: set[str], library=None) -> dict[str, list[int]]:
        """Ids of distinct words; those that ``library`` encodes otherwise are noted in ``wrong``."""
        short = [w for w in words if len(w) <= SHORT]
        out = dict(zip(short, self.short_words(short))) if short else {}
        for w in words:
            if len(w) > SHORT:
                out[w] = self.long_word(w)
        if library is not None:
            own = [w for w in out if w != SPACE]  # a space alone is no text to the library: with the one in front it makes two
            plain = [w.replace(SPACE, " ")[self.v.dummy_prefix :] for w in own]
            for w, theirs in zip(own, library.encode(plain, num_threads=1)):
                if out[w] != theirs:
                    self.wrong.add(w)
        return out

    def encode_words(self, words: list[list[str]], library=None) -> list[list[int]]:
        cache = self.cache
        new = set(chain.from_iterable(words)).difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            keep = set(chain.from_iterable(words)) - new
            self.cache = cache = {w: cache[w] for w in keep}
        known = cache if len(new) <= CACHE_WORDS else dict(cache)
        if new:
            known.update(self.learn(new, library))
        out = [list(chain.from_iterable(map(known.__getitem__, ws))) for ws in words]
        for w in [w for w in new if len(w) > SHORT]:
            cache.pop(w, None)
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, the end id included."""
        return [ids + [self.v.end] for ids in self.encode_words([self.words.findall(self.normalise(t)) for t in texts])]

    def encode_checked(self, texts: list[str], library=None) -> tuple[list[list[int]], list[bool]]:
        words = [self.words.findall(self.normalise(t)) for t in texts]
        ids = self.encode_words(words, library)
        for x in ids:
            x.append(self.v.end)
        return ids, [not self.wrong or self.wrong.isdisjoint(ws) for ws in words]

    def encode_stream(self, text: str, library=None, words: int = 100_000) -> Iterator[tuple[list[int], bool]]:
        """Ids of one long text, some words at a time, and whether they agree with the library's."""
        found = (m.group() for m in self.words.finditer(self.normalise(text)))
        while some := list(islice(found, words)):
            yield self.encode_words([some], library)[0], not self.wrong or self.wrong.isdisjoint(some)
        yield [self.v.end], True

    def decode_stream(self, parts: Iterator[list[int]]) -> Iterator[str]:
        """The text of the ids, part by part. Runs of byte pieces are read as UTF-8, a wrong byte as U+FFFD; the space that was put in
        front goes again."""
        v, first, left = self.v, self.v.dummy_prefix or self.v.squeeze, ""
        for ids in parts:
            stop = len(ids)
            while stop and ids[stop - 1] in self.controls:  # the end id, as a rule
                stop -= 1
            body = ids[:stop]
            cuts = [k for k, i in enumerate(body) if i in self.controls] if not self.controls.isdisjoint(body) else []
            out = []
            for a, b in zip([0, *(k + 1 for k in cuts)], [*cuts, stop]):
                head = ""
                while first and a < b:
                    piece = self.say[ids[a]]
                    drop = v.kinds[ids[a]] == NORMAL and piece.startswith(" ")
                    head, first, a = piece[drop:], v.squeeze and drop and len(piece) == 1, a + 1
                said = left + head + "".join(map(self.say.__getitem__, body[a:b]))
                whole = said.rstrip(BYTES) if b == len(ids) else said  # a run of bytes may go on in the next part
                left = said[len(whole) :]
                out.append(whole.encode("utf-8", "surrogateescape").decode("utf-8", "each_byte"))
            yield "".join(out)
        yield left.encode("utf-8", "surrogateescape").decode("utf-8", "each_byte")

    def decode(self, ids: list[int]) -> str:
        return "".join(self.decode_stream([ids]))


def coder(v: Vocabulary, held: dict = {}) -> Agenda:  # noqa: B006
    """The coder of this worker; built once for each broadcast vocabulary."""
    key = hashlib.sha256(repr(v).encode()).digest() if id(v) not in held else id(v)
    if key not in held:
        held.clear()
        held[key] = held[id(v)] = Agenda(v)
    return held[key]


def encode(df: DataFrame, model_path: str, text: str = "text", id_col: str = "doc_id", ids: bool = True, digests: bool = True,
           check: bool = False) -> DataFrame:
    """``(id_col, n_tokens, ids array<int>, ids_sha256, decoded_sha256, agrees)`` for every row; the flags choose columns. The
    vocabulary (bounded by its file) is broadcast, so only the driver needs the path."""
    spark = df.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_model(model_path))
    raw = None
    if check:
        with open(model_path, "rb") as f:
            raw = spark.sparkContext.broadcast(f.read())
    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] * digests
    fields += [T.StructField("agrees", T.BooleanType())] * check

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = coder(vocabulary.value)
        said = [str(i) for i in range(len(agenda.v.pieces))]
        library = None
        if check:
            from sentencepiece import SentencePieceProcessor
            library = SentencePieceProcessor(model_proto=raw.value)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("n_tokens", pa.int64()), *[("ids", pa.list_(pa.int32()))] * ids,
                                *[("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] * digests, *[("agrees", pa.bool_())] * check])
            for keys, texts in packs(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(texts) == 1 and len(texts[0]) > LONG_TEXT:
                    rows: Iterator = iter([agenda.encode_stream(texts[0], library)])
                else:
                    rows = ([x] for x in zip(*agenda.encode_checked(texts, library)))
                n, kept, a, b, same = [], [], [], [], []
                for parts in rows:
                    count, right, own, h, d = 0, True, [], hashlib.sha256(), hashlib.sha256()

                    def counted() -> Iterator[list[int]]:
                        nonlocal count, right
                        for part, agrees in parts:
                            if digests and part:
                                h.update(((b" " if count else b"") + " ".join(map(said.__getitem__, part)).encode()))
                            count += len(part)
                            right = right and agrees
                            if ids:
                                own.extend(part)
                            yield part

                    for piece in agenda.decode_stream(counted()) if digests else counted():
                        if digests:
                            d.update(piece.encode())
                    n.append(count)
                    kept.append(own)
                    a.append(h.hexdigest())
                    b.append(d.hexdigest())
                    same.append(right)
                yield batch_of(schema, [keys, n, *[kept] * ids, *[a, b] * digests, *[same] * check])

    return df.select(F.col(id_col), F.col(text)).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, model_path: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, decoded string)``: the text that the ids stand for (null ids: null)."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = coder(vocabulary.value)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("decoded", pa.string())])
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield batch_of(schema, [part.column(0).to_pylist(), [None if x is None else agenda.decode(x) for x in part.column(1).to_pylist()]])

    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("decoded", T.StringType())]
    return df.select(F.col(id_col), F.col(ids)).mapInArrow(run, T.StructType(fields))


def op11_pieces(spark, sf_dir: str) -> DataFrame:
    """Every document, encoded with an end id and decoded again, each row checked against the library."""
    import public_tokenizers
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ids=False, check=True)
