"""Byte-pair encoding and decoding of a word-end vocabulary in batched numpy merge rounds."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from wardlens.functions.scalar import quoted
from wardlens.llm.common import map_text, without

_NONE = np.iinfo(np.int32).max
_PIECE_BYTES = 1 << 20

# Characters for which lower case, composition and character classes need the
# full Unicode rules, or the start of a special token's name.
_UNUSUAL = re.compile("[\u0130\u0180-\U0010ffff]")
_LETTERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f"
_DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PLAIN_WORDS = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]"
                          f"|[^{_LETTERS}{_DIGITS}\\t-\\r \x85\xa0]+")
_SIGN_BEFORE_STOP = re.compile(f"[^{_LETTERS}{_DIGITS}\\t-\\r \x85\xa0][.,]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _unusual(text: str) -> bool:
    return "<|" in text or _UNUSUAL.search(text) is not None


def plain_words(text: str) -> list[str]:
    """Words of text without unusual characters."""
    return _PLAIN_WORDS.findall(text.lower())


class WordSplit:
    """Words of text with unusual characters, by the file's own normal form and split rules.

    Unicode tables differ between libraries and releases, so these rare chunks
    ask the tokenizer itself; it names each byte by a letter.
    """

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self._normal, self._split = tokenizer.normalizer, tokenizer.pre_tokenizer
        letters = byte_letters()
        self._byte = {c: b for b, c in enumerate(letters)}
        self._letter = {b: c for b, c in enumerate(letters) if chr(b) != c}

    def spelled(self, word: str) -> str:
        """A word as the model reads it, one letter per byte."""
        return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self._letter)

    def words(self, text: str) -> list[str]:
        found = self._split.pre_tokenize_str(self._normal.normalize_str(text))
        return [bytes(map(self._byte.__getitem__, w)).decode() for w, _ in found]


class WordBpe:
    """A vocabulary file of words that end in ``</w>``, its merges and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        letters = byte_letters()
        self._inner = np.array([vocab[c] for c in letters], np.int64)
        self._final = np.array([vocab[c + end] for c in letters], np.int64)
        self._width = len(self.names)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self._width + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order.astype(np.int32)
        self._made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def segments(self, text: str) -> list[str]:
        """Text cut at special tokens, which keep their own places."""
        return self._cut.split(text) if self._cut else [text]

    def encode_words(self, words: Sequence[str]) -> list[bytes]:
        """Ids of each word as little-endian int32.

        All symbols of all words lie in one flat array. In a round every word
        merges all places of its lowest-ranked pair, left to right; words
        without a known pair leave the array.
        """
        raw = [w.encode() for w in words]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self._inner[flat]
        ends = np.cumsum(length) - 1
        some = length > 0
        sym[ends[some]] = self._final[flat[ends[some]]]
        word = np.repeat(np.arange(len(raw)), length)
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            rank = np.full(len(sym), _NONE, np.int32)
            rank[:-1] = self._rank(sym[:-1], sym[1:])
            rank[first[1:] - 1] = _NONE
            best = np.minimum.reduceat(rank, first)
            counts = np.diff(np.r_[first, len(sym)])
            lowest = np.repeat(best, counts)
            done = lowest == _NONE
            done_sym.append(sym[done])
            done_word.append(word[done])
            hit = np.flatnonzero((rank == lowest) & ~done)
            if not len(hit):
                break
            # Neighbouring hits are a run of one symbol: every second one merges.
            run = np.r_[True, hit[1:] != hit[:-1] + 1]
            offset = np.arange(len(hit)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            hit = hit[offset % 2 == 0]
            sym[hit] = self._made[rank[hit]]
            keep = ~done
            keep[hit + 1] = False
            sym, word = sym[keep], word[keep]
        ids = np.concatenate(done_sym) if done_sym else np.empty(0, np.int64)
        of = np.concatenate(done_word) if done_word else np.empty(0, np.int64)
        order = np.argsort(of, kind="stable")
        data = ids[order].astype("<i4").tobytes()
        cuts = np.r_[0, np.cumsum(np.bincount(of, minlength=len(raw)))] * 4
        return [data[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self._width + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NONE).astype(np.int32)

    def decode(self, ids: Sequence[int]) -> str:
        """Names of the ids joined by one space; the file names no decoder. Unknown ids are left out."""
        names = self.names
        return " ".join([names[i] for i in ids if 0 <= i < len(names) and names[i]])


class ChunkEncoder(dict):
    """Ids of texts, chunk by chunk; the dictionary holds the packed ids of each chunk met.

    A chunk is a run without ASCII white space. No word reaches over white
    space, so chunks stand on their own. Stops and commas are set apart first
    where no other sign precedes one, so most chunks are plain words.
    ``words`` encodes a list of words, ``special`` lists the words of a chunk
    with unusual characters, special tokens given as packed ids. With ``batch``
    all new chunks of a group of texts are worked out together, else one by
    one. The dictionary is emptied when it is full.
    """

    def __init__(self, words: Callable[[Sequence[str]], list[bytes]],
                 special: Callable[[str], list[str | bytes]], batch: bool, limit: int = 600_000):
        super().__init__()
        self._words, self._special, self._batch, self._limit = words, special, batch, limit

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Packed ids of each text; none for null."""
        out = []
        for group in _groups(texts):
            lists = [_chunks(t) for t in group]
            if self._batch:
                wanted = set(chain.from_iterable(lists))
                missing = wanted - self.keys()
                if len(missing) + len(self) > self._limit:
                    self.clear()
                    missing = wanted
                self._fill(list(missing))
            elif len(self) > self._limit:
                self.clear()
            out += [b"".join(map(self.__getitem__, chunks)) for chunks in lists]
        joined, at = [], 0
        for t in texts:
            n = len(_pieces(t))
            joined.append(out[at] if n == 1 else b"".join(out[at:at + n]))
            at += n
        return joined

    def _split(self, chunk: bytes) -> list[str | bytes]:
        text = chunk.decode()
        return self._special(text) if _unusual(text) else plain_words(text)

    def _fill(self, chunks: list[bytes]) -> None:
        lists = [self._split(c) for c in chunks]
        words = list({w for ws in lists for w in ws if isinstance(w, str)})
        of = dict(zip(words, self._words(words)))
        for c, ws in zip(chunks, lists):
            self[c] = b"".join([of[w] if isinstance(w, str) else w for w in ws])

    def __missing__(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # ASCII letters
            value = self[chunk] = self._words([chunk.decode().lower()])[0]
            return value
        words = self._split(chunk)
        plain = iter(self._words([w for w in words if isinstance(w, str)]))
        value = self[chunk] = b"".join([next(plain) if isinstance(w, str) else w for w in words])
        return value


def _chunks(text: str) -> list[bytes]:
    if _unusual(text):
        return text.encode().split()
    text = text.lower()
    if not _SIGN_BEFORE_STOP.search(text):
        text = text.replace(".", " .").replace(",", " ,")
    return text.encode().split()


def _pieces(text: str | None) -> list[str]:
    """A very long text cut at white space, so that the work on it stays bounded."""
    if not text or len(text) <= _PIECE_BYTES:
        return [text or ""]
    parts, at = [], 0
    while at < len(text):
        space = re.compile(r"[\x20\x09-\x0D]").search(text, at + _PIECE_BYTES)
        end = space.end() if space else len(text)
        parts.append(text[at:end])
        at = end
    return parts


def _groups(texts: Sequence[str | None]) -> Iterator[list[str]]:
    group, size = [], 0
    for piece in chain.from_iterable(map(_pieces, texts)):
        group.append(piece)
        size += len(piece)
        if size >= _PIECE_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(maxsize=2)
def load(path: str) -> tuple[WordBpe, ChunkEncoder]:
    """Vocabulary and encoder of a file, kept for the life of the Python worker."""
    bpe, split = WordBpe(path), WordSplit(path)

    def special(text: str) -> list[str | bytes]:
        out: list[str | bytes] = []
        for part in bpe.segments(text):
            if part in bpe.special:
                out.append(np.array([bpe.special[part]], "<i4").tobytes())
            else:
                out += split.words(part)
        return out

    return bpe, ChunkEncoder(bpe.encode_words, special, batch=True)


def _id_lists(encoded: Sequence[bytes]) -> pa.Array:
    sizes = np.fromiter((len(e) // 4 for e in encoded), np.int64, len(encoded))
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    values = np.frombuffer(b"".join(encoded), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def encode(df: DataFrame, text: str, path: str, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Append the token ids of each text, and with ``decoded`` the text those ids decode to.

    Null and empty texts have no ids and decode to empty text. Every row is
    encoded on its own, so ties and repeated rows need no rule; an empty table
    gives an empty one. Input columns named like an output are replaced.
    """
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))

    def make():
        bpe, encoder = load(path)

        def work(texts):
            encoded = encoder.encode(texts)
            arrays = [_id_lists(encoded)]
            if decoded:
                arrays.append(pa.array([bpe.decode(np.frombuffer(e, "<i4").tolist()) for e in encoded], pa.string()))
            return arrays

        return work

    return map_text(df, text, make, fields, limit=1 << 20)


def decode(df: DataFrame, ids: str, path: str, text: str = "decoded") -> DataFrame:
    """Append the text each list of ids decodes to; a null list gives empty text."""
    source = df.select(*[quoted(c) for c in without(df, text)])
    at, columns = source.columns.index(ids), [*source.columns, text]

    def run(batches):
        bpe, _ = load(path)
        for batch in batches:
            lists = batch.column(at).to_pylist()
            texts = pa.array([bpe.decode([i for i in x or [] if i is not None]) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], columns)

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(text, T.StringType())]))
