"""Texts to token ids, each distinct chunk encoded once while it is remembered.

A chunk is what ASCII white space separates. For a tokenizer that drops white space and normalises
character by character (its file is checked for that) the ids of a text are those of its chunks, one
after the other. So that few chunks differ, ASCII letters are lower-cased first, unless a combining mark
might join one of them, and an ASCII mark other than the apostrophe that follows a letter or digit begins a chunk of its own. The
chunks of many texts are one Arrow column: only the distinct ones become Python objects and are looked up. A chunk of
printable ASCII is split here, and its pre-tokens go to the file's model; every other chunk goes to
the library whole, all new ones of a call at once, in one text where a mark that none of them has can stand between them.
With any other tokenizer whole texts do.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, chain, islice, repeat

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from goldpan.llm.common import runs

# The parts of a tokenizer file under which chunks can be encoded apart.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_NOT_PRINTABLE = re.compile(rb"[^\x21-\x7e]")
_COMBINING = re.compile(rb"\xcc|\xcd[\x80-\xaf]")  # U+0300 to U+036F, the marks that compose with ASCII letters
_WORD_END = re.compile(rb"[,.](?=[ \n])(?<=[a-z0-9].)")
_SPACE, _LETTER_OR_DIGIT, _MARK = (
    np.isin(np.arange(256), list(b))
    for b in (b"\t\n\v\f\r ", b"abcdefghijklmnopqrstuvwxyz0123456789", b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
)
_BETWEEN = "!"  # stands between chunks that the library encodes together
_TOGETHER = 500  # chunks


def load(path: str) -> Tokenizer:
    """The tokenizer, without truncation or padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def splits_at_spaces(path: str) -> bool:
    """Whether the file's normaliser and pre-tokeniser are those that chunks rely on."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return (
        spec["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZERS}
        and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": _PRE_TOKENIZERS}
        and spec["model"]["type"] == "BPE"
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
        and not any(re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    )


def _lowers(text: bytes, special: Sequence[bytes]) -> bool:
    """Whether lower-casing the ASCII letters changes no pre-token."""
    if (b"\xcc" in text or b"\xcd" in text) and _COMBINING.search(text):
        return False
    lower = text.lower()  # A-Z alone
    return not any(s in lower for s in special)


def lower_chunks(text: bytes, special: Sequence[bytes] = ()) -> list[bytes]:
    """Chunks of one text, with ASCII letters lower-cased where that changes no pre-token; of the marks, commas and full stops before white space are apart."""
    return (_WORD_END.sub(rb" \g<0>", text.lower()) if _lowers(text, special) else text).split()


def column_of_chunks(texts: list[bytes], special: Sequence[bytes] = ()) -> tuple[pa.Array, np.ndarray]:
    """The chunks of some texts one after the other, and how many each text has; lower-cased as ``lower_chunks`` are."""
    lowers = np.fromiter((_lowers(t, special) for t in texts), bool, len(texts))
    ended = [t.lower() if low else t for t, low in zip(texts, lowers.tolist(), strict=True)]
    joined = np.frombuffer(b"\n".join([*ended, b""]), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    in_chunk = ~_SPACE[joined]
    begins = in_chunk.copy()
    begins[1:] &= ~in_chunk[:-1]
    marks = 1 + np.flatnonzero(_MARK[joined[1:]] & _LETTER_OR_DIGIT[joined[:-1]])
    if not lowers.all():
        marks = marks[lowers[np.searchsorted(ends, marks, "right")]]
    begins[marks] = True
    at, column = runs(joined, in_chunk, begins)
    return column, np.diff(np.searchsorted(at, ends), prepend=0)


class ChunkIds(dict):
    """Chunk to the number of its entry in ``pool``."""

    def __init__(self, path: str, most_chunks: int):
        super().__init__()
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters_are_plain = not any(s.isalpha() for s in self.special)
        self.most_chunks = most_chunks
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.pool, self.ends = array("I"), array("q", [0])

    def entries(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all chunks of some texts, where the ids of each begin and end in ``pool``; how many chunks each text has."""
        column, counts = column_of_chunks(texts, self.special)
        coded = column.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        entry = np.fromiter(map(self.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(entry < 0)
        entry[new] = self.learn(distinct[new].tolist())
        ends, chunk = np.frombuffer(self.ends, np.int64), coded.indices.to_numpy()
        return ends[entry][chunk], ends[entry + 1][chunk], counts

    def learn(self, chunks: list[bytes]) -> range:
        """Make entries of chunks that have none; their numbers."""
        tokenize = self.model.tokenize
        found, waiting = [], []
        for i, chunk in enumerate(chunks):
            if self.letters_are_plain and chunk.isalpha():  # A-Z and a-z alone: one pre-token
                found.append([t.id for t in tokenize(chunk.lower().decode("ascii"))])
            elif _NOT_PRINTABLE.search(chunk) or any(s in chunk for s in self.special):
                waiting.append(i)
                found.append(())
            else:
                found.append([t.id for word in _ASCII_PIECES.findall(chunk.decode("ascii").lower()) for t in tokenize(word)])
        for i, ids in zip(waiting, self.encoded([chunks[i].decode("utf-8") for i in waiting]), strict=True):
            found[i] = ids
        numbers = range(len(self.ends) - 1, len(self.ends) - 1 + len(chunks))
        self.update(zip(chunks, numbers, strict=True))
        self.ends.extend(islice(accumulate(map(len, found), initial=len(self.pool)), 1, None))
        self.pool.extend(chain.from_iterable(found))
        return numbers

    def encoded(self, chunks: list[str]) -> list[Sequence[int]]:
        """The ids of chunks, by the library: some hundred in a text, with a mark between them that it makes one id of."""
        encode = self.tokenizer.encode_batch_fast
        apart = [c for c in chunks if _BETWEEN in c]
        found = dict(zip(apart, (e.ids for e in encode(apart, add_special_tokens=False)), strict=True)) if apart else {}
        together = [c for c in chunks if _BETWEEN not in c]
        groups = [together[i : i + _TOGETHER] for i in range(0, len(together), _TOGETHER)]
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        for group in groups:
            ids = encode([f" {_BETWEEN} ".join(group)], add_special_tokens=False)[0].ids
            at = np.flatnonzero(np.array(ids) == between[0]).tolist()
            if len(between) == 1 and len(at) == len(group) - 1:
                found.update((c, ids[a + 1 : b]) for c, a, b in zip(group, [-1, *at], [*at, len(ids)], strict=True))
            else:
                found.update(zip(group, (e.ids for e in encode(group, add_special_tokens=False)), strict=True))
        return [found[c] for c in chunks]


_REMEMBERED: dict[str, ChunkIds] = {}


class Encoder:
    """Lists of UTF-8 texts to lists of their ids.

    What is remembered stays with the Python process, so that a task begins with what earlier tasks of
    its worker have met. It is bounded and starts anew beyond that, which changes no id.
    """

    def __init__(self, path: str, most_chunks: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # every core has a task of its own
        self.by_chunk = splits_at_spaces(path)
        if self.by_chunk:
            if path not in _REMEMBERED:
                _REMEMBERED.clear()
                _REMEMBERED[path] = ChunkIds(path, most_chunks)
            self.known = _REMEMBERED[path]
        else:
            self.tokenizer = load(path)

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_chunk:
            encode = self.tokenizer.encode
            return [np.array(encode(t.decode("utf-8"), add_special_tokens=False).ids, np.uint32) for t in texts]
        if not texts:
            return []
        known = self.known
        if len(known) > known.most_chunks:
            known.forget()
        start, end, counts = known.entries(texts)
        total = np.append(0, np.cumsum(end - start))
        pool = np.frombuffer(known.pool, np.uint32) if known.pool else np.empty(0, np.uint32)
        places = np.repeat(start - total[:-1], end - start)
        places += np.arange(total[-1])
        ids = pool[places]
        return np.split(ids, total[np.cumsum(counts)[:-1]])


def stretches(texts: list[bytes], most_bytes: int = 1 << 23) -> Iterator[tuple[int, int]]:
    """First and last row (exclusive) of runs of texts of about ``most_bytes``; a longer text is alone."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > most_bytes:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def encoder(path: str) -> Callable[[], Encoder]:
    return lambda: Encoder(path)
