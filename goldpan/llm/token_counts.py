"""Token counts without token ids.

Inside each task the texts are split into chunks at ASCII white space, which no pre-token crosses; the pieces of a
chunk's pre-tokens are counted once, when it first comes up, and joined to the chunk frequencies of every
document that follows. No ids are made and nothing is shuffled. The table of counts stays with the Python process, so
that a task begins with what earlier tasks of its worker have met; it holds at most ``most_cached`` chunks
and as many pre-tokens of other characters than ASCII, and starts anew beyond that, which bounds memory and changes no count.

The vocabulary is the word-ending BPE of a ``tokenizers`` file: texts are composed (NFC) and lower-cased,
then split into contractions, runs of letters, single digits and runs of other marks. Special
strings inside a text count as one token each, as the library has it by default.

Defined results: a null or empty text has no bytes and no tokens; repeated rows are counted
each; other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable
from itertools import chain
from operator import mul
from unicodedata import is_normalized, normalize

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.llm.common import id_and_text, per_document
from goldpan.llm.encoding import load, lower_chunks

_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_NOT_PRINTABLE = re.compile(rb"[^\x21-\x7e]")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text without special strings."""
    if text.isascii():
        return re.findall(_CONTRACTIONS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+", text.lower(), re.ASCII)
    if not is_normalized("NFC", text):
        text = normalize("NFC", text)
    lower = text.replace("Σ", "σ").lower()  # one letter at a time: no final sigma
    return regex.findall(_CONTRACTIONS + r"|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+", lower)


class PieceCounts(dict):
    """Chunk to its number of pieces, as the file's tokenizer cuts it."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # every core has a task of its own
        self.tokenizer = load(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = re.compile(b"|".join(map(re.escape, self.special))) if self.special else None
        self.others: dict[str, int] = {}  # pre-tokens of other characters than printable ASCII

    def learn(self, chunks: list[bytes], most_cached: int) -> None:
        """Count the pieces of new chunks, all new pre-tokens for the library at once."""
        tokenize = self.tokenizer.model.tokenize
        waiting = {}
        for chunk in chunks:
            if chunk.isalpha():  # a-z alone: one pre-token
                self[chunk] = len(tokenize(chunk.decode("ascii").lower()))
            elif _NOT_PRINTABLE.search(chunk):
                waiting[chunk] = pre_tokens(chunk.decode("utf-8"))
            else:
                self[chunk] = sum(len(tokenize(p)) for p in pre_tokens(chunk.decode("ascii")))
        others = self.others
        new = [p for p in dict.fromkeys(chain.from_iterable(waiting.values())) if p not in others]
        if len(others) + len(new) > most_cached:
            others.clear()
            new = list(dict.fromkeys(chain.from_iterable(waiting.values())))
        if new:
            encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            others.update(zip(new, map(len, encoded), strict=True))
        for chunk, found in waiting.items():
            self[chunk] = sum(map(others.__getitem__, found))


_REMEMBERED: dict[str, PieceCounts] = {}


def counter(tokenizer_path: str, most_cached: int) -> Callable[[bytes], tuple]:
    if tokenizer_path not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[tokenizer_path] = PieceCounts(tokenizer_path)
    known = _REMEMBERED[tokenizer_path]
    special, split = known.special, known.split

    def run(raw: bytes) -> tuple:
        total, parts = 0, [raw]
        if split and any(s in raw for s in special):
            parts = split.split(raw)
            total = len(parts) - 1
        often: Counter[bytes] = Counter()
        for part in parts:
            often.update(lower_chunks(part))
        new = [c for c in often if c not in known]
        if new:
            if len(known) + len(new) > most_cached:
                known.clear()
                new = list(often)
            known.learn(new, most_cached)
        return len(raw), total + sum(map(mul, map(known.__getitem__, often), often.values()))

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, most_cached: int = 1_000_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the document has more than ``limit`` tokens."""
    counted = per_document(
        id_and_text(docs), "n_bytes long, n_tokens long", lambda: counter(tokenizer_path, most_cached)
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
