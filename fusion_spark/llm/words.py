"""Helpers that run inside a task: batches of rows, byte tables, encoders with a word cache."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from tokenizers import Tokenizer

CACHE_WORDS = 600_000  # bounds a worker's memory; beyond it the cache starts afresh


def slices(batches: Iterable[pa.RecordBatch], most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a slice holds about ``most`` bytes, however long its texts are."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, int(batch.num_rows * most / max(batch.nbytes, most)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if text is None else text for text in batch.column(column).to_pylist()]


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte value."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {value: chr(value) for value in printable}
    rest = (value for value in range(256) if value not in table)
    table.update({value: chr(256 + place) for place, value in enumerate(rest)})
    return table


def latin_pattern(pattern: str) -> str:
    """``pattern`` for the ``re`` module, good for texts of code points below 256.

    The classes that ``re`` lacks or reads otherwise are spelled out.
    """
    latin = [chr(point) for point in range(256)]
    members = {
        name: "".join(re.escape(c) for c in latin if regex.match(name, c))
        for name in (r"\p{L}", r"\p{N}", r"\s")
    }
    out, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\.|\[|\])", pattern):
        inside = part == "[" or inside and part != "]"
        if part in members:
            part = members[part] if inside else f"[{members[part]}]"
        elif part == r"\S":
            part = f"[^{members[r'\s']}]"
        out.append(part)
    return "".join(out)


class _Known(dict):
    """Ids of each word as bytes; a new word is encoded when it is first asked for.

    The word's UTF-8 bytes become characters of the byte alphabet, which the tokenizer's
    model merges.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.merge, self.alphabet = tokenizer.model.tokenize, byte_alphabet()

    def __missing__(self, word: str) -> bytes:
        mapped = word.encode("utf-8").decode("latin-1").translate(self.alphabet)
        ids = array("I", [token.id for token in self.merge(mapped)])
        self[word] = code = ids.tobytes()
        return code


class WordEncoder:
    """Token ids of whole texts, each match of ``pattern`` encoded by itself.

    Matches repeat, so their ids are kept: the tokenizer sees each new match once. A text
    that holds an added token of the tokenizer, such as ``<|endoftext|>``, is encoded by the
    tokenizer itself, which gives that token its own id.
    """

    def __init__(self, model: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(model)
        self.known = _Known(self.tokenizer)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.find_added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
        self.find = regex.compile(pattern).findall
        self.find_latin = re.compile(latin_pattern(pattern)).findall

    @classmethod
    def of(cls, shared: dict) -> WordEncoder:
        """The encoder of a broadcast ``{"model": ..., "pattern": ...}``.

        It is made once per Python worker, which keeps it and what it knows for later tasks.
        """
        if "encoder" not in shared:
            shared["encoder"] = cls(shared["model"], shared["pattern"])
        return shared["encoder"]

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit numbers in native (little-endian) order."""
        if self.find_added(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return array("I", ids).tobytes()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        try:
            text.encode("latin-1")
            find = self.find_latin
        except UnicodeEncodeError:
            find = self.find
        return b"".join(map(self.known.__getitem__, find(text)))
