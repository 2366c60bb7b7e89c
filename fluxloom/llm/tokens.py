"""Token ids of whole texts, by words a worker remembers."""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np

#: Distinct words, alone or with the signs beside them, whose ids a worker remembers, over its tasks, and characters of text looked up in one go.
REMEMBERED, AT_ONCE = 1_000_000, 4 << 20

# How the word tokenizer prepares a text before it joins letters.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_ENCODERS: dict[str, Encoder] = {}


def _kind(of: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0xA1, 0x180) if unicodedata.category(chr(c))[0] == of)


#: Texts of these characters alone change neither under NFC nor, but for their case, under any of the steps above: each is
#: one character in lower case, too. All others go through the tokenizer whole.
PLAIN = re.compile("[\x09-\x0d\x20-\x7e\xa1-įı-ſ]*")
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_kind('L')}]+|[0-9{_kind('N')}]|[^\\x09-\\x0d a-z{_kind('L')}0-9{_kind('N')}]+")


def _byte_letters() -> list[str]:
    """The letter a byte-level model has for each byte: itself where it can be seen, else the next one beyond Latin-1."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + others.index(b)) for b in range(256)]


LETTERS = _byte_letters()


class Remembered(dict):
    """The ids of what stands between spaces, and of the words in it; worked out where it is asked for first."""

    def __init__(self, model):
        self.model = model

    def word(self, word: str) -> bytes:
        found = self.get(word)
        if found is None:
            shown = word if word.isascii() else "".join(map(LETTERS.__getitem__, word.encode()))
            ids = [t.id for t in self.model.tokenize(shown)]
            found = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        words, before = WORDS.findall(chunk), len(self)
        found = b"".join(map(self.word, words))
        # What holds a word met for the first time is seldom met again.
        if len(self) == before:
            self[chunk] = found
        return found


class Encoder:
    """A tokenizer and the ids of the words this worker has met, as little-endian 32-bit integers.

    The ids are those of the tokenizers library without special tokens. No
    token crosses a word, so where the tokenizer prepares texts in the way
    told above, a plain text is cut at its spaces, which no word crosses, only
    what was not met before is cut into words, and only words not met before
    go to the library's model.
    """

    def __init__(self, path: str):
        # Spark's tasks already use every core; threads inside one would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as held:
            told = json.load(held)
        steps = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_words = (
            (told.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and (steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) == ({"Regex": PATTERN}, "Removed", True)
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        )
        special = [t["content"] for t in told.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda text: None
        self.size = self.tokenizer.get_vocab_size()
        self.remembered = Remembered(self.tokenizer.model)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        plain = [self.by_words and PLAIN.fullmatch(t) and not self.special(t) for t in texts]
        get = self.remembered.__getitem__
        return [b"".join(map(get, t.lower().split())) if p else self.whole(t) for t, p in zip(texts, plain, strict=True)]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(rows: Iterable[tuple], path: str, most: int = AT_ONCE) -> Iterator[tuple]:
    """Rows ``(…, text)`` as ``(…, ids)``, in their order; NULL reads as the empty text."""
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += len(row[-1] or "")
        if chars > most:
            yield from ((*r[:-1], i) for r, i in zip(held, encoder(path).ids([r[-1] or "" for r in held]), strict=True))
            held, chars = [], 0
    if held:
        yield from ((*r[:-1], i) for r, i in zip(held, encoder(path).ids([r[-1] or "" for r in held]), strict=True))
