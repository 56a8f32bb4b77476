"""Token ids of whole texts from the tokenizers library, which is called once per distinct piece a worker meets.

A piece is a run of a text that the library splits off anyway, so ids of a text are the ids of its pieces, joined:

* vocabularies that drop white space: pieces are what stands between spaces and line feeds;
* byte-level vocabularies that keep it: a text is cut before every space that a non-space follows. The splitting pattern
  ends a token there whatever stands on the left, and has no look-behind. Where every space and line feed stands alone, a
  line feed is a token of its own, so lines are cut as well.

No special string holds white space, so none is cut. Vocabularies of any other kind get whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Callable

#: Distinct pieces a worker remembers in each of two generations.
REMEMBERED = 200_000
#: Longer pieces are encoded each time; they seldom come again and would fill the memory.
LONGEST_KEPT = 64

_ODD_SPACE = re.compile(r"[ \n]\s")
_BEFORE_WORD = re.compile(r"(?= \S)")
#: Letters (after a space, where that is kept), then marks other than the apostrophe, which starts tokens of its own.
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_WORKER: dict = {}


def vocabulary_text(path: str) -> str:
    """The vocabulary file as text, read on the driver and shipped with the task: workers need no copy of the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def kept_spaces(vocabulary: str) -> bool | None:
    """True: byte level with white space kept; False: white space dropped; None: unknown kind, so no pieces."""
    rules = json.loads(vocabulary)
    before = rules.get("pre_tokenizer") or {}
    special = [t for t in rules.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"])]
    if special or rules.get("post_processor"):
        return None
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not rules.get("normalizer"):
        return True
    parts = before.get("pretokenizers", [])
    if parts and parts[0].get("type") == "Split" and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and r"[^\s" in parts[0]["pattern"].get("Regex", ""):
        return False
    return None


class Memory(dict):
    """What ``make`` gave for a key, for the keys met last: two generations of at most ``size`` keys each."""

    def __init__(self, make: Callable, size: int = REMEMBERED):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        return self.put(key, self.make(key) if value is None else value)

    def put(self, key, value):
        if not isinstance(key, str) or len(key) <= LONGEST_KEPT:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_letters() -> dict[int, str]:
    """Byte-level spelling of each character up to U+00FF: its UTF-8 bytes, the unprintable ones moved up from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    spelt = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(spelt[b] for b in chr(c).encode()) for c in range(256)}


class Pieces:
    """Splits texts into pieces and encodes them.

    Most pieces are Latin-1 letters with ASCII marks behind, which are two tokens of the splitting pattern at most; each
    goes straight to the library's merge model. All other pieces take the library's whole path. ``remembered`` pieces and
    ``words`` (the same without marks) are kept in each of two generations.
    """

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED, words: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.spaces = kept_spaces(vocabulary)
        self._library = Tokenizer.from_str(vocabulary)
        self._library.no_truncation()
        self._library.no_padding()
        self._merge, self._spelt = self._library.model.tokenize, byte_letters()
        self.size = self._library.get_vocab_size(with_added_tokens=True)
        self._word = Memory(lambda word: packed([t.id for t in self._merge(word.translate(self._spelt))]), words)
        self.packed = Memory(self._packed, remembered)

    def ids_of(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def _packed(self, piece: str) -> bytes:
        plain = _PLAIN.fullmatch(piece)
        if plain is None or self.spaces is None:
            return packed(self.ids_of(piece))
        word, marks = plain.groups()
        return self._word[word if self.spaces else word.lower()] + (self._word[marks] if marks else b"")

    def split(self, text: str) -> list[str]:
        if self.spaces is None or not text:
            return [text] if text else []
        if not self.spaces:
            return [p for p in text.replace("\n", " ").split(" ") if p]
        if _ODD_SPACE.search(text) or text[0].isspace() or text[-1].isspace():
            return _BEFORE_WORD.split(text)
        found: list[str] = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            found += ["\n", first, *[" " + p for p in rest]]
        return found[1:]

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.split(text)))


def on_worker(vocabulary: str, remembered: int = REMEMBERED, words: int = REMEMBERED) -> Pieces:
    """One ``Pieces`` per vocabulary, sizes and worker process, kept from task to task."""
    key = hashlib.sha256(vocabulary.encode()).digest(), remembered, words
    if key not in _WORKER:
        _WORKER[key] = Pieces(vocabulary, remembered, words)
    return _WORKER[key]
